"""Numeric column helpers; every function maps columns to columns and stays in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NUMBER_CHARACTERS = "0123456789.+-eE"


def round_at(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled binary value.

    ``F.round(x, n)`` rounds the decimal text of a double (1.005 -> 1.01). Stored results
    come from an engine that rounds ``x * 10^n`` (1.005 -> 1.0), so we scale first. Written
    with floor, because rounding a double goes through a decimal object per value; the
    fraction ``size - floor(size)`` is exact. Scaled values of 2^52 and above have no fraction
    left, so they (and infinities) pass unrounded.
    """
    scaled = value.cast("double") * float(10**digits)
    size = F.abs(scaled)
    small = size < float(2**52)
    whole = F.floor(F.when(small, size))
    rounded = whole + (size - whole >= 0.5).cast("long")
    return F.when(small, F.signum(scaled) * rounded / float(10**digits)).otherwise(value.cast("double"))


def to_number(text: Column, dtype: str = "double") -> Column:
    """Parse text such as ``'1,234.50'``; blanks, notes and other non-numbers become NULL.

    The character check keeps out spellings a cast would accept, such as ``1d`` or ``NaN``.
    """
    bare = F.trim(F.translate(text.cast("string"), ",", ""))
    number = F.when(F.translate(bare, _NUMBER_CHARACTERS, "") == "", bare).try_cast("double")
    return number if dtype == "double" else number.try_cast(dtype)


def is_blank(text: Column) -> Column:
    return F.trim(text.cast("string")) == ""


def missing_or_zero(value: Column) -> Column:
    """Audit rule: NULL and 0 both mean absent, negatives are real values."""
    return value.isNull() | (value == 0)


def missing_or_not_positive(value: Column) -> Column:
    return value.isNull() | (value <= 0)


def failing_columns(rules: dict[str, Column]) -> Column:
    """Comma-separated names of the rules that hold on a row, in rule order."""
    return F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in rules.items()])


def any_of(conditions: Iterable[Column]) -> Column:
    combined = F.lit(False)
    for condition in conditions:
        combined = combined | condition
    return combined


def blank_report(df: DataFrame, columns: list[str], code: str, sample: int = 20) -> DataFrame:
    """One row per column that holds blank text: how many cells, how many codes, first codes.

    The rank filter is pushed below the shuffle (window group limit), so no task receives
    more than ``sample`` codes per column from each input partition.
    """
    marks = F.array(*[F.when(is_blank(F.col(c)), F.lit(c)) for c in columns])
    per_code = (
        df.select(F.col(code).alias("code"), F.explode(marks).alias("column_name"))
        .where(F.col("column_name").isNotNull())
        .groupBy("column_name", "code")
        .agg(F.count(F.lit(1)).alias("cells"))
    )
    totals = per_code.groupBy("column_name").agg(
        F.sum("cells").alias("blank_cells"), F.count(F.lit(1)).alias("blank_codes")
    )
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy("code"))
    first = (
        per_code.select("column_name", "code", rank.alias("rank"))
        .where(F.col("rank") <= sample)
        .groupBy("column_name")
        .agg(F.concat_ws(",", F.sort_array(F.collect_list("code"))).alias("first_codes"))
    )
    return totals.join(first, "column_name")
