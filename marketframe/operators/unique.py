"""Repeated keys of dated tables, found without moving all keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]):
    condition = F.lit(True)
    for name in names:
        condition &= left[name].eqNullSafe(right[name])
    return condition


def crowded_months(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """The other keys and _month of every month that holds more rows than different days.

    A month of a code is a count and a mask of the days seen, a bit for each. Both are combined
    before rows move, so what moves is one short row per code, month and task, however many days there are. Rows
    without a day share a month of their own. Exact: no hash is involved.
    """
    others = [k for k in keys if k != day]
    bit = F.when(F.col(day).isNull(), F.lit(1)).otherwise(F.expr(f"shiftleft(1, dayofmonth(`{day}`) - 1)"))
    seen = df.groupBy(*others, F.trunc(day, "month").alias("_month")).agg(F.count(F.lit(1)).alias("_rows"), F.bit_or(bit).alias("_days"))
    return seen.where(F.col("_rows") > F.bit_count("_days")).select(*others, "_month")


def repeated_keys(df: DataFrame, keys: Sequence[str], day: str | None = None) -> DataFrame:
    """Keys that more than one row has, and copies, their number; NULLs count as equal.

    With a date among the keys, only rows of crowded months take part in the exact count; in a
    table without repeats there are none, and Spark does not run the second scan.
    """
    rows = df.select(*keys)
    if day in keys and dict(df.dtypes)[day] == "date":
        months = crowded_months(df, keys, day)
        dated = rows.withColumn("_month", F.trunc(day, "month"))
        names = [*(k for k in keys if k != day), "_month"]
        rows = dated.join(months, _same(dated, months, names), "left_semi").drop("_month")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
