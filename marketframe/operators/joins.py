"""Ordered joins that plain equi-joins cannot express, built so that one hot key spreads.

A key's history is cut into time chunks. Each (key, chunk) group is its own window group,
and what the chunk needs from earlier ones is computed from one row per (key, chunk) and
handed in as an extra row. A task therefore holds one chunk of one key, never a whole key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import asof_ranges

Chunk = Callable[[Column], Column]


def by_days(width: int = 366) -> Chunk:
    """Chunk a date (or timestamp) by a fixed number of days."""
    return lambda time: F.floor(F.unix_date(time.cast("date")) / F.lit(width)).cast("int")


def by_seconds(width: int = 600) -> Chunk:
    """Chunk a timestamp by a fixed number of seconds."""
    return lambda time: F.floor(F.unix_micros(time.cast("timestamp")) / F.lit(width * 1_000_000))


def chunks_between(begin: Column, end: Column, chunk: Chunk) -> Column:
    """Every chunk number a closed interval touches, one per row."""
    return F.explode(F.sequence(chunk(begin), chunk(end)))


def tick_of(time: Column, kind: str) -> Column:
    """Integer order of a time column, so that strictness is an exact range offset."""
    if kind == "date":
        return F.unix_date(time)
    return F.unix_micros(time.cast("timestamp"))


def carry_tails(tails: DataFrame, chunks: DataFrame, on: Sequence[str]) -> DataFrame:
    """For each wanted (on, _chunk), the ``_tail`` of the latest earlier chunk that has one.

    Both sides hold one row per key and chunk, and so does the per-key window here.
    """
    wanted = chunks.select(*on, "_chunk", F.lit(True).alias("_wanted"))
    earlier = Window.partitionBy(*on).orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1)
    return (
        tails.unionByName(wanted, allowMissingColumns=True)
        .withColumn("_tail", F.last("_tail", ignorenulls=True).over(earlier))
        .where(F.col("_wanted") & F.col("_tail").isNotNull())
    )


def scan_known(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    chunk: Chunk,
    at_or_before: str | None = "_known",
    strictly_before: str | None = None,
    left_chunks: DataFrame | None = None,
) -> DataFrame:
    """``left`` plus the latest right row as a struct of ``values`` (NULL when none).

    ``right`` must be unique on (on, right_time); ``left`` may repeat a time, but then the
    repeats of one time share a group (see ``asof_join`` for the remedy). ``left_chunks``
    gives the (on, _chunk) pairs of the left side where they are cheaper to list than to
    derive from its rows; extra pairs do no harm.
    """
    on = list(on)
    kind = dict(right.dtypes)[right_time]
    flat = right.where(F.col(right_time).isNotNull() & ~_any_null(on)).select(
        *on,
        tick_of(F.col(right_time), kind).alias("_tick"),
        chunk(F.col(right_time)).alias("_chunk"),
        *[F.col(v).alias(f"_v_{v}") for v in values],
    )
    packed = F.struct(*[F.col(f"_v_{v}").alias(v) for v in values])
    known = flat.select(*on, "_tick", "_chunk", packed.alias("_value"))
    rows = left.withColumns(
        {"_tick": tick_of(F.col(left_time), dict(left.dtypes)[left_time]), "_chunk": chunk(F.col(left_time))}
    )

    tails = flat.groupBy(*on, "_chunk").agg(
        F.max("_tick").alias("_last"), *[F.max_by(f"_v_{v}", "_tick").alias(f"_v_{v}") for v in values]
    ).select(*on, "_chunk", F.struct(F.col("_last").alias("_tick"), packed.alias("_value")).alias("_tail"))
    if left_chunks is None:
        left_chunks = rows.select(*on, "_chunk").distinct()
    carried = carry_tails(tails, left_chunks, on).select(
        *on, "_chunk", F.col("_tail._tick").alias("_tick"), F.col("_tail._value").alias("_value")
    )

    stream = (
        rows.withColumn("_is_left", F.lit(True))
        .unionByName(known, allowMissingColumns=True)
        .unionByName(carried, allowMissingColumns=True)
    )
    group = Window.partitionBy(*on, "_chunk").orderBy("_tick")
    found = {}
    if at_or_before:
        frame = group.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        found[at_or_before] = F.last("_value", ignorenulls=True).over(frame)
    if strictly_before:
        frame = group.rangeBetween(Window.unboundedPreceding, -1)
        found[strictly_before] = F.last("_value", ignorenulls=True).over(frame)
    return stream.withColumns(found).where("_is_left").select(*left.columns, *found)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str] | dict[str, str],
    how: str = "left",
    strict: bool = False,
    chunk: Chunk | None = None,
    left_unique: bool = True,
    left_chunks: DataFrame | None = None,
) -> DataFrame:
    """Latest right row at or before (``strict``: before) each left row, per key.

    ``values`` names the right columns to bring, or maps them to output names. Dates are matched
    by chunks of days; there, with ``left_unique=False``, many left rows may share (key, time): the match
    is computed once per distinct pair and joined back, so a hot pair never has to fit one window group.
    Timestamps are matched by sampled ranges, unless a ``chunk`` is given: no key and no moment has to
    fit one task, and nothing is counted while planning.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported as-of join type: {how}")
    names = values if isinstance(values, dict) else {v: v for v in values}
    clash = set(names.values()) & set(left.columns)
    if clash:
        raise ValueError(f"output columns already on the left side: {sorted(clash)}")
    kind = dict(left.dtypes)[left_time]
    if chunk is None and kind != "date":  # nothing bounds the rows of a time span
        ticks = tick_of(F.col(left_time), kind), tick_of(F.col(right_time), dict(right.dtypes)[right_time])
        return asof_ranges(left, right, on, left_time, right_time, names, how, strict, ticks)
    base = left if left_unique else left.select(*on, left_time).distinct()
    chunk = chunk or by_days()  # a year has at most a row per day
    marks = {"at_or_before": None, "strictly_before": "_known"} if strict else {}
    scanned = scan_known(
        base, right, on, left_time, right_time, list(names), chunk, left_chunks=left_chunks, **marks
    )
    if how == "inner":
        scanned = scanned.where(F.col("_known").isNotNull())
    matched = scanned.select(
        *base.columns, *[F.col("_known")[source].alias(target) for source, target in names.items()]
    )
    return matched if left_unique else left.join(matched, [*on, left_time], how)


def _any_null(columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition
