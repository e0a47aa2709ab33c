"""Per-security series: trailing means, suspension filling and as-of densification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .calendar import expand_open_days, open_days
from .joins import Chunk, asof_join, by_days, carry_tails, chunks_between, scan_known


def trailing_mean(
    df: DataFrame,
    key: str,
    day: str,
    value: str,
    rows: int = 5,
    out: str = "trailing_mean",
    chunk: Chunk | None = None,
) -> DataFrame:
    """Mean of up to ``rows`` preceding rows of the same key, current row excluded.

    Returns (key, day, value, out). ``df`` must be unique on (key, day). The window runs per
    (key, chunk); each chunk is preceded by the last ``rows`` rows of the earlier chunks.
    """
    cut = chunk or by_days()
    series = df.select(key, day, value).withColumn("_chunk", cut(F.col(day)))

    # Up to `rows` last rows per chunk; the rank filter limits them before the shuffle.
    newest = Window.partitionBy(key, "_chunk").orderBy(F.col(day).desc())
    tails = (
        series.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= rows)
        .groupBy(key, "_chunk")
        .agg(F.sort_array(F.collect_list(F.struct(day, value))).alias("_tail"))
    )
    # Every non-empty chunk has at least one row, so `rows` chunks back are enough.
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(-rows, -1)
    halo = (
        tails.withColumn("_tail", F.flatten(F.collect_list("_tail").over(earlier)))
        .withColumn("_tail", F.slice("_tail", F.greatest(F.size("_tail") - rows + 1, F.lit(1)), F.lit(rows)))
        .select(key, "_chunk", F.explode("_tail").alias("_row"))
        .select(key, "_chunk", F.col("_row")[day].alias(day), F.col("_row")[value].alias(value))
    )
    before = Window.partitionBy(key, "_chunk").orderBy(day).rowsBetween(-rows, -1)
    return (
        series.withColumn("_own", F.lit(True))
        .unionByName(halo.withColumn("_own", F.lit(False)))
        .withColumn(out, F.avg(value).over(before))
        .where("_own")
        .select(key, day, value, out)
    )


def interval_chunks(intervals: DataFrame, key: str, begin: str, end: str) -> DataFrame:
    """Distinct (key, chunk) pairs of day intervals, without listing their days."""
    valid = intervals.where(F.col(begin) <= F.col(end))
    return valid.select(key, chunks_between(F.col(begin), F.col(end), by_days()).alias("_chunk")).distinct()


def densify(
    intervals: DataFrame,
    events: DataFrame,
    calendar: DataFrame,
    *,
    key: str = "code",
    begin: str = "from_date",
    end: str = "to_date",
    event_day: str = "trade_date",
    values: Sequence[str] = ("fore_factor", "back_factor", "adjust_factor"),
    default: float = 1.0,
    out_day: str = "trade_date",
) -> DataFrame:
    """For every key and open day of its interval, the latest event values on or before it.

    Days before a key's first event, and NULL event values, take ``default``.
    """
    grid = expand_open_days(intervals.select(key, begin, end), begin, end, calendar, "_day").select(
        key, F.col("_day").alias(out_day)
    )
    history = events.select(key, F.col(event_day).alias("_event_day"), *values)
    dense = asof_join(
        grid, history, [key], out_day, "_event_day", list(values),
        left_chunks=interval_chunks(intervals, key, begin, end),
    )
    filled = [F.coalesce(F.col(v), F.lit(default)).alias(v) for v in values]
    return dense.select(key, out_day, *filled)


def fill_suspensions(
    intervals: DataFrame,
    bars: DataFrame,
    calendar: DataFrame,
    *,
    key: str = "code",
    begin: str = "from_date",
    end: str = "to_date",
    day: str = "date",
    status: int | None = None,
) -> DataFrame:
    """Daily bars over the open days of each key's interval, suspended days filled in.

    A day with a bar keeps it and gets the last close before it as pre_close (NULL at the
    first). A day without one repeats the last close at zero volume and tradestatus 0. Days
    before the first close are left out. Bars before the interval seed the close, whatever
    their day; inside it a bar on a closed day counts for nothing. Intervals are unique on
    the key. ``status`` fixes the status of real bars where the source has none.
    """
    grid = expand_open_days(intervals.select(key, begin, end), begin, end, calendar, "_day").select(
        key, F.col("_day").alias(day)
    )
    own_status = F.lit(status) if status is not None else F.col("tradestatus")
    begins = intervals.select(key, F.col(begin).alias("_begin"))
    opened = open_days(calendar).select(F.col("cal_date").alias(day), F.lit(True).alias("_open")).distinct()
    seen = bars.join(begins, key).join(F.broadcast(opened), day, "left").where((F.col(day) < F.col("_begin")) | F.col("_open"))
    source = seen.select(
        key, F.col(day).alias("_bar_day"), "open", "high", "low", "close", "volume", "amount",
        own_status.cast("int").alias("tradestatus"),
    )
    fields = ["_bar_day", "open", "high", "low", "close", "volume", "amount", "tradestatus"]
    rows = scan_known(
        grid, source, [key], day, "_bar_day", fields, by_days(),
        at_or_before="_bar", strictly_before="_before",
        left_chunks=interval_chunks(intervals, key, begin, end),
    )
    real = F.coalesce(F.col("_bar._bar_day") == F.col(day), F.lit(False))
    last_close = F.col("_before.close")
    price = {p: F.when(real, F.col(f"_bar.{p}")).otherwise(last_close) for p in ("open", "high", "low", "close")}
    return rows.where(real | last_close.isNotNull()).select(
        key,
        day,
        *[expr.alias(name) for name, expr in price.items()],
        last_close.alias("pre_close"),
        F.when(real, F.col("_bar.tradestatus")).otherwise(F.lit(0)).alias("tradestatus"),
        F.when(real, F.col("_bar.volume")).otherwise(F.lit(0).cast("long")).alias("volume"),
        F.when(real, F.col("_bar.amount")).otherwise(F.lit(0.0)).alias("amount"),
    )


def carry_close(
    bars: DataFrame, key: str = "code", day: str = "date", out: str = "pre_close", chunk: Chunk | None = None
) -> DataFrame:
    """Last known close strictly before each bar; ``bars`` must be unique on (key, day).

    Each bar is both a row and a value, so only one row per chunk is added to the series.
    """
    series = bars.drop(out).withColumn("_chunk", (chunk or by_days())(F.col(day)))
    known = series.where(F.col("close").isNotNull())
    tails = known.groupBy(key, "_chunk").agg(F.max_by("close", day).alias("_tail"))
    opening = carry_tails(tails, series.select(key, "_chunk").distinct(), [key])
    before = Window.partitionBy(key, "_chunk").orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    return (
        series.withColumn("_own", F.lit(True))
        .unionByName(opening.select(key, "_chunk", F.col("_tail").alias("close")), allowMissingColumns=True)
        .withColumn(out, F.last("close", ignorenulls=True).over(before))
        .where("_own")
        .drop("_own", "_chunk")
    )
