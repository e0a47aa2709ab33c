"""Adjustment-factor job: store change events, extend the dense daily table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DateLike, as_date
from ..operators.merge import KEEP, MONTH, NOW, OVERWRITE, dedup_last, merge_keyed, merge_touched, partition_unit
from ..operators.merge import touched as touched_days
from ..operators.series import densify
from ..session import staged
from ..sources.files import require_columns

FACTORS = ("fore_factor", "back_factor", "adjust_factor")
FACTOR_RULES = {**{f: OVERWRITE for f in FACTORS}, "created_at": KEEP, "updated_at": NOW}


def store_events(raw: DataFrame, events: DataFrame, now: dt.datetime, order: str, touched: str | None = None) -> DataFrame:
    """Upsert change events (code, date, factors); repeated (code, date) rows keep the last by ``order``.

    Rows that tie in ``order`` too keep the greatest factors. ``touched`` returns only the whole months (or, if it is
    ``"day"``, days) of the events.
    """
    require_columns(events, ["code", "date", *FACTORS, order], "factor events")
    last = dedup_last(events, ["code", "date"], [order, *FACTORS])
    batch = last.select("code", F.col("date").cast("date").alias("trade_date"), *FACTORS)
    return merge_touched(raw, batch, ["code", "trade_date"], FACTOR_RULES, "trade_date", partition_unit(touched), now=now)


def recompute_ranges(
    targets: DataFrame, events: DataFrame, dense: DataFrame, as_of: DateLike
) -> DataFrame:
    """Per target, the days to (re)compute.

    Without dense history, or when the target starts before the last dense day, the whole
    target range. Otherwise from the earlier of the first change in this batch and the day
    after the last dense day, so that no open day between the two is left out.
    """
    first_change = events.groupBy("code").agg(F.min(F.col("date").cast("date")).alias("_change"))
    last_dense = dense.groupBy("code").agg(F.max("trade_date").alias("_last"))
    start = F.col("start_date").cast("date")
    next_day = F.date_add(F.col("_last"), 1)
    resume = F.greatest(start, F.least(F.col("_change"), next_day))
    return (
        targets.where(start <= F.col("end_date").cast("date"))
        .join(first_change, "code", "left")
        .join(last_dense, "code", "left")
        .select(
            "code",
            F.when(F.col("_last").isNull() | (start < F.col("_last")), start).otherwise(resume).alias("from_date"),
            F.least(F.col("end_date").cast("date"), F.lit(as_date(as_of))).alias("to_date"),
        )
        .where(F.col("from_date") <= F.col("to_date"))
    )


def dense_rows(
    targets: DataFrame, events: DataFrame, raw: DataFrame, dense: DataFrame, calendar: DataFrame, as_of: DateLike
) -> DataFrame:
    """The daily factor rows this run has to write, from the events already in ``raw``."""
    ranges = recompute_ranges(targets, events, dense, as_of)
    return densify(ranges, raw, calendar, values=FACTORS)


def run_factors(
    targets: DataFrame,
    events: DataFrame,
    raw: DataFrame,
    dense: DataFrame,
    calendar: DataFrame,
    *,
    as_of: DateLike,
    now: dt.datetime,
    order: str,
    touched: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(new raw table, new dense table). Both are plans; writing them is one commit.

    The days to compute are intervals of single codes, one row per target, and written once. Stored
    rows inside them are merged; all others of the table, or with ``touched`` of the months (days) that
    some interval touches, pass by without a shuffle. With ``touched`` no other month is read:
    a code that is backfilled far into the past adds its own months, not the time in between.
    """
    new_raw = store_events(raw, events, now, order)
    ranges = staged(recompute_ranges(targets, events, dense, as_of), "factor-ranges")
    # A few rows on disk, but each becomes all its open days: not the work of one task.
    spread = ranges.repartition(int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")), "code")
    rows = densify(spread, new_raw, calendar, values=FACTORS)
    unit = partition_unit(touched)
    scope = dense.where(touched_days(_days_of(ranges, unit), "trade_date", unit=unit)) if unit and ranges.take(1) else dense
    scope = scope.limit(0) if unit and scope is dense else scope
    spans = F.broadcast(ranges.select(F.col("code").alias("_code"), "from_date", "to_date"))  # one row per target
    within = (F.col("code") == F.col("_code")) & F.col("trade_date").between(F.col("from_date"), F.col("to_date"))
    merged = merge_keyed(scope.join(spans, within, "left_semi"), rows, ["code", "trade_date"], FACTOR_RULES, now=now)
    stored_raw = store_events(raw, events, now, order, touched) if unit else new_raw
    return stored_raw, scope.join(spans, within, "left_anti").unionByName(merged)


def _days_of(ranges: DataFrame, unit: str) -> DataFrame:
    """The days, or for months the first day of each, that some interval touches; about 1,200 months a century."""
    first, last = (F.trunc(c, "month") if unit == MONTH else F.col(c) for c in ("from_date", "to_date"))
    step = F.expr("INTERVAL 1 MONTH" if unit == MONTH else "INTERVAL 1 DAY")
    different = ranges.select(first.alias("first"), last.alias("last")).distinct()
    return different.select(F.explode(F.sequence("first", "last", step)).alias("trade_date"))
