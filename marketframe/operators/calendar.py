"""Trading-calendar operators.

A calendar has one row per day, so it never exceeds the day count of its range (about
36,500 rows per century). That bound is what allows the broadcasts and the single-task
running windows below; nothing else in the library relies on such a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import DateLike, as_date, between_days

OPEN, CLOSED, UNKNOWN = "open", "closed", "unknown"


def weekday_calendar(df: DataFrame, day: Column) -> DataFrame:
    """Calendar over the day range of ``df``: weekdays open, weekends closed."""
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("cal_date")
    )
    return days.select("cal_date", F.when(F.weekday("cal_date") < 5, 1).otherwise(0).alias("is_open"))


def open_days(calendar: DataFrame, begin: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Open days of a closed range."""
    return calendar.where((F.col("is_open") == 1) & between_days(F.col("cal_date"), begin, end)).select(
        "cal_date"
    )


def last_open_day(calendar: DataFrame, before: DateLike) -> DataFrame:
    """One row: the last open day strictly before ``before`` (NULL when there is none)."""
    earlier = (F.col("is_open") == 1) & (F.col("cal_date") < F.lit(as_date(before)))
    return calendar.where(earlier).agg(F.max("cal_date").alias("last_open"))


def day_status(df: DataFrame, day: str, calendar: DataFrame, out: str = "day_status") -> DataFrame:
    """Label each row's day open, closed, or unknown when the calendar lacks it."""
    known = calendar.groupBy(F.col("cal_date").alias(day)).agg(F.max("is_open").alias("_open"))
    status = (
        F.when(F.col("_open").isNull(), UNKNOWN).when(F.col("_open") == 1, OPEN).otherwise(CLOSED)
    )
    return df.join(F.broadcast(known), day, "left").withColumn(out, status).drop("_open")


def is_open_day(df: DataFrame, day: str, calendar: DataFrame, out: str = "is_trading_day") -> DataFrame:
    labelled = day_status(df, day, calendar, "_status")
    return labelled.withColumn(out, F.col("_status") == OPEN).drop("_status")


def previous_open_day(df: DataFrame, day: str, calendar: DataFrame, out: str = "prev_open") -> DataFrame:
    """Last open day strictly before each row's day, also for days the calendar lacks.

    The lookup comes from the calendar alone: an open day answers for the days after it up to
    the next open one, the last open day for all later ones (one row, read first). It has one
    row per day of the calendar's span, whatever the calendar repeats. Timestamps count as their day.
    """
    opens = open_days(calendar).select(F.col("cal_date").cast("date").alias(out)).distinct()
    last = opens.agg(F.max(out)).first()[0]
    upto = F.coalesce(F.lead(out).over(Window.orderBy(out)), F.date_add(F.col(out), 1))
    spans = opens.withColumn("_upto", upto)
    lookup = spans.select(out, F.explode(F.sequence(F.date_add(F.col(out), 1), F.col("_upto"))).alias("_lookup_day"))
    joined = df.join(F.broadcast(lookup), F.col(day).cast("date") == F.col("_lookup_day"), "left").drop("_lookup_day")
    if last is None:
        return joined
    return joined.withColumn(out, F.coalesce(F.col(out), F.when(F.col(day).cast("date") > F.lit(last), F.lit(last))))


def expand_open_days(
    intervals: DataFrame, begin: str, end: str, calendar: DataFrame, out: str = "trade_date"
) -> DataFrame:
    """One row per interval row and open day inside its closed interval.

    Each interval generates its own days and keeps the open ones through a hash lookup, so
    the calendar is never compared pairwise with the intervals. The interval columns stay.
    """
    valid = intervals.where(F.col(begin) <= F.col(end))
    days = valid.withColumn(out, F.explode(F.sequence(F.col(begin), F.col(end))))
    wanted = open_days(calendar).select(F.col("cal_date").alias(out))
    return days.join(F.broadcast(wanted), out, "left_semi")


def day_rule_report(params: DataFrame, begin: str, end: str, calendar: DataFrame) -> DataFrame:
    """Check requested date ranges (compact text) and name the first broken rule per row.

    Rules: both ends parse, begin is not after end, and a single-day range is an open day.
    """
    from ..functions.dates import compact_date

    parsed = params.withColumn("_b", compact_date(F.col(begin))).withColumn("_e", compact_date(F.col(end)))
    checked = day_status(parsed.withColumn("_day", F.col("_b")), "_day", calendar, "_status")
    single = F.col("_b") == F.col("_e")
    problem = (
        F.when(F.col("_b").isNull(), "begin_format")
        .when(F.col("_e").isNull(), "end_format")
        .when(F.col("_b") > F.col("_e"), "date_order")
        .when(single & (F.col("_status") == CLOSED), "closed_day")
        .when(single & (F.col("_status") == UNKNOWN), "unknown_day")
    )
    return checked.withColumn("problem", problem).drop("_b", "_e", "_day", "_status")
