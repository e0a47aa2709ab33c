"""Text-to-date parsing and inclusive range predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | dt.date


def compact_date(text: Column) -> Column:
    """``'20240105'`` -> DATE; anything else NULL."""
    bare = F.trim(text.cast("string"))
    return F.try_to_date(F.when(bare.rlike(r"^\d{8}$"), bare), "yyyyMMdd")


def iso_date(text: Column) -> Column:
    """``'2024-01-05'`` (one- or two-digit month and day) -> DATE; anything else NULL."""
    return F.try_to_date(F.trim(text.cast("string")), "yyyy-M-d")


def loose_date(text: Column) -> Column:
    """Compact number (also written ``20240105.0``), ISO date or full timestamp -> DATE."""
    raw = F.trim(text.cast("string"))
    compact = raw.try_cast("decimal(20,0)").cast("string")
    return F.coalesce(
        compact_date(compact), iso_date(raw), raw.try_cast("timestamp_ntz").cast("date")
    )


def loose_timestamp(text: Column) -> Column:
    raw = F.trim(text.cast("string"))
    return F.coalesce(raw.try_cast("timestamp_ntz"), loose_date(raw).cast("timestamp_ntz"))


def iso_text(compact: Column) -> Column:
    """YYYYMMDD text -> ISO text, NULL when it is not a date."""
    return F.date_format(compact_date(compact), "yyyy-MM-dd")


def report_date(text: Column) -> Column:
    """Report period given as YYYYMMDD or ISO."""
    return F.coalesce(compact_date(text), iso_date(text))


def between_days(column: Column, begin: DateLike | None, end: DateLike | None) -> Column:
    """Closed interval; an open end is left out so that the filter still pushes down."""
    condition = F.lit(True)
    if begin is not None:
        condition = column >= F.lit(as_date(begin))
    if end is not None:
        upper = column <= F.lit(as_date(end))
        condition = upper if begin is None else condition & upper
    return condition


def as_date(value: DateLike) -> dt.date:
    """Accept a date, ISO text or compact text; reject everything else."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = value.strip()
    for fmt in ("%Y-%m-%d", "%Y%m%d"):
        try:
            return dt.datetime.strptime(text, fmt).date()
        except ValueError:
            continue
    raise ValueError(f"not a date: {value!r}")


def timestamp_literal(value: dt.datetime) -> Column:
    """Naive timestamp literal, independent of any time zone setting."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
