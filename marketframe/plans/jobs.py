"""One function per program: landed frames and stored tables in, what has to be stored out.

Dated tables come back as the whole months (``touched="day"``: days) a batch touches, ready for a
dynamic overwrite of a store partitioned by that unit; ``touched=False`` adds the rest of the table. The stored
plans stay lazy; only the distinct days of a batch are read while planning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DateLike, as_date
from ..operators import fills
from ..operators.industry import derive_hierarchy
from ..operators.merge import MONTH, fallback_union, first_available, partition_unit
from ..operators.series import fill_suspensions
from ..sources import bars as bar_sources
from ..sources import events as event_sources
from . import loads

HIERARCHY_COLUMNS = ("行业代码", "一级行业名称", "二级行业名称", "三级行业名称")


def import_combined_bars(
    raw: DataFrame, stored_bars: DataFrame, stored_basic: DataFrame, touched: str | None = MONTH,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bars, indicators, rejected codes) from the source that carries both."""
    daily, indicators, rejected = bar_sources.split_combined(raw)
    return loads.load_bars(stored_bars, daily, touched=partition_unit(touched)), loads.load_indicators(stored_basic, indicators, touched=partition_unit(touched)), rejected


def import_sparse_bars(
    source: DataFrame,
    universe: DataFrame,
    calendar: DataFrame,
    stored_bars: DataFrame,
    stored_basic: DataFrame,
    status: int | None = None, touched: str | None = MONTH,
) -> tuple[DataFrame, DataFrame]:
    """(bars, indicators) from a source that omits suspended days: bar files or online pages.

    ``source`` must reach back before the range, so that its last close seeds the first day.
    Bar files have no status of their own; pass 1 for them.
    """
    spans = universe.where(F.col("list_status") != "D").select("code", "from_date", "to_date")
    daily = fill_suspensions(spans, source, calendar, status=status)
    skeleton = bar_sources.indicator_skeleton(daily)
    return loads.load_bars(stored_bars, daily, touched=partition_unit(touched)), loads.load_indicators(stored_basic, skeleton, touched=partition_unit(touched))


def import_lot_bars(
    raw: DataFrame, stored_bars: DataFrame, stored_basic: DataFrame, code: str = "code", touched: str | None = MONTH,
) -> tuple[DataFrame, DataFrame]:
    daily, indicators = bar_sources.lot_bars(raw, F.col(code))
    return loads.load_bars(stored_bars, daily, touched=partition_unit(touched)), loads.load_indicators(stored_basic, indicators, touched=partition_unit(touched))


def import_index_bars(raw: DataFrame, stored_bars: DataFrame, touched: str | None = MONTH) -> DataFrame:
    return loads.load_index_bars(stored_bars, bar_sources.index_bars(raw), touched=partition_unit(touched))


def sync_calendar(raw: DataFrame, stored: DataFrame) -> DataFrame:
    return loads.load_calendar(stored, bar_sources.calendar_days(raw))


def sync_securities(raw: DataFrame, stored: DataFrame, now: dt.datetime) -> DataFrame:
    return loads.load_securities(stored, bar_sources.securities(raw), now)


def sync_beijing(
    raw: DataFrame, stored: DataFrame, stored_basic: DataFrame, day: DateLike, now: dt.datetime, touched: str | None = MONTH,
) -> tuple[DataFrame, DataFrame]:
    """(securities, indicators) from the Beijing exchange list."""
    shares = bar_sources.beijing_shares(raw, F.lit(as_date(day)))
    return (
        loads.load_securities(stored, bar_sources.beijing_securities(raw), now),
        loads.load_share_counts(stored_basic, shares, touched=partition_unit(touched)),
    )


def sync_capital(sources: Sequence[DataFrame], stored: DataFrame, now: dt.datetime, touched: str | None = MONTH) -> DataFrame:
    """Capital events from the first source, in order of preference, that has each event."""
    return loads.load_capital(stored, first_available(sources, ["code", "date", "category"]), now, touched=partition_unit(touched))


def sync_margin_summary(
    primary: DataFrame, fallback: DataFrame, stored: DataFrame, now: dt.datetime,
    on: Sequence[str] = ("exchange_code", "trade_date"), touched: str | None = MONTH,
) -> DataFrame:
    """Cleaned totals; the fallback source fills the exchanges and days the primary lacks."""
    return loads.load_margin_summary(stored, fallback_union(primary, fallback, on), now, touched=partition_unit(touched))


def sync_margin_detail(
    primary: DataFrame, fallback: DataFrame, stored: DataFrame, now: dt.datetime,
    on: Sequence[str] = ("exchange_code", "trade_date"), touched: str | None = MONTH,
) -> DataFrame:
    return loads.load_margin_detail(stored, fallback_union(primary, fallback, on), now, touched=partition_unit(touched))


def sync_industry_history(raw: DataFrame, stored: DataFrame, now: dt.datetime, order: str) -> DataFrame:
    return loads.load_industry_history(stored, event_sources.industry_history(raw, order), now)


def sync_hierarchy(raw: DataFrame, version: str, stored: DataFrame, now: dt.datetime, order: str) -> DataFrame:
    derived = derive_hierarchy(raw, version, *HIERARCHY_COLUMNS, order)
    return loads.load_hierarchy(stored, derived, now)


def sync_finance(
    decoded: DataFrame, stored: DataFrame, now: dt.datetime, codes: str | Sequence[str] | None = None, touched: str | None = MONTH,
) -> DataFrame:
    """Reports of all periods at once, whatever mix of layouts their files have."""
    return loads.load_finance(stored, event_sources.finance_report(decoded, codes), now, touched=partition_unit(touched))


def fill_shares_and_value(
    basic: DataFrame, bars: DataFrame, capital: DataFrame, master: DataFrame,
    begin: DateLike, end: DateLike, codes: Iterable[str] | None = None, exchanges: Iterable[str] | None = None, touched: str | None = MONTH,
) -> DataFrame:
    """Share counts first, then the market values that need them."""
    counted = fills.fill_shares(basic, capital, master, begin, end, codes, exchanges, touched=partition_unit(touched))
    return fills.fill_market_value(counted, bars, master, begin, end, codes, exchanges, touched=partition_unit(touched))
