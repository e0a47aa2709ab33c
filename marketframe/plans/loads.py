"""How each landed batch merges into its table.

Tables with a day take ``touched``, the unit by which the store is partitioned (``"month"`` or
``"day"``): with it a load reads and returns only the partitions of the batch, each whole, as a
dynamic partition overwrite wants; without it the untouched rows follow, unshuffled. Every batch is
made unique on its keys first: the last row by ``order``, or the greatest by value where no order is known.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import loose_date
from ..operators.merge import (
    COALESCE, KEEP, NOW, OVERWRITE, dedup_by_values, dedup_last, merge_keyed, merge_present, merge_touched, partition_unit,
)
from ..schemas import MARGIN_COLUMNS, REPORT_FIELDS, TABLES
from ..sources.bars import normalize_bars, numeric_bars
from ..sources.files import require_columns

BASE_INDICATORS = ("turnover_rate", "pe", "pb", "is_st")
SHARE_COUNTS = ("total_shares", "float_shares")
BAR_VALUES = ("open", "high", "low", "close", "pre_close", "tradestatus", "volume", "amount")
SECURITY_VALUES = ("symbol", "name", "exchange", "board", "list_date", "delist_date", "list_status")
HIERARCHY_VALUES = ("industry_name", "sw_level", "parent_code")
CAPITAL_VALUES = ("dividend", "allotment_price", "bonus_share", "allotment_share")


def _all(columns: Sequence[str], rule: str) -> dict[str, str]:
    return {c: rule for c in columns}


def _dated(
    stored: DataFrame, batch: DataFrame, keys: list[str], rules: dict[str, str], day: str, touched: str | None, order: str | None, **options
) -> DataFrame:
    return merge_touched(stored, dedup_by_values(batch, keys, order), keys, rules, day, partition_unit(touched), **options)


def load_bars(stored: DataFrame, batch: DataFrame, *, order: str | None = None, touched: str | None = None) -> DataFrame:
    return _dated(stored, normalize_bars(batch), ["code", "date"], _all(BAR_VALUES, OVERWRITE), "date", touched, order)


def load_index_bars(stored: DataFrame, batch: DataFrame, *, order: str | None = None, touched: str | None = None) -> DataFrame:
    return _dated(stored, numeric_bars(batch), ["code", "date"], _all(BAR_VALUES, OVERWRITE), "date", touched, order)


def _whole(stored: DataFrame, batch: DataFrame, keys: list[str], rules: dict[str, str], order: str | None, **options) -> DataFrame:
    return merge_keyed(stored, dedup_by_values(batch, keys, order), keys, rules, **options)


def load_calendar(stored: DataFrame, batch: DataFrame, order: str | None = None) -> DataFrame:
    return _whole(stored, batch, ["cal_date"], {"is_open": OVERWRITE}, order)


def load_indicators(stored: DataFrame, batch: DataFrame, *, order: str | None = None, touched: str | None = None) -> DataFrame:
    """Owned columns only; a NULL never erases a stored value."""
    return _dated(
        stored, batch, ["code", "trade_date"], _all(BASE_INDICATORS, COALESCE), "trade_date", touched, order,
        defaults=TABLES["daily_basic"].defaults,
    )


def load_share_counts(stored: DataFrame, batch: DataFrame, *, order: str | None = None, touched: str | None = None) -> DataFrame:
    renamed = batch.withColumnRenamed("date", "trade_date")
    return _dated(
        stored, renamed, ["code", "trade_date"], _all(SHARE_COUNTS, COALESCE), "trade_date", touched, order,
        defaults=TABLES["daily_basic"].defaults,
    )


def load_securities(stored: DataFrame, batch: DataFrame, now: dt.datetime, order: str | None = None) -> DataFrame:
    """Rows change only when a tracked column differs; created_at never moves."""
    rules = {**_all(SECURITY_VALUES, OVERWRITE), "created_at": KEEP, "last_updated_at": NOW}
    return _whole(stored, batch, ["code"], rules, order, now=now, only_if_changed=SECURITY_VALUES)


def load_hierarchy(stored: DataFrame, batch: DataFrame, now: dt.datetime, order: str | None = None) -> DataFrame:
    require_columns(batch, ["sw_version", "industry_code", *HIERARCHY_VALUES], "industry hierarchy")
    rules = {**_all(HIERARCHY_VALUES, OVERWRITE), "updated_at": NOW}
    return _whole(stored, batch, ["sw_version", "industry_code"], rules, order, now=now, only_if_changed=HIERARCHY_VALUES)


def load_industry_history(stored: DataFrame, batch: DataFrame, now: dt.datetime, order: str | None = None) -> DataFrame:
    keys = ["symbol", "start_date", "industry_code"]
    require_columns(batch, [*keys, "update_time"], "industry history")
    return _whole(stored, batch, keys, {"update_time": OVERWRITE, "updated_at": NOW}, order, now=now)


def load_capital(
    stored: DataFrame, batch: DataFrame, now: dt.datetime, order: str | None = None, *, touched: str | None = None
) -> DataFrame:
    """Insert or replace; the day may come as compact number, ISO date or timestamp."""
    dated = batch.withColumn("date", loose_date(F.col("date")))
    rules = {**_all(CAPITAL_VALUES, OVERWRITE), "updated_at": NOW}
    return _dated(stored, dated, ["code", "date", "category"], rules, "date", touched, order, now=now)


def _as_numbers(batch: DataFrame) -> DataFrame:
    """Amounts pass through DOUBLE before the stored decimal, as the sources deliver them."""
    return batch.withColumns({c: F.col(c).cast("double") for c in MARGIN_COLUMNS if c in batch.columns})


def load_margin_summary(
    stored: DataFrame, batch: DataFrame, now: dt.datetime, *, order: str | None = None, touched: str | None = None
) -> DataFrame:
    """Insert or replace: both stamps are renewed."""
    rules = {**_all(MARGIN_COLUMNS, OVERWRITE), "created_at": NOW, "updated_at": NOW}
    return _dated(stored, _as_numbers(batch), ["trade_date", "exchange_code"], rules, "trade_date", touched, order, now=now)


def load_margin_detail(
    stored: DataFrame, batch: DataFrame, now: dt.datetime, *, order: str | None = None, touched: str | None = None
) -> DataFrame:
    """Values are replaced, created_at stays."""
    rules = {**_all(("code", *MARGIN_COLUMNS), OVERWRITE), "created_at": KEEP, "updated_at": NOW}
    return _dated(stored, _as_numbers(batch), ["trade_date", "exchange_code", "symbol"], rules, "trade_date", touched, order, now=now)


def load_finance(
    stored: DataFrame, batch: DataFrame, now: dt.datetime, *, order: str | None = None, touched: str | None = None
) -> DataFrame:
    """Only the report columns a batch carries are replaced, per row where layouts are mixed.

    Of rows that repeat a key and tie in ``order`` (or have none) the one with the most columns stays.
    """
    keys, layout, latest = ["code", "report_date"], None, [order] if order else []
    columns = list(REPORT_FIELDS.values())
    if "field_count" in batch.columns:
        layout = ("field_count", {name: number for number, name in REPORT_FIELDS.items()})
        latest.append("field_count")
    others = [c for c in batch.columns if c not in (*keys, *latest)]
    unique = dedup_last(batch, keys, [*latest, *others])
    return merge_present(stored, unique, keys, columns, day="report_date", unit=partition_unit(touched), now=now, carried_from=layout)
