"""Normalise landed bars, securities, calendars and factor events to the stored schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import board_of, dotted_parts, suffixed
from ..functions.dates import iso_date, loose_date
from ..functions.numeric import to_number

PRICES = ("open", "high", "low", "close")
UNKNOWN_VALUE = -1
SHARES_PER_LOT = 100


def normalize_bars(df: DataFrame) -> DataFrame:
    """Fill absent or NULL pre_close and tradestatus with -1; ``trade_status`` is an alias."""
    unknown = F.lit(UNKNOWN_VALUE)
    pre_close = F.coalesce(F.col("pre_close").cast("double"), unknown.cast("double")) if "pre_close" in df.columns else unknown.cast("double")
    if "tradestatus" in df.columns:
        status = F.coalesce(F.col("tradestatus").try_cast("int"), unknown)
    elif "trade_status" in df.columns:
        status = F.coalesce(F.col("trade_status").try_cast("int"), unknown)
    else:
        status = unknown
    return df.withColumns({"pre_close": pre_close, "tradestatus": status}).drop("trade_status")


def numeric_bars(df: DataFrame) -> DataFrame:
    """Bars whose numbers arrive as text; blanks and other non-numbers become NULL.

    An absent or NULL pre_close is unknown (-1), a blank one is stored as NULL.
    """
    base = normalize_bars(df.drop("pre_close"))
    if "pre_close" in df.columns:
        given = F.col("pre_close")
        known = F.when(given.isNull(), F.lit(float(UNKNOWN_VALUE))).otherwise(to_number(given))
        base = normalize_bars(df.withColumn("_given", known).drop("pre_close")).withColumn("pre_close", F.col("_given")).drop("_given")
    numbers = [c for c in (*PRICES, "amount") if c in base.columns]
    out = base.withColumns({c: to_number(F.col(c)) for c in numbers})
    return out.withColumn("volume", to_number(F.col("volume"), "long")) if "volume" in out.columns else out


def securities(raw: DataFrame) -> DataFrame:
    """Security master from dotted codes; keeps shares (type 1) and indexes (type 2)."""
    exchange, symbol = dotted_parts(F.col("code"))
    kind = F.trim(F.col("type").cast("string"))
    return raw.where(kind.isin("1", "2")).select(
        suffixed(symbol, exchange).alias("code"),
        symbol.alias("symbol"),
        F.col("code_name").alias("name"),
        exchange.alias("exchange"),
        board_of(kind, symbol).alias("board"),
        iso_date(F.col("ipoDate")).alias("list_date"),
        iso_date(F.col("outDate")).alias("delist_date"),
        F.when(F.trim(F.col("status").cast("string")) == "0", "D").otherwise("L").alias("list_status"),
    )


def beijing_securities(raw: DataFrame) -> DataFrame:
    """Security master of the Beijing exchange list."""
    symbol = F.col("证券代码").cast("string")
    return raw.select(
        suffixed(symbol, F.lit("BJ")).alias("code"), symbol.alias("symbol"), F.col("证券简称").alias("name"),
        F.lit("BJ").alias("exchange"), F.lit("BJ").alias("board"), loose_date(F.col("上市日期")).alias("list_date"),
        F.lit(None).cast("date").alias("delist_date"), F.lit("L").alias("list_status"),
    )


def beijing_shares(raw: DataFrame, day: Column) -> DataFrame:
    """Share counts of the same list; counts carry thousands commas."""
    return raw.select(
        suffixed(F.col("证券代码").cast("string"), F.lit("BJ")).alias("code"), day.cast("date").alias("date"),
        to_number(F.col("总股本"), "long").alias("total_shares"),
        to_number(F.col("流通股本"), "long").alias("float_shares"),
    )


def _combined(raw: DataFrame) -> DataFrame:
    exchange, symbol = dotted_parts(F.col("code"))
    zero_filled = {c: F.coalesce(to_number(F.col(c)), F.lit(0.0)) for c in (*PRICES, "preclose", "volume", "amount")}
    kept = {c: to_number(F.col(c)) for c in ("turn", "peTTM", "pbMRQ")}
    return raw.withColumns(
        {
            **zero_filled,
            **kept,
            "isST": F.coalesce(to_number(F.col("isST")), F.lit(0.0)).cast("int"),
            "code": suffixed(symbol, exchange),
            "date": iso_date(F.col("date")),
            "tradestatus": F.trim(F.col("tradestatus")).try_cast("int"),
        }
    )


def split_combined(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bars, indicators, rejected codes) from one source that carries both.

    Missing prices read as 0 while missing indicators stay NULL. A code with a trading day
    that lacks turnover is rejected whole: its rows are in neither output and its count of
    bad rows is reported, so that it can be loaded again.
    """
    rows = _combined(raw)
    rejected = (
        rows.where((F.col("tradestatus") == 1) & F.col("turn").isNull())
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("missing_turnover"))
    )
    accepted = rows.join(rejected.select("code"), "code", "left_anti")
    bars = accepted.select(
        "code", "date", *PRICES, F.col("preclose").alias("pre_close"), F.col("tradestatus"),
        F.col("volume").cast("long").alias("volume"), "amount",
    )
    indicators = accepted.select(
        "code", F.col("date").alias("trade_date"), F.col("turn").alias("turnover_rate"),
        F.col("peTTM").alias("pe"), F.col("pbMRQ").alias("pb"), F.col("isST").alias("is_st"),
    )
    return bars, indicators, rejected


def index_bars(raw: DataFrame) -> DataFrame:
    """Index bars: a missing volume is 0 and every day counts as traded."""
    exchange, symbol = dotted_parts(F.col("code"))
    return raw.select(
        suffixed(symbol, exchange).alias("code"), iso_date(F.col("date")).alias("date"),
        *[to_number(F.col(p)).alias(p) for p in PRICES],
        to_number(F.col("preclose")).alias("pre_close"), F.lit(1).alias("tradestatus"),
        F.coalesce(to_number(F.col("volume")), F.lit(0.0)).cast("long").alias("volume"),
        to_number(F.col("amount")).alias("amount"),
    )


# Column names of the lot-based bar source.
LOT_BAR_COLUMNS = {
    "日期": "date", "开盘": "open", "最高": "high", "最低": "low", "收盘": "close",
    "成交量": "volume", "成交额": "amount", "换手率": "turnover_rate",
}


def lot_bars(raw: DataFrame, code: Column) -> tuple[DataFrame, DataFrame]:
    """(bars, indicators) from a source that counts volume in lots of 100 shares."""
    renamed = raw.withColumn("_code", code).withColumnsRenamed(LOT_BAR_COLUMNS)
    shares = to_number(F.col("volume")) * SHARES_PER_LOT
    bars = renamed.select(
        F.col("_code").alias("code"), loose_date(F.col("date")).alias("date"),
        *[to_number(F.col(p)).alias(p) for p in PRICES],
        shares.cast("long").alias("volume"), to_number(F.col("amount")).alias("amount"),
        F.lit(1).alias("tradestatus"),
    )
    indicators = renamed.select(
        F.col("_code").alias("code"), loose_date(F.col("date")).alias("trade_date"),
        to_number(F.col("turnover_rate")).alias("turnover_rate"),
        F.lit(None).cast("double").alias("pe"), F.lit(None).cast("double").alias("pb"),
        F.lit(None).cast("int").alias("is_st"),
    )
    return bars, indicators


def looks_suspended(volume: Column, open_: Column, high: Column, low: Column, close: Column) -> Column:
    """No volume and four equal prices at three decimals."""
    o, h, l, c = (F.round(p, 3) for p in (open_, high, low, close))
    return (volume == 0) & (o == c) & (h == l) & (o == h)


def online_bars(raw: DataFrame) -> DataFrame:
    """Bars of the paged online source: day from a timestamp text, lots to shares, status inferred."""
    day = F.coalesce(F.col("datetime").try_cast("timestamp_ntz").cast("date"), loose_date(F.col("datetime")))
    suspended = looks_suspended(*[F.col(c) for c in ("vol", *PRICES)])
    return raw.withColumn("date", day).where(F.col("date").isNotNull()).select(
        "code", "date", *PRICES, (F.col("vol").cast("long") * SHARES_PER_LOT).alias("volume"),
        F.col("amount").cast("double").alias("amount"), F.when(suspended, 0).otherwise(1).alias("tradestatus"),
    )


def indicator_skeleton(bars: DataFrame) -> DataFrame:
    """One indicator row per bar with every indicator NULL, so that fills find a row."""
    return bars.select(
        "code", F.col("date").alias("trade_date"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("turnover_rate", "double"), ("pe", "double"), ("pb", "double"), ("is_st", "int"))],
    )


def calendar_days(raw: DataFrame) -> DataFrame:
    return raw.select(
        iso_date(F.col("calendar_date")).alias("cal_date"), F.col("is_trading_day").try_cast("int").alias("is_open")
    )


def factor_events(raw: DataFrame) -> DataFrame:
    """Adjustment-factor change events from dotted codes."""
    exchange, symbol = dotted_parts(F.col("code"))
    return raw.select(
        suffixed(symbol, exchange).alias("code"), iso_date(F.col("dividOperateDate")).alias("date"),
        to_number(F.col("foreAdjustFactor")).alias("fore_factor"),
        to_number(F.col("backAdjustFactor")).alias("back_factor"),
        to_number(F.col("adjustFactor")).alias("adjust_factor"),
    )
