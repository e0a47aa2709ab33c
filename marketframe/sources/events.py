"""Normalise capital events, margin balances, industry histories and financial reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import in_codes, suffixed, zero_pad
from ..functions.dates import compact_date, loose_date, loose_timestamp
from ..functions.numeric import to_number
from ..operators.merge import dedup_last
from ..schemas import MARGIN_COLUMNS, REPORT_FIELDS
from .files import require_columns

# Capital-event category numbers.
CAPITAL_CATEGORIES = {
    1: "除权除息", 2: "送配股上市", 3: "非流通股上市", 4: "未知股本变动", 5: "股本变化",
    6: "增发新股", 7: "股份回购", 8: "增发新股上市", 9: "转配股上市", 10: "可转债上市",
    11: "扩缩股", 12: "非流通股缩股", 13: "送认购权证", 14: "送认沽权证", 15: "未知新类别",
}
EX_RIGHTS = CAPITAL_CATEGORIES[1]

# Stored column -> (field for ex-rights events, field for share-count events).
CAPITAL_FIELDS = {
    "dividend": ("fenhong", "panqianliutong"),
    "allotment_price": ("peigujia", "qianzongguben"),
    "bonus_share": ("songzhuangu", "panhouliutong"),
    "allotment_share": ("peigu", "houzongguben"),
}


def _category_name(number: Column) -> Column:
    pairs = [F.lit(x) for pair in CAPITAL_CATEGORIES.items() for x in pair]
    return F.create_map(*pairs)[number.cast("int")]


def capital_events(raw: DataFrame, code: str = "code", keep: Sequence[str] = ()) -> DataFrame:
    """Capital events with day, category name and the four value columns its family fills.

    ``keep`` names raw columns to carry along, such as an arrival order.
    """
    named = raw.withColumns({"date": _day_of_parts(), "category": _category_name(F.col("category"))})
    dividend_family = F.coalesce(F.col("category") == EX_RIGHTS, F.lit(False))
    values = [
        F.when(dividend_family, F.col(ex)).otherwise(F.col(shares)).cast("double").alias(out)
        for out, (ex, shares) in CAPITAL_FIELDS.items()
    ]
    return named.select(F.col(code).cast("string").alias("code"), "date", "category", *values, *keep)


def _day_of_parts() -> Column:
    text = F.concat_ws(
        "-", *[zero_pad(F.col(p), n) for p, n in (("year", 4), ("month", 2), ("day", 2))]
    )  # padding never cuts, so a month such as 123 is no date
    return F.try_to_date(text, "yyyy-MM-dd")


def unknown_categories(raw: DataFrame) -> DataFrame:
    """Category numbers without a name, with their row counts."""
    return (
        raw.where(_category_name(F.col("category")).isNull())
        .groupBy(F.col("category").cast("int").alias("category"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def decoded_capital_events(raw: DataFrame) -> DataFrame:
    """Events from an already decoded file: category number to name, mixed date texts."""
    return raw.select(
        F.col("code").cast("string").alias("code"), loose_date(F.col("date")).alias("date"),
        _category_name(F.col("category")).alias("category"),
        *[F.col(c).cast("double").alias(c) for c in CAPITAL_FIELDS],
    )


# Exchange column names -> stored columns, per publication.
SH_SUMMARY = {
    "本日融资余额(元)": "margin_balance", "本日融资买入额(元)": "margin_buy_amount",
    "本日融券余量": "short_balance_volume", "本日融券余量金额(元)": "short_balance_amount",
    "本日融券卖出量": "short_sell_volume", "本日融资融券余额(元)": "margin_short_balance",
}
SH_DETAIL = {
    "标的证券代码": "symbol", "本日融资余额(元)": "margin_balance", "本日融资买入额(元)": "margin_buy_amount",
    "本日融资偿还额(元)": "margin_repay_amount", "本日融券余量": "short_balance_volume",
    "本日融券卖出量": "short_sell_volume", "本日融券偿还量": "short_repay_volume",
}
SZ_SUMMARY = {
    "融资买入额(元)": "margin_buy_amount", "融资余额(元)": "margin_balance",
    "融券卖出量(股/份)": "short_sell_volume", "融券余量(股/份)": "short_balance_volume",
    "融券余额(元)": "short_balance_amount", "融资融券余额(元)": "margin_short_balance",
}
SZ_DETAIL = {"证券代码": "symbol", **SZ_SUMMARY}
SH_SUMMARY_ALT = {
    "信用交易日期": "trade_date", "融资余额": "margin_balance", "融资买入额": "margin_buy_amount",
    "融券余量": "short_balance_volume", "融券余量金额": "short_balance_amount",
    "融券卖出量": "short_sell_volume", "融资融券余额": "margin_short_balance",
}
SZ_SUMMARY_ALT = {
    "数据日期": "trade_date", "融资买入额": "margin_buy_amount", "融资余额": "margin_balance",
    "融券卖出量": "short_sell_volume", "融券余额": "short_balance_amount",
    "融券余量": "short_balance_volume", "融资融券余额": "margin_short_balance",
}
SZ_DETAIL_ALT = {
    "证券代码": "symbol", "融资买入额": "margin_buy_amount", "融资余额": "margin_balance",
    "融券卖出量": "short_sell_volume", "融券余量": "short_balance_volume",
    "融券余额": "short_balance_amount", "融资融券余额": "margin_short_balance",
}
SH_DETAIL_ALT = {
    "标的证券代码": "symbol", "融资余额": "margin_balance", "融资买入额": "margin_buy_amount",
    "融资偿还额": "margin_repay_amount", "融券余量": "short_balance_volume",
    "融券卖出量": "short_sell_volume", "融券偿还量": "short_repay_volume",
}
LEGACY_SUFFIX = "(股)"
TOTAL_ROW = "融资融券"
YI = 1e8
SYMBOLS = {"SH": r"^6\d{5}$", "SZ": r"^[03]\d{5}$"}


def _renamed(raw: DataFrame, names: dict[str, str], what: str) -> DataFrame:
    """Trim headers, strip the legacy unit suffix, require and rename the known columns."""
    clean = {c: c.strip().removesuffix(LEGACY_SUFFIX) for c in raw.columns}
    tidy = raw.toDF(*clean.values())
    require_columns(tidy, list(names), what)
    return tidy.withColumnsRenamed(names)


def _margin_rows(df: DataFrame, exchange: str, ids: Sequence[str], scale: float = 1.0) -> DataFrame:
    values = []
    for c in MARGIN_COLUMNS:
        number = to_number(F.col(c)) if c in df.columns else F.lit(None).cast("double")
        values.append((number * scale if scale != 1.0 else number).alias(c))
    return df.select("trade_date", F.lit(exchange).alias("exchange_code"), *ids, *values)


def _margin_detail(df: DataFrame, exchange: str, symbols: str | None = None) -> DataFrame:
    """Pad symbols first, then keep the exchange's own share symbols, or those that the pattern ``symbols`` names."""
    padded = df.withColumn("symbol", zero_pad(F.col("symbol"))).where(F.col("symbol").rlike(symbols or SYMBOLS[exchange]))
    return _margin_rows(
        padded.withColumn("code", suffixed(F.col("symbol"), F.lit(exchange))), exchange, ["symbol", "code"]
    )


def margin_summary_sh(raw: DataFrame) -> DataFrame:
    """Shanghai daily totals; rows without a balance are notes and leave. ``raw`` carries trade_date."""
    rows = _margin_rows(_renamed(raw, SH_SUMMARY, "SH margin summary"), "SH", [])
    return rows.where(F.col("margin_balance").isNotNull())


def margin_detail_sh(raw: DataFrame) -> DataFrame:
    return _margin_detail(_renamed(raw, SH_DETAIL, "SH margin detail"), "SH")


def margin_summary_sz(raw: DataFrame) -> DataFrame:
    """Shenzhen daily totals, already in yuan and shares."""
    rows = _margin_rows(_renamed(raw, SZ_SUMMARY, "SZ margin summary"), "SZ", [])
    return rows.where(F.col("margin_balance").isNotNull())


def margin_detail_sz(raw: DataFrame, symbols: str | None = None) -> DataFrame:
    return _margin_detail(_renamed(raw, SZ_DETAIL, "SZ margin detail"), "SZ", symbols)


def margin_summary_sh_alt(raw: DataFrame) -> DataFrame:
    """Shanghai totals of the alternate source, dated by compact text."""
    renamed = raw.withColumnsRenamed(SH_SUMMARY_ALT)
    dated = renamed.withColumn("trade_date", compact_date(F.col("trade_date"))).where(F.col("trade_date").isNotNull())
    return _margin_rows(dated, "SH", [])


def margin_summary_sz_alt(raw: DataFrame) -> DataFrame:
    """Shenzhen totals of the alternate source: the all-securities row, in units of 1e8."""
    rows = raw.where(F.trim(F.col("项目")) == TOTAL_ROW) if "项目" in raw.columns else raw
    renamed = rows.withColumnsRenamed(SZ_SUMMARY_ALT)
    return _margin_rows(renamed.withColumn("trade_date", loose_date(F.col("trade_date"))), "SZ", [], YI)


def margin_detail_sz_alt(raw: DataFrame, symbols: str | None = None) -> DataFrame:
    return _margin_detail(raw.withColumnsRenamed(SZ_DETAIL_ALT), "SZ", symbols)


def margin_detail_sh_alt(raw: DataFrame) -> DataFrame:
    return _margin_detail(raw.withColumnsRenamed(SH_DETAIL_ALT), "SH")


# Column names of the industry membership file.
INDUSTRY_COLUMNS = {"股票代码": "symbol", "计入日期": "start_date", "行业代码": "industry_code", "更新日期": "update_time"}


def rename_industry(raw: DataFrame) -> DataFrame:
    require_columns(raw, list(INDUSTRY_COLUMNS), "industry membership file")
    return raw.withColumnsRenamed(INDUSTRY_COLUMNS)


def industry_history(raw: DataFrame, order: str) -> DataFrame:
    """Clean memberships: padded symbols, real dates, non-blank keys, last duplicate kept."""
    typed = raw.where(
        F.col("symbol").isNotNull() & F.col("start_date").isNotNull() & F.col("industry_code").isNotNull()
    ).select(
        zero_pad(F.col("symbol")).alias("symbol"),
        loose_timestamp(F.col("start_date")).cast("date").alias("start_date"),
        F.trim(F.col("industry_code").cast("string")).alias("industry_code"),
        loose_timestamp(F.col("update_time")).alias("update_time"),
        F.col(order).alias("_order"),
    )
    usable = typed.where(F.col("start_date").isNotNull() & (F.col("symbol") != "") & (F.col("industry_code") != ""))
    return dedup_last(usable, ["symbol", "start_date", "industry_code"], ["_order"]).drop("_order")


def finance_report(decoded: DataFrame, codes: str | Sequence[str] | None = None, width: int | None = None) -> DataFrame:
    """Named report columns from (report_date, code, fields), plus each row's ``field_count``.

    A field past the end of a row's layout is NULL; ``field_count`` lets a merge tell that
    from a reported NULL. ``width`` leaves out the columns past a known layout altogether.
    """
    require_columns(decoded, ["report_date", "code", "fields"], "decoded report")
    named = [
        f"nanvl(CAST(get(fields, {number - 1}) AS DOUBLE), CAST(NULL AS DOUBLE)) AS {name}"
        for number, name in REPORT_FIELDS.items() if width is None or number <= width
    ]
    return decoded.where(in_codes(F.col("code"), codes)).selectExpr(
        "code", "report_date", *named, "size(fields) AS field_count"
    )
