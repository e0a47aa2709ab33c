"""Keyed-merge and source-precedence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.operators import merge
from marketframe.operators.unique import repeated_keys
from marketframe.plans import loads
from marketframe.plans.factors import FACTOR_RULES
from marketframe.plans.transfer import IMPORT_RULES
from marketframe.schemas import MARGIN_COLUMNS, REPORT_FIELDS, TABLES
from marketframe.session import fresh_path
from marketframe.sources import buckets
from marketframe.sources.events import finance_report

from .clean_queries import REPORTS, _report_columns, report_raw
from .daily_queries import hierarchy
from .registry import query
from .shapes import NOW, OLD, Shapes

OLD_TS, NEW_TS = f"TIMESTAMP '{OLD}'", f"TIMESTAMP '{NOW}'"
STAMP_OLD, STAMP_NEW = f"TIMESTAMP_NTZ '{OLD}'", f"TIMESTAMP_NTZ '{NOW}'"
BAR_COLUMNS = ", ".join(TABLES["stock_daily"].schema.names)


def stored_bars(s: Shapes) -> DataFrame:
    return s.bars().where("date < DATE '2024-01-20'").select(*TABLES["stock_daily"].schema.names)


def bar_batch(s: Shapes) -> DataFrame:
    return s.bars().where("date > DATE '2024-01-15'").selectExpr(
        "code", "date", "open", "high", "low", "close + 1 AS close", "CASE WHEN dayofmonth(date) = 17 THEN NULL ELSE pre_close END AS pre_close",
        "tradestatus", "CASE WHEN tradestatus = 1 THEN volume END AS volume", "amount",
    )


MERGED_BARS = f"""
SELECT code, date, open, high, low, CASE WHEN fresh THEN close + 1 ELSE close END AS close,
       CASE WHEN fresh AND day(date) = 17 THEN -1.0 ELSE pre_close END AS pre_close, tradestatus,
       CASE WHEN fresh AND tradestatus <> 1 THEN NULL ELSE volume END AS volume, amount
FROM (SELECT {BAR_COLUMNS}, date > DATE '2024-01-15' AS fresh FROM bars)"""


@query(MERGED_BARS)
def merge_overwrite(s: Shapes) -> DataFrame:
    return loads.load_bars(stored_bars(s), bar_batch(s))


@query(MERGED_BARS.replace("-1.0 ELSE", "NULL ELSE"))
def merge_bucketed(s: Shapes) -> DataFrame:
    """The same rule on a store bucketed by its keys: merged into a new store, which is read back."""
    rules = {c: merge.OVERWRITE for c in loads.BAR_VALUES}
    folder = fresh_path(s.spark, "buckets")
    name = folder.rpartition("/")[2].replace("-", "_")
    store = buckets.BucketedStore("stock_daily", f"{name}_old", f"{folder}/old", 8).write(stored_bars(s))
    merged = buckets.merge_bucketed(s.spark, store, bar_batch(s), rules, (f"{name}_new", f"{folder}/new"))
    store.drop(s.spark)
    return merged.read(s.spark)


@query(MERGED_BARS.replace("-1.0 ELSE", "NULL ELSE"))
def merge_within_days(s: Shapes) -> DataFrame:
    """The same rule, joining only the days the batch spans; a NULL overwrites here."""
    rules = {c: merge.OVERWRITE for c in loads.BAR_VALUES}
    return merge.merge_window(stored_bars(s), bar_batch(s), ["code", "date"], rules, "date")


@query("""
SELECT code, date, round(close, 2) AS close, day(date) AS is_new FROM bars WHERE date >= DATE '2024-01-20'
UNION ALL SELECT code, date, CASE WHEN date > DATE '2024-01-15' THEN close + 1 ELSE close END, day(date) FROM bars WHERE date < DATE '2024-01-20' AND date <= DATE '2024-01-15'
UNION ALL SELECT code, date, close + 1, day(date) FROM bars WHERE date > DATE '2024-01-15' AND date < DATE '2024-01-20'""", name="merge_update_only")
def merge_update_only(s: Shapes) -> DataFrame:
    """Batch rows without a stored row are ignored; stored rows beyond the batch stay."""
    base = s.bars().selectExpr("code", "date", "close", "CAST(dayofmonth(date) AS BIGINT) AS is_new")
    batch = s.bars().where("date > DATE '2024-01-15' AND date < DATE '2024-01-20'").selectExpr("code", "date", "close + 1 AS close")
    extra = batch.selectExpr("concat(code, '.X') AS code", "date", "close")
    return merge.update_keyed(base, batch.unionByName(extra), ["code", "date"], ["close"])


@query("""
SELECT code, trade_date, CASE WHEN trade_date > DATE '2024-01-10' AND day(trade_date) % 2 = 0 THEN 1.5 ELSE turnover_rate END AS turnover_rate,
       CASE WHEN trade_date > DATE '2024-01-10' THEN coalesce(close, pe) ELSE pe END AS pe, pb,
       CASE WHEN trade_date > DATE '2024-01-10' THEN coalesce(CASE WHEN tradestatus = 1 THEN 1 END, is_st) ELSE is_st END AS is_st, limit_up, total_shares
FROM (SELECT b.code, b.trade_date, d.close, d.tradestatus, is_limit_up,
        CASE WHEN b.trade_date < DATE '2024-01-20' THEN turnover_rate END AS turnover_rate, CASE WHEN b.trade_date < DATE '2024-01-20' THEN pe END AS pe,
        CASE WHEN b.trade_date < DATE '2024-01-20' THEN pb END AS pb, CASE WHEN b.trade_date < DATE '2024-01-20' THEN is_st END AS is_st,
        CASE WHEN b.trade_date < DATE '2024-01-20' THEN limit_up END AS limit_up, CASE WHEN b.trade_date < DATE '2024-01-20' THEN total_shares END AS total_shares
      FROM basic b JOIN bars d ON d.code = b.code AND d.date = b.trade_date)""")
def merge_coalesce(s: Shapes) -> DataFrame:
    batch = s.bars().where("date > DATE '2024-01-10'").selectExpr(
        "code", "date AS trade_date", "CASE WHEN dayofmonth(date) % 2 = 0 THEN 1.5D END AS turnover_rate", "close AS pe",
        "CAST(NULL AS DOUBLE) AS pb", "CASE WHEN tradestatus = 1 THEN 1 END AS is_st",
    )
    stored = s.basic().where("trade_date < DATE '2024-01-20'")
    merged = loads.load_indicators(stored, batch)
    return merged.select("code", "trade_date", "turnover_rate", "pe", "pb", "is_st", "limit_up", "total_shares")


@query("""
SELECT code, trade_date, coalesce(CASE WHEN day(trade_date) % 3 = 0 THEN 777 END, total_shares) AS total_shares, coalesce(888, float_shares)::bigint AS float_shares, is_limit_up
FROM basic""")
def merge_share_counts(s: Shapes) -> DataFrame:
    batch = s.bars().selectExpr(
        "code", "date", "CASE WHEN dayofmonth(date) % 3 = 0 THEN 777L END AS total_shares", "888L AS float_shares"
    )
    return loads.load_share_counts(s.basic(), batch).select("code", "trade_date", "total_shares", "float_shares", "is_limit_up")


def stored_master(s: Shapes) -> DataFrame:
    return s.master().where("list_date < DATE '2024-01-15'").selectExpr(
        "*", f"{STAMP_OLD} AS created_at", f"{STAMP_OLD} AS last_updated_at"
    )


@query(f"""
SELECT code, symbol, CASE WHEN board = 'GEM' THEN name || ' B' ELSE name END AS name, exchange, board, list_date,
       CASE WHEN board = 'STAR' THEN NULL ELSE delist_date END AS delist_date, list_status,
       CASE WHEN list_date < DATE '2024-01-15' THEN {OLD_TS} ELSE {NEW_TS} END AS created_at,
       CASE WHEN list_date < DATE '2024-01-15' AND NOT (board = 'GEM' OR (board = 'STAR' AND delist_date IS NOT NULL)) THEN {OLD_TS} ELSE {NEW_TS} END AS last_updated_at
FROM master""")
def merge_changed(s: Shapes) -> DataFrame:
    batch = s.master().selectExpr(
        "code", "symbol", "CASE WHEN board = 'GEM' THEN concat(name, ' B') ELSE name END AS name", "exchange", "board", "list_date",
        "CASE WHEN board = 'STAR' THEN NULL ELSE delist_date END AS delist_date", "list_status",
    )
    return loads.load_securities(stored_master(s), batch, NOW)


@query(f"""
SELECT '2021' AS sw_version, industry_code, CASE WHEN sw_level = 2 THEN upper(industry_name) || '!' ELSE industry_name END AS industry_name, sw_level,
       parent_code, CASE WHEN sw_level = 1 THEN {OLD_TS} ELSE {NEW_TS} END AS updated_at FROM hierarchy""")
def merge_hierarchy(s: Shapes) -> DataFrame:
    tree = hierarchy(s)
    stored = tree.where("sw_level < 3").selectExpr("*", f"{STAMP_OLD} AS updated_at")
    batch = tree.withColumn("industry_name", F.expr("CASE WHEN sw_level = 2 THEN concat(upper(industry_name), '!') ELSE industry_name END"))
    return loads.load_hierarchy(stored, batch, NOW)


def daily_totals(s: Shapes, factor: str) -> DataFrame:
    """Order totals per day and priority class in the margin layout."""
    values = [f"sum(CAST(o_totalprice AS DECIMAL(20,4))) * {i + 1} * {factor} AS {c}" for i, c in enumerate(MARGIN_COLUMNS)]
    grouped = s.table("orders").groupBy(
        F.expr("CAST(o_orderdate AS DATE) AS trade_date"), F.expr("CASE WHEN o_orderpriority < '3' THEN 'SH' ELSE 'SZ' END AS exchange_code")
    ).agg(*[F.expr(v) for v in values])
    return grouped


def _totals_sql(columns: str) -> str:
    values = ", ".join(
        f"cast(cast(sum(o_totalprice::decimal(20,4)) * {i + 1} * if(o_orderdate >= TIMESTAMP '1998-01-01', 2, 1) AS double) AS decimal(20,4)) AS {c}"
        for i, c in enumerate(MARGIN_COLUMNS)
    )
    return f"""SELECT o_orderdate::date AS trade_date, CASE WHEN o_orderpriority < '3' THEN 'SH' ELSE 'SZ' END AS exchange_code, {values}, {columns}
FROM orders GROUP BY o_orderdate, 2"""


@query(_totals_sql(f"CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN {NEW_TS} ELSE {OLD_TS} END AS created_at, "
                   f"CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN {NEW_TS} ELSE {OLD_TS} END AS updated_at"))
def merge_insert_replace(s: Shapes) -> DataFrame:
    casts = [f"CAST(CAST({c} AS DOUBLE) AS DECIMAL(20,4)) AS {c}" for c in MARGIN_COLUMNS]
    stored = daily_totals(s, "1").where("trade_date < DATE '1999-01-01'").selectExpr(
        "trade_date", "exchange_code", *casts, f"{STAMP_OLD} AS created_at", f"{STAMP_OLD} AS updated_at"
    )
    return loads.load_margin_summary(stored, daily_totals(s, "2").where("trade_date >= DATE '1998-01-01'"), NOW)


@query(_totals_sql(f"CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN {NEW_TS} ELSE {OLD_TS} END AS created_at, "
                   f"CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN {NEW_TS} ELSE {OLD_TS} END AS updated_at").replace(
    "AS exchange_code,", "AS exchange_code, '000001' AS symbol, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'new' ELSE 'old' END AS code,", 1))
def merge_keep_created(s: Shapes) -> DataFrame:
    casts = [f"CAST(CAST({c} AS DOUBLE) AS DECIMAL(20,4)) AS {c}" for c in MARGIN_COLUMNS]
    stored = daily_totals(s, "1").where("trade_date < DATE '1999-01-01'").selectExpr(
        "trade_date", "exchange_code", "'000001' AS symbol", "'old' AS code", *casts, f"{STAMP_OLD} AS created_at", f"{STAMP_OLD} AS updated_at"
    )
    batch = daily_totals(s, "2").where("trade_date >= DATE '1998-01-01'").selectExpr("*", "'000001' AS symbol", "'new' AS code")
    return loads.load_margin_detail(stored, batch, NOW)


SUBSET = ["eps", "roe", "total_assets", "op_revenue", "ocf_in", "cash_end_bal", "net_margin", "report_anno_date"]


def _subset_sql() -> str:
    old = _report_columns(SUBSET)
    # Fields up to 120 come from the batch (NULL there overwrites), later ones stay.
    late = {REPORT_FIELDS[n] for n in REPORT_FIELDS if n > 120}
    parts = []
    for piece in old.split(", CASE"):
        text = piece if piece.startswith("CASE") else "CASE" + piece
        body, name = text.rsplit(" AS ", 1)
        parts.append(text if name in late else f"2 * ({body}) AS {name}")
    return f"SELECT lpad(l_suppkey::varchar, CAST(greatest(6, length(l_suppkey::varchar)) AS INT), '0') AS code, report_date, {', '.join(parts)}, {NEW_TS} AS updated_at FROM {REPORTS}"


@query(_subset_sql())
def merge_subset(s: Shapes) -> DataFrame:
    raw = report_raw(s)
    stored = finance_report(raw).drop("field_count").selectExpr("*", f"{STAMP_OLD} AS updated_at")
    doubled = raw.withColumn("fields", F.expr("transform(fields, x -> x * 2)"))
    merged = loads.load_finance(stored, finance_report(doubled, width=120), NOW)
    return merged.select("code", "report_date", *SUBSET, "updated_at")


@query(f"""
SELECT code, trade_date, CASE WHEN n THEN fore_factor * 2 ELSE fore_factor END AS fore_factor, CASE WHEN n THEN back_factor * 2 ELSE back_factor END AS back_factor,
       CASE WHEN n THEN adjust_factor * 2 ELSE adjust_factor END AS adjust_factor,
       CASE WHEN o THEN {OLD_TS} ELSE TIMESTAMP '2024-01-31 00:00:00' END AS created_at, CASE WHEN n THEN TIMESTAMP '2024-01-31 01:00:00' ELSE {OLD_TS} END AS updated_at
FROM (SELECT *, date AS trade_date, date > DATE '2024-01-10' AS n, date < DATE '2024-01-20' AS o FROM factor_events)""")
def merge_source_stamps(s: Shapes) -> DataFrame:
    events = s.factor_events().withColumnRenamed("date", "trade_date").drop("user_id")
    stored = events.where("trade_date < DATE '2024-01-20'").selectExpr("*", f"{STAMP_OLD} AS created_at", f"{STAMP_OLD} AS updated_at")
    batch = events.where("trade_date > DATE '2024-01-10'").selectExpr(
        "code", "trade_date", "fore_factor * 2 AS fore_factor", "back_factor * 2 AS back_factor", "adjust_factor * 2 AS adjust_factor",
        "TIMESTAMP_NTZ '2024-01-31 00:00:00' AS created_at", "TIMESTAMP_NTZ '2024-01-31 01:00:00' AS updated_at",
    )
    return merge.merge_keyed(stored, batch, ["code", "trade_date"], IMPORT_RULES["adj_factor"])


@query(f"""
SELECT code, date AS trade_date, fore_factor, {OLD_TS} AS created_at, CASE WHEN date > DATE '2024-01-10' THEN {NEW_TS} ELSE {OLD_TS} END AS updated_at FROM factor_events""")
def merge_idempotent(s: Shapes) -> DataFrame:
    """Merging the same batch twice leaves what merging it once leaves."""
    events = s.factor_events().withColumnRenamed("date", "trade_date").drop("user_id")
    stored = events.selectExpr("*", f"{STAMP_OLD} AS created_at", f"{STAMP_OLD} AS updated_at")
    batch = events.where("trade_date > DATE '2024-01-10'")
    once = merge.merge_keyed(stored, batch, ["code", "trade_date"], FACTOR_RULES, now=NOW)
    twice = merge.merge_keyed(once, batch, ["code", "trade_date"], FACTOR_RULES, now=NOW)
    return twice.select("code", "trade_date", "fore_factor", "created_at", "updated_at")


@query("SELECT cal_date, CASE WHEN day(cal_date) = 2 THEN 0 ELSE is_open END AS is_open FROM cal")
def merge_calendar(s: Shapes) -> DataFrame:
    stored = s.calendar().where("cal_date < DATE '2024-01-15'")
    return loads.load_calendar(stored, s.calendar().selectExpr("cal_date", "CASE WHEN dayofmonth(cal_date) = 2 THEN 0 ELSE is_open END AS is_open"))


@query(f"SELECT *, {NEW_TS} AS updated_at FROM capital")
def merge_capital(s: Shapes) -> DataFrame:
    stored = s.capital().selectExpr("code", "date", "category", "dividend + 1 AS dividend", "allotment_price", "bonus_share", "allotment_share",
                                    f"{STAMP_OLD} AS updated_at")
    return loads.load_capital(stored, s.capital().withColumn("date", F.col("date").cast("string")), NOW)


@query("""WITH
f AS (SELECT * FROM orders WHERE o_orderstatus = 'F'), rest AS (SELECT * FROM orders WHERE o_orderstatus <> 'F')
SELECT o_orderkey, o_orderpriority, o_orderdate, o_totalprice FROM f
UNION ALL
SELECT o_orderkey, o_orderpriority, o_orderdate, o_totalprice FROM rest r
WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.o_orderpriority = r.o_orderpriority AND f.o_orderdate = r.o_orderdate)""")
def fallback_union(s: Shapes) -> DataFrame:
    rows = s.table("orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderstatus")
    primary, secondary = rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus <> 'F'")
    return merge.fallback_union(primary, secondary, ["o_orderpriority", "o_orderdate"]).drop("o_orderstatus")


@query("""
SELECT o_custkey, arg_min(total, rank) AS total, min(rank)::int AS source FROM (
  SELECT o_custkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS rank, max(o_totalprice) AS total FROM orders GROUP BY ALL)
GROUP BY o_custkey""")
def source_cascade(s: Shapes) -> DataFrame:
    best = s.table("orders").groupBy("o_custkey", "o_orderstatus").agg(F.max("o_totalprice").alias("total"))
    sources = [
        best.where(F.col("o_orderstatus") == status).select("o_custkey", "total", F.lit(i).alias("source"))
        for i, status in enumerate("PFO")
    ]
    return merge.first_available(sources, ["o_custkey"])


@query("""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority, CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN o_orderdate END AS o_orderdate
FROM orders""")
def concat_sources(s: Shapes) -> DataFrame:
    orders = s.table("orders")
    return merge.concat_sources([
        orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority"),
        orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice", "o_custkey"),
        orders.where("o_orderstatus NOT IN ('F', 'O')").select("o_orderkey", "o_totalprice", "o_orderdate"),
    ])


@query(f"""SELECT code, report_date, CASE WHEN old THEN 2 ELSE 3 END * v1 AS eps, CASE WHEN year(report_date) < 1998 AND old THEN 1 ELSE 3 END * v304 AS rd_expense,
  {NEW_TS} AS updated_at FROM (
  SELECT lpad(l_suppkey::varchar, CAST(greatest(6, length(l_suppkey::varchar)) AS INT), '0') AS code, report_date, year(report_date) < 1998 AS old, CASE WHEN (l_suppkey + 1) % 29 <> 0 THEN (l_suppkey + month(report_date)) % 1000 / 8 END AS v1,
         CASE WHEN (l_suppkey + 304) % 29 <> 0 THEN (l_suppkey * 304 + month(report_date)) % 1000 / 8 END AS v304 FROM {REPORTS})""")
def merge_mixed_layouts(s: Shapes) -> DataFrame:
    """Short rows replace only the fields they carry; full rows replace all, NULLs included."""
    raw = report_raw(s)
    full = raw.withColumn("fields", F.expr(
        """transform(sequence(1, 320), n -> CASE WHEN (CAST(code AS BIGINT) + n) % 29 = 0 THEN CAST('NaN' AS FLOAT)
           ELSE CAST((CAST(code AS BIGINT) * n + month(report_date)) % 1000 / 8 AS FLOAT) END)"""
    ))
    stored = finance_report(full).drop("field_count").selectExpr("*", f"{STAMP_OLD} AS updated_at")
    batch = finance_report(raw.withColumn("fields", F.expr("transform(fields, x -> x * IF(size(fields) = 120, 2, 3))")))
    return loads.load_finance(stored, batch, NOW).select("code", "report_date", "eps", "rd_expense", "updated_at")


@query("SELECT code, date, 2 AS copies FROM bars WHERE day(date) % 9 = 4 UNION ALL SELECT NULL, NULL, count(*) FROM bars WHERE day(date) % 9 = 5 HAVING count(*) > 1")
def repeated_bar_keys(s: Shapes) -> DataFrame:
    """Bars of some days twice, and rows without a key: only crowded months are counted key by key."""
    twice = s.bars().where("dayofmonth(date) % 9 = 4")
    bare = s.bars().where("dayofmonth(date) % 9 = 5").selectExpr("CAST(NULL AS STRING) AS code", "CAST(NULL AS DATE) AS date")
    every = s.bars().select("code", "date").unionByName(twice.select("code", "date")).unionByName(bare)
    return repeated_keys(every, ["code", "date"], "date")


TWO_MONTHS = "(date BETWEEN DATE '2021-03-01' AND DATE '2021-03-31' OR date BETWEEN DATE '2023-11-01' AND DATE '2023-11-30')"


def touched_load(s: Shapes) -> tuple[DataFrame, DataFrame]:
    """A long store, and a batch for a few days of two of its months."""
    stored = s.long_bars().select(*TABLES["stock_daily"].schema.names)
    batch = stored.where(f"{TWO_MONTHS} AND dayofmonth(date) BETWEEN 10 AND 14").withColumn("close", F.col("close") + 1)
    return stored, batch


@query(f"""
SELECT code, date, open, high, low, CASE WHEN day(date) BETWEEN 10 AND 14 THEN close + 1 ELSE close END AS close, pre_close, tradestatus, volume, amount
FROM long_bars WHERE {TWO_MONTHS}""")
def load_touched_months(s: Shapes) -> DataFrame:
    """The daily default: what a batch's months become, whole, ready to overwrite them."""
    stored, batch = touched_load(s)
    return loads.load_bars(stored, batch, touched=merge.MONTH)


@query(f"""
SELECT code, date, open, high, low, close + 1 AS close, pre_close, tradestatus, volume, amount
FROM long_bars WHERE {TWO_MONTHS} AND day(date) BETWEEN 10 AND 14""")
def load_touched_days(s: Shapes) -> DataFrame:
    stored, batch = touched_load(s)
    return loads.load_bars(stored, batch, touched=merge.DAY)
