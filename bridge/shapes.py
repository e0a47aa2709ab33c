"""Market-shaped relations derived from the given tables, so that operators have real input.

``events`` become short bar histories, ``lineitem`` long ones, ``customer`` and ``supplier``
security masters, and so on. Each relation is a plan over a whole table, written in SQL
expressions because they are plain projections and aggregates.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.operators.calendar import weekday_calendar
from marketframe.operators.merge import dedup_last
from marketframe.session import tune
from marketframe.sources.events import capital_events

NOW = dt.datetime(2024, 2, 1, 12, 0, 0)
OLD = dt.datetime(2023, 6, 1, 8, 30, 0)
SHIFT_DAYS = 9131  # moves the 1995-2001 ship dates onto 2020-2026

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def exchange_of(k: str) -> str:
    return f"CASE WHEN {k} % 9 = 5 THEN 'BJ' WHEN {k} % 2 = 1 THEN 'SH' ELSE 'SZ' END"


def symbol_of(k: str) -> str:
    return f"CASE WHEN {k} < 1000000 THEN lpad(CAST({k} AS STRING), 6, '0') ELSE CAST({k} AS STRING) END"


def code_of(k: str) -> str:
    return f"concat({symbol_of(k)}, '.', {exchange_of(k)})"


class Shapes:
    """Lazy access to the given tables and the relations derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    @cache
    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cache
    def bars(self) -> DataFrame:
        """Daily bars per user from events."""
        daily = self.table("events").groupBy("user_id", F.expr("CAST(ts AS DATE) AS date")).agg(
            F.expr("min_by(value, ts) AS open"), F.expr("max(value) AS high"), F.expr("min(value) AS low"),
            F.expr("max_by(value, ts) AS close"), F.expr("count(*) AS trades"),
            F.expr("CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount"),
        )
        mark = "(user_id + dayofmonth(date))"
        return daily.selectExpr(
            "user_id", f"{code_of('user_id')} AS code", "date", "open", "high", "low", "close",
            f"CASE WHEN {mark} % 7 = 0 THEN -1.0D ELSE open END AS pre_close",
            f"CASE WHEN {mark} % 13 = 0 THEN 0 ELSE 1 END AS tradestatus",
            f"CASE WHEN {mark} % 17 = 0 THEN 0L ELSE trades * 100 END AS volume", "amount",
        )

    @cache
    def calendar(self) -> DataFrame:
        return weekday_calendar(self.table("events"), F.expr("CAST(ts AS DATE)"))

    @cache
    def master(self) -> DataFrame:
        return master_from(self.table("customer"), "c_custkey", "c_name", "2023-12-20", "c_custkey % 40")

    @cache
    def basic(self) -> DataFrame:
        """Daily indicators for every bar, with missing values."""
        mark = "(user_id + dayofmonth(date))"
        return self.bars().selectExpr(
            "code", "date AS trade_date",
            f"CASE WHEN {mark} % 4 = 0 THEN (user_id % 50) / 10 END AS turnover_rate",
            "CAST(NULL AS DOUBLE) AS float_mv", "CAST(NULL AS DOUBLE) AS total_mv",
            f"CASE WHEN {mark} % 6 = 0 THEN NULL WHEN {mark} % 6 = 1 THEN 0.0D ELSE CAST(user_id % 30 + 1 AS DOUBLE) END AS pe",
            f"CASE WHEN {mark} % 8 = 0 THEN NULL ELSE CAST(user_id % 10 - 1 AS DOUBLE) END AS pb",
            "CASE WHEN user_id % 5 = 0 THEN 1 WHEN user_id % 5 = 1 THEN NULL ELSE 0 END AS is_st",
            f"CASE WHEN {mark} % 5 = 0 THEN 0.0D ELSE close + 1 END AS limit_up", "close - 1 AS limit_down",
            "0 AS is_limit_up", "0 AS is_limit_down", "CAST(NULL AS DOUBLE) AS volume_ratio",
            "CASE WHEN user_id % 11 <> 0 THEN user_id * 2000 + 2000000 END AS total_shares",
            "CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 13 = 0 THEN 0L ELSE user_id * 1000 + 1000000 END AS float_shares",
        )

    @cache
    def factor_events(self) -> DataFrame:
        """Sparse factor changes: the last purchase of a user and day."""
        last = self.table("events").where("event_type = 'purchase'").groupBy(
            "user_id", F.expr("CAST(ts AS DATE) AS date")
        ).agg(F.expr("max_by(CAST(regexp_extract(props, '(\\\\d+)', 1) AS INT), ts) AS k"))
        return last.selectExpr(
            "user_id", f"{code_of('user_id')} AS code", "date", "k / 100 AS fore_factor", "k / 50 + 1 AS back_factor",
            "k / 10 AS adjust_factor",
        )

    @cache
    def capital_raw(self) -> DataFrame:
        """Raw capital events with both value families filled, from signups."""
        parsed = self.table("events").where("event_type = 'signup'").selectExpr(
            "*", "CAST(regexp_extract(props, '(\\\\d+)', 1) AS INT) AS k"
        )
        return parsed.selectExpr(
            "event_id", f"{symbol_of('user_id')} AS code", "year(ts) AS year", "month(ts) AS month", "dayofmonth(ts) AS day",
            "CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id % 17 END AS INT) AS category",
            "k / 10 AS fenhong", "(k % 7) / 2 AS peigujia", "CAST(k % 5 AS DOUBLE) AS songzhuangu",
            "CAST(k % 3 AS DOUBLE) AS peigu",
            "CASE WHEN k % 4 <> 0 THEN k * 10.5D ELSE 0.0D END AS panqianliutong",
            "CASE WHEN k % 6 <> 0 THEN k * 20.25D ELSE 0.0D END AS qianzongguben",
            "k * 11.5D AS panhouliutong", "k * 22.75D AS houzongguben",
        )

    @cache
    def capital(self) -> DataFrame:
        """Stored capital detail: normalised, last event per key."""
        usable = capital_events(self.capital_raw(), keep=["event_id"]).where("category IS NOT NULL")
        return dedup_last(usable, ["code", "date", "category"], ["event_id"]).drop("event_id")

    @cache
    def long_bars(self) -> DataFrame:
        """Bars per supplier and ship date, 2020-2026, some closing at a limit."""
        daily = self.table("lineitem").groupBy(
            "l_suppkey", F.expr(f"date_add(CAST(l_shipdate AS DATE), {SHIFT_DAYS}) AS date")
        ).agg(
            F.expr("min(l_extendedprice) AS pre_close"), F.expr("max(l_extendedprice) AS top"),
            F.expr("sum(CAST(l_quantity AS BIGINT)) AS lots"),
            F.expr("CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount"),
        )
        return daily.selectExpr(
            "l_suppkey", f"{code_of('l_suppkey')} AS code", "date", "pre_close AS open", "top AS high", "pre_close AS low",
            """CASE WHEN lots % 3 = 0 THEN round((pre_close * 1.1D + 0.000001D) * 100) / 100
                    WHEN lots % 3 = 1 THEN round((pre_close * 0.9D + 0.000001D) * 100) / 100 ELSE top END AS close""",
            "CASE WHEN (l_suppkey + lots) % 23 = 0 THEN -1.0D ELSE pre_close END AS pre_close",
            "CASE WHEN (l_suppkey + dayofmonth(date)) % 13 = 0 THEN 0 ELSE 1 END AS tradestatus",
            "lots * 100 AS volume", "amount",
        )

    @cache
    def long_master(self) -> DataFrame:
        return master_from(self.table("supplier"), "s_suppkey", "s_name", "2019-12-20", "s_suppkey * 37 % 2500")

    @cache
    def long_basic(self) -> DataFrame:
        empty = [f"CAST(NULL AS DOUBLE) AS {c}" for c in ("turnover_rate", "float_mv", "total_mv", "pe", "pb")]
        return self.long_bars().selectExpr(
            "code", "date AS trade_date", *empty,
            "CASE WHEN l_suppkey % 5 = 0 THEN 1 WHEN l_suppkey % 5 = 1 THEN NULL ELSE 0 END AS is_st",
            "CAST(NULL AS DOUBLE) AS limit_up", "CAST(NULL AS DOUBLE) AS limit_down", "0 AS is_limit_up",
            "0 AS is_limit_down", "CAST(NULL AS DOUBLE) AS volume_ratio",
            "CASE WHEN l_suppkey % 11 <> 0 THEN l_suppkey * 2000 + 2000000 END AS total_shares",
            "CASE WHEN l_suppkey % 11 <> 0 THEN l_suppkey * 1000 + 1000000 END AS float_shares",
        )

    @cache
    def hierarchy_names(self) -> DataFrame:
        """Region, nation and supplier as three name levels, one row per node, with a row order.

        Level-3 nodes come twice, the second time renamed, so that keep-last has work to do.
        """
        region, nation, supplier = self.table("region"), self.table("nation"), self.table("supplier")
        l1 = region.selectExpr(
            "concat(r_regionkey * 10000 + 100000, '.0') AS code", "r_name AS n1", "'' AS n2",
            "CAST(NULL AS STRING) AS n3", "CAST(r_regionkey AS BIGINT) AS seq",
        )
        within = nation.join(region, F.expr("n_regionkey = r_regionkey"))
        l2 = within.selectExpr(
            "concat(' ', n_nationkey * 100 + 200000, ' ') AS code", "r_name AS n1", "n_name AS n2", "'nan' AS n3",
            "CAST(n_nationkey + 1000 AS BIGINT) AS seq",
        )
        l3 = supplier.join(within, F.expr("s_nationkey = n_nationkey")).selectExpr(
            "CAST(s_suppkey + 300000 AS STRING) AS code", "r_name AS n1", "n_name AS n2",
            "explode(array(struct(s_name AS n3, s_suppkey + 100000 AS seq), "
            "struct(concat(s_name, ' (new)') AS n3, s_suppkey + 10000100000 AS seq))) AS copy",
        ).selectExpr("code", "n1", "n2", "copy.n3", "copy.seq")
        return l1.unionByName(l2).unionByName(l3)


def master_from(df: DataFrame, key: str, name: str, first: str, offset: str) -> DataFrame:
    listed = df.selectExpr("*", f"date_add(DATE '{first}', CAST({offset} AS INT)) AS list_date")
    return listed.selectExpr(
        f"{code_of(key)} AS code", f"{symbol_of(key)} AS symbol", f"{name} AS name", f"{exchange_of(key)} AS exchange",
        f"""CASE WHEN {key} % 9 <= 2 THEN 'MAIN' WHEN {key} % 9 = 3 THEN 'STAR' WHEN {key} % 9 = 4 THEN 'GEM'
            WHEN {key} % 9 = 5 THEN 'BJ' WHEN {key} % 9 = 6 THEN 'INDEX' WHEN {key} % 9 = 7 THEN 'ETF' ELSE 'BOND' END AS board""",
        "list_date", f"CASE WHEN {key} % 11 = 3 THEN date_add(list_date, CAST({key} % 10 + 15 AS INT)) END AS delist_date",
        f"CASE WHEN {key} % 22 = 3 THEN 'D' ELSE 'L' END AS list_status",
    )
