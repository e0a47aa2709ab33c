"""The relations of ``shapes`` in the SQL dialect of the comparison engine, as named CTEs."""

from __future__ import annotations

import re


def code_sql(k: str) -> str:
    return f"lpad(({k})::varchar, CAST(greatest(6, length(({k})::varchar)) AS INT), '0') || '.' || {exchange_sql(k)}"


def exchange_sql(k: str) -> str:
    return f"(CASE WHEN ({k}) % 9 = 5 THEN 'BJ' WHEN ({k}) % 2 = 1 THEN 'SH' ELSE 'SZ' END)"


def master_sql(table: str, key: str, name: str, first: str, offset: str) -> str:
    return f"""
SELECT {code_sql(key)} AS code, lpad({key}::varchar, CAST(greatest(6, length({key}::varchar)) AS INT), '0') AS symbol, {name} AS name,
       {exchange_sql(key)} AS exchange,
       CASE WHEN {key} % 9 <= 2 THEN 'MAIN' WHEN {key} % 9 = 3 THEN 'STAR' WHEN {key} % 9 = 4 THEN 'GEM'
            WHEN {key} % 9 = 5 THEN 'BJ' WHEN {key} % 9 = 6 THEN 'INDEX' WHEN {key} % 9 = 7 THEN 'ETF' ELSE 'BOND' END AS board,
       DATE '{first}' + ({offset})::int AS list_date,
       CASE WHEN {key} % 11 = 3 THEN DATE '{first}' + ({offset})::int + ({key} % 10 + 15)::int END AS delist_date,
       CASE WHEN {key} % 22 = 3 THEN 'D' ELSE 'L' END AS list_status
FROM {table}"""


def calendar_sql(span: str) -> str:
    return f"""
SELECT d::date AS cal_date, CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END AS is_open
FROM (SELECT unnest(generate_series(lo::timestamp, hi::timestamp, INTERVAL 1 DAY)) AS d FROM ({span}))"""


CTES: dict[str, str] = {
    "bars": f"""
SELECT user_id, {code_sql('user_id')} AS code, date, open, high, low, close,
       CASE WHEN (user_id + day(date)) % 7 = 0 THEN -1.0 ELSE open END AS pre_close,
       CASE WHEN (user_id + day(date)) % 13 = 0 THEN 0 ELSE 1 END AS tradestatus,
       CASE WHEN (user_id + day(date)) % 17 = 0 THEN 0 ELSE trades * 100 END AS volume, amount
FROM (SELECT user_id, ts::date AS date, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
             arg_max(value, ts) AS close, count(*) AS trades, sum(value::decimal(18,2))::double AS amount
      FROM events GROUP BY user_id, ts::date)""",
    "cal": calendar_sql("SELECT min(ts::date) lo, max(ts::date) hi FROM events"),
    "master": master_sql("customer", "c_custkey", "c_name", "2023-12-20", "c_custkey % 40"),
    "basic": """
SELECT code, date AS trade_date,
       CASE WHEN (user_id + day(date)) % 4 = 0 THEN (user_id % 50) / 10 END AS turnover_rate,
       NULL::double AS float_mv, NULL::double AS total_mv,
       CASE WHEN (user_id + day(date)) % 6 = 0 THEN NULL WHEN (user_id + day(date)) % 6 = 1 THEN 0.0
            ELSE (user_id % 30 + 1)::double END AS pe,
       CASE WHEN (user_id + day(date)) % 8 = 0 THEN NULL ELSE (user_id % 10 - 1)::double END AS pb,
       CASE WHEN user_id % 5 = 0 THEN 1 WHEN user_id % 5 = 1 THEN NULL ELSE 0 END AS is_st,
       CASE WHEN (user_id + day(date)) % 5 = 0 THEN 0.0 ELSE close + 1 END AS limit_up,
       close - 1 AS limit_down, 0 AS is_limit_up, 0 AS is_limit_down, NULL::double AS volume_ratio,
       CASE WHEN user_id % 11 <> 0 THEN user_id * 2000 + 2000000 END AS total_shares,
       CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 13 = 0 THEN 0 ELSE user_id * 1000 + 1000000 END AS float_shares
FROM bars""",
    "factor_events": f"""
SELECT user_id, {code_sql('user_id')} AS code, date, k / 100 AS fore_factor, k / 50 + 1 AS back_factor,
       k / 10 AS adjust_factor
FROM (SELECT user_id, ts::date AS date, arg_max(regexp_extract(props, '(\\d+)', 1)::int, ts) AS k
      FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts::date)""",
    "capital_raw": """
SELECT event_id, lpad(user_id::varchar, CAST(greatest(6, length(user_id::varchar)) AS INT), '0') AS code, year(ts)::int AS year, month(ts)::int AS month, day(ts)::int AS day,
       (CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id % 17 END)::int AS category,
       k / 10 AS fenhong, (k % 7) / 2 AS peigujia, (k % 5)::double AS songzhuangu, (k % 3)::double AS peigu,
       CASE WHEN k % 4 <> 0 THEN k::double * 10.5::double ELSE 0 END AS panqianliutong,
       CASE WHEN k % 6 <> 0 THEN k::double * 20.25::double ELSE 0 END AS qianzongguben,
       k::double * 11.5::double AS panhouliutong, k::double * 22.75::double AS houzongguben
FROM (SELECT *, regexp_extract(props, '(\\d+)', 1)::int AS k FROM events WHERE event_type = 'signup')""",
    "category_names": """
SELECT unnest(range(1, 16))::int AS category, unnest(['除权除息','送配股上市','非流通股上市','未知股本变动','股本变化',
  '增发新股','股份回购','增发新股上市','转配股上市','可转债上市','扩缩股','非流通股缩股','送认购权证','送认沽权证','未知新类别']) AS name""",
    "capital_named": """
SELECT event_id, code, make_date(year, month, day) AS date, n.name AS category,
       CASE WHEN r.category = 1 THEN fenhong ELSE panqianliutong END AS dividend,
       CASE WHEN r.category = 1 THEN peigujia ELSE qianzongguben END AS allotment_price,
       CASE WHEN r.category = 1 THEN songzhuangu ELSE panhouliutong END AS bonus_share,
       CASE WHEN r.category = 1 THEN peigu ELSE houzongguben END AS allotment_share
FROM capital_raw r LEFT JOIN category_names n ON n.category = r.category""",
    "capital": """
SELECT code, date, category, dividend, allotment_price, bonus_share, allotment_share
FROM capital_named WHERE category IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY code, date, category ORDER BY event_id DESC) = 1""",
    "long_bars": f"""
SELECT l_suppkey, {code_sql('l_suppkey')} AS code, date, pre_close AS open, top AS high, pre_close AS low,
       CASE WHEN lots % 3 = 0 THEN round(pre_close * 1.1::double + 0.000001::double, 2)
            WHEN lots % 3 = 1 THEN round(pre_close * 0.9::double + 0.000001::double, 2) ELSE top END AS close,
       CASE WHEN (l_suppkey + lots) % 23 = 0 THEN -1.0 ELSE pre_close END AS pre_close,
       CASE WHEN (l_suppkey + day(date)) % 13 = 0 THEN 0 ELSE 1 END AS tradestatus, lots * 100 AS volume, amount
FROM (SELECT l_suppkey, l_shipdate::date + 9131 AS date, min(l_extendedprice) AS pre_close, max(l_extendedprice) AS top,
             sum(l_quantity::bigint)::bigint AS lots, sum(l_extendedprice::decimal(18,2))::double AS amount
      FROM lineitem GROUP BY 1, 2)""",
    "long_master": master_sql("supplier", "s_suppkey", "s_name", "2019-12-20", "s_suppkey * 37 % 2500"),
    "long_basic": """
SELECT code, date AS trade_date,
       CASE WHEN l_suppkey % 5 = 0 THEN 1 WHEN l_suppkey % 5 = 1 THEN NULL ELSE 0 END AS is_st,
       CASE WHEN l_suppkey % 11 <> 0 THEN l_suppkey * 2000 + 2000000 END AS total_shares,
       CASE WHEN l_suppkey % 11 <> 0 THEN l_suppkey * 1000 + 1000000 END AS float_shares
FROM long_bars""",
    # Universe with intervals over the event month, and the dense factors over it.
    "targets": """
SELECT code, symbol, exchange, greatest(list_date, DATE '2024-01-01') AS start_date,
       least(CASE WHEN list_status = 'L' THEN DATE '2024-01-30' ELSE delist_date END, DATE '2024-01-31') AS end_date, list_status
FROM master WHERE board <> 'INDEX' AND (list_status = 'L' OR delist_date IS NOT NULL)""",
    "grid": """
SELECT t.code, c.cal_date AS trade_date FROM targets t JOIN cal c
  ON c.is_open = 1 AND c.cal_date BETWEEN t.start_date AND t.end_date""",
    "dense": """
SELECT g.code, g.trade_date, coalesce(e.fore_factor, 1.0) AS fore_factor, coalesce(e.back_factor, 1.0) AS back_factor,
       coalesce(e.adjust_factor, 1.0) AS adjust_factor
FROM grid g ASOF LEFT JOIN factor_events e ON g.code = e.code AND g.trade_date >= e.date""",
    # Audit helpers over the event month.
    "active": """
SELECT code, symbol, name, list_date, delist_date FROM master
WHERE board NOT IN ('INDEX', 'BJ') AND list_status = 'L'""",
    "open_days": "SELECT cal_date FROM cal WHERE is_open = 1 AND cal_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'",
    "halted": "SELECT code, date FROM bars WHERE tradestatus = 0 AND date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'",
    "listed_days": """
SELECT o.cal_date, a.code, a.name FROM open_days o JOIN active a
  ON o.cal_date >= a.list_date AND (a.delist_date IS NULL OR o.cal_date <= a.delist_date)""",
    "hierarchy_names": """
SELECT (r_regionkey * 10000 + 100000)::varchar AS code, r_name AS n1, '' AS n2, '' AS n3, r_regionkey::bigint AS seq FROM region
UNION ALL
SELECT (n_nationkey * 100 + 200000)::varchar, r_name, n_name, '', n_nationkey + 1000
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT (s_suppkey + 300000)::varchar, r_name, n_name,
       CASE WHEN v = 1 THEN s_name || ' (new)' ELSE s_name END, s_suppkey + 100000 + v * 10000000000
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
     CROSS JOIN (SELECT unnest([0, 1]) AS v)""",
    "hierarchy": """
SELECT code AS industry_code, CASE lvl WHEN 1 THEN n1 WHEN 2 THEN n2 ELSE n3 END AS industry_name, lvl AS sw_level,
       CASE lvl WHEN 2 THEN (SELECT max(p.code) FROM hierarchy_names p WHERE p.n1 = h.n1 AND p.n2 = '')
                WHEN 3 THEN (SELECT max(p.code) FROM hierarchy_names p WHERE p.n1 = h.n1 AND p.n2 = h.n2 AND p.n3 = '') END AS parent_code
FROM (SELECT *, CASE WHEN n2 = '' THEN 1 WHEN n3 = '' THEN 2 ELSE 3 END AS lvl FROM hierarchy_names
      QUALIFY row_number() OVER (PARTITION BY code ORDER BY seq DESC) = 1) h""",
}


def needs(sql: str) -> list[str]:
    """CTEs a statement uses, dependencies first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def with_shapes(sql: str) -> str:
    """Prefix a statement with the CTEs it uses; its own leading WITH is merged."""
    ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in needs(sql))
    body = sql.strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].strip()}"
    return f"WITH {ctes}\n{body}"
