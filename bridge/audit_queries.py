"""Audit queries over the whole event month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.operators.calendar import weekday_calendar
from marketframe.plans import audit
from marketframe.schemas import TABLES

from .daily_queries import dense_table
from .registry import query
from .shapes import Shapes

SCOPE = audit.Scope("2024-01-01", "2024-01-30")
BUDGET = 500

EXPECTED = "expected_days AS (SELECT cal_date, count(*) AS n FROM listed_days GROUP BY cal_date)"


def _gap_sql(table: str, day: str, is_bars: bool) -> str:
    off = "0" if is_bars else "coalesce(h.n, 0)"
    return f"""WITH {EXPECTED},
present AS (SELECT {day} AS day, count(*) AS n FROM {table} WHERE code IN (SELECT code FROM active) GROUP BY 1),
idle AS (SELECT date AS day, count(*) AS n FROM halted WHERE code IN (SELECT code FROM active) GROUP BY 1)
SELECT e.cal_date, e.n - {off} AS expected, coalesce(p.n, 0) AS actual, e.n - {off} - coalesce(p.n, 0) AS missing
FROM expected_days e LEFT JOIN present p ON p.day = e.cal_date LEFT JOIN idle h ON h.day = e.cal_date
WHERE e.n - {off} > coalesce(p.n, 0)"""


def _missing_sql(table: str, day: str, is_bars: bool) -> str:
    gaps = _gap_sql(table, day, is_bars)[len("WITH "):]
    head, tail = gaps.rsplit("\nSELECT e.cal_date", 1)
    halts = "" if is_bars else "AND NOT EXISTS (SELECT 1 FROM halted h WHERE h.code = l.code AND h.date = l.cal_date)"
    return f"""WITH {head}, gaps AS (SELECT e.cal_date{tail})
SELECT l.cal_date AS date, l.code, l.name FROM listed_days l
WHERE l.cal_date IN (SELECT cal_date FROM gaps)
  AND NOT EXISTS (SELECT 1 FROM {table} t WHERE t.code = l.code AND t.{day} = l.cal_date) {halts}"""


@query(_gap_sql("bars", "date", True))
def gap_dates_bars(s: Shapes) -> DataFrame:
    return audit.gap_dates(s.bars(), "date", s.bars(), s.master(), s.calendar(), SCOPE, is_bars=True)


@query(_gap_sql("basic", "trade_date", False))
def gap_dates_indicators(s: Shapes) -> DataFrame:
    return audit.gap_dates(s.basic(), "trade_date", s.bars(), s.master(), s.calendar(), SCOPE)


@query(_gap_sql("factor_events", "date", False))
def gap_dates_factors(s: Shapes) -> DataFrame:
    return audit.gap_dates(s.factor_events(), "date", s.bars(), s.master(), s.calendar(), SCOPE)


@query(_missing_sql("bars", "date", True))
def missing_codes_bars(s: Shapes) -> DataFrame:
    return audit.missing_codes(s.bars(), "date", s.bars(), s.master(), s.calendar(), SCOPE, is_bars=True)


@query(_missing_sql("factor_events", "date", False))
def missing_codes_factors(s: Shapes) -> DataFrame:
    return audit.missing_codes(s.factor_events(), "date", s.bars(), s.master(), s.calendar(), SCOPE)


NOT_HALTED = """
checked AS (
  SELECT b.*, a.name FROM basic b JOIN active a ON a.code = b.code JOIN open_days o ON o.cal_date = b.trade_date
  WHERE NOT EXISTS (SELECT 1 FROM halted h WHERE h.code = b.code AND h.date = b.trade_date))"""
LABELS = """
concat_ws(',', CASE WHEN coalesce(pb, 0) = 0 THEN 'pb' END, CASE WHEN coalesce(total_shares, 0) = 0 THEN 'total_shares' END,
  CASE WHEN coalesce(float_shares, 0) = 0 THEN 'float_shares' END, CASE WHEN coalesce(turnover_rate, 0) = 0 THEN 'turnover_rate' END,
  CASE WHEN coalesce(total_mv, 0) = 0 THEN 'total_mv' END, CASE WHEN coalesce(float_mv, 0) = 0 THEN 'float_mv' END,
  CASE WHEN coalesce(limit_up, 0) <= 0 THEN 'limit_up' END, CASE WHEN coalesce(limit_down, 0) <= 0 THEN 'limit_down' END)"""


@query(f"""WITH {NOT_HALTED}, labelled AS (SELECT trade_date, code, name, {LABELS} AS missing FROM checked)
SELECT * FROM labelled WHERE missing <> ''""")
def null_indicators(s: Shapes) -> DataFrame:
    return audit.null_indicators(s.basic(), s.bars(), s.master(), s.calendar(), SCOPE)


@query(f"WITH {NOT_HALTED} SELECT trade_date, code, name FROM checked WHERE is_st IS NULL")
def null_is_st(s: Shapes) -> DataFrame:
    return audit.null_is_st(s.basic(), s.bars(), s.master(), s.calendar(), SCOPE)


@query(f"WITH {NOT_HALTED} SELECT count(*) AS pe_missing FROM checked WHERE coalesce(pe, 0) = 0")
def missing_pe(s: Shapes) -> DataFrame:
    return audit.missing_pe(s.basic(), s.bars(), s.master(), s.calendar(), SCOPE)


BAD_BARS = """
bar_labels AS (
  SELECT b.date AS trade_date, b.code, a.name,
    concat_ws(',', CASE WHEN coalesce(open, 0) <= 0 THEN 'open' END, CASE WHEN coalesce(high, 0) <= 0 THEN 'high' END,
      CASE WHEN coalesce(low, 0) <= 0 THEN 'low' END, CASE WHEN coalesce(close, 0) <= 0 THEN 'close' END,
      CASE WHEN coalesce(pre_close, 0) <= 0 THEN 'pre_close' END, CASE WHEN coalesce(volume, 0) <= 0 THEN 'volume' END,
      CASE WHEN coalesce(amount, 0) <= 0 THEN 'amount' END) AS missing
  FROM bars b JOIN active a ON a.code = b.code JOIN open_days o ON o.cal_date = b.date WHERE b.tradestatus = 1)"""
BAD_FACTORS = """
factor_labels AS (
  SELECT f.date AS trade_date, f.code, a.name,
    concat_ws(',', CASE WHEN coalesce(fore_factor, 0) <= 0 THEN 'fore_factor' END,
      CASE WHEN coalesce(back_factor, 0) <= 0 THEN 'back_factor' END,
      CASE WHEN coalesce(adjust_factor, 0) <= 0 THEN 'adjust_factor' END) AS missing
  FROM factor_events f JOIN active a ON a.code = f.code JOIN open_days o ON o.cal_date = f.date
       JOIN bars b ON b.code = f.code AND b.date = f.date AND b.tradestatus = 1)"""


@query(f"WITH {BAD_BARS} SELECT * FROM bar_labels WHERE missing <> ''")
def bad_bars(s: Shapes) -> DataFrame:
    return audit.bad_bars(s.bars(), s.master(), s.calendar(), SCOPE)


def daily_factors(s: Shapes) -> DataFrame:
    return s.factor_events().withColumnRenamed("date", "trade_date")


@query(f"WITH {BAD_FACTORS} SELECT * FROM factor_labels WHERE missing <> ''")
def bad_factors(s: Shapes) -> DataFrame:
    return audit.bad_factors(daily_factors(s), s.bars(), s.master(), s.calendar(), SCOPE)


XDR = """
ex_days AS (
  SELECT a.code, a.name, c.date AS xdr_date, c.dividend, c.allotment_price, c.bonus_share, c.allotment_share,
         (SELECT max(cal_date) FROM cal WHERE is_open = 1 AND cal_date < c.date) AS prev_day
  FROM capital c JOIN active a ON a.symbol = c.code WHERE c.category = '除权除息'),
ex_priced AS (
  SELECT e.xdr_date, e.code, e.name, p.close AS close_prev, q.pre_close, q.tradestatus,
         fq.adjust_factor - fp.adjust_factor AS change,
         (p.close - dividend / 10 + allotment_price * allotment_share / 10) / (1 + bonus_share / 10 + allotment_share / 10) AS theory
  FROM ex_days e
  LEFT JOIN bars p ON p.code = e.code AND p.date = e.prev_day LEFT JOIN bars q ON q.code = e.code AND q.date = e.xdr_date
  LEFT JOIN dense fp ON fp.code = e.code AND fp.trade_date = e.prev_day
  LEFT JOIN dense fq ON fq.code = e.code AND fq.trade_date = e.xdr_date),
ex_checked AS (
  SELECT xdr_date, code, name, close_prev, pre_close, theory, round(abs(pre_close - theory), 4) AS diff,
         CASE WHEN close_prev IS NULL OR pre_close IS NULL THEN 'uncomputable'
              WHEN round(abs(pre_close - theory), 4) > 0.01::double THEN 'mismatch' ELSE 'ok' END AS status
  FROM ex_priced WHERE abs(change) > 1e-9 AND coalesce(tradestatus, 1) <> 0)"""


def xdr_inputs(s: Shapes) -> tuple:
    return s.capital(), s.bars(), dense_table(s), s.master(), s.calendar(), SCOPE


@query(f"WITH {XDR} SELECT * FROM ex_checked")
def xdr_check(s: Shapes) -> DataFrame:
    return audit.xdr_check(*xdr_inputs(s))


@query(f"WITH {XDR} SELECT * EXCLUDE (status) FROM ex_checked WHERE status = 'mismatch'")
def xdr_mismatches(s: Shapes) -> DataFrame:
    return audit.xdr_mismatches(*xdr_inputs(s))


@query(f"WITH {XDR} SELECT count(*) AS uncomputable FROM ex_checked WHERE status = 'uncomputable'")
def xdr_uncomputable(s: Shapes) -> DataFrame:
    return audit.xdr_uncomputable(*xdr_inputs(s))


@query("""WITH
lines AS (SELECT lpad(l_orderkey::varchar, CAST(greatest(6, length(l_orderkey::varchar)) AS INT), '0') AS code, l_shipdate::date AS date, l_linenumber % 4 - 1 AS tradestatus FROM lineitem),
repeated AS (SELECT code, date FROM lines GROUP BY code, date HAVING count(*) > 1)
SELECT 'stock_daily' AS table_name, 'not_null' AS rule, 'code' AS column_name, count(*) FILTER (code IS NULL) AS violations FROM lines
UNION ALL SELECT 'stock_daily', 'not_null', 'date', count(*) FILTER (date IS NULL) FROM lines
UNION ALL SELECT 'stock_daily', 'domain', 'tradestatus', count(*) FILTER (tradestatus NOT IN (-1, 0, 1)) FROM lines
UNION ALL SELECT 'stock_daily', 'unique', 'code,date', (SELECT count(*) FROM repeated)""")
def domain_check(s: Shapes) -> DataFrame:
    lines = s.table("lineitem").selectExpr(
        "lpad(CAST(l_orderkey AS STRING), CAST(greatest(6, length(CAST(l_orderkey AS STRING))) AS INT), '0') AS code", "CAST(l_shipdate AS DATE) AS date", "l_linenumber % 4 - 1 AS tradestatus"
    )
    return audit.domain_check(lines, TABLES["stock_daily"])


def tables(s: Shapes) -> audit.AuditTables:
    return audit.AuditTables(s.bars(), s.basic(), daily_factors(s), s.capital(), s.master(), s.calendar())




CHECKS = (("bars", "bars", "date", True), ("factors", "factor_events", "date", False), ("indicators", "basic", "trade_date", False))
GAPS = " UNION ALL ".join(
    f"SELECT {i}::int AS check_order, '{n}' AS check_name, * FROM ({_gap_sql(t, d, b)})" for i, (n, t, d, b) in enumerate(CHECKS)
)
MISSING = " UNION ALL ".join(
    f"SELECT {i}::int AS check_order, '{n}' AS check_name, * FROM ({_missing_sql(t, d, b)})" for i, (n, t, d, b) in enumerate(CHECKS)
)
# The check's ex-rights part compares with the sparse factor table here.
XDR_SPARSE = XDR.replace("LEFT JOIN dense fp ON fp.code = e.code AND fp.trade_date", "LEFT JOIN factor_events fp ON fp.code = e.code AND fp.date").replace(
    "LEFT JOIN dense fq ON fq.code = e.code AND fq.trade_date", "LEFT JOIN factor_events fq ON fq.code = e.code AND fq.date")
SUMMARY = f"""
{NOT_HALTED}, {BAD_BARS}, {BAD_FACTORS}, {XDR_SPARSE},
all_gaps AS ({GAPS}),
summary AS (
  SELECT c.name AS check_name, 'core' AS kind, coalesce(sum(missing), 0)::bigint AS row_count
  FROM (SELECT unnest(['bars', 'factors', 'indicators']) AS name) c LEFT JOIN all_gaps g ON g.check_name = c.name GROUP BY c.name
  UNION ALL SELECT 'bad_bars', 'warning', count(*) FROM bar_labels WHERE missing <> ''
  UNION ALL SELECT 'bad_factors', 'warning', count(*) FROM factor_labels WHERE missing <> ''
  UNION ALL SELECT 'null_is_st', 'warning', count(*) FROM checked WHERE is_st IS NULL
  UNION ALL SELECT 'null_indicators', 'warning', count(*) FROM checked WHERE {LABELS} <> ''
  UNION ALL SELECT 'xdr_pre_close', 'warning', count(*) FROM ex_checked WHERE status = 'mismatch')"""


@query(GAPS)
def audit_gaps(s: Shapes) -> DataFrame:
    return audit.audit_gaps(tables(s), SCOPE)


@query(f"WITH {SUMMARY} SELECT * FROM summary")
def audit_summary(s: Shapes) -> DataFrame:
    return audit.audit_summary(tables(s), SCOPE)


@query(f"""WITH {SUMMARY}, totals AS (
  SELECT sum(row_count) FILTER (kind = 'core')::bigint AS core_missing, sum(row_count) FILTER (kind = 'warning')::bigint AS warnings FROM summary)
SELECT CASE WHEN core_missing = 0 THEN 'complete' ELSE 'gaps_found' END AS status, * FROM totals""")
def audit_status(s: Shapes) -> DataFrame:
    return audit.audit_status(audit.audit_summary(tables(s), SCOPE))


@query(f"SELECT * FROM ({MISSING}) ORDER BY check_order, date, code LIMIT {BUDGET}")
def detail_budget(s: Shapes) -> DataFrame:
    found = audit.audit_missing(tables(s), SCOPE)
    return audit.limit_detail(found, ["check_order", "date", "code"], "check_name", BUDGET)[0]


@query(f"""WITH ranked AS (
  SELECT check_name, row_number() OVER (ORDER BY check_order, date, code) AS place FROM ({MISSING}))
SELECT check_name, count(*) AS total, count(*) FILTER (place <= {BUDGET}) AS shown, count(*) FILTER (place <= {BUDGET}) < count(*) AS truncated
FROM ranked GROUP BY check_name""")
def detail_totals(s: Shapes) -> DataFrame:
    found = audit.audit_missing(tables(s), SCOPE)
    return audit.limit_detail(found, ["check_order", "date", "code"], "check_name", BUDGET)[1]


def _long_gap(s: Shapes) -> DataFrame:
    days = weekday_calendar(s.long_bars(), F.col("date"))
    scope = audit.Scope("2020-01-01", "2026-12-31")
    return audit.gap_dates(s.long_bars(), "date", s.long_bars(), s.long_master(), days, scope, is_bars=True)


@query("""WITH
spread AS (SELECT d::date AS day FROM (SELECT unnest(generate_series(lo::timestamp, hi::timestamp, INTERVAL 1 DAY)) AS d
           FROM (SELECT min(date) AS lo, max(date) AS hi FROM long_bars)) WHERE isodow(d) < 6),
lively AS (SELECT code, list_date, delist_date FROM long_master WHERE board NOT IN ('INDEX', 'BJ') AND list_status = 'L'),
wanted AS (SELECT day, count(*) AS n FROM spread JOIN lively ON day >= list_date AND (delist_date IS NULL OR day <= delist_date) GROUP BY day),
had AS (SELECT date AS day, count(*) AS n FROM long_bars WHERE code IN (SELECT code FROM lively) GROUP BY date)
SELECT w.day AS cal_date, w.n AS expected, coalesce(h.n, 0) AS actual, w.n - coalesce(h.n, 0) AS missing
FROM wanted w LEFT JOIN had h USING (day) WHERE w.n > coalesce(h.n, 0)""")
def gap_dates_long(s: Shapes) -> DataFrame:
    return _long_gap(s)


@query(f"""WITH {SUMMARY}, totals AS (
  SELECT sum(row_count) FILTER (kind = 'core')::bigint AS core_missing, sum(row_count) FILTER (kind = 'warning')::bigint AS warnings FROM summary),
all_missing AS (SELECT *, row_number() OVER (ORDER BY check_order, date, code) AS place FROM ({MISSING})),
detail AS (SELECT check_name, count(*) AS total, count(*) FILTER (place <= {BUDGET}) AS shown FROM all_missing GROUP BY check_name)
SELECT 'status' AS part, json_object('status', CASE WHEN core_missing = 0 THEN 'complete' ELSE 'gaps_found' END,
       'core_missing', core_missing, 'warnings', warnings)::varchar AS document FROM totals
UNION ALL SELECT 'check', CASE WHEN d.total IS NULL THEN json_object('check_name', c.check_name, 'kind', kind, 'row_count', row_count)
       ELSE json_object('check_name', c.check_name, 'kind', kind, 'row_count', row_count, 'total', total, 'shown', shown, 'truncated', shown < total) END::varchar
FROM summary c LEFT JOIN detail d ON d.check_name = c.check_name
UNION ALL SELECT 'gap', json_object('check_order', check_order, 'check_name', check_name, 'cal_date', cal_date::varchar,
       'expected', expected, 'actual', actual, 'missing', missing)::varchar FROM all_gaps
UNION ALL SELECT 'missing', json_object('check_order', check_order, 'check_name', check_name, 'date', date::varchar, 'code', code, 'name', name)::varchar
FROM all_missing WHERE place <= {BUDGET}""")
def audit_document(s: Shapes) -> DataFrame:
    return audit.audit_document(tables(s), SCOPE, limit=BUDGET)


@query("""WITH
chosen AS (SELECT code, list_date, delist_date FROM master WHERE board = 'INDEX' AND list_status = 'L'),
due AS (SELECT cal_date, count(*) AS n FROM cal JOIN chosen ON cal_date >= list_date AND (delist_date IS NULL OR cal_date <= delist_date)
        WHERE is_open = 1 AND cal_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY cal_date),
had AS (SELECT date, count(*) AS n FROM bars SEMI JOIN chosen USING (code) GROUP BY date)
SELECT cal_date, due.n AS expected, coalesce(had.n, 0) AS actual, due.n - coalesce(had.n, 0) AS missing
FROM due LEFT JOIN had ON had.date = cal_date WHERE due.n > coalesce(had.n, 0)""")
def gap_dates_index(s: Shapes) -> DataFrame:
    """The index scope: the blocking check that is made on request only."""
    found = audit.audit_gaps(tables(s), SCOPE, include_index=True)
    return found.where(F.col("check_name") == "index_bars").drop("check_order", "check_name")


@query("""WITH
chosen AS (SELECT code, name, list_date, delist_date FROM master
           WHERE board NOT IN ('INDEX', 'BJ') AND list_status = 'L' AND exchange IN ('SH', 'SZ') AND symbol IN ('000001', '000002', '000005', '000011')),
due AS (SELECT cal_date AS date, code, name FROM cal JOIN chosen ON cal_date >= list_date AND (delist_date IS NULL OR cal_date <= delist_date)
        WHERE is_open = 1 AND cal_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30')
SELECT date, code, name FROM due ANTI JOIN bars USING (code, date)""")
def missing_codes_named(s: Shapes) -> DataFrame:
    """Named codes among the securities of two exchanges."""
    scope = audit.Scope(SCOPE.begin, SCOPE.end, ("sh", "sz"), ("000001,000002", "000005，000011"))
    return audit.missing_codes(s.bars(), "date", s.bars(), s.master(), s.calendar(), scope, is_bars=True)
