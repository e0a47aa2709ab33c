import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marketframe.plans import audit
from tests.conftest import day, rows


def security(code="600519.SH", **more):
    symbol, exchange = code.split(".")
    return {"code": code, "symbol": symbol, "name": symbol, "exchange": exchange, "board": "MAIN", "list_date": "2010-01-01", "list_status": "L", **more}


def bar(code, date, **more):
    return {"code": code, "date": date, "open": 10.0, "high": 11.0, "low": 9.0, "close": 10.5, "pre_close": 10.0, "tradestatus": 1,
            "volume": 1_000_000, "amount": 1.2e7, **more}


def basic(code, date, **more):
    return {"code": code, "trade_date": date, "pb": 1.0, "pe": 10.0, "total_shares": 100, "float_shares": 80, "turnover_rate": 2.5,
            "total_mv": 1e10, "float_mv": 8e9, "limit_up": 11.0, "limit_down": 9.0, "is_st": 0, **more}


def factor(code, date, value=1.0, **more):
    return {"code": code, "trade_date": date, "fore_factor": value, "back_factor": value, "adjust_factor": value, **more}


PREV, EX = "2023-01-04", "2023-01-05"
SCOPE = audit.Scope(EX, EX)


@pytest.fixture
def xdr(table, calendar):
    """An ex-rights event on EX with prices and factors around it."""

    def build(close=10.0, pre_close=10.0, factors=(1.0, 1.1), prev_bar=True, code="600519.SH", master=None, status=1, **terms):
        bars = ([bar(code, PREV, close=close)] if prev_bar else []) + [bar(code, EX, pre_close=pre_close, tradestatus=status)]
        return audit.xdr_check(
            table("capital_detail", {"code": code.split(".")[0], "date": EX, "category": "除权除息", **{k: float(v) for k, v in terms.items()}}),
            table("stock_daily", *bars),
            table("adj_factor", *[factor(code, d, f) for d, f in zip((PREV, EX), factors) if f is not None]),
            table("stock_info", master or security(code)), calendar(PREV, EX), SCOPE,
        )

    return build


@pytest.mark.parametrize(
    "close, pre_close, terms, theory, status",
    [
        (11.0, 11.0, dict(dividend=5, bonus_share=10), 5.25, "mismatch"),
        (10.0, 9.91, dict(dividend=1), 9.9, "ok"),
        (10.0, 9.92, dict(dividend=1), 9.9, "mismatch"),
        (10.0, 10.0, dict(bonus_share=10), 5.0, "mismatch"),
        (10.0, 10.0, dict(allotment_price=5, allotment_share=5), 12.5 / 1.5, "mismatch"),
        (9.87, 9.87, dict(dividend=8), 9.07, "mismatch"),
    ],
)
def test_theoretical_price(xdr, close, pre_close, terms, theory, status):
    found = xdr(close, pre_close, **terms).first()
    assert found.code == "600519.SH" and found.close_prev == close and found.pre_close == pre_close
    assert found.theory == pytest.approx(theory, abs=1e-9) and found.status == status


def test_only_confirmed_ex_days_are_checked(xdr):
    assert xdr(dividend=20, status=0).count() == 0                      # suspended
    assert xdr(dividend=20, factors=(1.0, 1.0)).count() == 0            # factor unchanged
    assert xdr(dividend=20, factors=(1.0, None)).count() == 0           # factor missing
    assert xdr(dividend=20, factors=(None, None)).count() == 0
    assert xdr(dividend=20, master=security(board="INDEX")).count() == 0
    assert xdr(dividend=20, master=security(list_status="D")).count() == 0


def test_missing_previous_close_is_uncomputable(xdr):
    assert [r.status for r in xdr(dividend=20, prev_bar=False).collect()] == ["uncomputable"]
    assert xdr(dividend=20, prev_bar=False, status=0).count() == 0


TWO_DAYS = ("2026-08-17", "2026-08-18")
WEEK = audit.Scope(*TWO_DAYS)


def test_gap_report_says_which_day_and_which_security(table, calendar):
    master = table("stock_info", security(), security("000001.SZ"))
    bars = table("stock_daily", bar("600519.SH", TWO_DAYS[0]))
    inputs = (bars, "date", bars, master, calendar(*TWO_DAYS))
    assert rows(audit.gap_dates(*inputs, WEEK, is_bars=True), "cal_date") == [(day(TWO_DAYS[0]), 2, 1, 1), (day(TWO_DAYS[1]), 2, 0, 2)]
    assert rows(audit.missing_codes(*inputs, WEEK, is_bars=True).select("date", "code"), "date", "code") == [
        (day(TWO_DAYS[0]), "000001.SZ"), (day(TWO_DAYS[1]), "000001.SZ"), (day(TWO_DAYS[1]), "600519.SH")
    ]
    only = audit.Scope(*TWO_DAYS, codes=("600519",))
    assert rows(audit.missing_codes(*inputs, only, is_bars=True).select("code")) == [("600519.SH",)]
    assert audit.gap_dates(*inputs, audit.Scope(*TWO_DAYS, exchanges=("bj",)), is_bars=True).count() == 0


def test_listing_interval_bounds_what_is_expected(table, calendar):
    master = table(
        "stock_info", security(list_date=TWO_DAYS[1]), security("000001.SZ", delist_date=TWO_DAYS[0]),
        security("000002.SZ", list_date=None), security("000003.SZ", list_status="D"), security("000004.SZ", list_date="2026-08-20", delist_date="2026-08-10"),
    )
    empty = table("stock_daily")
    got = audit.gap_dates(empty, "date", empty, master, calendar(*TWO_DAYS), WEEK, is_bars=True)
    assert rows(got.select("cal_date", "expected"), "cal_date") == [(day(TWO_DAYS[0]), 1), (day(TWO_DAYS[1]), 1)]


def test_suspension_explains_a_missing_row_in_other_tables(table, calendar):
    master = table("stock_info", security())
    bars = table("stock_daily", bar("600519.SH", TWO_DAYS[0], tradestatus=0))
    one = audit.Scope(TWO_DAYS[0], TWO_DAYS[0])
    assert audit.gap_dates(table("daily_basic"), "trade_date", bars, master, calendar(TWO_DAYS[0]), one).count() == 0
    assert audit.gap_dates(bars, "date", bars, master, calendar(TWO_DAYS[0]), one, is_bars=True).count() == 0


def labels(table, calendar, **more):
    d = TWO_DAYS[0]
    found = audit.null_indicators(
        table("daily_basic", basic("600519.SH", d, **more)), table("stock_daily"), table("stock_info", security()), calendar(d), audit.Scope(d, d)
    )
    return [r.missing for r in found.collect()]


def test_indicator_rules(table, calendar):
    assert labels(table, calendar) == []
    assert labels(table, calendar, pe=None) == []
    assert labels(table, calendar, pb=None) == ["pb"]
    assert labels(table, calendar, pb=0.0) == ["pb"]
    assert labels(table, calendar, pb=-1.5) == []
    assert labels(table, calendar, total_shares=0) == ["total_shares"]
    assert labels(table, calendar, pb=None, float_shares=0, pe=0.0) == ["pb,float_shares"]
    assert labels(table, calendar, limit_up=-1.0, limit_down=None) == ["limit_up,limit_down"]


def test_pe_is_a_warning_and_negatives_are_values(table, calendar):
    d = TWO_DAYS[0]
    def count(pe):
        return audit.missing_pe(table("daily_basic", basic("600519.SH", d, pe=pe)), table("stock_daily"), table("stock_info", security()),
                                calendar(d), audit.Scope(d, d)).first().pe_missing

    assert [count(p) for p in (None, 0.0, -12.3, 5.0)] == [1, 1, 0, 0]


def test_suspended_closed_and_foreign_rows_are_not_audited(table, calendar):
    d = TWO_DAYS[0]
    bad = table("daily_basic", basic("600519.SH", d, pb=None, is_st=None))
    stock, halted, scope = table("stock_info", security()), table("stock_daily", bar("600519.SH", d, tradestatus=0)), audit.Scope(d, d)
    assert audit.null_indicators(bad, halted, stock, calendar(d), scope).count() == 0
    assert audit.null_is_st(bad, halted, stock, calendar(d), scope).count() == 0
    none = table("stock_daily")
    assert audit.null_is_st(bad, none, stock, calendar(d), scope).count() == 1
    assert audit.null_is_st(bad, none, stock, calendar(closed=(d,)), scope).count() == 0
    assert audit.null_is_st(bad, none, table("stock_info", security(board="BJ")), calendar(d), scope).count() == 0


def test_bar_and_factor_sanity(table, calendar):
    d = TWO_DAYS[0]
    stock, cal, scope = table("stock_info", security()), calendar(d), audit.Scope(d, d)
    def bad_bar(**more):
        return [r.missing for r in audit.bad_bars(table("stock_daily", bar("600519.SH", d, **more)), stock, cal, scope).collect()]

    assert bad_bar() == []
    assert bad_bar(open=0.0, pre_close=-1.0, volume=None) == ["open,pre_close,volume"]
    assert bad_bar(close=None, tradestatus=0) == []
    traded = table("stock_daily", bar("600519.SH", d))
    broken = table("adj_factor", factor("600519.SH", d, back_factor=None, adjust_factor=0.0))
    assert [r.missing for r in audit.bad_factors(broken, traded, stock, cal, scope).collect()] == ["back_factor,adjust_factor"]
    assert audit.bad_factors(broken, table("stock_daily"), stock, cal, scope).count() == 0


def findings(spark, *counts):
    df = spark.createDataFrame([(i, f"check{i}", n) for i, n in enumerate(counts)], "check_order int, check_name string, n int")
    return df.where("n > 0").select("check_order", "check_name", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("date")).withColumn("code", F.lit("x"))


def budget(spark, limit, *counts):
    shown, report = audit.limit_detail(findings(spark, *counts), ["check_order", "date", "code"], "check_name", limit)
    return shown.count(), [tuple(r) for r in report.orderBy("check_name").collect()]


def test_detail_budget_is_shared_in_check_order(spark):
    assert budget(spark, 10, 8, 8, 8) == (10, [("check0", 8, 8, False), ("check1", 8, 2, True), ("check2", 8, 0, True)])
    assert budget(spark, 24, 8, 8, 8)[1] == [("check0", 8, 8, False), ("check1", 8, 8, False), ("check2", 8, 8, False)]
    assert budget(spark, 0, 2) == (0, [("check0", 2, 0, True)])
    assert budget(spark, -1, 5, 0, 5)[0] == 10


def test_domain_check_counts_each_rule(table):
    df = table("trade_cal", {"cal_date": "2024-01-01", "is_open": 1}, {"cal_date": "2024-01-01", "is_open": 7}, {"is_open": None})
    assert {(r.rule, r.column_name): r.violations for r in audit.domain_check(df, "trade_cal").collect()} == {
        ("not_null", "cal_date"): 1, ("domain", "is_open"): 1, ("unique", "cal_date"): 1
    }
    bars = table("stock_daily", bar("a.SH", "2024-01-01", tradestatus=2), {"code": None, "date": None})
    found = {(r.rule, r.column_name): r.violations for r in audit.domain_check(bars, "stock_daily").collect()}
    assert found == {("not_null", "code"): 1, ("not_null", "date"): 1, ("domain", "tradestatus"): 1, ("unique", "code,date"): 0}


def test_whole_audit_blocks_on_gaps_only(table, calendar):
    d = TWO_DAYS[0]
    full = dict(bars=table("stock_daily", bar("600519.SH", d, open=0.0)), basic=table("daily_basic", basic("600519.SH", d)),
                factors=table("adj_factor", factor("600519.SH", d)), capital=table("capital_detail"),
                master=table("stock_info", security(), security("000300.SH", board="INDEX")), calendar=calendar(d))
    scope = audit.Scope(d, d)
    summary = audit.audit_summary(audit.AuditTables(**full), scope)
    assert rows(audit.audit_status(summary)) == [("complete", 0, 1)]
    with_index = audit.audit_summary(audit.AuditTables(**full), scope, include_index=True)
    assert rows(audit.audit_status(with_index)) == [("gaps_found", 1, 1)]
    empty = audit.AuditTables(**{**full, "bars": table("stock_daily")})
    lines = [tuple(r) for r in audit.audit_document(empty, scope, limit=0).collect()]
    assert [part for part, _ in lines].count("gap") == 1 and not [1 for part, _ in lines if part == "missing"]
    assert '"status":"gaps_found"' in dict(lines)["status"]


def test_missing_days_over_several_months_move_as_months(table, calendar, spark):
    open_ = [d.isoformat() for i in range(70) if (d := day("2026-07-25") + dt.timedelta(days=i)).weekday() < 5 or i % 9 == 0]
    spans = {"600519.SH": ("2026-07-31", None), "000001.SZ": ("2026-08-31", "2026-09-01"), "000002.SZ": ("2020-01-01", "2026-07-25"), "000003.SZ": ("2026-08-02", "2026-10-31")}
    master = table("stock_info", *[security(c, list_date=a, delist_date=b) for c, (a, b) in spans.items()])
    held = {(c, d) for i, c in enumerate(spans) for j, d in enumerate(open_) if (i + j) % 3 == 0}
    bars = table("stock_daily", *[bar(c, d) for c, d in sorted(held)])
    scope = audit.Scope("2026-07-20", "2026-10-02")
    missing = audit.missing_codes(bars, "date", bars, master, calendar(*open_), scope, is_bars=True)
    gap_days = {r.cal_date.isoformat() for r in audit.gap_dates(bars, "date", bars, master, calendar(*open_), scope, is_bars=True).collect()}
    expected = [(day(d), c) for d in sorted(gap_days) for c, (a, b) in sorted(spans.items()) if a <= d <= (b or scope.end) and (c, d) not in held]
    assert len(expected) > 60 and rows(missing.select("date", "code"), "date", "code") == expected
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(code#\d+, date#\d+", plan)  # no row per security and day is shuffled
