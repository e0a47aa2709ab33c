import datetime as dt

from pyspark.sql import functions as F

from marketframe.operators.universe import candidates
from marketframe.plans import jobs
from tests.conftest import day, rows
from tests.test_sources import combined

NOW = dt.datetime(2024, 2, 1)


def test_bar_files_become_daily_bars_with_suspensions(spark, table, calendar):
    master = table("stock_info", *[
        {"code": f"{s}.SH", "symbol": s, "exchange": "SH", "board": "MAIN", "list_date": "2020-01-01", "list_status": st, "delist_date": "2024-01-03"}
        for s, st in (("600000", "L"), ("600001", "D"))
    ])
    source = spark.createDataFrame(
        [("600000.SH", day("2023-12-29"), 1.0, 1.0, 1.0, 5.0, 1, 1.0), ("600000.SH", day("2024-01-03"), 6.0, 6.0, 6.0, 6.0, 9, 9.0)],
        "code string, date date, open double, high double, low double, close double, volume long, amount double",
    )
    universe = candidates(master, "2024-01-31", "2024-01-02", "2024-01-03", include_delisted=True)
    bars, basic = jobs.import_sparse_bars(source, universe, calendar("2024-01-02", "2024-01-03"), table("stock_daily"), table("daily_basic"), status=1)
    assert rows(bars.select("code", "date", "close", "pre_close", "tradestatus"), "date") == [
        ("600000.SH", day("2024-01-02"), 5.0, 5.0, 0), ("600000.SH", day("2024-01-03"), 6.0, 5.0, 1)
    ]
    assert rows(basic.select("trade_date", "pe", "is_limit_up"), "trade_date") == [(day("2024-01-02"), None, 0), (day("2024-01-03"), None, 0)]


def test_combined_import_fills_both_tables(spark, table):
    raw = combined(spark, {"date": "2024-01-02", "code": "sh.600000", "close": "9.5", "volume": "100", "turn": "0.5", "tradestatus": "1", "peTTM": "8"})
    base = table("daily_basic", {"code": "600000.SH", "trade_date": "2024-01-02", "volume_ratio": 1.1})
    bars, basic, rejected = jobs.import_combined_bars(raw, table("stock_daily"), base)
    assert rows(bars.select("close", "tradestatus")) == [(9.5, 1)] and rejected.count() == 0
    assert rows(basic.select("turnover_rate", "pe", "volume_ratio")) == [(0.5, 8.0, 1.1)]


def test_margin_fallback_covers_missing_days(spark, table):
    schema = "trade_date date, exchange_code string, margin_balance double"
    primary = spark.createDataFrame([(day("2024-01-02"), "SH", 1.0)], schema)
    web = spark.createDataFrame([(day("2024-01-02"), "SH", 9.0), (day("2024-01-03"), "SH", 2.0), (day("2024-01-02"), "SZ", 3.0)], schema)
    got = jobs.sync_margin_summary(primary, web, table("margin_summary_daily"), NOW)
    assert sorted((r.exchange_code, r.trade_date.day, float(r.margin_balance)) for r in got.collect()) == [("SH", 2, 1.0), ("SH", 3, 2.0), ("SZ", 2, 3.0)]


def test_capital_prefers_the_first_source(spark, table):
    schema = "code string, date string, category string, dividend double, allotment_price double, bonus_share double, allotment_share double"
    local = spark.createDataFrame([("1", "20240102", "c", 1.0, 0.0, 0.0, 0.0)], schema)
    online = spark.createDataFrame([("1", "20240102", "c", 9.0, 0.0, 0.0, 0.0), ("2", "20240102", "c", 2.0, 0.0, 0.0, 0.0)], schema)
    assert rows(jobs.sync_capital([local, online], table("capital_detail"), NOW).select("code", "dividend"), "code") == [("1", 1.0), ("2", 2.0)]


def test_finance_sync_keeps_fields_a_short_report_does_not_carry(spark, table):
    base = table("finance_report", {"code": "000001", "report_date": "2005-12-31", "eps": 1.0, "roe": 2.0})
    decoded = spark.sql("SELECT DATE '2005-12-31' report_date, '000001' code, array(CAST('NaN' AS FLOAT), CAST(3 AS FLOAT)) fields")
    got = jobs.sync_finance(decoded, base, NOW).first()
    assert (got.eps, got.eps_deduct, got.roe, got.updated_at) == (None, 3.0, 2.0, NOW)


def test_hierarchy_and_history_sync(spark, table):
    raw = spark.createDataFrame([(1, "110000", "农林牧渔", None, None), (2, "110100", "农林牧渔", "种植业", None)],
                                "seq int, `行业代码` string, `一级行业名称` string, `二级行业名称` string, `三级行业名称` string")
    assert rows(jobs.sync_hierarchy(raw, "2021", table("sw_industry"), NOW, "seq").select("industry_code", "parent_code"), "industry_code") == [("110000", None), ("110100", "110000")]
    history = spark.createDataFrame([("1", "2021-01-01", "110101", "2022-01-01", 1)], "symbol string, start_date string, industry_code string, update_time string, seq int")
    assert rows(jobs.sync_industry_history(history, table("stock_industry_clf_hist_sw_raw"), NOW, "seq").select("symbol", "updated_at")) == [("000001", NOW)]


def test_other_syncs_merge_into_empty_tables(spark, table):
    cal = spark.createDataFrame([("2024-01-02", "1")], "calendar_date string, is_trading_day string")
    assert rows(jobs.sync_calendar(cal, table("trade_cal"))) == [(day("2024-01-02"), 1)]
    info = spark.createDataFrame([("sh.600519", "A", "2001-08-27", "", "1", "1")], "code string, code_name string, ipoDate string, outDate string, status string, type string")
    assert rows(jobs.sync_securities(info, table("stock_info"), NOW).select("code", "created_at")) == [("600519.SH", NOW)]
    bj = spark.createDataFrame([("430047", "N", "2021-11-15", "1,000", "500")], "`证券代码` string, `证券简称` string, `上市日期` string, `总股本` string, `流通股本` string")
    info, basic = jobs.sync_beijing(bj, table("stock_info"), table("daily_basic"), "2024-01-02", NOW)
    assert rows(info.select("board")) == [("BJ",)] and rows(basic.select("total_shares", "float_shares")) == [(1000, 500)]
    index = combined(spark, {"date": "2024-01-02", "code": "sh.000300", "open": "1", "close": "2"})
    assert rows(jobs.import_index_bars(index, table("stock_daily")).select("code", "tradestatus", "pre_close")) == [("000300.SH", 1, -1.0)]


def test_market_value_uses_the_share_counts_just_filled(table):
    code, d = "600399.SH", "2018-12-28"
    basic = table("daily_basic", {"code": code, "trade_date": d})
    bars = table("stock_daily", {"code": code, "date": d, "close": 2.0})
    capital = table("capital_detail", {"code": "600399", "date": d, "category": "股本变化", "bonus_share": 3.0, "allotment_share": 5.0})
    master = table("stock_info", {"code": code, "symbol": "600399", "exchange": "SH", "board": "MAIN", "list_status": "L"})
    got = jobs.fill_shares_and_value(basic, bars, capital, master, d, d).select("total_shares", "total_mv", "float_mv")
    assert rows(got) == [(50000, 100000.0, 60000.0)]
