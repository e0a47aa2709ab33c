import pytest
from pyspark.sql import functions as F

from marketframe.operators import calendar as cal
from marketframe.operators import industry, universe
from tests.conftest import day, rows


@pytest.fixture
def week(calendar):
    return calendar("2024-01-02", "2024-01-03", "2024-01-05", closed=("2024-01-01", "2024-01-04"))


def dates(spark, *values):
    return spark.createDataFrame([(day(v),) for v in values], "d date")


def test_day_status_tells_closed_from_unknown(spark, week):
    df = dates(spark, "2024-01-02", "2024-01-04", "2024-03-01")
    assert rows(cal.day_status(df, "d", week), "d") == [(day("2024-01-02"), "open"), (day("2024-01-04"), "closed"), (day("2024-03-01"), "unknown")]
    assert [r.is_trading_day for r in cal.is_open_day(df, "d", week).orderBy("d").collect()] == [True, False, False]


def test_open_days_are_inclusive(week):
    assert rows(cal.open_days(week, "20240102", "2024-01-05"), "cal_date") == [(day("2024-01-02"),), (day("2024-01-03"),), (day("2024-01-05"),)]
    assert cal.open_days(week, "2024-01-04", "2024-01-04").count() == 0


def test_previous_open_day_is_strict_and_works_off_calendar(spark, week):
    asked = ("2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05", "2024-02-10", "2023-12-31")
    found = dict(rows(cal.previous_open_day(dates(spark, *asked), "d", week)))
    assert [found[day(a)] for a in asked] == [None, day("2024-01-02"), day("2024-01-03"), day("2024-01-03"), day("2024-01-05"), None]
    assert rows(cal.last_open_day(week, "20240105")) == [(day("2024-01-03"),)]
    assert rows(cal.last_open_day(week, "2024-01-02")) == [(None,)]


def test_range_rules_name_the_first_problem(spark, week):
    asked = [("20240102", "20240103"), ("2024-1-2", "20240103"), ("20240102", "x"), ("20240105", "20240102"), ("20240104", "20240104"), ("20240301", "20240301"), ("20240105", "20240105")]
    got = cal.day_rule_report(spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "i int, b string, e string"), "b", "e", week)
    assert [r.problem for r in got.orderBy("i").collect()] == [None, "begin_format", "end_format", "date_order", "closed_day", "unknown_day", None]


@pytest.fixture
def master(table):
    def s(symbol, **more):
        return {"code": f"{symbol}.SH", "symbol": symbol, "exchange": "SH", "board": "MAIN", "list_date": "2020-01-01", "list_status": "L", **more}

    return table(
        "stock_info", s("600002"), s("600001", list_date="2024-01-10"), s("600003", list_status="D", delist_date="2024-01-05"),
        s("600004", list_status="D"), s("600005", list_date=None), s("000300", board="INDEX"), s("000001", exchange="SZ", code="000001.SZ"),
    )


def found(df):
    return [(r.code, str(r.from_date), str(r.to_date)) for r in df.collect()]


def test_intervals_are_clipped_to_listing_delisting_and_today(master):
    assert found(universe.candidates(master, "2024-01-20", "2024-01-01", "2024-01-31", exchanges=["sh"])) == [
        ("600001.SH", "2024-01-10", "2024-01-20"), ("600002.SH", "2024-01-01", "2024-01-20")
    ]
    every = universe.candidates(master, "2024-01-20", "2024-01-01", "2024-01-15", include_delisted=True, exchanges=["sh"])
    assert ("600003.SH", "2024-01-01", "2024-01-05") in found(every) and len(found(every)) == 3
    assert found(universe.candidates(master, "2024-01-20", exchanges=["sz"])) == [("000001.SZ", "2020-01-01", "2024-01-20")]
    assert universe.candidates(master, "2024-01-20", "2024-01-06", "2024-01-08", codes=["600003"], include_delisted=True).count() == 0


def test_codes_beat_exchanges_and_indexes_are_separate(master):
    assert [c for c, *_ in found(universe.candidates(master, "2024-01-20", exchanges=["sz"], codes=["600002，600001"]))] == ["600001.SH", "600002.SH"]
    assert [c for c, *_ in found(universe.candidates(master, "2024-01-20", index=True))] == ["000300.SH"]
    assert len(found(universe.candidates(master, "2024-01-20", exchanges=["all"]))) == 3


def test_sources_do_not_serve_delisted_or_nine_prefixed(spark):
    df = spark.createDataFrame([("900901", "SH", "L"), ("600000", "SH", "L"), ("600001", "SH", "D"), ("430047", "BJ", "L")], "symbol string, exchange string, list_status string")
    assert [r.symbol for r in universe.fetchable(df).collect()] == ["600000", "430047"]
    assert [r.symbol for r in universe.capital_fetchable(df).collect()] == ["900901", "600000", "600001"]


def tree(spark):
    raw = spark.createDataFrame(
        [(1, "110000.0", "Farm", None, None), (2, "110100", "Farm", " Crop ", ""), (3, "110101", "Farm", "Crop", "Seed"), (4, "", "Farm", "Crop", "Lost"),
         (5, "220000", "Chem", "nan", None), (6, "110102", "Farm", "Fish", "Net"), (7, "110101", "Farm", "Crop", "Seeds")],
        "seq int, code string, n1 string, n2 string, n3 string",
    )
    return industry.derive_hierarchy(raw, "2021", "code", "n1", "n2", "n3", "seq")


def test_levels_and_parents_come_from_names(spark):
    assert rows(tree(spark).drop("sw_version"), "industry_code") == [
        ("110000", "Farm", 1, None), ("110100", "Crop", 2, "110000"), ("110101", "Seeds", 3, "110100"), ("110102", "Net", 3, None), ("220000", "Chem", 1, None)
    ]


def test_membership_expands_by_version(spark, table, master):
    history = table(
        "stock_industry_clf_hist_sw_raw", {"symbol": "600002", "start_date": "2021-07-30", "industry_code": "110101"},
        {"symbol": "600002", "start_date": "2021-07-29", "industry_code": "110101"}, {"symbol": "600001", "start_date": "2022-01-01", "industry_code": "110102"},
        {"symbol": "000300", "start_date": "2022-01-01", "industry_code": "110101"}, {"symbol": "600003", "start_date": "2022-01-01", "industry_code": "110100"},
    )
    got = industry.expand_membership(history, master, tree(spark))
    picked = got.select("symbol", F.col("start_date").cast("string"), "sw_version", "sw_l1_name", "sw_l2_code", "sw_l3_name")
    assert rows(picked, "symbol", "start_date") == [
        ("600001", "2022-01-01", "2021", None, None, "Net"), ("600002", "2021-07-29", "2014", None, None, None),
        ("600002", "2021-07-30", "2021", "Farm", "110100", "Seeds"), ("600003", "2022-01-01", "2021", None, None, None),
    ]
