import pytest
from pyspark.sql import functions as F

from marketframe.functions.numeric import round_at
from marketframe.operators import fills
from tests.conftest import day, rows


@pytest.fixture
def market(table):
    """One security with bars and indicator rows on given days."""

    def build(symbol="600519", exchange="SH", board="MAIN", listed="2018-01-01", days=("2023-01-03",), bar=None, basic=None):
        code = f"{symbol}.{exchange}"
        bar = {"close": 10.0, "pre_close": 10.0, "tradestatus": 1, "volume": 100_000, **(bar or {})}
        return (
            table("daily_basic", *[{"code": code, "trade_date": d, **(basic or {})} for d in days]),
            table("stock_daily", *[{"code": code, "date": d, **bar} for d in days]),
            table("stock_info", {"code": code, "symbol": symbol, "exchange": exchange, "board": board, "list_date": listed, "list_status": "L"}),
        )

    return build


def limits(market, trade_day, *, board="MAIN", pre_close=10.0, close=10.0, listed="2010-01-01", is_st=0, exchange="SH", **bar):
    basic, bars, master = market(
        board=board, exchange=exchange, listed=listed, days=(trade_day,), bar={"pre_close": pre_close, "close": close, **bar}, basic={"is_st": is_st}
    )
    return rows(fills.fill_price_limits(basic, bars, master).select("limit_up", "limit_down", "is_limit_up", "is_limit_down"))[0]


@pytest.mark.parametrize(
    "trade_day, options, up, down",
    [
        ("2026-07-03", dict(is_st=1), 10.5, 9.5),
        ("2026-07-06", dict(is_st=1), 11.0, 9.0),
        ("2022-05-10", dict(is_st=1), 10.5, 9.5),
        ("2022-05-10", dict(is_st=None), 11.0, 9.0),
        ("2022-05-10", dict(listed="2022-05-10"), 14.4, 6.4),
        ("2022-05-11", dict(listed="2022-05-10"), 11.0, 9.0),
        ("2023-04-09", dict(listed="2023-04-09"), 14.4, 6.4),
        ("2023-04-10", dict(listed="2023-04-10"), 999999.99, 0.01),
        ("2023-04-14", dict(listed="2023-04-10"), 999999.99, 0.01),
        ("2023-04-15", dict(listed="2023-04-10"), 11.0, 9.0),
        ("2026-07-10", dict(listed="2026-07-06"), 999999.99, 0.01),
        ("2026-07-11", dict(listed="2026-07-06"), 11.0, 9.0),
        ("2020-08-23", dict(board="GEM", listed="2020-08-23"), 14.4, 6.4),
        ("2020-08-23", dict(board="GEM"), 11.0, 9.0),
        ("2020-08-24", dict(board="GEM"), 12.0, 8.0),
        ("2020-08-28", dict(board="GEM", listed="2020-08-24"), 999999.99, 0.01),
        ("2020-08-29", dict(board="GEM", listed="2020-08-24"), 12.0, 8.0),
        ("2021-01-05", dict(board="STAR", listed="2021-01-01"), 999999.99, 0.01),
        ("2021-01-06", dict(board="STAR", listed="2021-01-01"), 12.0, 8.0),
        ("2022-01-04", dict(board="BJ", listed="2022-01-04"), 999999.99, 0.01),
        ("2022-01-05", dict(board="BJ", listed="2022-01-04"), 13.0, 7.0),
        ("2022-01-05", dict(board="BJ", pre_close=10.05), 13.06, 7.04),   # inward from 13.065 and 7.035
        ("2022-05-10", dict(pre_close=10.05), 11.06, 9.05),               # half cents round up
    ],
)
def test_limit_prices_follow_the_dated_rules(market, trade_day, options, up, down):
    assert limits(market, trade_day, **options)[:2] == (up, down)


def test_flags_mark_a_close_at_the_limit(market):
    assert limits(market, "2022-05-10", close=11.0)[2:] == (1, 0)
    assert limits(market, "2022-05-10", close=9.0)[2:] == (0, 1)
    assert limits(market, "2022-05-10", close=10.99)[2:] == (0, 0)
    assert limits(market, "2023-04-10", listed="2023-04-10", close=999999.99)[2:] == (0, 0)


def test_limits_skip_suspended_unknown_and_foreign_rows(market):
    assert limits(market, "2022-05-10", tradestatus=0)[0] is None
    assert limits(market, "2022-05-10", pre_close=-1.0)[0] is None
    assert limits(market, "2022-05-10", board="INDEX")[0] is None


def test_limit_fill_respects_range_exchange_and_code(market):
    basic, bars, master = market(days=("2022-05-10", "2022-05-11"))
    def filled(**scope):
        return [r.limit_up is not None for r in fills.fill_price_limits(basic, bars, master, **scope).orderBy("trade_date").collect()]

    assert filled(begin="2022-05-11", end="2022-05-11") == [False, True]
    assert filled(exchanges=["sz"]) == [False, False]
    assert filled(exchanges=["sh"]) == [True, True]
    assert filled(codes=["000001.SZ"]) == [False, False]


def capital(table, category, *values, symbol="600399", date="2018-12-28"):
    names = ("dividend", "allotment_price", "bonus_share", "allotment_share")
    return table("capital_detail", {"code": symbol, "date": date, "category": category, **dict(zip(names, map(float, values)))})


DAYS = ("2018-12-27", "2018-12-28", "2018-12-29")


def test_share_counts_step_at_the_event(market, table):
    basic, _, master = market("600399", days=DAYS)
    filled = fills.fill_shares(basic, capital(table, "转配股上市", 23246.4902, 52000, 197210, 197210), master, DAYS[0], DAYS[-1])
    assert rows(filled.select("trade_date", "float_shares", "total_shares"), "trade_date") == [
        (day(DAYS[0]), 232464902, 520000000), (day(DAYS[1]), 1972100000, 1972100000), (day(DAYS[2]), 1972100000, 1972100000)
    ]
    assert rows(fills.fill_report(filled, master, "total_shares", DAYS[1], DAYS[2])) == [(2, 2, 0)]
    assert rows(fills.fill_report(basic, master, "total_shares")) == [(3, 0, 3)]


@pytest.mark.parametrize("category, values", [("未知新类别", (0, 0, 10, 0)), ("增发新股", (0, 0, 8888, 9999)), ("股本变化", (1, 1, 5, 0))])
def test_events_that_state_no_share_count_are_ignored(market, table, category, values):
    basic, _, master = market("600399", days=DAYS)
    filled = fills.fill_shares(basic, capital(table, category, *values), master, DAYS[0], DAYS[-1])
    assert {(r.total_shares, r.float_shares) for r in filled.collect()} == {(None, None)}


def test_same_day_events_collapse_and_days_before_stay_unknown(market, table):
    basic, _, master = market("600399", days=DAYS)
    both = capital(table, "股本变化", 0, 0, 100, 300).union(capital(table, "股份回购", 0, 0, 200, 250))
    filled = fills.fill_shares(basic, both, master, DAYS[0], DAYS[-1])
    assert rows(filled.select("float_shares", "total_shares"), "trade_date") == [(None, None), (2000000, 3000000), (2000000, 3000000)]


def turnover(market, bar=None, basic=None, **options):
    b, d, m = market(bar=bar, basic={"float_shares": 1_000_000, **(basic or {})})
    rate = fills.fill_turnover(b, d, m, "2023-01-03", "2023-01-03", **options).first().turnover_rate
    return rate, fills.turnover_updates(b, d, m, "2023-01-03", "2023-01-03", **options).first().updated


def test_turnover_rate_and_count(market):
    assert turnover(market) == (10.0, 1)
    assert turnover(market, basic={"turnover_rate": 99.9}) == (99.9, 0)
    assert turnover(market, basic={"turnover_rate": 99.9}, overwrite=True) == (10.0, 1)
    assert turnover(market, basic={"float_shares": None}) == (None, 0)
    assert turnover(market, basic={"float_shares": 0}) == (None, 0)
    assert turnover(market, bar={"tradestatus": 0, "volume": 0}) == (None, 0)
    assert turnover(market, codes=["000001.SZ"]) == (None, 0)
    assert turnover(market, codes=["600519.SH"]) == (10.0, 1)


def test_market_value_needs_total_shares_but_no_trading(market):
    basic, bars, master = market(bar={"close": 2.5, "tradestatus": 0}, basic={"total_shares": 1000, "float_shares": 400})
    assert rows(fills.fill_market_value(basic, bars, master).select("total_mv", "float_mv")) == [(2500.0, 1000.0)]
    basic, bars, master = market(basic={"float_shares": 400})
    assert rows(fills.fill_market_value(basic, bars, master).select("total_mv", "float_mv")) == [(None, None)]


def test_volume_ratio_counts_trading_rows_only(market, table):
    days = [f"2023-01-{d:02d}" for d in range(2, 10)]
    volumes = [100, 200, 0, 300, 400, 500, 600, 700]
    basic, _, master = market(days=days)
    bars = table("stock_daily", *[
        {"code": "600519.SH", "date": d, "volume": v, "tradestatus": int(v > 0)} for d, v in zip(days, volumes)
    ])
    got = [r.volume_ratio for r in fills.fill_volume_ratio(basic, bars, master).orderBy("trade_date").collect()]
    assert got == [None, 2.0, None, 2.0, 2.0, 2.0, 2.0, 1.75]
    late = fills.fill_volume_ratio(basic, bars, master, begin="2023-01-09", end="2023-01-09")
    assert [r.volume_ratio for r in late.orderBy("trade_date").collect()] == [None] * 7 + [1.75]


def test_rounding_scales_the_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (1.125,), (None,)], "x double")
    assert [r[0] for r in df.select(round_at(df.x, 2)).collect()] == [1.0, 2.5, -2.5, 1.13, None]


def test_touched_fills_return_every_row_of_their_partitions(spark, table, tmp_path):
    from marketframe.plans import jobs

    path = str(tmp_path / "basic")
    rows_ = [{"code": c, "trade_date": d, "total_shares": 100, "float_shares": 10} for c in ("600000.SH", "000001.SZ")
             for d in ("2024-01-02", "2024-01-03", "2024-02-01")]
    basic = table("daily_basic", *rows_, {"code": "600000.SH"})
    basic.withColumn("month", F.date_format("trade_date", "yyyy-MM")).write.partitionBy("month").parquet(path)
    stored = spark.read.parquet(path).drop("month")
    bars = table("stock_daily", {"code": "600000.SH", "date": "2024-01-03", "close": 2.0, "tradestatus": 1, "volume": 5})
    master = table("stock_info", *[{"code": c, "symbol": c[:6], "exchange": c[-2:], "board": "MAIN"} for c in ("600000.SH", "000001.SZ")])
    args = ("2024-01-03", "2024-01-03")
    one = jobs.fill_shares_and_value(stored, bars, table("capital_detail"), master, *args, codes=["600000.SH"])
    by_day = fills.fill_turnover(stored, bars, master, *args, codes=["600000.SH"], touched="day")
    assert sorted((r.code, str(r.trade_date)) for r in by_day.collect()) == [("000001.SZ", "2024-01-03"), ("600000.SH", "2024-01-03")]
    for fill in (fills.fill_price_limits, fills.fill_volume_ratio, fills.fill_turnover, fills.fill_market_value):
        assert fill(stored, bars, master, *args, codes=["600000.SH"], touched="month").count() == 4
    held = one.localCheckpoint()
    held.withColumn("month", F.date_format("trade_date", "yyyy-MM")).write.mode("overwrite").partitionBy("month").parquet(path)
    after = spark.read.parquet(path)
    assert after.count() == 7
    assert [(r.code, str(r.trade_date), r.total_mv) for r in after.where("total_mv IS NOT NULL").collect()] == [("600000.SH", "2024-01-03", 200.0)]
