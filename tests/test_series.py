import random

import pytest
from pyspark.sql import functions as F

from marketframe.operators.joins import by_days
from marketframe.operators.series import carry_close, fill_suspensions, trailing_mean
from tests.conftest import day, rows


@pytest.mark.parametrize("width", [1, 3, 10, 366])
def test_trailing_mean_equals_brute_force_across_chunks(spark, width):
    rng = random.Random(width)
    series = {k: sorted(rng.sample(range(120), n)) for k, n in (("hot", 90), ("b", 12), ("c", 1))}
    values = {(k, d): rng.choice([None, rng.randrange(1, 100)]) for k, days in series.items() for d in days}
    df = spark.createDataFrame([(k, d, v) for (k, d), v in values.items()], "code string, n int, volume long").withColumn(
        "date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n"))
    )
    got = trailing_mean(df, "code", "date", "volume", 5, "mean", by_days(width))
    want = {}
    for k, days in series.items():
        for i, d in enumerate(days):
            seen = [values[(k, x)] for x in days[max(0, i - 5):i] if values[(k, x)] is not None]
            want[(k, d)] = sum(seen) / len(seen) if seen else None
    found = {(r.code, (r.date - day("2024-01-01")).days): r["mean"] for r in got.collect()}
    assert found == want


BAR = "code string, date date, open double, high double, low double, close double, volume long, amount double, tradestatus int"


def bars(spark, *items):
    return spark.createDataFrame([("a", day(d), c, c, c, c, v, 1.0, 1) for d, c, v in items], BAR)


def span(spark, first="2024-01-01", last="2024-01-05"):
    return spark.createDataFrame([("a", day(first), day(last))], "code string, from_date date, to_date date")


def test_suspended_day_repeats_the_last_close(spark, calendar):
    got = fill_suspensions(span(spark, last="2024-01-02"), bars(spark, ("2024-01-01", 10.5, 100)), calendar("2024-01-01", "2024-01-02"))
    assert rows(got.drop("code"), "date") == [
        (day("2024-01-01"), 10.5, 10.5, 10.5, 10.5, None, 1, 100, 1.0),
        (day("2024-01-02"), 10.5, 10.5, 10.5, 10.5, 10.5, 0, 0, 0.0),
    ]


def test_bar_before_the_range_seeds_the_close(spark, calendar):
    got = fill_suspensions(span(spark), bars(spark, ("2023-06-01", 7.0, 1)), calendar("2024-01-02", "2024-01-03", closed=("2024-01-01",)))
    assert rows(got.select("date", "close", "tradestatus"), "date") == [(day("2024-01-02"), 7.0, 0), (day("2024-01-03"), 7.0, 0)]


def test_days_before_the_first_close_and_closed_days_are_left_out(spark, calendar):
    got = fill_suspensions(
        span(spark), bars(spark, ("2024-01-04", 3.0, 1)), calendar("2024-01-02", "2024-01-03", "2024-01-04", closed=("2024-01-05",))
    )
    assert rows(got.select("date", "pre_close")) == [(day("2024-01-04"), None)]


def test_real_bar_keeps_its_own_status(spark, calendar):
    halted = bars(spark, ("2024-01-01", 5.0, 1), ("2024-01-02", 5.0, 0)).withColumn("tradestatus", F.when(F.col("volume") == 0, 0).otherwise(1))
    got = fill_suspensions(span(spark, last="2024-01-02"), halted, calendar("2024-01-01", "2024-01-02"))
    assert rows(got.select("tradestatus", "pre_close"), "date") == [(1, None), (0, 5.0)]
    fixed = fill_suspensions(span(spark, last="2024-01-02"), halted, calendar("2024-01-01", "2024-01-02"), status=1)
    assert [r.tradestatus for r in fixed.collect()] == [1, 1]


def test_carry_close_skips_unknown_closes(spark):
    got = carry_close(bars(spark, ("2024-01-01", 5.0, 1), ("2024-01-02", None, 1), ("2024-01-03", 6.0, 1)))
    assert rows(got.select("date", "pre_close"), "date") == [
        (day("2024-01-01"), None), (day("2024-01-02"), 5.0), (day("2024-01-03"), 5.0)
    ]


@pytest.mark.parametrize("width", [1, 4, 366])
def test_carry_close_equals_brute_force_across_chunks(spark, width):
    rng = random.Random(width)
    closes = {(k, d): rng.choice([None, rng.random()]) for k in ("hot", "b") for d in rng.sample(range(60), 40)}
    df = spark.createDataFrame([(k, d, c) for (k, d), c in closes.items()], "code string, n int, close double").withColumn(
        "date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n"))
    )
    got = {(r.code, r.n): r.pre_close for r in carry_close(df, chunk=by_days(width)).collect()}
    want = {}
    for k, d in closes:
        before = [x for (kk, x), c in closes.items() if kk == k and x < d and c is not None]
        want[(k, d)] = closes[(k, max(before))] if before else None
    assert got == want


def test_bars_on_closed_days_inside_the_range_move_no_close(spark, table, calendar):
    """Friday 10, Sunday 99, Monday 11: Monday's previous close is Friday's; a Sunday before the range seeds."""
    from marketframe.operators.series import fill_suspensions

    bar = {"open": 1.0, "high": 1.0, "low": 1.0, "volume": 1, "amount": 1.0, "tradestatus": 1, "code": "a"}
    bars = table("stock_daily", *[{**bar, "date": d, "close": c} for d, c in (("2024-01-05", 10.0), ("2024-01-07", 99.0), ("2024-01-08", 11.0))])
    cal = calendar("2024-01-05", "2024-01-08", "2024-01-09", closed=("2024-01-06", "2024-01-07"))

    def closes(begin):
        spans = spark.sql(f"SELECT 'a' AS code, DATE '{begin}' AS from_date, DATE '2024-01-09' AS to_date")
        return [(r.date.isoformat(), r.pre_close) for r in fill_suspensions(spans, bars, cal).orderBy("date").collect()]

    assert closes("2024-01-05") == [("2024-01-05", None), ("2024-01-08", 10.0), ("2024-01-09", 11.0)]
    assert closes("2024-01-08") == [("2024-01-08", 99.0), ("2024-01-09", 11.0)]
