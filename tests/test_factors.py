import datetime as dt

import pytest

from marketframe.plans.factors import run_factors, store_events
from tests.conftest import day, rows

NOW = dt.datetime(2025, 10, 20, 7, 30)
WEEK = ["2025-09-15", "2025-09-16", "2025-09-17", "2025-09-18"]
EVENTS = "code string, date string, fore_factor double, back_factor double, adjust_factor double"


def targets(spark, code="688111.SH", start="2025-09-15", end="2025-09-18"):
    return spark.createDataFrame([(code, start, end)], "code string, start_date string, end_date string")


def events(spark, *pairs, code="688111.SH"):
    return spark.createDataFrame([(code, d, f, f, f) for d, f in pairs], EVENTS)


def run(spark, table, cal, tg, ev, raw=None, dense=None, as_of="2026-06-30"):
    return run_factors(
        tg, ev, raw if raw is not None else table("adj_factor_raw"), dense if dense is not None else table("adj_factor"),
        cal, as_of=as_of, now=NOW, order="back_factor",
    )


def test_missing_columns_are_an_error(spark, table):
    with pytest.raises(ValueError, match="lacks columns"):
        store_events(table("adj_factor_raw"), spark.createDataFrame([("a", "2025-09-16")], "code string, date string"), NOW, "date")


def test_repeated_events_keep_the_last_by_order(spark, table):
    batch = spark.createDataFrame(
        [("a", "2025-09-16", 1.0, 1.0, 1.0, 1), ("a", "2025-09-16", 2.0, 2.0, 2.0, 2)], EVENTS + ", seq int"
    )
    raw = store_events(table("adj_factor_raw"), batch, NOW, order="seq")
    assert rows(raw.select("fore_factor")) == [(2.0,)]


def test_dense_row_count_equals_open_days_in_range(spark, table, calendar):
    cal = calendar(*WEEK, "2025-09-22", closed=("2025-09-20", "2025-09-21"))
    spans = spark.createDataFrame(
        [("a", "2025-09-13", "2025-10-13"), ("b", "2025-09-17", "2025-09-21"), ("c", "2025-09-20", "2025-09-21"), ("d", "2025-09-22", "2025-09-15")],
        "code string, start_date string, end_date string",
    )
    _, dense = run(spark, table, cal, spans, events(spark))
    assert rows(dense.groupBy("code").count(), "code") == [("a", 5), ("b", 2)]


def test_days_before_a_later_first_change_are_written(spark, table, calendar):
    """The first change of a batch may lie after the day that follows the last dense day."""
    cal = calendar(*WEEK, "2025-09-22", "2025-09-23")
    _, first = run(spark, table, cal, targets(spark, end="2025-09-16"), events(spark))
    stored = spark.createDataFrame(first.collect(), first.schema)
    _, dense = run(spark, table, cal, targets(spark, start="2025-09-16", end="2025-09-23"), events(spark, ("2025-09-22", 2.0)), dense=stored)
    assert rows(dense.select("trade_date", "fore_factor"), "trade_date") == [
        (day(d), f) for d, f in zip([*WEEK, "2025-09-22", "2025-09-23"], (1.0, 1.0, 1.0, 1.0, 2.0, 2.0))
    ]


def test_security_without_events_gets_factor_one(spark, table, calendar):
    _, dense = run(spark, table, calendar(*WEEK), targets(spark), events(spark))
    assert [r.fore_factor for r in dense.collect()] == [1.0] * 4


def test_event_value_holds_until_the_next_event(spark, table, calendar):
    _, dense = run(spark, table, calendar(*WEEK), targets(spark), events(spark, ("2025-09-16", 0.85)))
    assert rows(dense.select("trade_date", "back_factor"), "trade_date") == [
        (day(d), f) for d, f in zip(WEEK, (1.0, 0.85, 0.85, 0.85))
    ]


def test_second_run_appends_only_new_days(spark, table, calendar):
    cal = calendar(*WEEK, "2025-09-22", "2025-09-23", closed=("2025-09-20", "2025-09-21"))
    raw, dense = run(spark, table, cal, targets(spark), events(spark, ("2025-09-16", 0.85)))
    stored = spark.createDataFrame(dense.collect(), dense.schema)
    _, again = run(spark, table, cal, targets(spark, end="2025-09-23"), events(spark), spark.createDataFrame(raw.collect(), raw.schema), stored)
    assert again.count() == 6
    assert [f for _, f in rows(again.select("trade_date", "fore_factor"), "trade_date")][-2:] == [0.85, 0.85]


def test_backfill_starts_at_the_target_start(spark, table, calendar):
    cal = calendar(*WEEK)
    _, late = run(spark, table, cal, targets(spark, start="2025-09-17"), events(spark))
    stored = spark.createDataFrame(late.collect(), late.schema)
    _, dense = run(spark, table, cal, targets(spark), events(spark, ("2025-09-18", 3.0)), dense=stored)
    assert dense.count() == 4


def test_days_after_as_of_are_not_written(spark, table, calendar):
    _, dense = run(spark, table, calendar(*WEEK), targets(spark), events(spark), as_of="2025-09-16")
    assert dense.count() == 2


def test_no_targets_leave_the_table_alone(spark, table, calendar):
    _, dense = run(spark, table, calendar(*WEEK), targets(spark).where("false"), events(spark))
    assert dense.count() == 0


def test_intervals_of_single_codes_leave_other_rows_alone(spark, table, calendar, tmp_path):
    """A code whose range ends long ago, next to one of today: only the months of the two are read."""
    from marketframe.plans.publish import read_store, write_store

    days = ["2024-03-04", "2024-03-05", "2024-11-04", "2025-09-15", "2025-09-16"]
    held = [{"code": c, "trade_date": d, "fore_factor": 1.0, "back_factor": 1.0, "adjust_factor": 1.0, "created_at": NOW, "updated_at": NOW}
            for c in ("688111.SH", "600777.SH", "000888.SZ") for d in days]
    path = str(tmp_path / "dense")
    write_store(table("adj_factor", *held), path, "trade_date")
    dense = read_store(spark, path, "adj_factor")
    spans = spark.createDataFrame([("688111.SH", "2024-03-05", "2024-03-31"), ("600777.SH", "2025-09-16", "2025-09-30")], "code string, start_date string, end_date string")
    batch = events(spark, ("2024-03-05", 2.0)).unionByName(events(spark, ("2025-09-16", 4.0), code="600777.SH"))
    cal = calendar(*days)
    _, whole = run(spark, table, cal, spans, batch, dense=dense)
    changed = {("688111.SH", day("2024-03-05")): 2.0, ("600777.SH", day("2025-09-16")): 4.0}
    assert {(r.code, r.trade_date): r.fore_factor for r in whole.collect()} == {(h["code"], day(h["trade_date"])): 1.0 for h in held} | changed
    _, part = run_factors(spans, batch, table("adj_factor_raw"), dense, cal, as_of="2026-06-30", now=NOW, order="back_factor", touched="month")
    assert {(r.code, r.trade_date): r.fore_factor for r in part.collect()} == {
        (h["code"], day(h["trade_date"])): 1.0 for h in held if h["trade_date"] != "2024-11-04"} | changed
    plan = part._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "FileScan" in line and "/dense" in line]
    assert pushed and all("Or(And(GreaterThanOrEqual(trade_date,2024-03-01),LessThan(trade_date,2024-04-01)),And(" in line for line in pushed)
    none = run_factors(spans.where("false"), batch, table("adj_factor_raw"), dense, cal, as_of="2026-06-30", now=NOW, order="back_factor", touched="month")[1]
    assert none.count() == 0
