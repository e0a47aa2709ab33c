"""Stores that answer from footers, and merges into buckets."""

import datetime as dt
import uuid

import pytest

from marketframe.operators.merge import OVERWRITE
from marketframe.plans.loads import BAR_VALUES
from marketframe.plans.publish import MONTH_FOLDER, write_store
from marketframe.schemas import TABLES
from marketframe.sources import buckets, statistics
from tests.conftest import day, rows

BAR = {"open": 3.0, "high": 4.0, "low": 2.0, "close": 3.5, "pre_close": 3.0, "tradestatus": 1, "volume": 10, "amount": 1.0}
RULES = {c: OVERWRITE for c in BAR_VALUES}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_come_from_footers(spark, table, tmp_path):
    path = str(tmp_path / "bars")
    held = [{"code": c, "date": d, **BAR} for c in ("600010.SH", "600011.SH") for d in ("2025-04-01", "2025-05-30", "2025-05-06")] + [{"code": "600012.SH", **BAR}]
    write_store(table("stock_daily", *held), path, "date")
    whole = statistics.footer_stats(spark, path, TABLES["stock_daily"].schema, "date", MONTH_FOLDER)
    assert plan_of(whole).count("PushedAggregation: [COUNT(*)") == 2
    assert rows(whole) == [(7, day("2025-04-01"), day("2025-05-30"))]
    by_month = statistics.footer_stats_by(spark, path, TABLES["stock_daily"].schema, "date", MONTH_FOLDER)
    assert "PushedGroupBy: [month]" in plan_of(by_month) and "PushedAggregation: [COUNT(*), MIN(date), MAX(date)]" in plan_of(by_month)
    assert rows(by_month, "month") == [(None, 1, None, None), ("2025-04", 2, day("2025-04-01"), day("2025-04-01")), ("2025-05", 4, day("2025-05-06"), day("2025-05-30"))]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # other scans keep their reader


@pytest.fixture
def store(spark, table, tmp_path):
    made = []

    def build(*held, count=4):
        made.append(buckets.BucketedStore("stock_daily", f"bars_{uuid.uuid4().hex}", str(tmp_path / uuid.uuid4().hex), count))
        return made[-1].write(table("stock_daily", *held))

    yield build
    for one in made:
        one.drop(spark)


def bars(n, code="600020.SH", close=3.5):
    return [{"code": code, "date": (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat(), **BAR, "close": close} for i in range(n)]


def test_a_merge_shuffles_the_batch_and_not_the_store(spark, table, store, tmp_path):
    old = store(*bars(300), *bars(20, "600021.SH"))
    batch = table("stock_daily", *bars(10, close=9.0), *bars(5, "600022.SH", 8.0), *bars(1, "600022.SH", 7.0))
    plan = plan_of(buckets.merge_plan(spark, old, batch, RULES))
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    store_side = plan[plan.index("SortMergeJoin"):plan.index("Bucketed: true")]
    assert "Exchange" not in store_side
    new = buckets.merge_bucketed(spark, old, batch, RULES, (f"{old.name}_next", str(tmp_path / "next")))
    found = {(r.code, r.date): r.close for r in new.read(spark).collect()}
    assert len(found) == new.read(spark).count() == 325 and old.read(spark).count() == 320
    assert found["600020.SH", dt.date(2024, 1, 3)] == 9.0 and found["600020.SH", dt.date(2024, 2, 3)] == 3.5 and found["600022.SH", dt.date(2024, 1, 1)] == 8.0
    again = buckets.merge_plan(spark, new, batch, RULES)
    assert plan_of(again).count("Exchange hashpartitioning") == 1 and again.count() == 325
    assert len(buckets.files_of(new, spark)) <= 4
    new.drop(spark)
    later = new.attach(spark)  # as another session would
    assert plan_of(buckets.merge_plan(spark, later, batch, RULES)).count("Exchange hashpartitioning") == 1
    assert later.read(spark).count() == 325
    later.drop(spark)


def test_one_code_with_all_rows_fills_every_bucket(spark, store):
    files = buckets.files_of(store(*bars(400)), spark)
    sizes = [spark.read.parquet(f).count() for f in files]
    assert len(sizes) == 4 and max(sizes) < 160


def test_number_of_buckets_follows_the_rows():
    assert [buckets.bucket_count(n) for n in (0, 1, 4_000_001, 10**12)] == [1, 1, 2, 16_384]
