"""Imports into stores by month: whole-table counts, dry runs, and nothing changed by a failed stage."""

import datetime as dt
import os

import pytest

from marketframe.plans import publish, transfer
from marketframe.schemas import TABLES
from tests.conftest import rows

T = dt.datetime(2025, 3, 4, 5, 6)
BAR = {"open": 5.0, "high": 6.0, "low": 4.0, "close": 5.5, "pre_close": 5.0, "tradestatus": 1, "volume": 300, "amount": 2.0}


@pytest.fixture
def stores(spark, table, tmp_path):
    """Stored tables over three months, and an export that touches two of them."""
    stored = {
        "stock_daily": [{"code": c, "date": d, **BAR} for c in ("600001.SH", "600002.SH") for d in ("2025-01-06", "2025-02-06", "2025-03-06")],
        "daily_basic": [{"code": "600001.SH", "trade_date": d, "pe": 9.0, "limit_up": 7.0} for d in ("2025-01-06", "2025-02-06")],
    }
    paths = {}
    for name, held in stored.items():
        paths[name] = str(tmp_path / "store" / name)
        publish.write_store(table(name, *held), paths[name], TABLES[name].day)
    fresh = {
        "stock_daily": [{"code": "600001.SH", "date": "2025-02-06", **BAR, "close": 8.0}, {"code": "600003.SH", "date": "2025-03-07", **BAR}],
        "daily_basic": [{"code": "600001.SH", "trade_date": "2025-02-06", "turnover_rate": 1.0}, {"code": "600003.SH", "trade_date": "2025-04-01", "pb": 2.0}],
    }
    source = str(tmp_path / "export")
    for name, held in fresh.items():
        table(name, *held).select(*transfer.moved_columns(name)).write.parquet(f"{source}/{name}.parquet")
    return paths, source


def test_import_counts_whole_tables_and_keeps_other_months(spark, stores):
    paths, source = stores
    untouched = set(os.listdir(f"{paths['stock_daily']}/month=2025-01"))
    assert publish.import_store(spark, source, paths, dry_run=True) == {t: {"src": 2, "before": 0, "after": 0} for t in paths}
    assert publish.row_count(spark, paths["stock_daily"], "stock_daily") == 6
    expected = {"stock_daily": {"src": 2, "before": 6, "after": 7}, "daily_basic": {"src": 2, "before": 2, "after": 3}}
    assert publish.import_store(spark, source, {**paths, "adj_factor": "/not/there"}) == expected
    bars = rows(publish.read_store(spark, paths["stock_daily"], "stock_daily").select("code", "date", "close"), "date", "code")
    assert [(c, str(d), x) for c, d, x in bars if x != 5.5] == [("600001.SH", "2025-02-06", 8.0)] and len(bars) == 7
    basic = rows(publish.read_store(spark, paths["daily_basic"], "daily_basic").select("trade_date", "turnover_rate", "pe", "pb", "limit_up", "is_limit_up"), "trade_date")
    assert [r[1:] for r in basic] == [(None, 9.0, None, 7.0, None), (1.0, 9.0, None, 7.0, None), (None, None, 2.0, None, 0)]
    assert set(os.listdir(f"{paths['stock_daily']}/month=2025-01")) == untouched
    again = publish.import_store(spark, source, paths)  # idempotent
    assert again["stock_daily"] == {"src": 2, "before": 7, "after": 7}


def test_a_table_that_does_not_fit_stops_the_import_before_any_store_changes(spark, stores, tmp_path):
    paths, source = stores
    spark.read.parquet(f"{source}/daily_basic.parquet").drop("pe").write.parquet(str(tmp_path / "narrow/daily_basic.parquet"))
    spark.read.parquet(f"{source}/stock_daily.parquet").write.parquet(str(tmp_path / "narrow/stock_daily.parquet"))
    with pytest.raises(Exception, match="pe"):
        publish.import_store(spark, str(tmp_path / "narrow"), paths)
    assert publish.row_count(spark, paths["stock_daily"], "stock_daily") == 6
    assert rows(publish.read_store(spark, paths["stock_daily"], "stock_daily").where("close = 8")) == []


def test_counts_that_do_not_add_up_are_not_published(spark, stores, monkeypatch):
    paths, source = stores
    monkeypatch.setattr(publish, "merge_keyed", lambda target, *_, **__: target.limit(1))
    with pytest.raises(publish.PublicationError, match="stock_daily: 1 rows staged"):
        publish.import_store(spark, source, paths)
    assert publish.row_count(spark, paths["stock_daily"], "stock_daily") == 6


def test_publication_can_be_completed_after_a_stop(spark, stores, tmp_path):
    paths, source = stores
    staged = publish.stage_import(spark, source, paths, str(tmp_path / "staging"))
    publish.publish(spark, staged[:1], paths)  # stopped between two tables
    publish.publish(spark, staged, paths)
    assert [publish.row_count(spark, paths[t], t) for t in paths] == [7, 3]


def test_repeated_and_dayless_rows_of_an_export(spark, stores, table):
    paths, source = stores
    rows_in = [{"code": "600009.SH", "date": "2025-02-07", **BAR, "close": c} for c in (1.0, 3.0, 2.0)] + [{"code": "600009.SH", "date": None, **BAR}]
    table("stock_daily", *rows_in).write.mode("overwrite").parquet(f"{source}/stock_daily.parquet")
    assert publish.import_store(spark, source, {"stock_daily": paths["stock_daily"]}) == {"stock_daily": {"src": 4, "before": 6, "after": 8}}
    found = rows(publish.read_store(spark, paths["stock_daily"], "stock_daily").where("code = '600009.SH'").select("date", "close"), "date")
    assert [x for _, x in found] == [5.5, 3.0]
    table("stock_daily").write.mode("overwrite").parquet(f"{source}/stock_daily.parquet")
    assert publish.import_store(spark, source, {"stock_daily": paths["stock_daily"]})["stock_daily"] == {"src": 0, "before": 8, "after": 8}


def test_a_day_range_of_a_store_prunes_months(spark, stores):
    paths, _ = stores
    plan = publish.read_store(spark, paths["stock_daily"], "stock_daily", ["2025-02"])._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
