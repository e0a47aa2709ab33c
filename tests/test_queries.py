"""Every registered query against its comparison SQL, and what every plan must not do."""

import contextlib
import io

import pytest

from __spark_entry__ import entry
from bridge.registry import all_queries, all_sql
from marketframe.operators.fills import fill_turnover
from tools.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="session")
def duck():
    return connect(FOLDER)


def explained(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_and_avoids_pairwise_joins(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = explained(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    got = df.toArrow()
    if name in SQL:
        assert difference(got, duck.sql(SQL[name]).to_arrow_table()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    assert entry(spark).columns == ["code", "trade_date", "fore_factor", "back_factor", "adjust_factor"]


def test_range_filter_and_columns_reach_the_scan(spark, table, tmp_path):
    for name in ("daily_basic", "stock_daily", "stock_info"):
        table(name, {"code": "a.SH"}).write.parquet(str(tmp_path / name))
    basic, bars, master = (spark.read.parquet(str(tmp_path / n)) for n in ("daily_basic", "stock_daily", "stock_info"))
    plan = explained(fill_turnover(basic, bars, master, "2024-01-02", "2024-01-05", codes=["a.SH"]))
    assert "GreaterThanOrEqual(trade_date,2024-01-02)" in plan and "GreaterThanOrEqual(date,2024-01-02)" in plan
    assert "ReadSchema: struct<code:string,date:date,tradestatus:int,volume:bigint>" in plan
