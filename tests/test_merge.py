import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketframe.operators import merge
from marketframe.plans import loads
from tests.conftest import day, rows

T1, T2 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 2, 8)


def stored(df):
    """The merged table as a later run reads it back."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_null_indicator_keeps_the_stored_value(table, spark):
    def batch(pe):
        return spark.createDataFrame([("a", day("2024-01-02"), None, pe, None, None)], "code string, trade_date date, turnover_rate double, pe double, pb double, is_st int")

    t = stored(loads.load_indicators(table("daily_basic"), batch(35.0)))
    t = stored(loads.load_indicators(t, batch(None)))
    assert t.first().pe == 35.0
    t = loads.load_indicators(t, batch(40.0)).first()
    assert t.pe == 40.0 and t.is_limit_up == 0 and t.total_shares is None


def test_share_counts_leave_other_columns_alone(table, spark):
    base = table("daily_basic", {"code": "a", "trade_date": "2024-01-02", "pe": 5.0, "total_shares": 10, "is_limit_up": 1})
    batch = spark.createDataFrame([("a", "2024-01-02", None, 7), ("b", "2024-01-02", 3, None)], "code string, date string, total_shares long, float_shares long")
    assert rows(loads.load_share_counts(base, batch).select("code", "pe", "total_shares", "float_shares", "is_limit_up"), "code") == [
        ("a", 5.0, 10, 7, 1), ("b", None, 3, None, 0)
    ]


def test_bars_overwrite_whole_rows_and_fill_unknowns(table, spark):
    base = table("stock_daily", {"code": "a", "date": "2024-01-02", "open": 1.0, "pre_close": 9.0, "tradestatus": 1, "amount": 5.0})
    batch = spark.createDataFrame([("a", "2024-01-02", 2.0, None, None)], "code string, date string, open double, pre_close double, trade_status int")
    assert rows(loads.load_bars(base, batch).select("open", "pre_close", "tradestatus", "amount")) == [(2.0, -1.0, -1, 5.0)]


def test_unchanged_security_keeps_its_stamp(table, spark):
    def batch(name):
        return table("stock_info", {"code": "a.SH", "symbol": "a", "name": name, "exchange": "SH", "board": "MAIN", "list_status": "L"}).drop("created_at", "last_updated_at")

    t = stored(loads.load_securities(table("stock_info"), batch("one"), T1))
    assert (t.first().created_at, t.first().last_updated_at) == (T1, T1)
    assert loads.load_securities(t, batch("one"), T2).first().last_updated_at == T1
    changed = loads.load_securities(t, batch("two"), T2).first()
    assert (changed.name, changed.created_at, changed.last_updated_at) == ("two", T1, T2)
    gone = loads.load_securities(t, batch(None), T2).first()
    assert gone.name is None and gone.last_updated_at == T2


def test_margin_detail_keeps_created_and_summary_renews_it(table, spark):
    ids = [("2024-01-02", "SH", "600000", "600000.SH", 12.34567)]
    detail = spark.createDataFrame(ids, "trade_date string, exchange_code string, symbol string, code string, margin_balance double")
    t = stored(loads.load_margin_detail(table("margin_detail_daily"), detail, T1))
    again = loads.load_margin_detail(t, detail, T2).first()
    assert (again.created_at, again.updated_at, str(again.margin_balance)) == (T1, T2, "12.3457")
    s = stored(loads.load_margin_summary(table("margin_summary_daily"), detail.drop("symbol", "code"), T1))
    renewed = loads.load_margin_summary(s, detail.drop("symbol", "code"), T2).first()
    assert (renewed.created_at, renewed.updated_at) == (T2, T2)


def test_large_stored_decimals_survive_a_merge(table, spark):
    big = "1234567890123456.7891"
    base = table("margin_summary_daily").unionByName(
        spark.sql(f"SELECT DATE '2024-01-02' trade_date, 'SH' exchange_code, CAST('{big}' AS DECIMAL(20,4)) margin_balance"), allowMissingColumns=True
    )
    other = spark.createDataFrame([("2024-01-03", "SH", 1.0)], "trade_date string, exchange_code string, margin_balance double")
    kept = loads.load_margin_summary(base, other, T1).where("trade_date = DATE '2024-01-02'").first()
    assert str(kept.margin_balance) == big


def test_finance_merge_touches_only_the_columns_it_carries(table, spark):
    base = table("finance_report", {"code": "000001", "report_date": "2023-12-31", "eps": 1.0, "roe": 2.0})
    batch = spark.createDataFrame([("000001", "2023-12-31", None)], "code string, report_date string, eps double")
    merged = loads.load_finance(base, batch, T1).first()
    assert (merged.eps, merged.roe, merged.updated_at) == (None, 2.0, T1)


def test_capital_days_come_in_three_spellings(table, spark):
    batch = spark.createDataFrame(
        [("1", d, "c") for d in ("20240105", "20240106.0", "2024-01-07", "2024-01-08 00:00:00")], "code string, date string, category string"
    )
    assert rows(loads.load_capital(table("capital_detail"), batch, T1).select(F.dayofmonth("date")), "date") == [(5,), (6,), (7,), (8,)]


def test_merge_rejects_unknown_rules_and_columns(table):
    t = table("trade_cal")
    with pytest.raises(ValueError, match="unknown merge rules"):
        merge.merge_keyed(t, t, ["cal_date"], {"is_open": "replace"})
    with pytest.raises(ValueError, match="not in the target"):
        merge.merge_keyed(t, t, ["cal_date"], {"closed": merge.OVERWRITE})
    with pytest.raises(ValueError, match="lack key columns"):
        merge.merge_keyed(t, t.drop("cal_date"), ["cal_date"], {"is_open": merge.OVERWRITE})


def test_update_never_adds_keys(table):
    base = table("trade_cal", {"cal_date": "2024-01-01", "is_open": 0})
    batch = table("trade_cal", {"cal_date": "2024-01-01", "is_open": 1}, {"cal_date": "2024-01-02", "is_open": 1})
    assert rows(merge.update_keyed(base, batch, ["cal_date"], ["is_open"])) == [(day("2024-01-01"), 1)]


def test_windowed_merge_equals_the_plain_one(table):
    base = table("trade_cal", *[{"cal_date": f"2024-01-{d:02d}", "is_open": 0} for d in range(1, 20)])
    batch = table("trade_cal", *[{"cal_date": f"2024-01-{d:02d}", "is_open": 1} for d in range(8, 25)])
    rules = {"is_open": merge.OVERWRITE}
    plain = merge.merge_keyed(base, batch, ["cal_date"], rules)
    assert rows(merge.merge_window(base, batch, ["cal_date"], rules, "cal_date"), "cal_date") == rows(plain, "cal_date")
    assert merge.merge_window(base, batch.where("false"), ["cal_date"], rules, "cal_date").count() == 19


def test_last_copy_wins_even_for_a_key_with_very_many(spark):
    df = spark.range(20000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id AS seq")
    last = merge.dedup_last(df, ["k"], ["seq"])
    assert last.where("k = 'hot'").first().seq == 19998 and last.count() == df.select("k").distinct().count()
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


MARGIN = "exchange_code string, trade_date string, v int"


def test_fallback_fills_only_what_the_primary_lacks(spark):
    primary = spark.createDataFrame([("SH", "d1", 1)], MARGIN)
    web = spark.createDataFrame([("SH", "d1", 9), ("SH", "d2", 9), ("SZ", "d1", 9)], MARGIN)
    by_exchange = merge.fallback_union(primary, web, ["exchange_code"])
    assert sorted(rows(by_exchange)) == [("SH", "d1", 1), ("SZ", "d1", 9)]
    by_day = merge.fallback_union(primary, web, ["exchange_code", "trade_date"])
    assert sorted(rows(by_day)) == [("SH", "d1", 1), ("SH", "d2", 9), ("SZ", "d1", 9)]
    assert merge.fallback_union(primary.where("false"), web, ["exchange_code"]).count() == 3
    assert merge.fallback_union(primary, web.where("false"), ["exchange_code"]).count() == 1


def test_first_source_that_has_a_key_wins(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 2)], "k string, v int")
    c = spark.createDataFrame([("y", 3), ("z", 3)], "k string, v int")
    assert rows(merge.first_available([a, b, c], ["k"]), "k") == [("x", 1), ("y", 2), ("z", 3)]


def test_touched_loads_read_only_the_days_of_the_batch(spark, table, tmp_path):
    import contextlib
    import io

    from marketframe.operators.merge import merge_window, touched
    from marketframe.plans import loads

    stored = table("stock_daily", *[{"code": "a", "date": f"2024-01-{d:02d}", "close": 1.0} for d in (2, 3, 4)], {"code": "b"})
    stored.write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    batch = table("stock_daily", {"code": "a", "date": "2024-01-03", "close": 5.0}, {"code": "a", "date": "2024-01-03", "close": 4.0})
    part = loads.load_bars(stored, batch, touched="day")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        part.explain("formatted")
    assert "(date,2024-01-03)" in out.getvalue() or "In(date, [2024-01-03])" in out.getvalue()
    assert [(r.code, r.close) for r in part.collect()] == [("a", 5.0)]
    whole = loads.load_bars(stored, batch)
    assert sorted((r.code, str(r.date), r.close) for r in whole.collect()) == [
        ("a", "2024-01-02", 1.0), ("a", "2024-01-03", 5.0), ("a", "2024-01-04", 1.0), ("b", "None", None)]
    assert merge_window(stored, batch.limit(1), ["code", "date"], {"close": "overwrite"}, "date").count() == 4
    many = spark.range(400).selectExpr("date_add(DATE '2020-01-15', CAST(id AS INT)) AS date")
    text = str(touched(many, "date"))
    assert "2020-01-01" in text and "2021-03-01" in text and touched(many.limit(0), "date") is None


def test_defaults_and_names_are_taken_literally(spark):
    import datetime as dt

    from marketframe.operators.merge import merge_keyed

    stored = spark.sql("SELECT 1 AS k, 'x' AS `odd``name`, DATE '2020-01-01' AS since")
    batch = spark.sql("SELECT 2 AS k")
    merged = merge_keyed(stored, batch, ["k"], {}, defaults={"odd`name": "it's", "since": dt.date(2024, 1, 1)})
    assert sorted(map(tuple, merged.collect())) == [(1, "x", dt.date(2020, 1, 1)), (2, "it's", dt.date(2024, 1, 1))]


def _by_month(df, day, path):
    from pyspark.sql import functions as F

    df.withColumn("month", F.date_format(day, "yyyy-MM")).write.mode("overwrite").partitionBy("month").parquet(path)


def test_month_partitions_keep_their_untouched_rows_after_a_dynamic_overwrite(spark, table, tmp_path):
    from marketframe.operators.merge import DAY, MONTH, touched
    from marketframe.plans import jobs

    path = str(tmp_path / "capital")
    event = {"code": "a", "category": "x"}
    days = ("2024-01-02", "2024-01-30", "2024-02-01", "9999-12-31")
    _by_month(table("capital_detail", *[{**event, "date": d} for d in days], event), "date", path)
    stored = spark.read.parquet(path).drop("month")
    last = table("capital_detail", {**event, "date": "9999-12-31"})
    assert stored.where(touched(last, "date", unit=MONTH)).count() == 1
    batch = table("capital_detail", {**event, "date": "2024-01-30", "dividend": 2.0}, {**event, "code": "b"}).select("code", "date", "category", "dividend")
    now = dt.datetime(2024, 3, 1)
    part = jobs.sync_capital([batch], stored, now)
    assert sorted(str(r.date) for r in part.collect()) == ["2024-01-02", "2024-01-30", "None", "None"]
    _by_month(part.localCheckpoint(), "date", path)
    after = spark.read.parquet(path)
    assert sorted((str(r.date), r.dividend) for r in after.where("code = 'a'").collect()) == [
        ("2024-01-02", None), ("2024-01-30", 2.0), ("2024-02-01", None), ("9999-12-31", None), ("None", None)]

    many = spark.range(0, 400, 2).unionAll(spark.range(1000, 1002)).selectExpr("date_add(DATE '2020-01-15', CAST(id AS INT)) AS date")
    every = spark.range(2000).selectExpr("date_add(DATE '2020-01-01', CAST(id AS INT)) AS date")
    assert every.where(touched(many, "date", unit=DAY)).count() == many.count() == 202


@pytest.mark.parametrize("name", ["calendar", "securities", "hierarchy", "industry_history", "finance"])
def test_repeated_keys_of_a_batch_give_one_row(spark, table, name):
    """In a table loaded whole or by report period, as in the daily ones, the last row by order stays."""
    stamp = dt.datetime(2025, 6, 1)
    cases = {
        "calendar": ("trade_cal", [{"cal_date": "2025-06-02", "is_open": 0}], {"is_open": (1, 0)}, lambda s, b, o: loads.load_calendar(s, b, o)),
        "securities": ("stock_info", [{"code": "600001.SH", "name": "old"}], {"name": ("b", "a")}, lambda s, b, o: loads.load_securities(s, b, stamp, o)),
        "hierarchy": ("sw_industry", [{"sw_version": "v", "industry_code": "1", "industry_name": "old", "sw_level": 1}], {"industry_name": ("b", "a")},
                      lambda s, b, o: loads.load_hierarchy(s, b, stamp, o)),
        "industry_history": ("stock_industry_clf_hist_sw_raw", [{"symbol": "600001", "start_date": "2025-06-02", "industry_code": "1"}],
                             {"update_time": (dt.datetime(2025, 2, 2), dt.datetime(2025, 1, 1))}, lambda s, b, o: loads.load_industry_history(s, b, stamp, o)),
        "finance": ("finance_report", [{"code": "600001.SH", "report_date": "2025-03-31", "eps": 9.0}], {"eps": (2.0, 1.0)},
                    lambda s, b, o: loads.load_finance(s, b, stamp, order=o)),
    }
    stored_name, held, values, load = cases[name]
    (column, (greater, lesser)), = values.items()
    stored = table(stored_name, *held)
    twice = table(stored_name, *[{**held[0], column: v} for v in (greater, lesser)])
    by_value = load(stored, twice, None)
    assert by_value.count() == 1 and by_value.first()[column] == greater
    seen = twice.withColumn("arrival", F.when(F.col(column) == F.lit(greater), 1).otherwise(2))
    in_order = load(stored, seen, "arrival")
    assert in_order.count() == 1 and in_order.first()[column] == lesser


def test_finance_rows_of_one_key_keep_the_widest_layout(spark, table):
    stored = table("finance_report")
    batch = spark.createDataFrame([("600001.SH", dt.date(2025, 3, 31), 1.0, 2.0, 120), ("600001.SH", dt.date(2025, 3, 31), 9.0, None, 60)],
                                  "code string, report_date date, eps double, op_cost double, field_count int")
    row = loads.load_finance(stored, batch, dt.datetime(2025, 6, 1))
    assert [(r.eps, r.op_cost) for r in row.collect()] == [(1.0, 2.0)]


def test_a_unit_of_partitions_has_to_be_named(table):
    stored = table("stock_daily")
    for unknown in (True, "year"):
        with pytest.raises(ValueError, match="partitioned by"):
            loads.load_bars(stored, stored, touched=unknown)
