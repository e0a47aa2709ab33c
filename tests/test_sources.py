import datetime as dt
import struct
import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bridge import source_queries
from bridge.registry import all_queries, all_sql
from bridge.shapes import SCHEMAS, Shapes
from marketframe.functions import codes, dates, numeric
from marketframe.schemas import STATEMENT_FIELDS, TABLES, create_tables, statement_view
from marketframe.sources import bars, events, files, records
from tests.conftest import day, rows


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_numbers(spark):
    df = texts(spark, "1,234.5", " 7 ", "-3", ".5", "1e3", "", " ", "n/a", "1d", "NaN", "1-2", None)
    assert [r[0] for r in df.select(numeric.to_number(F.col("t"))).collect()] == [1234.5, 7.0, -3.0, 0.5, 1000.0] + [None] * 7
    assert texts(spark, "2,444,063,656").select(numeric.to_number(F.col("t"), "long")).first()[0] == 2444063656


def test_dates(spark):
    df = texts(spark, "20240105", "2024-01-05", "2024-1-5", "2024-01-05 09:30:00", "20240230", "x", None)
    d = day("2024-01-05")
    assert [r[0] for r in df.select(dates.loose_date(F.col("t"))).collect()] == [d, d, d, d, None, None, None]
    assert [r[0] for r in df.select(dates.compact_date(F.col("t"))).collect()] == [d, None, None, None, None, None, None]
    assert dates.as_date("20240105") == dates.as_date("2024-01-05") == d
    with pytest.raises(ValueError):
        dates.as_date("5 Jan")


def test_code_lists():
    assert codes.split_code_list(["600519,000001", "300750，688001 ", ""]) == ["600519", "000001", "300750", "688001"]
    assert codes.split_code_list(None) == codes.split_code_list([" , "]) == []
    assert codes.requested_exchanges(["sh", "ALL"]) is None and codes.requested_exchanges(["sh"]) == ["SH"]


def test_zero_padding_never_cuts(spark):
    assert [r[0] for r in texts(spark, "1", " 000002", "1234567").select(codes.zero_pad(F.col("t"))).collect()] == ["000001", "000002", "1234567"]


def test_blank_report_is_bounded_and_complete(spark):
    df = spark.range(200).selectExpr("CAST(1000 + id AS STRING) AS code", "CASE WHEN id % 2 = 0 THEN ' ' ELSE '1' END AS open", "'2' AS close")
    found = numeric.blank_report(df, ["open", "close"], "code", sample=3).collect()
    assert [tuple(r) for r in found] == [("open", 100, 100, "1000,1002,1004")]


def test_security_master(spark):
    raw = spark.createDataFrame(
        [("sh.600519", "A", "2001-08-27", "", "1", "1"), ("sz.300750", "B", "2018-06-11", "", "1", "1"), ("sh.688001", "C", "", "", "", "1"),
         ("bj.920001", "D", "bad", "2024-01-02", "0", "1"), ("sh.000001", "I", "1991-07-15", "", "1", "2"), ("sh.113001", "X", "", "", "1", "4")],
        "code string, code_name string, ipoDate string, outDate string, status string, type string",
    )
    assert rows(bars.securities(raw).select("code", "board", "list_date", "list_status"), "name") == [
        ("600519.SH", "MAIN", day("2001-08-27"), "L"), ("300750.SZ", "GEM", day("2018-06-11"), "L"), ("688001.SH", "STAR", None, "L"),
        ("920001.BJ", "BJ", None, "D"), ("000001.SH", "INDEX", day("1991-07-15"), "L"),
    ]


COMBINED = ["date", "code", "open", "high", "low", "close", "preclose", "volume", "amount", "turn", "tradestatus", "isST", "peTTM", "pbMRQ"]


def combined(spark, *items):
    return spark.createDataFrame([tuple({**dict.fromkeys(COMBINED, ""), **i}[c] for c in COMBINED) for i in items], ", ".join(f"{c} string" for c in COMBINED))


def test_combined_source_splits_and_rejects(spark):
    good = {"date": "2024-01-02", "code": "sh.600000", "close": "9.5", "volume": "100", "turn": "0.5", "tradestatus": "1", "isST": "1"}
    halted = {"date": "2024-01-03", "code": "sh.600000", "tradestatus": "0"}
    torn = {"date": "2024-01-02", "code": "sz.000001", "close": "1", "tradestatus": "1"}
    daily, indicators, rejected = bars.split_combined(combined(spark, good, halted, torn, {**torn, "turn": "1", "date": "2024-01-03"}))
    assert rows(daily.select("code", "close", "volume", "pre_close"), "date") == [("600000.SH", 9.5, 100, 0.0), ("600000.SH", 0.0, 0, 0.0)]
    assert rows(indicators.select("turnover_rate", "pe", "is_st"), "trade_date") == [(0.5, None, 1), (None, None, 0)]
    assert rows(rejected) == [("000001.SZ", 1)]


def test_suspension_needs_no_volume_and_equal_prices(spark):
    schema = "code string, datetime string, open double, high double, low double, close double, vol int, amount double"
    raw = spark.createDataFrame(
        [("a", "2024-01-02 15:00", 5.0, 5.0, 5.0, 5.0004, 0, 0.0), ("a", "2024-01-03 15:00", 5.0, 5.1, 5.0, 5.0, 0, 0.0),
         ("a", "2024-01-04 15:00", 5.0, 5.0, 5.0, 5.0, 3, 9.0), ("a", "bad", 5.0, 5.0, 5.0, 5.0, 3, 9.0)], schema,
    )
    assert rows(bars.online_bars(raw).select("tradestatus", "volume"), "date") == [(0, 0), (1, 0), (1, 300)]


def test_lots_become_shares_and_index_days_count_as_traded(spark):
    raw = spark.createDataFrame([("2024-01-02", "1", "2", "0.5", "1.5", 3, 4.0, "0.7")], "`日期` string, `开盘` string, `最高` string, `最低` string, `收盘` string, `成交量` long, `成交额` double, `换手率` string")
    daily, indicators = bars.lot_bars(raw, F.lit("600000.SH"))
    assert rows(daily.select("volume", "tradestatus", "close")) == [(300, 1, 1.5)] and indicators.first().turnover_rate == 0.7
    index = bars.index_bars(combined(spark, {"date": "2024-01-02", "code": "sh.000001", "open": "3000.5", "tradestatus": "0"}))
    assert rows(index.select("code", "open", "tradestatus", "volume", "amount")) == [("000001.SH", 3000.5, 1, 0, None)]
    assert rows(bars.indicator_skeleton(daily).drop("code", "trade_date")) == [(None, None, None, None)]


def test_beijing_share_counts_lose_their_commas(spark):
    raw = spark.createDataFrame([("430047", "N", "2021-11-15", "1,234,567", "-")], "`证券代码` string, `证券简称` string, `上市日期` string, `总股本` string, `流通股本` string")
    assert rows(bars.beijing_shares(raw, F.lit("2024-01-02")).select("code", "total_shares", "float_shares")) == [("430047.BJ", 1234567, None)]
    assert rows(bars.beijing_securities(raw).select("code", "board", "list_date")) == [("430047.BJ", "BJ", day("2021-11-15"))]


def test_capital_values_follow_the_category_family(spark):
    names = ("fenhong", "peigujia", "songzhuangu", "peigu", "panqianliutong", "qianzongguben", "panhouliutong", "houzongguben")
    schema = "code string, year int, month int, day int, category int, " + ", ".join(f"{n} double" for n in names)
    raw = spark.createDataFrame([("000001", 2024, 5, 7, c, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0) for c in (1, 5, 99)], schema)
    got = rows(events.capital_events(raw).drop("code"), "dividend", "category")
    assert got == [(day("2024-05-07"), "除权除息", 1.0, 2.0, 3.0, 4.0), (day("2024-05-07"), None, 5.0, 6.0, 7.0, 8.0), (day("2024-05-07"), "股本变化", 5.0, 6.0, 7.0, 8.0)]
    assert rows(events.unknown_categories(raw)) == [(99, 1)]


def frame(spark, columns: dict[str, list]):
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` string" for c in columns)).withColumn("trade_date", F.lit("2026-06-18").cast("date"))


def test_shanghai_summary_drops_notes(spark):
    raw = frame(spark, {
        "本日融资余额(元)": ["1495185799372", None, "注：本表格"], "本日融资买入额(元)": ["179607982680", None, None], "本日融券余量(股)": ["2444063656", None, None],
        "本日融券余量金额(元)": ["14089378242", None, None], "本日融券卖出量(股)": ["41813060", None, None], "本日融资融券余额(元)": ["1509275177614", None, None],
    })
    row = events.margin_summary_sh(raw).collect()
    assert len(row) == 1 and row[0].margin_balance == 1495185799372.0 and row[0].short_balance_volume == 2444063656.0
    assert row[0].margin_repay_amount is None and row[0].exchange_code == "SH"
    with pytest.raises(ValueError, match="本日融资余额"):
        events.margin_summary_sh(raw.drop("本日融资余额(元)"))


def test_detail_keeps_own_symbols_after_padding(spark):
    sh = {c: ["1", "2"] for c in events.SH_DETAIL}
    sh[" 标的证券代码"] = ["510050", "600000"]
    del sh["标的证券代码"]
    assert rows(events.margin_detail_sh(frame(spark, sh)).select("code", "short_balance_amount")) == [("600000.SH", None)]
    sz = {c: ["1,000"] * 4 for c in events.SZ_DETAIL}
    sz["证券代码"] = ["1", "000002", "159915", "301687"]
    assert rows(events.margin_detail_sz(frame(spark, sz)).select("code", "margin_balance"), "code") == [
        ("000001.SZ", 1000.0), ("000002.SZ", 1000.0), ("301687.SZ", 1000.0)
    ]
    with pytest.raises(ValueError):
        events.margin_detail_sz(frame(spark, {"证券代码": ["000001"]}))


def test_alternate_summaries(spark):
    sz = frame(spark, {**{c: ["1,5", "9"] for c in events.SZ_SUMMARY_ALT if c != "数据日期"}, "项目": [" 融资融券", "股票"], "数据日期": ["2026-06-18"] * 2}).drop("trade_date")
    assert rows(events.margin_summary_sz_alt(sz).select("trade_date", "margin_balance")) == [(day("2026-06-18"), 15e8)]
    sh = frame(spark, {**{c: ["3", "4"] for c in events.SH_SUMMARY_ALT if c != "信用交易日期"}, "信用交易日期": ["20260618", "x"]}).drop("trade_date")
    assert rows(events.margin_summary_sh_alt(sh).select("trade_date", "margin_balance")) == [(day("2026-06-18"), 3.0)]


def test_industry_history(spark):
    raw = spark.createDataFrame(
        [("1", "1991-04-03 00:00:00", "440101", "2015-10-27 15:29:00", 1), ("000002", "1991-01-29", "430101", "2024-09-27 09:08:00", 2),
         ("000002", "1991-01-29", "430101", "2024-09-28 09:08:00", 3), ("3", "not-a-date", "1", None, 4), ("4", "1991-01-29", " ", None, 5), (None, "1991-01-29", "1", None, 6)],
        "`股票代码` string, `计入日期` string, `行业代码` string, `更新日期` string, seq int",
    )
    got = rows(events.industry_history(events.rename_industry(raw), "seq"), "symbol")
    assert got == [("000001", day("1991-04-03"), "440101", dt.datetime(2015, 10, 27, 15, 29)), ("000002", day("1991-01-29"), "430101", dt.datetime(2024, 9, 28, 9, 8))]
    with pytest.raises(ValueError, match="行业代码"):
        events.rename_industry(raw.drop("行业代码"))


def test_report_fields_get_names(spark):
    raw = spark.sql("SELECT DATE '2024-12-31' report_date, '000001' code, array(CAST(1.25 AS FLOAT), CAST('NaN' AS FLOAT), CAST(0 AS FLOAT), CAST(12.5 AS FLOAT)) fields")
    row = events.finance_report(raw).first()
    assert (row.eps, row.eps_deduct, row.bps, row.net_profit) == (1.25, None, 12.5, None)
    narrow = events.finance_report(raw, codes="000001,000002", width=4)
    assert narrow.columns == ["code", "report_date", "eps", "eps_deduct", "undist_profit_ps", "bps", "field_count"] and narrow.count() == 1
    assert events.finance_report(raw, codes="600000").count() == 0
    with pytest.raises(ValueError, match="code"):
        events.finance_report(raw.drop("code"))


def test_statements_split_the_wide_report(spark):
    tables = create_tables(spark)
    assert set(tables) == set(TABLES) and all(df.schema == TABLES[n].schema for n, df in tables.items())
    columns = {s: statement_view(tables["finance_report"], s).columns[2:] for s in STATEMENT_FIELDS}
    assert [len(c) for c in columns.values()] == [22, 15, 7]
    assert columns["balance_sheet"][0] == "money_funds" and columns["income_statement"][-1] == "rd_expense" and columns["cash_flow"][-1] == "cash_end_bal"


def test_day_files(spark, tmp_path):
    def record(d, *prices, amount, volume):
        return struct.pack("<IIIIIfII", d, *prices, amount, volume, 0)

    folder = tmp_path / "sh" / "lday"
    folder.mkdir(parents=True)
    (folder / "sh600000.day").write_bytes(record(20240102, 1000, 1100, 990, 1050, amount=1.5, volume=7) + record(20240103, 1, 2, 3, 4, amount=0, volume=4_000_000_000) + b"torn")
    (folder / "sh600001.day").write_bytes(b"")
    assert rows(files.read_day_files(spark, str(tmp_path)), "date") == [
        ("600000.SH", day("2024-01-02"), 10.0, 11.0, 9.9, 10.5, 7, 1.5), ("600000.SH", day("2024-01-03"), 0.01, 0.02, 0.03, 0.04, 4_000_000_000, 0.0)
    ]
    assert files.read_day_files(spark, str(tmp_path), "2024-01-03", "2024-01-31").count() == 1


def report_file(*stocks):
    width = len(stocks[0][1])
    start = struct.calcsize("<1hI1H3L") + len(stocks) * struct.calcsize("<6s1c1L")
    head = struct.pack("<1hI1H3L", 1, 0, len(stocks), 0, width * 4, 0)
    index = b"".join(struct.pack("<6s1c1L", c.encode(), b"1", start + i * width * 4) for i, (c, _) in enumerate(stocks))
    return head + index + b"".join(struct.pack(f"<{width}f", *v) for _, v in stocks)


def test_report_files_by_period(spark, tmp_path):
    for period, body in {"20231231": report_file(("000001", [1.0, 2.0]), ("600000", [3.0, 4.5])), "20240331": report_file(("000001", [9.0, 8.0])), "20240630": b"broken"}.items():
        (tmp_path / f"gpcw{period}.dat").write_bytes(body)
    (tmp_path / "notes.txt").write_text("x")
    got = files.read_report_files(spark, str(tmp_path))
    assert rows(got, "report_date", "code") == [
        (day("2023-12-31"), "000001", [1.0, 2.0]), (day("2023-12-31"), "600000", [3.0, 4.5]), (day("2024-03-31"), "000001", [9.0, 8.0])
    ]
    assert files.read_report_files(spark, str(tmp_path), "20240101", "20241231").count() == 1


def test_recent_periods(spark):
    def recent(count, *names):
        return {r[0] for r in files.recent_periods(texts(spark, *names), "t", count).collect()}

    quarters = [f"gpcw{p}.zip" for p in ("20231231", "20240331", "20240630", "20240930", "20241231")]
    assert recent(3, *quarters) == set(quarters[-3:])
    assert recent(12, *quarters[:2]) == set(quarters[:2])
    assert recent(0, *quarters) == set(quarters)
    assert recent(1, *quarters, "gpcwBADDATE.zip", "notes.txt") == {quarters[-1], "gpcwBADDATE.zip", "notes.txt"}
    listed = files.list_periods(texts(spark, *quarters, quarters[0], "notes.txt"), "t", "2024-01-01", "2024-09-30")
    assert rows(listed) == [(day("2024-03-31"),), (day("2024-06-30"),), (day("2024-09-30"),)]


def test_csv_and_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("000001", "农业", None)], "`行业代码` string, `一级行业名称` string, n int")
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv_text(spark, str(tmp_path / "csv"), ["行业代码"])
    assert rows(back) == [("000001", "农业", None)] and {t for _, t in back.dtypes} == {"string"}
    with pytest.raises(ValueError, match="二级"):
        files.read_csv_text(spark, str(tmp_path / "csv"), ["二级行业名称"])
    files.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["一级行业名称"] == "农业"
    assert files.as_document(df.select("n")).first()[0] == '{"n":null}'


def test_values_that_cannot_be_read_are_named_or_null(spark):
    from pyspark.sql import functions as F

    from marketframe.functions.numeric import round_at
    from marketframe.sources.bars import numeric_bars
    from marketframe.sources.events import capital_events
    from marketframe.sources.files import decode_day_files, decode_report_files, unreadable_report_files

    files = spark.createDataFrame([("x/gpcw20240331.dat", bytearray(b"short"))], "path string, content binary")
    assert [tuple(map(str, r)) for r in unreadable_report_files(files).collect()] == [("x/gpcw20240331.dat", "2024-03-31", "no header")]
    assert decode_report_files(files).count() == 0
    numbers = [1e300, float("inf"), -2.0**60, 1.005, -1.675, None]
    rounded = [r[0] for r in spark.createDataFrame([(x,) for x in numbers], "x double").select(round_at(F.col("x"), 2)).collect()]
    assert rounded == [1e300, float("inf"), -2.0**60, 1.0, -1.68, None]
    texts = spark.createDataFrame([("a", " "), ("b", None), ("c", "1,5")], "code string, pre_close string")
    plain = texts.withColumns({c: F.lit("1") for c in ("open", "high", "low", "close", "volume", "amount")})
    assert {r.code: r.pre_close for r in numeric_bars(plain).collect()} == {"a": None, "b": -1.0, "c": 15.0}
    names = ["fenhong", "peigujia", "songzhuangu", "peigu", "panqianliutong", "qianzongguben", "panhouliutong", "houzongguben"]
    raw = spark.createDataFrame([("a", 2024, m, 5, 1, *[0.0] * 8) for m in (1, 12, 123)], ["code", "year", "month", "day", "category", *names])
    assert [str(r.date) for r in capital_events(raw).collect()] == ["2024-01-05", "2024-12-05", "None"]
    assert decode_day_files(spark.createDataFrame([], "path string, content binary"), "2024-01-01", "2024-01-02").count() == 0


def test_csv_round_trip_keeps_quotes_breaks_empty_texts_and_nulls(spark, tmp_path):
    texts = ['say "yes"', "a,b", "two\nlines", "", None, " padded ", "\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv_text(spark, str(tmp_path / "out"), ["text"], lines=True, empty_is_null=False)
    assert sorted((r.n, r.text) for r in back.collect()) == sorted((str(n), t) for n, t in enumerate(texts))
    assert {r.text for r in files.read_csv_text(spark, str(tmp_path / "out"), ["text"], lines=True).collect() if r.n in "34"} == {None}


def test_broken_csv_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('code,name,level\n1,one,1\n2,two\n3,three,3,more\n4,"f,our",\n')
    good, broken = files.split_csv(spark, str(tmp_path / "a.csv"), ["code", "level"])
    assert sorted(tuple(r) for r in good.collect()) == [("1", "one", "1"), ("4", "f,our", None)]
    assert sorted(r.line for r in broken.collect()) == ["2,two", "3,three,3,more"]
    assert broken.count() == 2 and good.count() == 2
    with pytest.raises(ValueError, match="lacks columns"):
        files.split_csv(spark, str(tmp_path / "a.csv"), ["price"])


def test_json_lines_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, 'a"b\n')], "n int, t string")
    files.write_json(df, str(tmp_path / "j"))
    assert '"t":null' in "".join(p.read_text() for p in (tmp_path / "j").glob("part*"))
    assert sorted(tuple(r) for r in files.read_json_rows(spark, str(tmp_path / "j"), "n int, t string, u string").collect()) == [(1, None, None), (2, 'a"b\n', None)]


@pytest.mark.parametrize("name", ["margin_detail_sz", "margin_detail_sz_alt"])
def test_symbols_past_six_digits_follow_the_sql_of_their_query(spark, tmp_path, name):
    keys = [1, 999, 1000, 3001, 9999, 10_000, 29_999, 30_000, 30_001, 39_999, 40_000, 300_000, 400_000]
    made = [(100 + k % 13, k, "F", float(k) + 0.5, dt.datetime(1996, 3, 4), "1-URGENT") for k in keys]
    spark.createDataFrame(made, SCHEMAS["orders"]).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    cursor = con.execute(all_sql()[name])
    columns = [c[0] for c in cursor.description]
    expected = sorted(cursor.fetchall(), key=repr)
    assert sorted(map(tuple, all_queries()[name](spark, str(tmp_path)).select(*columns).collect()), key=repr) == expected
    assert "3000100" in {e[columns.index("symbol")] for e in expected} and len(expected) == 7


def test_six_digit_symbols_are_the_rule_of_the_operator(spark):
    sz = {c: ["1"] * 3 for c in events.SZ_DETAIL} | {"证券代码": ["300001", "3000001", "0000001"]}
    assert rows(events.margin_detail_sz(frame(spark, sz)).select("code")) == [("300001.SZ",)]


@pytest.mark.parametrize("name", ["report_file_scan", "day_file_scan", "report_file_ranges"])
def test_whole_files_pass_python_as_arrays_in_batches_of_some_megabytes(spark, name):
    def weigh(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["size"])

    plan = all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan  # records and fields never become Python objects
    wide = spark.range(0, 40, 1, 1).selectExpr("CAST(repeat('x', 1048576) AS BINARY) AS content")
    assert max(r.size for r in wide.mapInArrow(weigh, "size bigint").collect()) < 12 << 20


def test_packed_report_files_leave_a_worker_about_a_megabyte_at_a_time(spark, monkeypatch):
    caught = []
    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", lambda self, f, schema: caught.append(f))
    source_queries.report_files(Shapes(spark, "/root/testdata/sf0.001"))
    stocks = [{"code": f"{n:06d}", "fields": [float(n)] * 320} for n in range(200)]
    kind = pa.struct([("code", pa.string()), ("fields", pa.list_(pa.float32()))])
    batch = pa.RecordBatch.from_arrays([pa.array([f"/r/{n}/gpcw20240331.dat" for n in range(30)]), pa.array([stocks] * 30, pa.list_(kind))], ["path", "stocks"])
    out = list(caught[0](iter([batch])))
    assert pa.Table.from_batches(out).column("path").to_pylist() == batch.column("path").to_pylist()
    assert len({c for b in out for c in b.column("content").to_pylist()}) == 1 and len(out) > 1
    assert max(b.get_total_buffer_size() for b in out) < 2 << 20


def test_files_are_written_from_their_batch_without_copies(tmp_path):
    wide = pa.RecordBatch.from_arrays([pa.array([f"/a/{n}" for n in range(9)]), pa.array([bytes([n]) * (1 << 20) for n in range(7)] + [b"", None], pa.binary())], ["path", "content"])
    writer = records.FileWriter(str(tmp_path))
    tracemalloc.start()
    try:
        moved = writer.write(iter([wide]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    writer.commit([moved])
    assert [(tmp_path / "a" / str(n)).read_bytes() for n in range(9)] == [c or b"" for c in wide.column("content").to_pylist()]
    assert most < 1 << 20


def test_many_bar_files_of_one_batch_keep_their_records(spark):
    one = lambda n: b"".join(struct.pack("<IIIIIfII", 20240101 + i % 28, n, n, n, n, 1.0, n + i, 0) for i in range(n % 29)) + b"\x00" * (n % 32)
    made = spark.createDataFrame([(f"/b/sz{n:06d}.day", one(n)) for n in range(200)], "path string, content binary").coalesce(1)
    got = files.decode_day_files(made).groupBy("code").agg(F.count("*").alias("n"), F.sum("volume").alias("v"), F.max("open").alias("o"))
    assert rows(got, "code") == [(f"{n:06d}.SZ", n % 29, sum(n + i for i in range(n % 29)), n / 100) for n in range(200) if n % 29]
    ranged = files.decode_day_files(made, "2024-01-05", "2024-01-06")
    assert ranged.count() == sum(len([i for i in range(n % 29) if i in (4, 5)]) for n in range(200))
