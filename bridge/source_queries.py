"""Scan, file-format, period-selection and export queries."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.plans import publish, transfer
from marketframe.schemas import TABLES
from marketframe.session import fresh_path
from marketframe.sources import files, records, statistics
from marketframe.sources.files import DAY_RECORD, REPORT_ENTRY, REPORT_HEADER

from .clean_queries import REPORTS, report_raw
from .daily_queries import dense_table
from .registry import query
from .shapes import NOW, OLD, Shapes

OLD_TS, NEW_TS = f"TIMESTAMP '{OLD}'", f"TIMESTAMP '{NOW}'"
_BYTES_PER_FRAME = 1 << 20


@query("SELECT count(*) AS row_count, min(l_shipdate) AS min_date, max(l_shipdate) AS max_date FROM lineitem")
def scan_stats(s: Shapes) -> DataFrame:
    return files.scan_stats(s.table("lineitem"), "l_shipdate")


@query("SELECT strftime(date, '%Y-%m') AS month, count(*) AS row_count, min(date) AS min_date, max(date) AS max_date FROM bars GROUP BY ALL")
def footer_stats(s: Shapes) -> DataFrame:
    """Counts and day spans of a stored table by month, from file footers."""
    folder, schema = fresh_path(s.spark, "stats"), TABLES["stock_daily"].schema
    publish.write_store(s.bars().select(*schema.names), folder, "date")
    return statistics.footer_stats_by(s.spark, folder, schema, "date", publish.MONTH_FOLDER)


@query("SELECT DISTINCT exchange FROM master")
def distinct_exchanges(s: Shapes) -> DataFrame:
    return s.master().select("exchange").distinct()


@query("""SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","gap":' ||
  CASE WHEN o_custkey % 2 = 0 THEN o_custkey::varchar ELSE 'null' END || '}' AS document FROM orders""")
def json_documents(s: Shapes) -> DataFrame:
    return files.as_document(s.table("orders").selectExpr("o_orderkey", "o_orderstatus", "CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS gap"))


NAMES = """
names AS (
  SELECT 'gpcw' || strftime(q, '%Y%m%d') || '.dat' AS name, q::date AS period FROM (
    SELECT DISTINCT last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS q FROM orders)
  UNION ALL SELECT DISTINCT 'gpcw-' || o_orderpriority || '.dat', NULL::date FROM orders)"""


def report_names(s: Shapes) -> DataFrame:
    orders = s.table("orders")
    dated = orders.selectExpr("last_day(add_months(date_trunc('quarter', o_orderdate), 2)) AS q").distinct()
    return dated.selectExpr("concat('gpcw', date_format(q, 'yyyyMMdd'), '.dat') AS name").unionByName(
        orders.selectExpr("concat('gpcw-', o_orderpriority, '.dat') AS name").distinct()
    )


@query(f"WITH {NAMES} SELECT name FROM names WHERE period IS NULL OR period IN (SELECT DISTINCT period FROM names WHERE period IS NOT NULL ORDER BY period DESC LIMIT 8)")
def recent_periods(s: Shapes) -> DataFrame:
    return files.recent_periods(report_names(s), "name", 8)


@query(f"WITH {NAMES} SELECT DISTINCT period AS report_date FROM names WHERE period BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'")
def period_list(s: Shapes) -> DataFrame:
    return files.list_periods(report_names(s), "name", "1996-01-01", "1999-12-31")


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Where the lists of a column begin and end among its elements, and the elements: arrays as they lie, no Python objects."""
    ends = column.offsets.to_numpy().astype(np.int64)
    return ends - ends[0], column.flatten()


def _frames(paths: pa.Array, contents: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    """(path, content) rows about a megabyte at a time: packed files leave a worker before the next ones are packed."""
    start, held, weight = 0, [], 0
    for at, content in enumerate(contents, 1):
        held.append(content)
        weight += len(content)
        if weight >= _BYTES_PER_FRAME or at == len(paths):
            yield pa.RecordBatch.from_arrays([paths[start:at], pa.array(held, pa.binary())], ["path", "content"])
            start, held, weight = at, [], 0


def day_files(s: Shapes) -> DataFrame:
    """One fixed-record file per security and year; at most one record per day of the year."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, structs = _lists(batch.column("records"))
            packed = np.zeros(len(structs), dtype=DAY_RECORD)
            for field in ("date", "open", "high", "low", "close", "volume", "amount"):
                packed[field] = structs.field(field).to_numpy(zero_copy_only=False)
            yield from _frames(batch.column("path"), (packed[s:e].tobytes() + b"\x00\x01" for s, e in zip(bounds[:-1], bounds[1:])))  # a torn record at the end

    cents = ", ".join(f"CAST(round({p} * 100) AS BIGINT) AS {p}" for p in ("open", "high", "low", "close"))
    grouped = s.bars().selectExpr(
        "concat('/bars/', year(date), '/', lower(substring(code, -2)), substring_index(code, '.', 1), '.day') AS path",
        f"struct(CAST(date_format(date, 'yyyyMMdd') AS BIGINT) AS date, {cents}, volume, CAST(amount AS FLOAT) AS amount) AS record",
    ).groupBy("path").agg(F.sort_array(F.collect_list("record")).alias("records"))
    return grouped.mapInArrow(encode, "path string, content binary")


@query("SELECT code, date, open, high, low, close, volume, amount::float::double AS amount FROM bars")
def day_file_scan(s: Shapes) -> DataFrame:
    return files.decode_day_files(day_files(s))


def report_files(s: Shapes) -> DataFrame:
    """Report files per period and block of 200 suppliers, so that no file grows with the data."""

    def contents(batch: pa.RecordBatch) -> Iterator[bytes]:
        bounds, structs = _lists(batch.column("stocks"))
        starts, values = _lists(structs.field("fields"))
        codes, values = np.array(structs.field("code").to_pylist(), "S"), values.to_numpy(zero_copy_only=False)
        for first, last in zip(bounds[:-1], bounds[1:]):
            stocks = first + np.argsort(codes[first:last], kind="stable")
            width = int(starts[stocks[0] + 1] - starts[stocks[0]])  # a period has one layout
            start = REPORT_HEADER.itemsize + REPORT_ENTRY.itemsize * len(stocks)
            header = np.zeros(1, dtype=REPORT_HEADER)
            header["count"], header["report_size"] = len(stocks), 4 * width
            entries = np.zeros(len(stocks), dtype=REPORT_ENTRY)
            entries["code"], entries["offset"] = codes[stocks], start + 4 * width * np.arange(len(stocks))
            blocks = values[starts[stocks][:, None] + np.arange(width)].astype("<f4", copy=False)
            yield header.tobytes() + entries.tobytes() + blocks.tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _frames(batch.column("path"), contents(batch))

    grouped = report_raw(s).selectExpr(
        "concat('/reports/', CAST(code AS BIGINT) div 200, '/gpcw', date_format(report_date, 'yyyyMMdd'), '.dat') AS path",
        "struct(code, fields) AS stock",
    ).groupBy("path").agg(F.collect_list("stock").alias("stocks"))
    return grouped.mapInArrow(encode, "path string, content binary")


@query(f"""
SELECT report_date, lpad(l_suppkey::varchar, CAST(greatest(6, length(l_suppkey::varchar)) AS INT), '0') AS code, w AS field_count,
       CASE WHEN (l_suppkey + 1) % 29 = 0 THEN NULL ELSE (l_suppkey + month(report_date)) % 1000 / 8 END AS first_field,
       CASE WHEN (l_suppkey + w) % 29 = 0 THEN NULL ELSE (l_suppkey * w + month(report_date)) % 1000 / 8 END AS last_field
FROM (SELECT *, CASE WHEN year(report_date) < 1998 THEN 120 ELSE 320 END AS w FROM {REPORTS})""")
def report_file_scan(s: Shapes) -> DataFrame:
    rows = files.decode_report_files(report_files(s))
    return rows.selectExpr(
        "report_date", "code", "size(fields) AS field_count", "CAST(nullif(fields[0], CAST('NaN' AS FLOAT)) AS DOUBLE) AS first_field",
        "CAST(nullif(element_at(fields, -1), CAST('NaN' AS FLOAT)) AS DOUBLE) AS last_field",
    )


FEW_DAYS = "date BETWEEN DATE '2024-01-09' AND DATE '2024-01-11'"


@query(f"SELECT code, date, open, high, low, close, volume, amount::float::double AS amount FROM bars WHERE {FEW_DAYS} AND code NOT LIKE '%.BJ'")
def day_file_ranges(s: Shapes) -> DataFrame:
    """A few days of bar files in the shared folder, read by binary search over their records."""
    folder = fresh_path(s.spark, "bars")
    records.write_files(day_files(s), folder)
    return records.day_records(s.spark, folder, "2024-01-09", "2024-01-11").where("code NOT LIKE '%.BJ'")


_REPORT_SAMPLE = (
    "report_date", "code", "size(fields) AS field_count", "CAST(nullif(fields[0], CAST('NaN' AS FLOAT)) AS DOUBLE) AS first_field",
    "CAST(nullif(element_at(fields, -1), CAST('NaN' AS FLOAT)) AS DOUBLE) AS last_field",
)
_REPORT_SAMPLE_SQL = f"""
SELECT report_date, lpad(l_suppkey::varchar, CAST(greatest(6, length(l_suppkey::varchar)) AS INT), '0') AS code, w AS field_count,
       CASE WHEN (l_suppkey + 1) % 29 = 0 THEN NULL ELSE (l_suppkey + month(report_date)) % 1000 / 8 END AS first_field,
       CASE WHEN (l_suppkey + w) % 29 = 0 THEN NULL ELSE (l_suppkey * w + month(report_date)) % 1000 / 8 END AS last_field
FROM (SELECT *, CASE WHEN year(report_date) < 1998 THEN 120 ELSE 320 END AS w FROM {REPORTS})"""


@query(f"{_REPORT_SAMPLE_SQL} WHERE report_date BETWEEN DATE '1997-03-01' AND DATE '1998-12-31'")
def report_file_ranges(s: Shapes) -> DataFrame:
    """Two years of report files in the shared folder; files of other periods are not opened."""
    folder = fresh_path(s.spark, "reports")
    records.write_files(report_files(s), folder)
    return records.report_records(s.spark, folder, "1997-03-01", "1998-12-31").selectExpr(*_REPORT_SAMPLE)


@query(f"{_REPORT_SAMPLE_SQL} WHERE report_date IN (SELECT DISTINCT report_date FROM {REPORTS} ORDER BY report_date DESC LIMIT 4)")
def landed_report_scan(s: Shapes) -> DataFrame:
    """Report files landed by period, then the latest four periods by dynamic partition pruning."""
    folder, out = fresh_path(s.spark, "reports"), fresh_path(s.spark, "landed")
    torn = s.table("region").selectExpr("concat('/torn/', r_regionkey, '/gpcw19970101.dat') AS path", "CAST('torn' AS BINARY) AS content")
    records.write_files(report_files(s).unionByName(torn), folder)
    records.land_reports(s.spark, folder, f"{out}/reports", f"{out}/checks")
    periods = records.landed_reports(s.spark, f"{out}/reports").select("report_date").distinct()
    return records.reports_of(s.spark, f"{out}/reports", periods.orderBy(F.desc("report_date")).limit(4)).selectExpr(*_REPORT_SAMPLE)


@query("SELECT '/torn/' || r_regionkey || '/gpcw19970101.dat' AS file, DATE '1997-01-01' AS report_date, 'no header' AS reason FROM region")
def rejected_report_files(s: Shapes) -> DataFrame:
    """Files too short to be read, kept apart by period while the others land."""
    folder, out = fresh_path(s.spark, "reports"), fresh_path(s.spark, "landed")
    torn = s.table("region").selectExpr("concat('/torn/', r_regionkey, '/gpcw19970101.dat') AS path", "CAST('torn' AS BINARY) AS content")
    records.write_files(report_files(s).unionByName(torn), folder)
    records.land_reports(s.spark, folder, f"{out}/reports", f"{out}/checks")
    return records.rejected_reports(s.spark, f"{out}/checks").selectExpr("substring(path, instr(path, '/torn/')) AS file", "report_date", "reason")


@query("""
SELECT code, date, open, high, low, close, pre_close, tradestatus, volume, amount FROM bars
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND code IN (SELECT code FROM master WHERE board <> 'INDEX')""")
def export_shares(s: Shapes) -> DataFrame:
    spec = transfer.specs_for(["import_daily"])["stock_daily"]
    return transfer.export_rows(s.bars(), spec, s.master(), "2024-01-05", "2024-01-25")


@query("""
SELECT code, date, open, high, low, close, pre_close, tradestatus, volume, amount FROM bars
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND code IN (SELECT code FROM master WHERE board = 'INDEX')""")
def export_indexes(s: Shapes) -> DataFrame:
    spec = transfer.specs_for(["fetch_index"])["stock_daily"]
    return transfer.export_rows(s.bars(), spec, s.master(), "2024-01-05", "2024-01-25")


@query("SELECT code, trade_date, turnover_rate, pe, pb, is_st FROM basic WHERE trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'")
def export_indicators(s: Shapes) -> DataFrame:
    spec = transfer.specs_for(["all"])["daily_basic"]
    return transfer.export_rows(s.basic(), spec, s.master(), "2024-01-05", "2024-01-25")


@query(f"""
SELECT code, trade_date, fore_factor, back_factor, adjust_factor, {OLD_TS} AS created_at, CASE WHEN code LIKE '%.BJ' THEN {NEW_TS} ELSE {OLD_TS} END AS updated_at
FROM dense WHERE trade_date BETWEEN DATE '2024-01-20' AND DATE '2024-01-25' OR code LIKE '%.BJ'""")
def export_corrected(s: Shapes) -> DataFrame:
    """Factors of a few days plus everything corrected since, whatever its day."""
    stored = dense_table(s).selectExpr(
        "*", f"TIMESTAMP_NTZ '{OLD}' AS created_at", f"CASE WHEN code LIKE '%.BJ' THEN TIMESTAMP_NTZ '{NOW}' ELSE TIMESTAMP_NTZ '{OLD}' END AS updated_at"
    )
    spec = transfer.specs_for(["adjust"])["adj_factor"]
    return transfer.export_rows(stored, spec, s.master(), "2024-01-20", "2024-01-25", updated_since="2024-01-01")


@query("""
SELECT code, date, open, high, low, close, pre_close, tradestatus, volume, amount FROM bars
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND code IN (SELECT code FROM master WHERE board <> 'INDEX')""")
def export_written(s: Shapes) -> DataFrame:
    """The written export of one program, read back from the shared folder."""
    out = fresh_path(s.spark, "export")
    spec = {"stock_daily": transfer.specs_for(["import_daily"])["stock_daily"]}
    transfer.export_tables({"stock_daily": s.bars()}, s.master(), spec, "2024-01-05", "2024-01-25", out)
    return transfer.exported(s.spark, out, "stock_daily")


CSV_KEY = "CAST(o_orderkey AS VARCHAR) AS o_orderkey"
CSV_NOTE = """CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE o_orderpriority || ', "' || o_orderstatus || '"' || chr(10) || 'line two' END AS note"""


@query(f"SELECT {CSV_KEY}, {CSV_NOTE} FROM orders")
def csv_written(s: Shapes) -> DataFrame:
    """Texts with quotes, commas and line breaks, empty ones and NULLs, written as CSV and read back."""
    path = fresh_path(s.spark, "csv")
    files.write_csv(s.table("orders").selectExpr(CSV_KEY.replace("VARCHAR", "STRING"), CSV_NOTE), path)
    return files.read_csv_text(s.spark, path, ["o_orderkey", "note"], lines=True, empty_is_null=False)


LINES = "CASE WHEN p_size % 7 = 0 THEN p_partkey || ',' || p_brand || ',' || p_type || ',surplus' WHEN p_size % 7 = 1 THEN p_partkey || ',' || p_brand ELSE p_partkey || ',' || p_brand || ',' || p_type END AS line"


def _csv_lines(s: Shapes) -> str:
    """Lines of three fields, and broken ones of two and of four, below one header per file."""
    path = fresh_path(s.spark, "lines")
    s.table("part").selectExpr(LINES).mapInPandas(_headed, "value string").write.text(path)
    return path


def _headed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for number, batch in enumerate(batches):
        head = ["p_partkey,p_brand,p_type"] if number == 0 else []
        yield pd.DataFrame({"value": head + batch["line"].tolist()})


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, p_type FROM part WHERE p_size % 7 > 1")
def csv_whole_lines(s: Shapes) -> DataFrame:
    return files.split_csv(s.spark, _csv_lines(s), ["p_partkey", "p_type"])[0]


@query(f"SELECT {LINES} FROM part WHERE p_size % 7 <= 1")
def csv_broken_lines(s: Shapes) -> DataFrame:
    return files.split_csv(s.spark, _csv_lines(s), ["p_partkey", "p_type"])[1]


@query("SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN o_totalprice END AS price, o_orderstatus || '\"' || chr(10) AS mark FROM orders")
def json_written(s: Shapes) -> DataFrame:
    path = fresh_path(s.spark, "json")
    rows = s.table("orders").selectExpr("o_orderkey", "CASE WHEN o_custkey % 2 = 0 THEN o_totalprice END AS price", "o_orderstatus || '\"' || chr(10) AS mark")
    files.write_json(rows, path)
    return files.read_json_rows(s.spark, path, "o_orderkey bigint, price double, mark string")


BARS_STORED = "code, date, open + 1 AS open, high, low, close, pre_close, tradestatus, volume, amount"
BASIC_STORED = "code, trade_date, turnover_rate, coalesce(pe, 0) + 1 AS pe, CASE WHEN day(trade_date) % 2 = 0 THEN pb END AS pb, is_st, limit_up, is_limit_up"
MOVED_DAYS = "BETWEEN DATE '2024-01-09' AND DATE '2024-01-16'"


def imported_stores(s: Shapes) -> tuple[dict[str, str], dict[str, dict[str, int]]]:
    """An export of some days brought into stores that lack every third day: their folders and the counts."""
    folder = fresh_path(s.spark, "stores")
    absent = "dayofmonth({}) % 3 <> 0"
    stored = {"stock_daily": s.bars().where(absent.format("date")).selectExpr(*BARS_STORED.split(", ")),
              "daily_basic": s.basic().where(absent.format("trade_date")).withColumns({"pe": F.expr("coalesce(pe, 0) + 1"), "pb": F.expr("CASE WHEN day(trade_date) % 2 = 0 THEN pb END")})}
    stores = {name: f"{folder}/{name}" for name in stored}
    for name, rows in stored.items():
        publish.write_store(rows, stores[name], TABLES[name].day)
    specs = transfer.specs_for(["import_daily", "fetch_index"])
    transfer.export_tables({"stock_daily": s.bars(), "daily_basic": s.basic()}, s.master(), specs, "2024-01-09", "2024-01-16", f"{folder}/export")
    return stores, publish.import_store(s.spark, f"{folder}/export", stores)


@query(f"""
SELECT code, date, open, high, low, close, pre_close, tradestatus, volume, amount FROM bars WHERE date {MOVED_DAYS}
UNION ALL SELECT {BARS_STORED} FROM bars WHERE day(date) % 3 <> 0 AND NOT date {MOVED_DAYS}""")
def import_bars_store(s: Shapes) -> DataFrame:
    """A store after an import: exported days replaced or added, all others as they were."""
    stores, _ = imported_stores(s)
    return publish.read_store(s.spark, stores["stock_daily"], "stock_daily")


@query(f"""
WITH old AS (SELECT {BASIC_STORED} FROM basic WHERE day(trade_date) % 3 <> 0),
     moved AS (SELECT code, trade_date, turnover_rate, pe, pb, is_st FROM basic WHERE trade_date {MOVED_DAYS})
SELECT code, trade_date, coalesce(m.turnover_rate, o.turnover_rate) AS turnover_rate, coalesce(m.pe, o.pe) AS pe, coalesce(m.pb, o.pb) AS pb,
       coalesce(m.is_st, o.is_st) AS is_st, o.limit_up AS limit_up, CASE WHEN o.code IS NULL THEN 0 ELSE o.is_limit_up END AS is_limit_up
FROM old o FULL JOIN moved m USING (code, trade_date)""")
def import_indicators_store(s: Shapes) -> DataFrame:
    """Imported indicators: a NULL erases nothing, and columns the export does not carry stay."""
    stores, _ = imported_stores(s)
    rows = publish.read_store(s.spark, stores["daily_basic"], "daily_basic")
    return rows.select("code", "trade_date", "turnover_rate", "pe", "pb", "is_st", "limit_up", "is_limit_up")


def _counts(table: str, rows: str, day: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) FILTER ({day} {MOVED_DAYS}) AS src, count(*) FILTER (day({day}) % 3 <> 0) AS before,
               count(*) FILTER (day({day}) % 3 <> 0 OR {day} {MOVED_DAYS}) AS after FROM {rows}"""


@query(f"{_counts('stock_daily', 'bars', 'date')} UNION ALL {_counts('daily_basic', 'basic', 'trade_date')}")
def import_counts(s: Shapes) -> DataFrame:
    """Rows of each file, and of its whole table before and after the import."""
    _, counts = imported_stores(s)
    return s.spark.createDataFrame([(t, *c.values()) for t, c in counts.items()], "table_name string, src bigint, before bigint, after bigint")
