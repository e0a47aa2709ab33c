"""File scans and sinks: parquet, CSV, JSON, fixed-record bar files, report files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import suffixed
from ..functions.dates import DateLike, as_date, between_days, compact_date
from ..schemas import TABLES

# Little-endian layout of a 32-byte bar record, prices in hundredths.
DAY_RECORD = np.dtype(
    [("date", "<u4"), ("open", "<u4"), ("high", "<u4"), ("low", "<u4"), ("close", "<u4"),
     ("amount", "<f4"), ("volume", "<u4"), ("reserved", "<u4")]
)
# Report file header, and its directory of (code, flag, data offset) entries.
REPORT_HEADER = np.dtype(
    [("kind", "<i2"), ("period", "<u4"), ("count", "<u2"), ("res1", "<u4"), ("report_size", "<u4"), ("res2", "<u4")]
)
REPORT_ENTRY = np.dtype([("code", "S6"), ("flag", "S1"), ("offset", "<u4")])

DAY_SCHEMA = "path string, day int, open double, high double, low double, close double, volume long, amount double"
REPORT_SCHEMA = "path string, code string, fields array<float>"
_STOCKS_PER_FRAME = 500
_BARS_PER_BATCH = 1 << 16


def read_table(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Parquet scan; with a table name the declared schema is applied instead of the file's."""
    reader = spark.read
    if table is not None:
        reader = reader.schema(TABLES[table].schema)
    return reader.parquet(path)


def scan_stats(df: DataFrame, day: str) -> DataFrame:
    """One row: row count and first and last day, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.min(day).alias("min_date"), F.max(day).alias("max_date")
    )


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")


#: A quote inside a quoted field is doubled, fields may hold line breaks, and an empty text is quoted while a NULL is not.
_CSV = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_BROKEN = "_broken"


def read_csv_text(spark: SparkSession, path: str, required: Sequence[str], lines: bool = False, empty_is_null: bool = True) -> DataFrame:
    """CSV with a header, every column as text, in header order; required columns are checked.

    ``lines`` allows line breaks inside quoted fields; such a file is one task. With
    ``empty_is_null=False`` a quoted empty field is an empty text and only a bare one NULL.
    """
    marks = {} if empty_is_null else {"nullValue": "\0"}  # what a bare empty field reads as, and no text holds
    df = spark.read.options(**{**_CSV, **marks}, multiLine=lines, inferSchema=False).csv(path)
    require_columns(df, required, path)
    return df.select(*[F.col(f"`{c}`").cast(T.StringType()) for c in df.columns])


def split_csv(spark: SparkSession, path: str, required: Sequence[str], lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines): a line whose number of fields is not the header's is kept apart, as it stands in the file."""
    columns = read_csv_text(spark, path, required, lines).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, _BROKEN)])
    read = spark.read.options(**_CSV, multiLine=lines, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, columnPruning=False).schema(schema).csv(path)
    read = read.where(F.length(F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))) >= 0)  # true, but Spark reads no mark of broken lines alone
    good = read.where(F.col(_BROKEN).isNull()).select(*[F.col(f"`{c}`") for c in columns])
    return good, read.where(F.col(_BROKEN).isNotNull()).select(F.col(_BROKEN).alias("line"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_csv_text(..., lines=True, empty_is_null=False)`` reads back as it was."""
    df.write.mode("overwrite").options(**{**_CSV, "emptyValue": '""'}).csv(path)


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a declared schema; a field that a line lacks is NULL."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def as_document(df: DataFrame, out: str = "document") -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(out))


def binary_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, content) of matching files, recursively. Files are spread over tasks by size."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "content")
    )


def decode_day_files(files: DataFrame, begin: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Bars of a closed date range from (path, content) rows of files named like ``sh600000.day``.

    Files are decoded as arrays and their bars handed on some ten thousand at a time; a trailing
    partial record is ignored. Records stand in the order of their dates, so the range is cut out by
    binary search before any row is built.
    """
    first, last = (None if d is None else int(as_date(d).strftime("%Y%m%d")) for d in (begin, end))

    def cut(content: pa.Buffer) -> np.ndarray:
        whole = len(content) // DAY_RECORD.itemsize
        records = np.frombuffer(content, dtype=DAY_RECORD, count=whole) if whole else np.zeros(0, DAY_RECORD)
        if whole and (np.diff(records["date"].astype("int64")) >= 0).all():
            start = 0 if first is None else np.searchsorted(records["date"], first, "left")
            stop = whole if last is None else np.searchsorted(records["date"], last, "right")
            records = records[start:stop]
        return records

    def bars(paths: pa.Array, held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        records = np.concatenate([r for _, r in held])
        path = paths.take(pa.array(np.repeat([at for at, _ in held], [len(r) for _, r in held])))
        prices = [pa.array(records[p] / 100.0) for p in ("open", "high", "low", "close")]
        return pa.RecordBatch.from_arrays(
            [path, pa.array(records["date"].astype("int32")), *prices, pa.array(records["volume"].astype("int64")), pa.array(records["amount"].astype("float64"))],
            ["path", "day", "open", "high", "low", "close", "volume", "amount"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows = [], 0
            for at, content in enumerate(batch.column("content")):
                records = cut(content.as_buffer())
                for piece in range(0, len(records), _BARS_PER_BATCH):
                    held.append((at, records[piece:piece + _BARS_PER_BATCH]))
                    rows += len(held[-1][1])
                    if rows >= _BARS_PER_BATCH:
                        yield bars(batch.column("path"), held)
                        held, rows = [], 0
            if held:
                yield bars(batch.column("path"), held)

    rows = files.select("path", "content").mapInArrow(decode, DAY_SCHEMA)
    market, symbol = file_security(F.col("path"))
    return rows.select(
        suffixed(symbol, market).alias("code"), compact_date(F.col("day").cast("string")).alias("date"),
        "open", "high", "low", "close", "volume", "amount",
    )


def file_security(path: Column) -> tuple[Column, Column]:
    """(exchange, symbol) from a bar file name."""
    pattern = r"([a-z]{2})(\d+)\.day$"
    return F.upper(F.regexp_extract(path, pattern, 1)), F.regexp_extract(path, pattern, 2)


def read_day_files(spark: SparkSession, folder: str, begin: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Bars of a closed date range from a folder of bar files."""
    return decode_day_files(binary_files(spark, folder, "*.day"), begin, end).where(between_days(F.col("date"), begin, end))


def decode_report_files(files: DataFrame) -> DataFrame:
    """(report_date, code, fields) from (path, content) rows of offset-indexed report files.

    ``fields[n]`` (1-based) is numbered field n. A file that is too short for what its header
    promises is skipped. A big file is emitted in slices of a few hundred securities.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                content = content.as_buffer()
                try:
                    header = np.frombuffer(content, dtype=REPORT_HEADER, count=1)[0]
                    entries = np.frombuffer(
                        content, dtype=REPORT_ENTRY, count=int(header["count"]), offset=REPORT_HEADER.itemsize
                    )
                    width = int(header["report_size"]) // 4
                    blocks = [np.frombuffer(content, dtype="<f4", count=width, offset=int(o)) for o in entries["offset"]]
                except ValueError:
                    continue
                codes = [c.decode("utf-8") for c in entries["code"]]
                for at in range(0, len(codes), _STOCKS_PER_FRAME):
                    upto = at + _STOCKS_PER_FRAME
                    own = blocks[at:upto]
                    bounds = pa.array(np.arange(len(own) + 1, dtype=np.int32) * width)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path.as_py()] * len(own), pa.string()), pa.array(codes[at:upto], pa.string()),
                         pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(own)))],
                        ["path", "code", "fields"])

    rows = files.select("path", "content").mapInArrow(decode, REPORT_SCHEMA)
    return rows.select(report_period(F.col("path")).alias("report_date"), "code", "fields")


def unreadable_report_files(files: DataFrame) -> DataFrame:
    """(path, report_date, reason) of the report files that ``decode_report_files`` has to skip."""

    def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(p, _report_problem(c)) for p, c in zip(batch["path"], batch["content"])]
            yield pd.DataFrame([f for f in found if f[1]], columns=["path", "reason"], dtype="object")

    rows = files.select("path", "content").mapInPandas(inspect, "path string, reason string")
    return rows.select("path", report_period(F.col("path")).alias("report_date"), "reason")


def _report_problem(content: bytes) -> str | None:
    if len(content) < REPORT_HEADER.itemsize:
        return "no header"
    header = np.frombuffer(content, dtype=REPORT_HEADER, count=1)[0]
    table = REPORT_HEADER.itemsize + int(header["count"]) * REPORT_ENTRY.itemsize
    if len(content) < table:
        return "shorter than its list of securities"
    offsets = np.frombuffer(content, dtype=REPORT_ENTRY, count=int(header["count"]), offset=REPORT_HEADER.itemsize)["offset"]
    size = int(header["report_size"]) // 4 * 4
    if len(offsets) and int(offsets.max()) + size > len(content):
        return "shorter than its reports"
    return None


def report_period(path: Column) -> Column:
    """Report period from a file name such as ``gpcw20240331.dat``; NULL when it has none."""
    return compact_date(F.nullif(F.regexp_extract(path, r"gpcw(\d{8})\.[A-Za-z]{3}$", 1), F.lit("")))


def read_report_files(
    spark: SparkSession, folder: str, begin: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Reports of a closed range of periods; files of other years are not even listed."""
    pattern = "gpcw*.dat"
    if begin is not None and end is not None:
        years = range(as_date(begin).year, as_date(end).year + 1)
        pattern = "gpcw{" + ",".join(str(y) for y in years) + "}*.dat"
    files = binary_files(spark, folder, pattern)
    wanted = files.where(
        report_period(F.col("path")).isNotNull() & between_days(report_period(F.col("path")), begin, end)
    )
    return decode_report_files(wanted)


def list_periods(names: DataFrame, name: str, begin: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Distinct report periods among file names, ascending, within a closed range."""
    periods = names.select(report_period(F.col(name)).alias("report_date")).where(F.col("report_date").isNotNull())
    return periods.where(between_days(F.col("report_date"), begin, end)).distinct().orderBy("report_date")


def recent_periods(names: DataFrame, name: str, count: int) -> DataFrame:
    """Names of the latest ``count`` report periods; unparsable names always stay.

    A non-positive count keeps everything. Only the top periods are gathered, as a limit.
    """
    if count <= 0:
        return names
    tagged = names.withColumn("_period", report_period(F.col(name)))
    newest = (
        tagged.select("_period").where(F.col("_period").isNotNull()).distinct()
        .orderBy(F.col("_period").desc()).limit(count)
    )
    dated = tagged.join(F.broadcast(newest), "_period", "left_semi")
    return dated.unionByName(tagged.where(F.col("_period").isNull())).drop("_period")
