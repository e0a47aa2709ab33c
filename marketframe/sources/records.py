"""Bar and report files as Spark data sources that read ranges of records instead of whole files.

Files are listed on the driver and dealt out as splits of a bounded number of bytes, aligned to
records. A filter on the security or the report period leaves out files by their names; one on
the day is answered inside a split by binary search over its records, so a short range of a long
file costs a few small reads. Stores are opened with ``pyarrow.fs`` (local disks, HDFS, S3, GCS);
for any other store ``files.read_day_files`` and ``files.read_report_files`` load whole files through Spark.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ..functions.codes import in_codes
from ..functions.dates import DateLike, between_days
from .files import DAY_RECORD, REPORT_ENTRY, REPORT_HEADER

DAY_COLUMNS = "code string, date date, open double, high double, low double, close double, volume bigint, amount double"
REPORT_COLUMNS = "report_date date, code string, fields array<float>"
CHECK_COLUMNS = "path string, report_date date, reason string"
_DAY_NAME = re.compile(r"([a-z]{2})(\d+)\.day$")
_REPORT_NAME = re.compile(r"gpcw(\d{8})\.[A-Za-z]{3}$")
_SPLIT_BYTES = 32 << 20
_ROWS_PER_BATCH = 1 << 16
_READ_BYTES = 8 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside it; a bare path and ``file:`` in any spelling are local."""
    local = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(local) if "://" in local else (fs.LocalFileSystem(), local)


class RangeFile:
    """One open file that is read by position."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)

    def __enter__(self) -> RangeFile:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def read(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)


@dataclass(frozen=True)
class Slice:
    """Part ``index`` of ``parts`` of one file."""

    path: str
    size: int
    index: int
    parts: int

    def records(self, total: int) -> tuple[int, int]:
        return total * self.index // self.parts, total * (self.index + 1) // self.parts


@dataclass
class Split(InputPartition):
    slices: list[Slice]

    def __post_init__(self) -> None:
        super().__init__(None)


def dealt(files: Iterable[tuple[str, int]], split_bytes: int) -> list[Split]:
    """Files as splits of about ``split_bytes``: large ones cut, small ones together."""
    splits: list[Split] = []
    held: list[Slice] = []
    weight = 0
    for path, size in files:
        parts = max(1, -(-size // split_bytes))
        for index in range(parts):
            if held and weight + size // parts > split_bytes:
                splits.append(Split(held))
                held, weight = [], 0
            held.append(Slice(path, size, index, parts))
            weight += size // parts
    return splits + [Split(held)] if held else splits


@dataclass
class Wanted:
    """What the pushed filters leave: a closed range of days and, if named, the codes."""

    day_column: str
    first: dt.date = dt.date.min
    last: dt.date = dt.date.max
    codes: set[str] | None = None
    ranged: bool = False

    def take(self, wanted: Filter) -> bool:
        """Whether the filter is answered here in full."""
        column, value = getattr(wanted, "attribute", None), getattr(wanted, "value", None)
        if column == ("code",) and isinstance(wanted, EqualTo | In):
            named = {value} if isinstance(wanted, EqualTo) else set(value)
            self.codes = named if self.codes is None else self.codes & named
            return True
        if column != (self.day_column,) or not isinstance(value, dt.date) or not isinstance(wanted, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
            return False
        one = dt.timedelta(days=1)
        if isinstance(wanted, GreaterThan) and value == dt.date.max or isinstance(wanted, LessThan) and value == dt.date.min:
            return False
        if isinstance(wanted, EqualTo | GreaterThan | GreaterThanOrEqual):
            self.first = max(self.first, value + one if isinstance(wanted, GreaterThan) else value)
        if isinstance(wanted, EqualTo | LessThan | LessThanOrEqual):
            self.last = min(self.last, value - one if isinstance(wanted, LessThan) else value)
        self.ranged = True
        return True

    def has_code(self, code: str) -> bool:
        return self.codes is None or code in self.codes

    def has_day(self, day: dt.date | None) -> bool:
        return not self.ranged or day is not None and self.first <= day <= self.last


def number_of(day: dt.date) -> int:
    return day.year * 10_000 + day.month * 100 + day.day


def days_of(numbers: np.ndarray) -> pa.Array:
    """Dates from numbers such as 20240105; NULL where a number is no date."""
    years, months, days = numbers // 10_000, numbers // 100 % 100, numbers % 100
    fits = (years >= 1) & (years <= 9999) & (months >= 1) & (months <= 12) & (days >= 1)
    month = ((np.where(fits, years, 1970) - 1970) * 12 + np.where(fits, months, 1) - 1).astype("datetime64[M]")
    fits &= days <= ((month + 1).astype("datetime64[D]") - month.astype("datetime64[D]")).astype(np.int64)
    day = month.astype("datetime64[D]").astype(np.int64) + np.where(fits, days, 1) - 1
    return pa.array(day.astype(np.int32), pa.int32(), mask=~fits).cast(pa.date32())


class _FileReader(DataSourceReader):
    """Lists the files that names and filters leave, and deals them out."""

    day_column = "date"

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.split_bytes = int(options.get("splitBytes", _SPLIT_BYTES))
        self.wanted = Wanted(self.day_column)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if not self.wanted.take(f)]

    def listed(self) -> Iterator[tuple[str, int]]:
        store, root = opened(self.folder)
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            if info.is_file and self.is_wanted(info.path):
                yield info.path, info.size

    def is_wanted(self, path: str) -> bool:
        raise NotImplementedError

    def partitions(self) -> Sequence[InputPartition]:
        return dealt(self.listed(), self.split_bytes)

    def file(self, path: str) -> RangeFile:
        return RangeFile(opened(self.folder)[0], path)

    def read(self, split: Split | None) -> Iterator[pa.RecordBatch]:
        for piece in split.slices if split else ():
            yield from self.rows(piece)

    def rows(self, piece: Slice) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


class DayFileReader(_FileReader):
    """Bars of files named like ``sh600000.day``: fixed records in ascending order of their days."""

    def is_wanted(self, path: str) -> bool:
        return bool(_DAY_NAME.search(path)) and self.wanted.has_code(self.code(path))

    @staticmethod
    def code(path: str) -> str:
        market, symbol = _DAY_NAME.search(path).groups()
        return f"{symbol}.{market.upper()}"

    @staticmethod
    def place(file: RangeFile, low: int, high: int, day: int) -> int:
        """The first record of low..high whose day is not before ``day``."""
        while low < high:
            middle = (low + high) // 2
            if int.from_bytes(file.read(middle * DAY_RECORD.itemsize, 4), "little") < day:
                low = middle + 1
            else:
                high = middle
        return low

    def rows(self, piece: Slice) -> Iterator[pa.RecordBatch]:
        low, high = piece.records(piece.size // DAY_RECORD.itemsize)  # a torn record at the end is left out
        with self.file(piece.path) as file:
            if self.wanted.ranged:
                if self.wanted.first > self.wanted.last:
                    return
                low = self.place(file, low, high, number_of(self.wanted.first))
                high = self.place(file, low, high, number_of(self.wanted.last) + 1)
            code = self.code(piece.path)
            for at in range(low, high, _ROWS_PER_BATCH):
                records = np.frombuffer(file.read(at * DAY_RECORD.itemsize, min(_ROWS_PER_BATCH, high - at) * DAY_RECORD.itemsize), DAY_RECORD)
                days = days_of(records["date"].astype(np.int64))
                prices = [pa.array(records[p] / 100.0) for p in ("open", "high", "low", "close")]
                batch = pa.RecordBatch.from_arrays(
                    [pa.array([code] * len(records), pa.string()), days, *prices, pa.array(records["volume"].astype(np.int64)), pa.array(records["amount"].astype(np.float64))],
                    ["code", "date", "open", "high", "low", "close", "volume", "amount"])
                yield batch.filter(days.is_valid()) if self.wanted.ranged else batch


def report_day(path: str) -> dt.date | None:
    """Report period in a file name such as ``gpcw20240331.dat``."""
    named = _REPORT_NAME.search(path)
    return days_of(np.array([int(named[1])], np.int64))[0].as_py() if named else None


class ReportFileReader(_FileReader):
    """Reports of offset-indexed files: the list of securities first, then only the blocks asked for."""

    day_column = "report_date"

    def is_wanted(self, path: str) -> bool:
        return bool(re.search(r"gpcw[^/]*\.dat$", path)) and self.wanted.has_day(report_day(path))

    @staticmethod
    def index(file: RangeFile, size: int) -> tuple[np.ndarray, int, str | None]:
        """(entries, bytes of a report, what is wrong with the file)."""
        none = np.zeros(0, REPORT_ENTRY)
        if size < REPORT_HEADER.itemsize:
            return none, 0, "no header"
        header = np.frombuffer(file.read(0, REPORT_HEADER.itemsize), REPORT_HEADER)[0]
        count, width = int(header["count"]), int(header["report_size"]) // 4 * 4
        if size < REPORT_HEADER.itemsize + count * REPORT_ENTRY.itemsize:
            return none, width, "shorter than its list of securities"
        entries = np.frombuffer(file.read(REPORT_HEADER.itemsize, count * REPORT_ENTRY.itemsize), REPORT_ENTRY)
        if count and int(entries["offset"].max()) + width > size:
            return none, width, "shorter than its reports"
        return entries, width, None

    def rows(self, piece: Slice) -> Iterator[pa.RecordBatch]:
        with self.file(piece.path) as file:
            entries, width, problem = self.index(file, piece.size)
            if problem:
                return
            low, high = piece.records(len(entries))
            entries = entries[low:high]
            codes = [c.decode("utf-8") for c in entries["code"]]
            if self.wanted.codes is not None:
                kept = [i for i, c in enumerate(codes) if c in self.wanted.codes]
                entries, codes = entries[kept], [codes[i] for i in kept]
            day, most, at = report_day(piece.path), max(1, _READ_BYTES // max(1, width)), 0
            while at < len(entries):
                end = at + 1  # blocks that stand side by side are read at once
                while end < min(len(entries), at + most) and int(entries["offset"][end]) == int(entries["offset"][end - 1]) + width:
                    end += 1
                values = np.frombuffer(file.read(int(entries["offset"][at]), (end - at) * width), "<f4")
                bounds = np.arange(end - at + 1, dtype=np.int32) * (width // 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([day] * (end - at), pa.date32()), pa.array(codes[at:end], pa.string()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))],
                    ["report_date", "code", "fields"])
                at = end


class ReportCheckReader(ReportFileReader):
    """One row per report file, with what keeps it from being read, if anything does."""

    def rows(self, piece: Slice) -> Iterator[pa.RecordBatch]:
        if piece.index:
            return
        with self.file(piece.path) as file:
            problem = self.index(file, piece.size)[2]
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece.path]), pa.array([report_day(piece.path)], pa.date32()), pa.array([problem], pa.string())], ["path", "report_date", "reason"])


class _Source(DataSource):
    columns, kind = "", _FileReader

    def schema(self) -> str:
        return self.columns

    def reader(self, schema: StructType) -> DataSourceReader:
        return self.kind(self.options)


class DayFiles(_Source):
    columns, kind = DAY_COLUMNS, DayFileReader

    @classmethod
    def name(cls) -> str:
        return "day_files"


class ReportFiles(_Source):
    columns, kind = REPORT_COLUMNS, ReportFileReader

    @classmethod
    def name(cls) -> str:
        return "report_files"


class ReportChecks(_Source):
    columns, kind = CHECK_COLUMNS, ReportCheckReader

    @classmethod
    def name(cls) -> str:
        return "report_checks"


@dataclass
class Moved(WriterCommitMessage):
    """Files of one task: where they lie until the commit, and where they belong."""

    files: list[tuple[str, str]]


class FileWriter(DataSourceArrowWriter):
    """Writes (path, content) rows as files. They appear under their names only when every task is done."""

    def __init__(self, folder: str):
        self.folder, self.staging = folder.rstrip("/"), f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Moved:
        store, root = opened(self.folder)
        written = []
        for batch in iterator:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):  # contents are written as they lie in the batch
                inside = path.strip("/")
                if not inside or ".." in inside.split("/"):
                    raise ValueError(f"not a path inside the folder: {path!r}")
                held = f"{root}/{self.staging}/{uuid.uuid4().hex}"
                store.create_dir(f"{root}/{self.staging}", recursive=True)
                with store.open_output_stream(held) as out:
                    out.write(content.as_buffer() or b"")
                written.append((held, f"{root}/{inside}"))
        return Moved(written)

    def commit(self, messages: list[Moved | None]) -> None:
        store, root = opened(self.folder)
        files = [f for m in messages if m for f in m.files]
        if len({to for _, to in files}) < len(files):
            self._clear(store, root)
            raise ValueError("two rows name one file")
        for parent in sorted({to.rpartition("/")[0] for _, to in files}):
            store.create_dir(parent, recursive=True)
        for held, to in files:
            store.move(held, to)
        self._clear(store, root)

    def abort(self, messages: list[Moved | None]) -> None:
        self._clear(*opened(self.folder))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        """Removes this write's own staging folder and nothing else."""
        if store.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.staging}")


class FileBytes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_bytes"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"])


def register(spark: SparkSession) -> SparkSession:
    """Makes the sources known to a session and lets Spark hand them its filters."""
    for source in (DayFiles, ReportFiles, ReportChecks, FileBytes):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def write_files(files: DataFrame, folder: str) -> None:
    """Write (path, content) rows below a folder; a file of the same name is replaced at the end, all together."""
    register(files.sparkSession)
    files.select("path", "content").write.format("file_bytes").mode("append").save(folder)


def day_records(
    spark: SparkSession, folder: str, begin: DateLike | None = None, end: DateLike | None = None, codes: str | Iterable[str] | None = None,
    split_bytes: int = _SPLIT_BYTES,
) -> DataFrame:
    """Bars of a closed range of days and of the named securities, from the records inside the range alone."""
    rows = register(spark).read.format("day_files").option("splitBytes", split_bytes).load(folder)
    return rows.where(between_days(F.col("date"), begin, end) & in_codes(F.col("code"), codes))


def report_records(
    spark: SparkSession, folder: str, begin: DateLike | None = None, end: DateLike | None = None, codes: str | Iterable[str] | None = None,
    split_bytes: int = _SPLIT_BYTES,
) -> DataFrame:
    """Reports (report_date, code, fields) of a closed range of periods; only files of these periods are opened.

    Files without a period in their name belong to no period; a file that is shorter than it promises is left out
    and named by ``report_checks``.
    """
    rows = register(spark).read.format("report_files").option("splitBytes", split_bytes).load(folder)
    return rows.where(F.col("report_date").isNotNull() & between_days(F.col("report_date"), begin, end) & in_codes(F.col("code"), codes))


def report_checks(spark: SparkSession, folder: str) -> DataFrame:
    """(path, report_date, reason) of every report file; a file with a reason is left out by ``report_records``."""
    return register(spark).read.format("report_checks").load(folder)


def land_reports(
    spark: SparkSession, folder: str, out: str, checks: str, begin: DateLike | None = None, end: DateLike | None = None
) -> None:
    """Reports as parquet by period, and per period what became of its files.

    Periods with a readable file in the folder are replaced, whole; all others stay as they are. The
    checks of a period are replaced with it, so a file that was delivered anew leaves the rejects.
    """
    inside = F.col("report_date").isNotNull() & between_days(F.col("report_date"), begin, end)
    for rows, path in ((report_records(spark, folder, begin, end), out), (report_checks(spark, folder).where(inside), checks)):
        rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("report_date").parquet(path)


def _landed(spark: SparkSession, path: str, columns: str) -> DataFrame:
    names = StructType.fromDDL(columns).names
    return spark.read.schema(columns).parquet(path).select(*names)


def landed_reports(spark: SparkSession, out: str, begin: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Landed reports of a closed range of periods; the folders of other periods are not read."""
    return _landed(spark, out, REPORT_COLUMNS).where(between_days(F.col("report_date"), begin, end))


def reports_of(spark: SparkSession, out: str, periods: DataFrame) -> DataFrame:
    """Landed reports of the periods in a table (report_date), one row per period; they prune folders while the query runs."""
    return _landed(spark, out, REPORT_COLUMNS).join(F.broadcast(periods.select("report_date").distinct()), "report_date", "left_semi")


def rejected_reports(spark: SparkSession, checks: str) -> DataFrame:
    """(path, report_date, reason) of the files that were kept apart."""
    return _landed(spark, checks, CHECK_COLUMNS).where(F.col("reason").isNotNull())
