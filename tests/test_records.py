"""Record files by range: what is read, what is left out, and what two-phase writes leave behind."""

import datetime as dt
import os

import numpy as np
import pytest

from marketframe.sources import files, records
from marketframe.sources.files import DAY_RECORD, REPORT_ENTRY, REPORT_HEADER
from tests.conftest import day, rows

FIRST = dt.date(1991, 1, 2)


def bar_file(days, torn=b""):
    packed = np.zeros(len(days), DAY_RECORD)
    packed["date"] = [records.number_of(d) for d in days]
    packed["close"], packed["volume"], packed["amount"] = np.arange(len(days)) + 100, 7, 1.5
    return packed.tobytes() + torn


def report_file(codes, width=3, torn=False):
    start = REPORT_HEADER.itemsize + REPORT_ENTRY.itemsize * len(codes)
    header = np.zeros(1, REPORT_HEADER)
    header["count"], header["report_size"] = len(codes), 4 * width
    entries = np.zeros(len(codes), REPORT_ENTRY)
    entries["code"] = [c.encode() for c in codes]
    entries["offset"] = start + 4 * width * np.arange(len(codes))
    blocks = (np.arange(len(codes) * width) + 1).astype("<f4").tobytes()
    return header.tobytes() + entries.tobytes() + (blocks[:-4] if torn else blocks)


@pytest.fixture
def folder(tmp_path):
    def put(name, content):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
        return str(tmp_path / "in")

    return put


def long_days(n=40_000):
    return [FIRST + dt.timedelta(days=i) for i in range(n)]


def test_ranges_of_bars_equal_the_whole_file_decode(spark, folder):
    path = folder("sh/sh600000.day", bar_file(long_days(3000), b"\x01\x02"))
    folder("sz/sz000001.day", bar_file(long_days(10)))
    folder("sz/sz000002.day", b"")
    folder("sz/readme.txt", b"not bars")
    whole = rows(files.read_day_files(spark, path), "code", "date")
    for begin, end in ((None, None), ("1995-02-28", "1995-03-01"), (None, "1991-01-04"), ("1999-03-20", None), ("2030-01-01", "2030-01-02"), ("1995-01-02", "1995-01-01")):
        first, last = day(begin or "0001-01-01"), day(end or "9999-12-31")
        for split in (32, 1000, 1 << 20):
            reader = records.DayFileReader({"path": path, "splitBytes": split})
            reader.pushFilters([records.GreaterThan(("date",), first - dt.timedelta(days=1))] if begin else [])
            reader.pushFilters([records.LessThan(("date",), last + dt.timedelta(days=1))] if end else [])
            found = [tuple(r.values()) for s in reader.partitions() for b in reader.read(s) for r in b.to_pylist()]
            assert sorted(found) == [r for r in whole if first <= r[1] <= last]
    found = rows(records.day_records(spark, path, "1991-01-04", "1991-01-06", codes="000001.SZ,999999.SH", split_bytes=100), "date")
    assert found == [r for r in whole if r[0] == "000001.SZ" and day("1991-01-04") <= r[1] <= day("1991-01-06")]
    assert records.day_records(spark, path, codes=["1.SH"]).count() == 0


class Counted(records.RangeFile):
    total = calls = 0

    def read(self, offset, size):
        Counted.total += size
        Counted.calls += 1
        return super().read(offset, size)


def test_one_day_of_a_long_file_reads_a_few_records(folder, monkeypatch):
    path = folder("sh600000.day", bar_file(long_days()))
    monkeypatch.setattr(records, "RangeFile", Counted)
    reader = records.DayFileReader({"path": path, "splitBytes": "320000"})
    one = dt.date(2001, 5, 5)
    rest = reader.pushFilters([records.GreaterThanOrEqual(("date",), one), records.LessThanOrEqual(("date",), one), records.LessThan(("close",), 3.0)])
    assert [type(f).__name__ for f in rest] == ["LessThan"]
    splits = reader.partitions()
    Counted.total = Counted.calls = 0
    found = [b.to_pylist() for s in splits for b in reader.read(s)]
    assert len(splits) == 4 and [r["date"] for f in found for r in f] == [one]
    assert Counted.total < 1000 < 40_000 * 32  # of 1,280,000 bytes
    assert list(reader.read(None)) == []


def test_numbers_that_are_no_dates(spark, folder):
    packed = np.zeros(5, DAY_RECORD)
    packed["date"] = [19910102, 19910229, 19910301, 19911301, 19920229]
    path = folder("sh600000.day", packed.tobytes())
    reader = records.DayFileReader({"path": path})
    assert [d for s in reader.partitions() for b in reader.read(s) for d in b.column("date").to_pylist()] == [
        day("1991-01-02"), None, day("1991-03-01"), None, day("1992-02-29")]
    assert [r[0] for r in rows(records.day_records(spark, path, "1991-01-01", "1999-01-01").select("date"), "date")] == [day("1991-01-02"), day("1991-03-01"), day("1992-02-29")]


def test_splits_cut_large_files_and_gather_small_ones():
    splits = records.dealt([("a", 10), ("b", 10), ("c", 100), ("d", 0), ("e", 30)], 40)
    assert [[(s.path, s.index, s.parts) for s in split.slices] for split in splits] == [
        [("a", 0, 1), ("b", 0, 1)], [("c", 0, 3)], [("c", 1, 3)], [("c", 2, 3), ("d", 0, 1)], [("e", 0, 1)]]
    assert records.dealt([], 40) == []
    covered = sorted(r for s in [x for split in splits for x in split.slices if x.path == "c"] for r in range(*s.records(7)))
    assert covered == list(range(7))


def test_reports_by_period_and_code(spark, folder, monkeypatch):
    codes = [f"{i:06d}" for i in range(50)]
    path = folder("a/gpcw20240331.dat", report_file(codes))
    folder("a/gpcw20240630.dat", report_file(codes[:3], width=5))
    folder("b/gpcw20240331.dat", report_file(["900001"]))
    folder("a/gpcw20230331.dat", report_file(codes, torn=True))
    folder("a/gpcw20230630.dat", b"short")
    folder("a/gpcw20230930.dat", report_file(codes)[:40])
    folder("a/gpcwnodate.dat", report_file(["1"]))
    whole = files.decode_report_files(files.binary_files(spark, path, "gpcw*.dat")).where("report_date IS NOT NULL")
    for split in (100, 1 << 20):
        reader = records.ReportFileReader({"path": path, "splitBytes": split})
        found = [(r["report_date"], r["code"], r["fields"]) for s in reader.partitions() for b in reader.read(s) for r in b.to_pylist() if r["report_date"]]
        assert sorted(found) == sorted(tuple(r) for r in whole.collect())
    found = rows(records.report_records(spark, path, "2024-03-31", "2024-03-31", codes="000007,900001"), "code")
    assert [(r[1], list(r[2])) for r in found] == [("000007", [22.0, 23.0, 24.0]), ("900001", [1.0, 2.0, 3.0])]
    checks = records.report_checks(spark, path).collect()
    assert len(checks) == 7
    assert sorted(r.reason for r in checks if r.reason) == ["no header", "shorter than its list of securities", "shorter than its reports"]
    monkeypatch.setattr(records, "RangeFile", Counted)
    reader = records.ReportFileReader({"path": path})
    assert not list(reader.pushFilters([records.EqualTo(("report_date",), day("2024-03-31")), records.In(("code",), ("000049",))]))
    Counted.calls = 0
    assert sum(b.num_rows for s in reader.partitions() for b in reader.read(s)) == 1 and Counted.calls == 5  # two headers, two lists, one block


def test_landing_replaces_periods_and_keeps_bad_files_apart(spark, folder, tmp_path):
    path = folder("gpcw20240331.dat", report_file(["000001", "000002"]))
    folder("x/gpcw20240331.dat", b"short")
    folder("gpcw20240630.dat", report_file(["000001"]))
    out, checks = str(tmp_path / "reports"), str(tmp_path / "checks")
    records.land_reports(spark, path, out, checks)
    assert records.landed_reports(spark, out).count() == 3
    assert [(r[1], r[2]) for r in rows(records.rejected_reports(spark, checks))] == [(day("2024-03-31"), "no header")]
    folder("x/gpcw20240331.dat", report_file(["000003"]))
    os.remove(f"{path}/gpcw20240630.dat")
    records.land_reports(spark, path, out, checks)
    assert [r[:2] for r in rows(records.landed_reports(spark, out).select("report_date", "code"), "report_date", "code")] == [
        (day("2024-03-31"), "000001"), (day("2024-03-31"), "000002"), (day("2024-03-31"), "000003"), (day("2024-06-30"), "000001")]
    assert rows(records.rejected_reports(spark, checks)) == []
    one = records.landed_reports(spark, out, "2024-06-01", "2024-06-30")
    assert "PartitionFilters: [isnotnull(report_date" in one._jdf.queryExecution().executedPlan().toString()
    assert [r[1] for r in rows(one)] == ["000001"]
    periods = spark.createDataFrame([(day("2024-06-30"), "wanted")], "report_date date, mark string").where("mark = 'wanted'")
    latest = records.reports_of(spark, out, periods)
    assert "dynamicpruning" in latest._jdf.queryExecution().executedPlan().toString()
    assert [r[1] for r in rows(latest)] == ["000001"]


def test_files_appear_together_or_not_at_all(spark, tmp_path):
    out = str(tmp_path / "out")
    good = spark.createDataFrame([("a/1.day", b"x"), ("b/2.day", None)], "path string, content binary")
    records.write_files(good, f"file:{out}")
    assert sorted(os.listdir(out)) == ["a", "b"] and open(f"{out}/a/1.day", "rb").read() == b"x" and os.path.getsize(f"{out}/b/2.day") == 0
    for bad in ([("c/1.day", b"1"), ("c/1.day", b"2")], [("c/1.day", b"1"), ("../2.day", b"2")]):
        with pytest.raises(Exception):
            records.write_files(spark.createDataFrame(bad, "path string, content binary"), out)
        assert sorted(os.listdir(out)) == ["a", "b"]
