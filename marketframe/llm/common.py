"""Small helpers that several text operators share."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    A local session without one gets a temporary folder; a cluster without one is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder: lineage ends there and lost executors cost nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def digest60(value: Column) -> Column:
    """The first 60 bits of the MD5 of a string, as a long that is never negative."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def own_columns(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of the input has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def rows_before(partition: list, order: list) -> Window:
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts have about size bytes; a longer text is a piece of its own."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_pylist()
    start = base = 0
    for i, end in enumerate(ends):
        if end - base > size and i > start:
            yield batch.slice(start, i - start)
            start, base = i, ends[i - 1]
    if len(ends) > start:
        yield batch.slice(start)
