"""Import of an export into stores by month: everything is staged and checked before any store changes.

A store is a folder of parquet partitioned by ``month``. The first phase writes what the touched
months of every table become to a staging folder and counts it. Only when all tables hold does the second phase
overwrite these months, table by table. It can be repeated: staged months replace stored
ones, so a run that was stopped in between is completed by ``publish``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import merge_keyed
from ..schemas import TABLES
from ..session import fresh_path
from .transfer import IMPORT_RULES, exported, import_batch

MONTH_FOLDER = "month"


class PublicationError(RuntimeError):
    """What was staged is not what the batch and the store add up to; no store was changed."""


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_store(df: DataFrame, path: str, day: str) -> None:
    """Replace the months that ``df`` has rows for; all others stay. Rows are spread by month, large months over several tasks."""
    rows = df.withColumn(MONTH_FOLDER, month_of(day)).hint("rebalance", F.col(MONTH_FOLDER))
    rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(MONTH_FOLDER).parquet(path)


def read_store(spark: SparkSession, path: str, table: str, months: list[str | None] | None = None) -> DataFrame:
    """A stored table, or only its named months (None: rows without a day). Other months' folders are not read."""
    schema = TABLES[table].schema
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH_FOLDER, T.StringType())])).parquet(path)
    if months is not None:
        named = F.col(MONTH_FOLDER).isin([m for m in months if m is not None])
        rows = rows.where(named | F.col(MONTH_FOLDER).isNull() if None in months else named)
    return rows.select(*schema.names)


def months_in(batch: DataFrame, day: str) -> list[str | None]:
    """Distinct months of a batch, about 1,200 a century; None stands for rows without a day."""
    return [r[0] for r in batch.select(month_of(day)).distinct().collect()]


@dataclass(frozen=True)
class Staged:
    """One table's part of an import, ready to be published."""

    table: str
    source_rows: int
    folder: str
    months: tuple[str | None, ...]


def stage_import(spark: SparkSession, source: str, stores: dict[str, str], staging: str) -> list[Staged]:
    """Merge each exported file into the touched months of its store, below ``staging``, and check the counts.

    Tables without a file are left out. A file that does not fit or a count that does not add up
    raises before any store is changed.
    """
    out = []
    for table, path in stores.items():
        batch, declared = import_batch(spark, source, table), TABLES[table]
        if batch is None:
            continue
        keys, day = list(declared.keys), declared.day
        months = months_in(batch, day)
        target, folder = read_store(spark, path, table, months), f"{staging}/{table}"
        merged = merge_keyed(target, batch, keys, IMPORT_RULES[table], defaults=declared.defaults)
        source_rows = exported(spark, source, table).count()
        if months:
            write_store(merged, folder, day)
            held, fresh = target.count(), batch.join(target.select(*keys), keys, "left_anti").count()
            staged = read_store(spark, folder, table).count()
            if staged != held + fresh:
                raise PublicationError(f"{table}: {staged} rows staged, but {held} are stored and {fresh} are new")
        out.append(Staged(table, source_rows, folder, tuple(months)))
    return out


def publish(spark: SparkSession, staged: list[Staged], stores: dict[str, str]) -> None:
    """Overwrite the staged months of every store. Safe to repeat."""
    for part in staged:
        if part.months:
            write_store(read_store(spark, part.folder, part.table), stores[part.table], TABLES[part.table].day)


def row_count(spark: SparkSession, path: str, table: str) -> int:
    """Rows of a whole store: no column is read, only file footers."""
    return read_store(spark, path, table).count()


def import_store(
    spark: SparkSession, source: str, stores: dict[str, str], dry_run: bool = False, staging: str | None = None
) -> dict[str, dict[str, int]]:
    """Import every exported file into its store: {table: rows in the file, and of the whole table before and after}.

    ``dry_run`` only counts the files (before and after are 0) and writes nothing.
    """
    if dry_run:
        counts = {table: exported(spark, source, table) for table in stores}
        return {table: {"src": rows.count(), "before": 0, "after": 0} for table, rows in counts.items() if rows is not None}
    staged = stage_import(spark, source, stores, staging or fresh_path(spark, "import"))
    before = {part.table: row_count(spark, stores[part.table], part.table) for part in staged}
    publish(spark, staged, stores)
    return {
        part.table: {"src": part.source_rows, "before": before[part.table], "after": row_count(spark, stores[part.table], part.table)}
        for part in staged
    }
