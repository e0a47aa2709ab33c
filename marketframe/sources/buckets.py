"""Stored tables bucketed by their keys, so that a merge moves the batch alone.

All rows of a key lie in one bucket, by the hash of the whole key: a code with a third of all rows is
spread as evenly as any other. A merge joins bucket with bucket; only the batch is shuffled, to the
buckets' number, and every task writes the bucket it has read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import dedup_by_values, merge_keyed
from ..schemas import TABLES


@dataclass(frozen=True)
class BucketedStore:
    """A table of ``schemas.TABLES`` as a catalog table over a folder of buckets."""

    table: str
    name: str
    path: str
    buckets: int

    @property
    def keys(self) -> tuple[str, ...]:
        return TABLES[self.table].keys

    def attach(self, spark: SparkSession) -> BucketedStore:
        """Make the folder known to a session that did not write it."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[self.table].schema)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{self.name}` ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def write(self, rows: DataFrame, placed: bool = False) -> BucketedStore:
        """Write all rows. ``placed`` says that every task has whole buckets already; else rows are shuffled to them."""
        first = rows if placed else rows.repartition(self.buckets, *self.keys)
        first.select(*TABLES[self.table].schema.names).write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option(
            "path", self.path).mode("overwrite").format("parquet").saveAsTable(self.name)
        return self

    def drop(self, spark: SparkSession) -> None:
        """Forget the name; the folder stays."""
        spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")


def merge_plan(spark: SparkSession, store: BucketedStore, batch: DataFrame, rules: dict[str, str], order: str | None = None, **options) -> DataFrame:
    """``merge_keyed`` of a batch, made unique on the keys first, without a shuffle of the store."""
    unique: DataFrame = dedup_by_values(batch, store.keys, order)
    return merge_keyed(store.read(spark), unique, store.keys, rules, **options)


def merge_bucketed(
    spark: SparkSession, store: BucketedStore, batch: DataFrame, rules: dict[str, str], into: tuple[str, str], order: str | None = None, **options
) -> BucketedStore:
    """Merge into a new store (name, path). The old one stays readable until the caller drops it."""
    name, path = into
    new = BucketedStore(store.table, name, path, store.buckets)
    return new.write(merge_plan(spark, store, batch, rules, order, **options), placed=True)


def bucket_count(rows: int, rows_per_bucket: int = 4_000_000, most: int = 16_384) -> int:
    """Buckets of a few hundred megabytes each."""
    return max(1, min(most, -(-rows // rows_per_bucket)))


def files_of(store: BucketedStore, spark: SparkSession) -> Sequence[str]:
    return store.read(spark).inputFiles()
