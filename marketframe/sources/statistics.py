"""Row counts and day spans of stored parquet from file footers: no row group is read.

Spark answers count, min and max from footers in its newer file reader; sessions use the older
one by default, so these scans choose it for themselves. Days must be dates: footers hold no usable bounds of other times.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OLD_READERS, _PUSHDOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _newer_reader(spark: SparkSession) -> Iterator[None]:
    kept = spark.conf.get(_OLD_READERS)
    spark.conf.set(_OLD_READERS, ",".join(name for name in kept.split(",") if name.strip() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(_OLD_READERS, kept)


def footer_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet scan whose plain counts, minima and maxima are taken from footers.

    ``schema`` has all columns of the files, in their order (Spark finds a column's bounds by its place), then those of the folders.
    """
    spark.conf.set(_PUSHDOWN, "true")
    with _newer_reader(spark):
        return spark.read.schema(schema).parquet(path)


def footer_stats_by(spark: SparkSession, path: str, schema: T.StructType, day: str, folder: str) -> DataFrame:
    """folder, row_count, min_date and max_date per folder of a store partitioned by a span of ``day``.

    Rows without a day lie in the folder without a name; there are no bounds to read there, only counts.
    """
    rows = footer_scan(spark, path, T.StructType([*schema.fields, T.StructField(folder, T.StringType())]))
    count = F.count(F.lit(1)).alias("row_count")
    dated = rows.where(F.col(folder).isNotNull()).groupBy(folder).agg(count, F.min(day).alias("min_date"), F.max(day).alias("max_date"))
    undated = rows.where(F.col(folder).isNull()).groupBy(folder).agg(count)
    return dated.unionByName(undated, allowMissingColumns=True)


def footer_stats(spark: SparkSession, path: str, schema: T.StructType, day: str, folder: str) -> DataFrame:
    """One row: row_count, min_date and max_date of a whole store, over one row per folder."""
    return footer_stats_by(spark, path, schema, day, folder).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))
