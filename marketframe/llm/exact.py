"""Exact dedup by skew-safe combining.

Copies meet in three steps, each of which groups by the digest and the full normalised text:
inside an input partition (the map side of the first aggregate), across partitions in salted digest
groups, and once more over the winners of the salts. After the first step a text has at most
one row per partition and salt, so a text that fills a third of the table moves no more rows than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, own_columns, staged


def content_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the normalised text (null counts as empty), its SHA-256 and a second, independent digest."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), lower_ascii(F.coalesce(F.col(text), F.lit(""))).alias("content"))
    return plain.withColumns({"sha": F.sha2("content", 256), "check": F.xxhash64("content")})


def content_groups(keys: DataFrame, salts: int = 4) -> DataFrame:
    """One row per distinct content: sha, check, keep_id (largest doc_id) and group_size."""
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    winners = salted.groupBy("sha", "salt", "check", "content").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    merged = winners.groupBy("sha", "check", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    return merged.drop("content")


def group_table(docs: DataFrame, salts: int = 4) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after lower-casing A-Z; null is the empty text. Of equal
    texts the largest doc_id stays; a null doc_id stays only where no other is left. Rows that
    repeat a doc_id within a group are each counted, and kept marks them alike. Only contents
    with two or more rows take part in the join back. An empty table gives an empty table.
    """
    keys = content_keys(docs)
    shared = staged(content_groups(keys, salts).filter("group_size > 1"), "exact-groups")
    rows = keys.select("doc_id", "sha", "check").join(shared, ["sha", "check"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = 4) -> DataFrame:
    """The rows of docs whose doc_id stays, with all their columns and no others.

    Rows that repeat the surviving doc_id of one text all stay; give such rows ids of their own first.
    """
    name, sha, check = own_columns(docs, "keep_id", "sha", "check")
    plain = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    groups = content_groups(content_keys(docs, doc_id, text), salts).filter("group_size > 1")
    dropped = groups.select(F.col("sha").alias(sha), F.col("check").alias(check), F.col("keep_id").alias(name))
    rows = docs.withColumns({sha: F.sha2(plain, 256), check: F.xxhash64(plain)}).join(dropped, [sha, check], "left")
    stays = F.col(name).isNull() | F.col(doc_id).eqNullSafe(F.col(name))
    return rows.filter(stays).select(*[F.col(f"`{c}`") for c in docs.columns])
