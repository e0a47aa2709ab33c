"""Sharding by sampled splitters: shards of near equal bytes that are ranges of one content order.

Native: DataFrame operations only. The order is (digest of the text, digest of the id), so
equal texts stand together and a hot text can still be split anywhere.
"""

from __future__ import annotations

import math
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, rows_before, staged

#: Cost of a row besides its text.
ROW_BYTES = 16
#: Samples drawn for each range, and the most ranges: both bound what the driver sees.
SAMPLES_PER_RANGE, MAX_RANGES = 24, 4096


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus the cost of a row; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with size and the key that orders it. Null texts and ids count as empty ones."""
    def digest(value: Column) -> Column:
        return F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 16)

    return docs.withColumns({
        "size": text_bytes(F.col(text)),
        "key": F.concat(digest(F.col(text)), digest(F.col(doc_id))),
    })


def _sample(rows: DataFrame, rate: float) -> list[tuple[str, float]]:
    """Keys drawn with a chance in proportion to size, with the bytes each one stands for.

    The draw hashes the keys, so a rerun draws the same rows.
    """
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(rate))
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30)) < chance
    return sorted(tuple(r) for r in rows.filter(drawn).select("key", F.col("size") / chance).collect())


def _quantiles(sample: list[tuple[str, float]], ranges: int) -> list[str]:
    total, seen, out = sum(w for _, w in sample), 0.0, []
    for key, w in sample:
        seen += w
        if seen * ranges >= total * (len(out) + 1) and len(out) < ranges - 1:
            out.append(key)
    return sorted(set(out))


def _range_of(splitters: list[str]) -> Column:
    """Number of splitters at or below the key: found among the blocks' first ones, then in one block."""
    def points(keys: list[str]) -> Column:
        return F.split(F.lit(",".join(keys)), ",")  # folded to a constant

    def below(keys: Column) -> Column:
        return F.size(F.filter(keys, lambda p: p <= F.col("key")))

    if not splitters:
        return F.lit(0)
    step = max(1, math.isqrt(len(splitters)))
    first = F.greatest(below(points(splitters[::step])) - 1, F.lit(0)) * step
    return (first + below(F.slice(points(splitters), first + 1, F.lit(step)))).cast("int")


def splitters_of(rows: DataFrame, n_shards: int, rounds: int = 2) -> list[str]:
    """Range boundaries from a size-weighted sample; ranges that turn out overfull are sampled anew.

    A range is overfull with over twice the mean bytes or rows. What reaches the driver is bounded
    by SAMPLES_PER_RANGE * MAX_RANGES keys and MAX_RANGES counts, whatever the size of the data.
    """
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    if not count:
        return []
    ranges = min(MAX_RANGES, max(8 * n_shards, math.ceil(total / (256 << 20))))
    splitters = _quantiles(_sample(rows, SAMPLES_PER_RANGE * ranges / total), ranges)
    for _ in range(rounds):
        parts = rows.groupBy(_range_of(splitters).alias("r")).agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()
        load = {p.r: max(p.n / count, p.b / total) * ranges for p in parts}
        overfull = {r: x for r, x in load.items() if x > 2}
        room = MAX_RANGES - len(splitters) - 1
        if not overfull or room <= 0:
            break
        wanted = sum(math.ceil(x) for x in overfull.values())
        pieces = {r: max(2, math.ceil(x * min(1.0, room / wanted))) for r, x in overfull.items()}
        held = sum(p.b for p in parts if p.r in overfull)
        again = rows.filter(_range_of(splitters).isin(*overfull))
        sample: dict[int, list] = {}
        for key in _sample(again, SAMPLES_PER_RANGE * sum(pieces.values()) / held):
            sample.setdefault(bisect_right(splitters, key[0]), []).append(key)
        new = sorted({*splitters, *(s for r, keys in sample.items() for s in _quantiles(keys, pieces[r]))})
        if new == splitters:
            break
        splitters = new
    return splitters


def placed(rows: DataFrame, n_shards: int, tie: list[str]) -> DataFrame:
    """rows (with size and key) and the columns shard and row_index.

    Ranges give every row its exact place in the order: totals of the ranges before it, and a
    running sum inside its range. The row whose middle byte lies in the i-th of n equal spans of
    the bytes goes to shard i, so two shards differ by less than two rows' bytes, and the result
    does not depend on the sample. tie orders rows with one key.
    """
    # Sampling reads keys several times; written once, no filter computes the digest of a text again.
    splitters = splitters_of(staged(rows.select("key", "size"), "shard-sizes"), n_shards)
    ranged = rows.withColumn("range", _range_of(splitters))
    totals = ranged.groupBy("range").agg(F.sum("size").alias("range_bytes"), F.count("*").alias("range_rows"))
    ahead = rows_before([], ["range"])  # one row per range, MAX_RANGES at most
    totals = totals.select(
        F.col("range"),
        F.coalesce(F.sum("range_bytes").over(ahead), F.lit(0)).alias("bytes_ahead"),
        F.coalesce(F.sum("range_rows").over(ahead), F.lit(0)).alias("rows_ahead"),
        F.sum("range_bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    order = ["key", *tie]
    inside = Window.partitionBy("range").orderBy(*order)
    before = F.coalesce(F.sum("size").over(rows_before(["range"], order)), F.lit(0))
    joined = ranged.withColumns({"in_range": before, "nth": F.row_number().over(inside)}).join(totals, "range")
    shard = F.least(F.expr("bigint((2 * (bytes_ahead + in_range) + size) * {} div (2 * all_bytes))".format(n_shards)), F.lit(n_shards - 1))
    return joined.withColumns({"shard": shard.cast("int"), "row_index": F.col("rows_ahead") + F.col("nth") - 1}).drop(
        "range", "bytes_ahead", "rows_ahead", "all_bytes", "in_range", "nth")


def with_slots(rows: DataFrame) -> DataFrame:
    """placed rows with slot: their number inside their shard, gapless from 0."""
    starts = rows.groupBy("shard").agg(F.min("row_index").alias("first_index"))
    return rows.join(starts, "shard").withColumn("slot", F.col("row_index") - F.col("first_index")).drop("row_index", "first_index")


def shard(docs: DataFrame, n_shards: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with a column shard (0 to n_shards - 1) of near equal bytes.

    All columns stay, also when their names clash with a helper's (the new column then gets a
    trailing underscore). Null texts weigh ROW_BYTES; rows that are the same in text and id may
    swap places, which changes no result; an empty table gives an empty table.
    """
    inner = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*inner)
    names = dict(zip(docs.columns, inner))
    rows = keyed(plain, names[text], names[doc_id])
    out = placed(rows, n_shards, [F.col(names[doc_id])]).select(*inner, "shard")
    return out.toDF(*docs.columns, own_columns(docs, "shard")[0])


def shard_table(docs: DataFrame, n_shards: int) -> DataFrame:
    """The assignment without texts: doc_id, size, text_crc32, shard, slot."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    narrow = staged(keyed(docs).select("doc_id", "size", crc, "key"), "shard-keys")
    rows = placed(narrow, n_shards, ["doc_id", "size", "text_crc32"]).drop("key")
    return with_slots(staged(rows, "shard-rows"))
