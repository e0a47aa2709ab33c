"""Repeated passages by a hash join at minimisers, in place of a sorted suffix array.

Only suffixes at minimiser positions are kept: of every 20 consecutive 5-word grams the one with
the smallest hash. A passage of 50 words or more selects the same positions wherever it stands,
the first of them within its first 20 words, so copies of a passage meet as suffixes that agree in 31
words at least.

No suffix order is built and no neighbours are compared:

1. Suffixes are grouped by the hash of their first 31 words; groups from one document only are gone.
2. Equal hashes of the 69 words from 19 before the suffix to 50 after its start settle all
   passages that select this suffix.
3. What is left, ends of passages and chance matches, is settled by further hashes: every 50-word
   passage that selects the suffix is compared by its own hash.

Groups shrink to two ids each before they move and then meet rows in joins that Spark can split, so a passage that
millions of documents share is nowhere gathered. Equality is that of 64-bit hashes of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged
from .jaccard import BROADCAST_ROWS, WIDTH, _FACTORS, _mixed, word_hashes

LENGTH, SPAN = 50, 20
KEY = LENGTH - SPAN + 1
_CHUNK_BYTES = 8 << 20
_NO_ID = -(1 << 63)


def _grams(hashes: np.ndarray) -> np.ndarray:
    last = max(len(hashes) - WIDTH + 1, 0)
    out = np.zeros(last, np.uint64)
    for j in range(WIDTH):
        out += hashes[j:j + last] * _FACTORS[j]
    return _mixed(out)


def stretch_hashes(grams: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of length words from each start, out of the hashes of the 5-word grams that cover them."""
    steps = [*range(0, length - WIDTH + 1, WIDTH)]
    if steps[-1] != length - WIDTH:
        steps.append(length - WIDTH)
    out = np.full(len(starts), length, np.uint64)
    for step in steps:
        out = _mixed(out ^ grams[starts + step])
    return out.view(np.int64)


def minimisers(grams: np.ndarray) -> np.ndarray:
    """For each gram that starts a full window the place of the window's smallest gram, the first of equals."""
    if len(grams) < SPAN:
        return np.zeros(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(grams, SPAN).argmin(axis=1) + np.arange(len(grams) - SPAN + 1)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """Row, number of words and gram hashes of texts with LENGTH words or more."""
    row = 0
    for part in slices(batch, "text", _CHUNK_BYTES):
        hashes, bounds = word_hashes([t or "" for t in part.column("text").to_pylist()])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= LENGTH:
                yield row, b - a, _grams(hashes[a:b])
            row += 1


def _suffix_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc").to_numpy()
        parts: list[tuple] = [(np.zeros(0, np.int64),) * 4 + (np.zeros(0, bool),)]
        for row, words, grams in _texts(batch):
            at = np.unique(minimisers(grams))
            at = at[at + KEY <= words]
            inside = (at >= SPAN - 1) & (at + LENGTH <= words)
            whole = np.zeros(len(at), np.int64)
            whole[inside] = stretch_hashes(grams, at[inside] - (SPAN - 1), LENGTH + SPAN - 1)
            parts.append((np.full(len(at), ids[row]), at, stretch_hashes(grams, at, KEY), whole, ~inside))
        doc, at, key, whole, outside = map(np.concatenate, zip(*parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(at.astype(np.int32)), pa.array(key), pa.array(whole, mask=outside)], ["doc", "at", "key", "whole"])


def _passage_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, wanted = batch.column("doc").to_numpy(), batch.column("places").to_pylist()
        parts: list[tuple] = [(np.zeros(0, np.int64),) * 3]
        for row, words, grams in _texts(batch):
            starts = np.arange(words - LENGTH + 1)
            starts = starts[np.isin(minimisers(grams)[:len(starts)], wanted[row])]
            parts.append((np.full(len(starts), ids[row]), starts, stretch_hashes(grams, starts, LENGTH)))
        doc, at, passage = map(np.concatenate, zip(*parts))
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(at.astype(np.int32)), pa.array(passage)], ["doc", "at", "passage"])


def _across(rows: DataFrame, key: str) -> DataFrame:
    """The values of key that two documents or more have, with the smallest of these."""
    ends = rows.groupBy(key).agg(F.min("doc").alias("earliest"), F.max("doc").alias("latest"))
    return ends.filter("earliest <> latest").drop("latest")


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping or touching spans of a document as one; a document has no more spans than words."""
    order = Window.partitionBy("doc").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.when(reach >= F.col("start"), 0).otherwise(1))
    numbered = opened.withColumn("nth", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("earliest").alias("earliest"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, n_words, earliest_doc: the parts of documents that repeat elsewhere.

    A part is the union of touching 50-word passages that at least one other doc_id has too; words
    stand between ASCII white space, A-Z count as a-z, numbers start at 0 and the end is exclusive.
    earliest_doc is the smallest doc_id that shares a passage of it: a part whose earliest_doc is
    not its own doc_id is a copy. Null, empty and short texts have no part; rows that repeat a
    doc_id are one document; null ids count as one document with the smallest id; an empty table
    gives none. Other columns are not read.
    """
    doc: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc")
    rows = docs.select(doc, "text")
    suffixes = staged(rows.mapInArrow(_suffix_batches, "doc bigint, at int, key bigint, whole bigint"), "suffixes")
    matched = staged(suffixes.join(_across(suffixes, "key").drop("earliest"), "key"), "matched-suffixes")
    extended = staged(matched.join(_across(matched.filter("whole IS NOT NULL"), "whole"), "whole", "left"), "extended-suffixes")
    open_keys = extended.filter("earliest IS NULL").select("key").distinct()
    places = staged(extended.join(open_keys, "key").groupBy("doc").agg(F.collect_set("at").alias("places")), "open-suffixes")
    if places.count() <= BROADCAST_ROWS // 10:
        places = F.broadcast(places)
    passages = staged(rows.join(places, "doc").mapInArrow(_passage_batches, "doc bigint, at int, passage bigint"), "passages")
    long = extended.filter("earliest IS NOT NULL").select(
        "doc", (F.col("at") - (SPAN - 1)).alias("start"), (F.col("at") + LENGTH).alias("end"), "earliest")
    exact = passages.join(_across(passages, "passage"), "passage").select("doc", F.col("at").alias("start"), (F.col("at") + LENGTH).alias("end"), "earliest")
    parts = _merged(long.union(exact))

    def named(c: str) -> Column:
        return F.when(F.col(c) != _NO_ID, F.col(c))

    return parts.select(
        named("doc").alias("doc_id"), F.col("start").cast("long").alias("start_word"), F.col("end").cast("long").alias("end_word"),
        (F.col("end") - F.col("start")).cast("long").alias("n_words"), named("earliest").alias("earliest_doc"))
