"""Hard negatives: near vectors of another label, but not nearer than a share of the positive's score.

Candidates are ordered by label and by their place along a Hilbert curve and written as Parquet
blocks, one row each, with the least and greatest value of every dimension (a zone map). Anchors
are grouped the same way. Interval arithmetic over a zone map bounds the scores that an anchor can reach in a
block, and only blocks whose bounds meet one of its windows are read and scored.

A search goes in two rounds. The first reads the few blocks with the highest bounds of each group
of anchors. What it finds raises the lower end of the windows, and the second round reads
the other blocks that still meet one. Nothing is left out: a block that is not read cannot hold a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .hilbert import hilbert_keys

DIMENSIONS, BITS = 4, 15
#: The grid of the curve spans this many standard deviations of a unit vector's random projection.
REACH = 4.0
#: Rows of a block, anchors of a group, zone maps of a page, and blocks a group reads in the first round.
BLOCK_ROWS, GROUP_ROWS, PAGE_ZONES, FIRST_BLOCKS = 2048, 512, 2048, 4
_NO_ID = np.iinfo(np.int64).max  # stands for a null id, and so comes last among ties
_MOST = np.iinfo(np.int64).max


class Numbers:
    """How vectors are stored and multiplied: the smallest types in which every result is exact."""

    def __init__(self, dimensions: int, largest: int):
        self.dimensions = dimensions
        self.stored = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
        bound = 2 * dimensions * largest * largest  # zone maps add two products
        self.exact = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object

    def matrix(self, data) -> np.ndarray:
        flat = np.frombuffer(data, self.stored)
        rows = flat.reshape(-1, self.dimensions) if self.dimensions else np.zeros((len(flat), 0), self.stored)
        return rows.astype(self.exact)

    def whole(self, scores: np.ndarray) -> np.ndarray:
        """Scores as longs; those beyond a long become its ends."""
        return (np.clip(scores, -_MOST, _MOST) if scores.dtype == object else scores).astype(np.int64)


def prepared(items: DataFrame, scale: int) -> DataFrame:
    """Rows that take part: id, label, is_anchor and vector in whole numbers, floor(scale * component)."""
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = items.select(
        F.col("id").cast("long"), F.col("label").cast("long"), F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"), F.col("vector").cast("array<double>"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & usable)
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x)))


def _with_place(numbers: Numbers):
    signs = np.random.default_rng(11).integers(0, 2, size=(numbers.dimensions, DIMENSIONS)) * 2.0 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            full = np.zeros((len(sizes), numbers.dimensions), np.int64)
            full[np.arange(numbers.dimensions) < sizes[:, None]] = flat  # shorter vectors end in zeros
            length = np.sqrt((full.astype(float) ** 2).sum(axis=1, keepdims=True))
            place = full / np.maximum(length, 1e-300) @ signs / REACH
            cells = np.minimum(np.floor((np.clip(place, -1, 1) + 1) * (1 << (BITS - 1))), (1 << BITS) - 1).astype(np.int64)
            data = [row.tobytes() for row in full.astype(numbers.stored)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("is_anchor"), pa.array(hilbert_keys(cells, BITS)), pa.array(data, pa.binary())],
                ["id", "label", "is_anchor", "place", "vector"])

    return run


def _pack(numbers: Numbers, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            nonlocal number
            ids, labels, data = (sum(x, []) for x in zip(*held))
            order = np.argsort(np.array(ids, np.int64), kind="stable")  # ties go by id
            matrix = np.frombuffer(b"".join(data), numbers.stored).reshape(len(ids), numbers.dimensions)[order]
            ids, labels = np.array(ids, np.int64)[order], np.array(labels, np.int64)[order]
            number += 1
            row = [number, len(ids), int(labels.min()), int(labels.max()), ids, labels, matrix.tobytes(), matrix.min(axis=0).tobytes(), matrix.max(axis=0).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["block", "n", "label_low", "label_high", "ids", "labels", "vectors", "low", "high"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - rows)
                ids = [_NO_ID if i is None else i for i in part.column("id").to_pylist()]
                held.append((ids, part.column("label").to_pylist(), part.column("vector").to_pylist()))
                at, rows = at + part.num_rows, rows + part.num_rows
                if rows == size:
                    yield block()
                    held, rows = [], 0
        if rows:
            yield block()

    return run


_BLOCK = "block bigint, n bigint, label_low bigint, label_high bigint, ids array<bigint>, labels array<bigint>, vectors binary, low binary, high binary"


def blocks_of(rows: DataFrame, numbers: Numbers, size: int, ranges: int | None = None) -> DataFrame:
    """Blocks of at most size rows (id, label, place, vector) along the curve, label by label, with their zone maps.

    Equal vectors of one label are ordered by a hash of id, so that a range boundary can fall between them.
    """
    order = ["label", "place", "tie"]
    keyed = rows.withColumn("tie", F.xxhash64("id"))
    ranged = keyed.repartitionByRange(ranges, *order) if ranges else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).select("id", "label", "vector").mapInArrow(_pack(numbers, size), _BLOCK)


def pages_of(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Zone maps in pages of about PAGE_ZONES, and the number of pages."""
    pages = -(-blocks.count() // PAGE_ZONES)
    zones = blocks.select("block", "label_low", "label_high", "low", "high")
    grouped = zones.groupBy(F.pmod(F.xxhash64("block"), F.lit(max(pages, 1))).cast("int").alias("page")).agg(F.collect_list(F.struct(*zones.columns)).alias("zones"))
    return staged(grouped, "zone-pages"), pages


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector inside each zone (interval arithmetic)."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _windows(asked: list) -> tuple[np.ndarray, ...]:
    return tuple(np.array([w[c] for w in asked], np.int64) for c in ("slot", "number", "low", "high"))


def _choose(numbers: Numbers, same: bool):
    """(group, block, bound) for zones that a window of the group meets; bound is the greatest score any anchor can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, float]] = []
            for row in batch.to_pylist():
                slot, _, low, high = _windows(row["windows"])
                labels = np.array(row["labels"], np.int64)[slot]
                zones = row["zones"]
                least, most = score_bounds(numbers.matrix(row["vectors"]), *(numbers.matrix(b"".join(z[c] for z in zones)) for c in ("low", "high")))
                first, last = (np.array([z[c] for z in zones], np.int64) for c in ("label_low", "label_high"))
                holds = (first <= labels[:, None]) & (labels[:, None] <= last)
                meets = (numbers.whole(most)[slot] >= low[:, None]) & (numbers.whole(least)[slot] <= high[:, None])
                meets &= holds if same else ~(holds & (first == last))
                reach = np.where(meets, most[slot].astype(float), -np.inf).max(axis=0, initial=-np.inf)
                out += [(row["group"], zones[z]["block"], reach[z]) for z in np.flatnonzero(meets.any(axis=0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else ((), (), ()), (pa.int64(), pa.int64(), pa.float64()))], ["group", "block", "bound"])

    return run


def _score(numbers: Numbers, same: bool, k: int):
    """(group, slot, number, id, score): the first k rows of a block in each window of a group."""

    def found(row: dict) -> list[tuple[int, ...]]:
        slot, number, low, high = _windows(row["windows"])
        anchor_ids, anchor_labels = (np.array(row[c], np.int64) for c in ("anchor_ids", "anchor_labels"))
        ids, labels = (np.array(row[c], np.int64) for c in ("ids", "labels"))
        scores = numbers.matrix(row["anchors"]) @ numbers.matrix(row["vectors"]).T
        floor, ceiling = np.full(len(anchor_ids), _MOST), np.full(len(anchor_ids), -_MOST)
        np.minimum.at(floor, slot, low)
        np.maximum.at(ceiling, slot, high)
        if scores.dtype != object:  # the ends as the scores' type; rounding may only widen them, and windows are cut exactly below
            floor, ceiling = (x.astype(np.float64) if scores.dtype != np.int64 else x for x in (floor, ceiling))
        kept = (scores >= floor[:, None]) & (scores <= ceiling[:, None])
        equal = anchor_labels[:, None] == labels
        kept &= equal & (anchor_ids[:, None] != ids) if same else ~equal
        at, column = np.nonzero(kept)
        score = numbers.whole(scores[at, column])
        order = np.lexsort((column, -score, at))  # columns ascend by id
        at, column, score = at[order], column[order], score[order]
        begin, end = np.searchsorted(at, slot), np.searchsorted(at, slot, side="right")
        out = []
        for s, w, lo, hi, b, e in zip(slot.tolist(), number.tolist(), low.tolist(), high.tolist(), begin.tolist(), end.tolist()):
            b += int(np.searchsorted(-score[b:e], -hi))
            for i in range(b, min(e, b + k)):
                if score[i] < lo:
                    break
                out.append((row["group"], s, w, int(ids[column[i]]), int(score[i])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out = found(batch.slice(i, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else ((),) * 5)], ["group", "slot", "number", "id", "score"])

    return run


class Searcher:
    """Candidate blocks and anchor groups of one table, written once, and searches over them."""

    def __init__(self, items: DataFrame, scale: int, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS):
        whole = prepared(items, scale)
        largest = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
        d, q = whole.agg(F.max(F.size("vector")), F.max(largest)).first()
        self.numbers = Numbers(d or 0, q or 0)
        rows = staged(whole.mapInArrow(_with_place(self.numbers), "id bigint, label bigint, is_anchor boolean, place bigint, vector binary"), "vectors")
        self.blocks = staged(blocks_of(rows, self.numbers, block_rows), "vector-blocks")
        anchors = rows.filter("is_anchor")
        groups = blocks_of(anchors, self.numbers, group_rows, max(1, anchors.count() // (4 * group_rows)))
        self.groups = staged(groups.select(F.col("block").alias("group"), "n", "ids", "labels", "vectors"), "anchor-groups")
        self.pages, self.n_pages = pages_of(self.blocks)

    def _asked(self, windows: DataFrame) -> DataFrame:
        """Groups with their windows: at most a few for each of a bounded number of anchors."""
        packed = windows.groupBy("group").agg(F.collect_list(F.struct("slot", "number", "low", "high")).alias("windows"))
        return self.groups.join(packed, "group")

    def _chosen(self, asked: DataFrame, same: bool) -> DataFrame:
        if not self.n_pages:
            return asked.select("group", F.lit(0).cast("long").alias("block"), F.lit(0.0).alias("bound")).limit(0)
        paged = asked.select("group", "vectors", "labels", "windows", F.explode(F.sequence(F.lit(0), F.lit(self.n_pages - 1))).alias("page"))
        return paged.join(self.pages, "page").select("group", "vectors", "labels", "windows", "zones").mapInArrow(
            _choose(self.numbers, same), "group bigint, block bigint, bound double")

    def _scored(self, asked: DataFrame, pairs: DataFrame, same: bool, k: int) -> DataFrame:
        anchors = asked.select("group", F.col("ids").alias("anchor_ids"), F.col("labels").alias("anchor_labels"), F.col("vectors").alias("anchors"), "windows")
        met = pairs.join(anchors, "group").join(self.blocks.select("block", "ids", "labels", "vectors"), "block")
        return met.drop("block").mapInArrow(_score(self.numbers, same, k), "group bigint, slot bigint, number bigint, id bigint, score bigint")

    def search(self, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """The first k rows by score, then id, in each window (group, slot, number, low, high): group, slot, number, rank, id, score.

        same: rows of the anchor's label but with another id; else rows of other labels.
        """
        order = Window.partitionBy("group", "slot", "number").orderBy(F.desc("score"), "id")

        def best(rows: DataFrame) -> DataFrame:
            return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

        asked = self._asked(windows)
        nearest = Window.partitionBy("group").orderBy(F.desc("bound"), "block")
        near = self._chosen(asked, same).withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= FIRST_BLOCKS)
        near = staged(near.select("group", "block"), "near-blocks")
        first = staged(best(self._scored(asked, near, same, k)), "near-rows")
        reached = first.filter(F.col("rank") == k).select("group", "slot", "number", "score")
        raised = windows.select("group", "slot", "number", "low", "high").join(reached, ["group", "slot", "number"], "left")
        raised = staged(raised.select("group", "slot", "number", F.greatest("low", "score").alias("low"), "high"), "raised-windows")
        asked = self._asked(raised)
        far = staged(self._chosen(asked, same).drop("bound").join(near, ["group", "block"], "left_anti"), "far-blocks")
        return best(first.drop("rank").unionByName(self._scored(asked, far, same, k)))


def hard_negatives(items: DataFrame, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    items: id, label, vector (array of numbers) and is_anchor. Scores are inner products of the components'
    floor(scale * x). An anchor's positives are the first rows of its label with another id; negatives of a
    positive are the first rows of other labels that score from low to high per cent of it. Ties go by id.

    A row with a null label, a null vector, or a null or non-finite component takes no part. A null id is no anchor, and last among
    ties. Vectors of different lengths are filled with zeros. Rows that repeat an id are each a candidate and each an anchor, but
    never each other's positive. Components and scores beyond a long become its ends. A negative positive score has no
    window. No anchors, no rows or one label give an empty table.
    """
    searcher = Searcher(items, scale, block_rows, group_rows)
    slots = searcher.groups.select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("slot"))
    everything = slots.select("group", "slot", F.lit(0).cast("long").alias("number"), F.lit(-_MOST).alias("low"), F.lit(_MOST).alias("high"))
    found = searcher.search(everything, True, positives)
    share = F.col("score").cast("decimal(20,0)")
    windows = staged(found.filter("score >= 0").select(
        "group", "slot", F.col("rank").cast("long").alias("number"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(share * low / 100).cast("long").alias("low"), F.floor(share * high / 100).cast("long").alias("high")), "score-windows")
    negative = searcher.search(windows, False, negatives).select(
        "group", "slot", "number", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    anchors = searcher.groups.select("group", F.posexplode("ids").alias("slot", "anchor_id"))
    rows = negative.join(windows.drop("low", "high"), ["group", "slot", "number"]).join(anchors, ["group", "slot"])

    def known(name: str):
        return F.nullif(F.col(name), F.lit(_NO_ID)).alias(name)

    return rows.select("anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative_id"), "positive_score", "negative_score")

