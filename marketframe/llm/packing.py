"""Packing along a space-filling curve: documents that resemble each other share sequences.

A document's tokens are hashed into a vector, the vector is projected to a few dimensions, and
its place along a Hilbert curve through them orders the documents. Sequences are filled along
that order without gaps; a document that crosses the end of one is cut there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_before, slices, staged
from .hilbert import hilbert_keys
from .tokens import END_ID, Encoder

#: The hashed vector, its projection, and the grid of the curve. 4 times 15 bits fit one long.
BUCKETS, DIMENSIONS, BITS = 512, 4, 15
#: The grid spans projections from -REACH to REACH; a unit vector's are near 1 and rarely beyond 4.
REACH = 8.0
_SIGNS = np.random.default_rng(13).integers(0, 2, size=(BUCKETS, DIMENSIONS)).astype(np.float32) * 2 - 1
_CHUNK_BYTES = 1 << 20


def document_vectors(rows: list[np.ndarray]) -> np.ndarray:
    """One unit vector per list of ids: the logarithms of the counts of its hashed ids."""
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for i, ids in enumerate(rows):
        bucket = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(23)
        out[i] = np.bincount(bucket, minlength=BUCKETS)
    np.log1p(out, out=out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-30)


def curve_keys(rows: list[np.ndarray]) -> np.ndarray:
    """Places of documents along the curve. A key depends on the document's ids alone."""
    places = document_vectors(rows) @ _SIGNS
    cells = np.floor((np.clip(places / REACH, -1, 1) + 1) * (1 << (BITS - 1)))
    return hilbert_keys(np.minimum(cells, (1 << BITS) - 1).astype(np.int64), BITS)


def _binary(values: np.ndarray, sizes: list[int]) -> pa.Array:
    """A binary column of rows that follow each other in values."""
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])


def _held(ids: memoryview, n: int) -> np.ndarray:
    """Ids of a stored row: two bytes each where all of them fit."""
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


_encoders: dict[str, Encoder] = {}  # one per Python worker and file


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        for batch in batches:
            for part in slices(batch, "text", _CHUNK_BYTES):
                rows = [np.append(x, np.int32(END_ID)) for x in encoder.encode([t or "" for t in part.column("text").to_pylist()])]
                sizes, flat = [len(x) for x in rows], np.concatenate(rows)
                flat = flat.astype("<u2" if flat.max() < 1 << 16 else "<u4")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(curve_keys(rows)), pa.array(sizes, pa.int64()), _binary(flat, sizes)], ["doc_id", "place", "n", "ids"])

    return run


def _run_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of the task, and the ids of its rows so far: ranges ascend with the number."""
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ahead = seen + np.cumsum(n) - n
        seen += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), part, np.int64)), pa.array(ahead), *(batch.column(c) for c in ("doc_id", "n", "ids"))],
            ["part", "ahead", "doc_id", "n", "ids"])


def sequence_ends(total: int, size: int) -> list[int]:
    """Ends of the sequences after the last full one: the rest in powers of two, which need no padding."""
    out, rest, end = [], total % size, total - total % size
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            end += 1 << bit
            out.append(end)
    return out


def _cut(size: int, with_ids: bool):
    def pieces(start: int, n: int, total: int) -> Iterator[tuple[int, int, int, int]]:
        """(ids before the piece, its length, its sequence, its place there)."""
        full, at = total - total % size, start
        tail = sequence_ends(total, size) if start + n > full else []
        while at < start + n:
            if at < full:
                sequence, begin = at // size, at - at % size
                end = begin + size
            else:
                k = next(k for k, x in enumerate(tail) if at < x)
                sequence, begin, end = full // size + k, tail[k - 1] if k else full, tail[k]
            stop = min(end, start + n)
            yield at - start, stop - at, sequence, at - begin
            at = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cuts, kept = [], [], []
            held = batch.column("ids")
            for i, (start, n, total) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("global_start", "n", "total")))):
                ids = _held(held[i].as_buffer(), n).astype("<u4")
                for first, length, sequence, offset in pieces(start, n, total):
                    piece = ids[first:first + length]
                    rows.append(i)
                    cuts.append((first, length, zlib.crc32(piece), n, sequence, offset))
                    if with_ids:
                        kept.append(piece)
            out = [pa.array(x, pa.int64()) for x in (zip(*cuts) if cuts else [[]] * 6)]
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out.append(_binary(np.concatenate(kept) if kept else np.zeros(0, "<u4"), [len(x) for x in kept]))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), *out], ["doc_id", *names])

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, with_ids: bool = True) -> DataFrame:
    """Pieces of the packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and ids.

    docs has doc_id and text; other columns are not read. A document is its ids and the end id; a
    null or empty text is the end id alone. ids (left out unless with_ids) are the piece's, little-endian, four bytes each.
    Sequences have exactly size ids each; what is left at the end of the curve fills sequences of
    falling powers of two, so nothing is padded. Repeated rows are packed each, a null doc_id as
    any other. An empty table gives no pieces.

    Documents with one place on the curve (exact copies) are ordered by a hash of doc_id, so a
    range boundary can fall between them. No task needs more than one batch of rows.
    """
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    encoded = staged(plain.mapInArrow(_encode(tokenizer), "doc_id bigint, place bigint, n bigint, ids binary"), "pack-ids")
    order = ["place", "tie", "doc_id"]
    ranged = encoded.withColumn("tie", F.xxhash64("doc_id")).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(ranged.select("doc_id", "n", "ids").mapInArrow(_run_on, "part bigint, ahead bigint, doc_id bigint, n bigint, ids binary"), "pack-order")
    parts = placed.groupBy("part").agg(F.sum("n").alias("held"))
    parts = parts.select(  # one row per task of the stage before
        "part", F.coalesce(F.sum("held").over(rows_before([], ["part"])), F.lit(0)).alias("before"), F.sum("held").over(Window.partitionBy()).alias("total"))
    joined = placed.join(F.broadcast(parts), "part").select("doc_id", "n", "ids", "total", (F.col("before") + F.col("ahead")).alias("global_start"))
    fields = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return joined.mapInArrow(_cut(size, with_ids), fields + ", ids binary" * with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences of pack(..., with_ids=True): sequence_id, n_tokens, doc_ids, lengths and ids.

    A sequence holds at most size pieces, which bounds its group.
    """
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("p"))
    return grouped.select(
        "sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"),
        F.aggregate("p", F.lit(b""), lambda all_ids, x: F.concat(all_ids, x["ids"])).alias("ids"))
