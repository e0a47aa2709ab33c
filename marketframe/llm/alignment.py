"""Alignment of two tokenizers: which token ids of one cover the same bytes as which of the other.

The ends of a text's tokens under A and under B are two ascending lists of byte offsets. Merging
them yields the offsets where both end; these cut the tokens into groups, and every A token of a group is
linked with every B token of it. The merge is divided along its path: diagonals at equal
distances are searched for the place where they cross it, so each piece merges the same number of
ends whatever the lengths of the texts, and pieces need nothing from each other. An end that one piece takes from
A and the next from B is found where they meet.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_columns, slices, staged

#: Ends that one piece merges.
PIECE = 1 << 15
#: Groups of more links than this are counted by distinct ids instead of link by link.
LARGE_GROUP = 1 << 12
#: Rows of the pair table that are broadcast (at 40 bytes each, 40 MB); all others are shuffled.
BROADCAST_PAIRS = 1_000_000
_CHUNK_BYTES = 1 << 20
#: Pieces of texts whose ids a Python worker remembers (some 60 MB); a chunk with more is encoded all the same.
KNOWN_PIECES = 1 << 18
_PIECES_PER_LINE = 64
_SPACES = r"\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
_VISIBLE, _BETWEEN = re.compile(f"[^{_SPACES}]"), re.compile(f"(?<=[^{_SPACES}]) (?=[^{_SPACES}])")
#: A pair of ids is held as one long: A's id in the upper half, B's in the lower.
_SHIFT = 32


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of a stand among the first d of the merged order, for each d; of equal values a's comes first.

    A binary search along every diagonal, all of them at once.
    """
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        at, d = ((low + high) // 2)[open_], diagonals[open_]
        taken = a[at] <= b[d - 1 - at]
        low[open_], high[open_] = np.where(taken, at + 1, low[open_]), np.where(taken, high[open_], at)
    return low


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a's and of b's values up to and with each value that both have; a and b ascend without repeats."""
    diagonals = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    in_a = crossings(a, b, diagonals)
    in_b = diagonals - in_a
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a0, a1, b0, b1 in zip(in_a[:-1], in_a[1:], in_b[:-1], in_b[1:]):
        if a0 and b0 < len(b) and a[a0 - 1] == b[b0]:  # one value on both sides of the diagonal
            found.append((np.array([a0]), np.array([b0 + 1])))
        own_a, own_b = a[a0:a1], b[b0:b1]
        at = np.searchsorted(own_b, own_a)
        hit = np.flatnonzero(at < len(own_b))
        hit = hit[own_b[at[hit]] == own_a[hit]]
        found.append((a0 + hit + 1, b0 + at[hit] + 1))
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), ())))


def _byte_level_table(size: int, vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of each entry: printable Latin-1 characters stand for themselves, the other bytes for 256 and on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    out = [b""] * size
    for token, i in vocabulary.items():
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def came_back(found: list[np.ndarray], raw: list[bytes], flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text, whether the bytes of its ids, joined, are its own. All texts are compared at once."""
    lengths = np.array([len(x) for x in raw], np.int64)
    whole = np.array([int(sizes[ids].sum()) for ids in found], np.int64) == lengths
    same = np.flatnonzero(whole)
    if not len(same):
        return whole
    ids = np.concatenate([found[i] for i in same])
    width, ends = sizes[ids], np.cumsum(sizes[ids])
    joined = flat[np.arange(int(ends[-1])) + np.repeat(starts[ids] - (ends - width), width)]
    off = np.flatnonzero(joined != np.frombuffer(b"".join([raw[i] for i in same]), np.uint8))
    whole[same[np.searchsorted(np.cumsum(lengths[same]), off, side="right")]] = False
    return whole


def counted(texts: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, n_texts: int, size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair) in ascending order, and how often each stands there."""
    bits_a, bits_b = size_a.bit_length(), size_b.bit_length()
    if n_texts.bit_length() + bits_a + bits_b > 63:
        keys = ids_a << _SHIFT | ids_b
        order = np.lexsort((keys, texts))
        texts, keys = texts[order], keys[order]
        first = np.flatnonzero(np.append(True, (texts[1:] != texts[:-1]) | (keys[1:] != keys[:-1]))[:len(keys)])
        return texts[first], keys[first], np.diff(np.append(first, len(keys)))
    held = np.sort(((texts << bits_a | ids_a) << bits_b) | ids_b)  # text and both ids in one number
    first = np.flatnonzero(np.append(True, held[1:] != held[:-1])[:len(held)])
    times, held = np.diff(np.append(first, len(held))), held[first]
    pairs = (held >> bits_b & (1 << bits_a) - 1) << _SHIFT | held & (1 << bits_b) - 1
    return held >> (bits_a + bits_b), pairs, times


class Pair:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        layout = json.loads(self.a.to_str())
        split = layout["pre_tokenizer"] or {}
        self.divides = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not layout["normalizer"]
                        and all(x["special"] for x in layout["added_tokens"]) and not layout.get("truncation") and not layout.get("padding"))
        self.known: dict[str, tuple[int, ...]] = {}
        vocabulary = self.a.get_vocab()
        self.bytes_a = _byte_level_table(max(vocabulary.values()) + 1, vocabulary)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        #: All entries' bytes, one after the other, and where each begins.
        self.flat_a, self.flat_b = (np.frombuffer(b"".join(table), np.uint8) for table in (self.bytes_a, self.bytes_b))
        self.starts_a, self.starts_b = (np.cumsum(sizes) - sizes for sizes in (self.sizes_a, self.sizes_b))
        #: Decimal ids with what follows them: inside a side of a group, at its end.
        words = [f"{i}{mark}" for size, marks in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for mark in marks for i in range(size)]
        self.words = np.array(words, object)

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        """Ids under A of each text with a space before it.

        A byte-level tokenizer never joins the two sides of a single space between visible characters. So a text is
        divided there, and every different piece goes through the tokenizer once, many in one call, as long as it is remembered.
        """
        if not self.divides:
            return [np.array(x.ids, np.int64) for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        divided = [_BETWEEN.split(t) for t in texts]
        wanted = set(chain.from_iterable(divided))
        fresh = [p for p in wanted if p not in self.known]
        if len(self.known) + len(fresh) > KNOWN_PIECES:
            self.known.clear()
            fresh = list(wanted)
        ends_open = {p for pieces in divided for p in (pieces[0], pieces[-1]) if not (_VISIBLE.match(p[0]) and _VISIBLE.match(p[-1]))}
        closed = [p for p in fresh if p not in ends_open]
        lines = ["".join([" " + p for p in closed[at:at + _PIECES_PER_LINE]]) for at in range(0, len(closed), _PIECES_PER_LINE)]
        flat = tuple(chain.from_iterable(x.ids for x in self.a.encode_batch_fast(lines, add_special_tokens=False)))  # tuples of numbers are nothing to the garbage collector
        ends, bounds = np.cumsum(self.sizes_a[np.array(flat, np.int64)]), np.cumsum(np.array([1 + len(p.encode()) for p in closed], np.int64))
        if closed and ends[-1] == bounds[-1]:
            upto = np.searchsorted(ends, bounds)
            if (ends[upto] == bounds).all():
                upto = (upto + 1).tolist()
                self.known.update(zip(closed, [flat[s:e] for s, e in zip([0, *upto], upto)]))
        rest = [p for p in fresh if p not in self.known]  # with white space at an end, or where bytes do not come back
        self.known.update(zip(rest, [tuple(x.ids) for x in self.a.encode_batch_fast([" " + p for p in rest], add_special_tokens=False)]))
        return [np.fromiter(chain.from_iterable(map(self.known.__getitem__, pieces)), np.int64) for pieces in divided]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text under A and B; both empty where the text is, or where its bytes do not come back."""
        filled = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in filled]
        none = np.zeros(0, np.int64)
        out_a, out_b = [none for _ in texts], [none for _ in texts]
        if not given:
            return out_a, out_b
        found_a = self.encode_a(given)
        found_b = [np.array(x, np.int64) for x in self.b.encode(given, num_threads=1)]
        raw = [b" " + t.encode() for t in given]
        whole = came_back(found_a, raw, self.flat_a, self.starts_a, self.sizes_a) & came_back(found_b, raw, self.flat_b, self.starts_b, self.sizes_b)
        for at in np.flatnonzero(whole):
            out_a[filled[at]], out_b[filled[at]] = found_a[at], found_b[at]
        return out_a, out_b

    def groups(self, texts: list[str | None]) -> "Groups":
        a, b = self.encode(texts)
        return Groups(self, a, b)


class Groups:
    """The groups of several texts, one after the other: their ids, and where the groups and the texts end in A and B."""

    def __init__(self, pair: Pair, a: list[np.ndarray], b: list[np.ndarray]):
        self.pair = pair
        self.a, self.b = np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])
        self.texts_a, self.texts_b = (np.append(0, np.cumsum([len(x) for x in side])).astype(np.int64) for side in (a, b))
        self.ends_a, self.ends_b = common_ends(np.cumsum(pair.sizes_a[self.a]), np.cumsum(pair.sizes_b[self.b]))
        self.begin_a, self.begin_b = (np.append(0, x)[:-1] for x in (self.ends_a, self.ends_b))
        self.links = (self.ends_a - self.begin_a) * (self.ends_b - self.begin_b)
        #: Groups before each text: a text's last byte ends a token on both sides.
        self.texts = np.searchsorted(self.ends_a, self.texts_a[1:], side="right")
        self.texts = np.append(0, self.texts)

    def written(self) -> list[str]:
        """Each text's groups in the form a1,a2|b1;a3|b2,b3."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.ends_a - 1] = last_b[self.ends_b - 1] = 1
        size_a, size_b = len(self.pair.bytes_a), len(self.pair.bytes_b)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.repeat(self.begin_b, self.ends_a - self.begin_a)] = self.a + last_a * size_a
        codes[np.arange(len(self.b)) + np.repeat(self.ends_a, self.ends_b - self.begin_b)] = self.b + last_b * size_b + 2 * size_a
        words, bounds = self.pair.words[codes].tolist(), (self.texts_a + self.texts_b).tolist()
        return ["".join(words[s:e])[:-1] for s, e in zip(bounds[:-1], bounds[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked id pairs of each text: number of the text, pair, and how many links it has there."""
        text = np.repeat(np.arange(len(self.texts) - 1), np.diff(self.texts))
        small = np.flatnonzero(self.links <= LARGE_GROUP)
        sizes, wide = self.links[small], (self.ends_b - self.begin_b)[small]
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        width = np.repeat(wide, sizes)
        ids_a = self.a[np.repeat(self.begin_a[small], sizes) + within // width]
        ids_b = self.b[np.repeat(self.begin_b[small], sizes) + within % width]
        parts = [counted(np.repeat(text[small], sizes), ids_a, ids_b, len(self.texts), len(self.pair.bytes_a), len(self.pair.bytes_b))]
        for g in np.flatnonzero(self.links > LARGE_GROUP):
            one, times_a = np.unique(self.a[self.begin_a[g]:self.ends_a[g]], return_counts=True)
            other, times_b = np.unique(self.b[self.begin_b[g]:self.ends_b[g]], return_counts=True)
            keys = (one[:, None] << _SHIFT | other).ravel()
            parts.append((np.full(len(keys), text[g]), keys, np.outer(times_a, times_b).ravel()))
        if len(parts) == 1:
            return parts[0]
        texts, keys, times = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((keys, texts))
        texts, keys, times = texts[order], keys[order], times[order]
        first = np.flatnonzero(np.append(True, (texts[1:] != texts[:-1]) | (keys[1:] != keys[:-1])))
        return texts[first], keys[first], np.add.reduceat(times, first)

    def table(self) -> list[pa.Array]:
        texts, keys, times = self.pairs()
        bounds = pa.array(np.searchsorted(texts, np.arange(len(self.texts))).astype(np.int32))
        per_text = np.append(0, np.cumsum(self.links))[self.texts]
        sha = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in self.written()]
        return [pa.array(np.diff(self.texts_a)), pa.array(np.diff(self.texts_b)), pa.array(np.diff(self.texts)), pa.array(np.diff(per_text)),
                pa.array(sha, pa.string()), pa.ListArray.from_arrays(bounds, pa.array(keys)), pa.ListArray.from_arrays(bounds, pa.array(times))]


_pairs: dict[tuple[str, str], Pair] = {}  # one per Python worker and pair of files


def pair_of(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for batch in batches:
            for part in slices(batch, "text", _CHUNK_BYTES):
                found = pair.groups(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found.table()], ["doc_id", *_COUNTS, "groups_sha256", "pairs", "times"])

    return run


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are not read), written once: row, doc_id,
    n_a, n_b, n_groups, n_links, groups_sha256, pairs (distinct id pairs) and times (links of each).

    A text that is null or empty, or that either tokenizer does not give back byte for byte, has no tokens: zeros,
    '' and empty lists. An empty table gives an empty table. A task holds a megabyte of texts, or one longer
    text, and its distinct pairs.
    """
    fields = ", ".join(f"{c} bigint" for c in _COUNTS)
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _align(path_a, path_b), f"doc_id bigint, {fields}, groups_sha256 string, pairs array<bigint>, times array<bigint>")
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")


def pair_table(aligned: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n_docs (rows that hold it linked) and best (no pair of the same a_id has more)."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    split = counted.withColumns({"a_id": F.shiftright("pair", _SHIFT), "b_id": F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))})
    return split.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a_id")))


def _frequent_from(counts: DataFrame, most: int) -> int | None:
    """The least power of two that at most `most` pairs reach; None if all pairs together are no more."""
    power = F.floor(F.log2("n_docs")).cast("int")  # 64 rows at most
    steps = sorted(((r.power, r.n) for r in counts.groupBy(power.alias("power")).agg(F.count("*").alias("n")).collect()), reverse=True)
    seen = 0
    for power, n in steps:
        seen += n
        if seen > most:
            return 2 ** (power + 1)
    return None


def link_counts(aligned: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """row, n_best and count_sum: its links by how many documents hold their pair.

    Pairs that very many rows hold are looked up in a broadcast of at most broadcast_pairs pairs,
    the rarer rest in a shuffle, in which no key is hot because none is frequent.
    """
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    narrow = counts.select("pair", "n_docs", "best")
    least = _frequent_from(counts, broadcast_pairs)
    if least is None:
        met = links.join(F.broadcast(narrow), "pair")
    else:
        frequent = F.broadcast(narrow.filter(F.col("n_docs") >= least))
        rare = links.join(frequent, "pair", "left_anti").join(narrow.filter(F.col("n_docs") < least), "pair")
        met = links.join(frequent, "pair").unionByName(rare)
    return met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"))


def alignment_table(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = align(docs, path_a, path_b)
    counts = staged(pair_table(aligned), "pair-counts")
    sums = link_counts(aligned, counts, broadcast_pairs)
    rows = aligned.select("row", "doc_id", *_COUNTS, "groups_sha256").join(sums, "row", "left")
    return rows.select("doc_id", *_COUNTS, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def with_alignment(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """docs with a column groups: arrays of A ids and of B ids, group by group. All columns stay, whatever their names."""
    name, = own_columns(docs, "groups")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for batch in batches:
            for part in slices(batch, text, _CHUNK_BYTES):
                found = pair.groups(part.column(text).to_pylist())
                sides = []
                for ids, ends in ((found.a, found.ends_a), (found.b, found.ends_b)):
                    sides.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)))
                groups = pa.StructArray.from_arrays(sides, ["a", "b"])
                lists = pa.ListArray.from_arrays(pa.array(found.texts.astype(np.int32)), groups)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, name])

    ids = T.ArrayType(T.LongType())
    groups = T.ArrayType(T.StructType([T.StructField("a", ids), T.StructField("b", ids)]))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, groups)]))
