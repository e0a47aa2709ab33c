"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k edits is cut into k + 1 pieces. Wherever the item occurs with at
most k edits, one piece occurs unchanged, so exact piece hits (one Aho-Corasick scan of each text)
find every occurrence. Around the hits Myers' bit-parallel algorithm computes the edit distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each character of an item.
ERROR_RATE = 0.05
#: Benchmark text that one scan holds; a larger benchmark is scanned for in several blocks.
BLOCK_CHARS = 4 << 20
_SPAN = re.compile(r"\S+")


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalised(text: str) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join(_lower(text).split())


def _places(text: str) -> list[int]:
    """For each character of the normalised text its place in the text."""
    out: list[int] = []
    for m in _SPAN.finditer(text):
        if out:
            out.append(m.start() - 1)
        out.extend(range(m.start(), m.end()))
    return out


def _columns(pattern: str) -> dict[str, int]:
    table: dict[str, int] = {}
    for i, c in enumerate(pattern):
        table[c] = table.get(c, 0) | 1 << i
    return table


def edit_distances(pattern: str, text: str, anchored: bool = False) -> Iterator[int]:
    """Distance of pattern to the best part of text that ends at each place (from its start if anchored)."""
    m = len(pattern)
    table, mask, top = _columns(pattern), (1 << m) - 1, 1 << (m - 1)
    positive, negative, score = mask, 0, m
    carry = 1 if anchored else 0
    for c in text:
        eq = table.get(c, 0)
        diagonal = (((eq & positive) + positive) ^ positive) | eq | negative
        up = negative | ~(diagonal | positive) & mask
        down = positive & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | carry) & mask
        down = down << 1 & mask
        positive = (down | ~(diagonal | up)) & mask
        negative = up & diagonal
        yield score


class Matcher:
    """Finds items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items: list[tuple[int, str, int]] = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            pattern = normalised(text)
            if not pattern:
                continue
            budget = int(error_rate * len(pattern))
            number = len(self.items)
            self.items.append((item_id, pattern, budget))
            cuts = [len(pattern) * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                pieces.setdefault(pattern[a:b], []).append((number, a))
        self.automaton = ahocorasick.Automaton()
        for piece, at in pieces.items():
            self.automaton.add_word(piece, (len(piece), at))
        if pieces:
            self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """item_id, edits, start and end (code points of text) of the best match of each item in it."""
        plain = normalised(text)
        if not self.items or not plain:
            return
        windows: dict[int, list[list[int]]] = {}
        for end, (size, at) in self.automaton.iter(plain):
            for number, offset in at:
                _, pattern, budget = self.items[number]
                start = end + 1 - size - offset
                low, high = max(0, start - budget), min(len(plain), start + len(pattern) + budget)
                held = windows.setdefault(number, [])
                # Hits come in the order of their ends, so windows of one item nearly come in order.
                if held and low <= held[-1][1]:
                    held[-1][0], held[-1][1] = min(low, held[-1][0]), max(high, held[-1][1])
                else:
                    held.append([low, high])
        places = None
        for number, spans in sorted(windows.items()):
            item_id, pattern, budget = self.items[number]
            best = (budget + 1, 0)
            for low, high in spans:
                for i, score in enumerate(edit_distances(pattern, plain[low:high]), low + 1):
                    best = min(best, (score, i))
                if best[0] == 0:
                    break
            edits, end = best
            if edits > budget:
                continue
            back = plain[max(0, end - len(pattern) - budget):end][::-1]
            length = next((i for i, score in enumerate(edit_distances(pattern[::-1], back, True), 1) if score == edits), len(back))
            places = places or _places(text)
            yield item_id, edits, places[end - length], places[end - 1] + 1


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of a bounded size, dealt by a hash of the item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = 1 + size // BLOCK_CHARS
    for block in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        yield sorted(((r.item_id, r.text) for r in part.collect()), key=repr)


_matchers: dict[tuple, Matcher] = {}  # one block at a time per Python worker


def _matcher(held, error_rate: float) -> Matcher:
    key = (held.value[0], error_rate)
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(held.value[1], error_rate)
    return _matchers[key]


def _broadcasts(docs: DataFrame, benchmark: DataFrame, item_id: str, text: str):
    import uuid

    for block in _blocks(benchmark, item_id, text):
        if block:
            yield docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block))


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, edits, start, end for every document and item that occurs in it.

    Both sides are compared in lower case with white space collapsed; an occurrence has at most
    error_rate * length edits, and the best one of each pair is given (the first of equals), with
    code points of the whole text. Null and empty texts or items match nothing; repeated rows give
    repeated results; empty tables give none. Only doc_id and text of docs are read.
    """
    def scan(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(held, error_rate)
            for batch in batches:
                out = [(doc, *found) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                       if text for found in matcher.matches(text)]
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "edits", "start", "end"])

        return run

    kind = "doc_id bigint, item_id bigint, edits bigint, start bigint, end bigint"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for held in _broadcasts(docs, benchmark, item_id, item_text):
        part = rows.mapInArrow(scan(held), kind)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], kind)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs in whose text no item occurs; null and empty texts stay. Columns as in docs."""
    def keep(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(held, error_rate)
            for batch in batches:
                clean = [next(matcher.matches(text), None) is None if text else True for text in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    inner = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    for held in _broadcasts(docs, benchmark, item_id, item_text):
        inner = inner.mapInArrow(keep(held), inner.schema)
    return inner.toDF(*docs.columns)
