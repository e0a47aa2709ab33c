"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring run in Arrow batches with numpy. Counts cover every training row; they are
summed by Spark, and the model is a matrix of 2^14 buckets by language, whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_columns

BUCKETS = 1 << 14
UNKNOWN = "und"
#: Bounds the model that is broadcast: 256 languages are 32 MB.
MAX_LANGUAGES = 256
#: Characters and documents handled at once.
_CHUNK_CHARS, _CHUNK_DOCS = 1 << 20, 128
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point -> itself for letters, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    found = [i for i in range(0x110000) if chr(i).isalpha()]
    table[found] = found
    return table


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts cut at white space; no n-gram spans white space, so nothing changes."""
    start = 0
    while len(text) - start > _CHUNK_CHARS:
        end = max(text.rfind(" ", start, start + _CHUNK_CHARS), text.rfind("\n", start, start + _CHUNK_CHARS))
        end = end + 1 if end > start else start + _CHUNK_CHARS
        yield text[start:end]
        start = end
    yield text[start:]


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row number and bucket of each 1-, 2- and 3-gram inside words; a space marks a word's ends."""
    joined = [f" {t.lower()}" for t in texts]
    sizes = np.array([len(t) for t in joined])
    codes = _letters()[np.frombuffer(("".join(joined) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)]
    rows = np.append(np.repeat(np.arange(len(texts), dtype=np.int32), sizes), np.int32(max(len(texts) - 1, 0)))
    letter = codes != 32
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # of a run of spaces the first stays
    codes, rows, letter = codes[keep], rows[keep], letter[keep]
    out_rows, out_buckets = [], []
    for n in (1, 2, 3):
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        mixed = np.full(last, n, np.uint32)
        for i in range(n):
            mixed = (mixed ^ codes[i:i + last]) * _FACTORS[i]
            mixed ^= mixed >> np.uint32(15)
        # The first and last place may be a space, a place between may not, and not all are.
        valid = letter[:last] if n == 1 else letter[:last] | letter[1:1 + last] if n == 2 else letter[1:1 + last]
        owner = rows[1:1 + last] if n > 1 else rows[:last]
        if n == 2:  # a leading space belongs to the next word, a trailing one to the word before
            owner = np.where(letter[:last], rows[:last], owner)
        out_rows.append(owner[valid])
        out_buckets.append((mixed[valid] >> np.uint32(32 - 14)).astype(np.int32))
    return np.concatenate(out_rows), np.concatenate(out_buckets)


def _chunks(texts: Iterator[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Document numbers and texts, a bounded number of characters at a time."""
    numbers, parts, chars = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            if parts and (chars + len(piece) > _CHUNK_CHARS or len(parts) >= _CHUNK_DOCS):
                yield np.array(numbers), parts
                numbers, parts, chars = [], [], 0
            numbers.append(i)
            parts.append(piece)
            chars += len(piece)
    if parts:
        yield np.array(numbers), parts


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prior: np.ndarray  # by language
    log_prob: np.ndarray  # bucket x language

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Most likely language of each text and its posterior probability; ties go to the first by name."""
        width = max(len(self.languages), 1)
        total, seen = np.zeros((len(texts), width)), np.zeros(len(texts), bool)
        for numbers, parts in _chunks(iter(texts)):
            rows, buckets = ngram_buckets(parts)
            counts = np.bincount(rows.astype(np.int64) * BUCKETS + buckets, minlength=len(parts) * BUCKETS)
            at = np.flatnonzero(counts)  # sparse: one entry per row and bucket
            row, bucket, weight = at // BUCKETS, at % BUCKETS, counts[at]
            seen[numbers[np.unique(row)]] = True
            for k in range(len(self.languages)):
                np.add.at(total[:, k], numbers, np.bincount(row, weight * self.log_prob[bucket, k], len(parts)))
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total += self.log_prior
        best = total.argmax(axis=1)
        posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen)]
        return names, np.where(seen, posterior, 0.0)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for numbers, parts in _chunks(iter(batch.column("text").to_pylist())):
            rows, buckets = ngram_buckets(parts)
            names, codes = np.unique([langs[i] for i in numbers], return_inverse=True)
            table = np.bincount(codes[rows].astype(np.int64) * BUCKETS + buckets, minlength=len(names) * BUCKETS)
            for name, row in zip(names, table.reshape(len(names), BUCKETS)):
                counts[str(name)] = counts.get(str(name), 0) + row
    for name, row in counts.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())], ["lang", "bucket", "n"])


def fit(docs: DataFrame, smoothing: float = 0.5) -> Model:
    """Count n-grams of all rows of docs (text, lang); rows without text or lang teach nothing."""
    rows = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    priors = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(priors) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = tuple(sorted(r["lang"] for r in priors))
    place = {name: i for i, name in enumerate(languages)}
    counts = rows.mapInArrow(_count_batches, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.zeros((BUCKETS, max(len(languages), 1)))
    found = counts.toArrow()  # at most BUCKETS rows per language
    if found.num_rows:
        names = found.column("lang").combine_chunks().dictionary_encode()
        columns = np.array([place[x] for x in names.dictionary.to_pylist()])[names.indices.to_numpy()]
        table[found.column("bucket").to_numpy(), columns] = found.column("n").to_numpy()
    log_prob = np.log(table + smoothing) - np.log(table.sum(axis=0) + smoothing * BUCKETS)
    total = sum(r["count"] for r in priors)
    prior = np.log(np.array([next(r["count"] for r in priors if r["lang"] == x) for x in languages] or [1]) / max(total, 1))
    return Model(languages, prior, log_prob)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score as last columns (with trailing underscores if taken); only text is read for them.

    A null or empty text, or one without a letter, is 'und' with score 0, and so is everything
    when the model saw no language. Text is never cut. Rows repeat as they come. An empty table
    stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    added = own_columns(docs, "lang_pred", "score")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            names, score = held.value.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, *added])

    kinds = [T.StructField(added[0], T.StringType()), T.StructField(added[1], T.DoubleType())]
    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, *kinds]))


def held_out(doc_id: str = "doc_id"):
    """A third of the ids, chosen by their checksum; they never teach the model."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on_training_part(docs: DataFrame) -> Model:
    return fit(docs.filter(~held_out()))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows not held out."""
    model = fit_on_training_part(docs)
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows whose language is known with a posterior of min_score or more, columns unchanged."""
    model = fit_on_training_part(docs)
    inner = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    kept = predict(inner, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.drop("lang_pred", "score").toDF(*docs.columns)
