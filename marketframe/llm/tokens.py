"""Token ids of documents in ORC: encode, write in ascending id order, read stripes back.

Files hold (doc_id, ordinal, ids). ORC run-length encodes the integers, keeps min/max per stripe
and row group, and a Bloom filter on doc_id, so a lookup reads only the row groups it needs and a
large file is read by stripe in parallel.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, rows_before, slices, staged

END_ID = 2
ORC_OPTIONS = {
    "compression": "lz4",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
#: Texts of these characters only are split into words here; others go to the library whole.
_OTHER = r"[^\t\n\r\x20-\x7E\x{C0}-\x{FF}]|<\|"
#: Runs without letters, in lower-case text of those characters. The library cuts them further.
_BETWEEN = r"([^a-z\s\x{DF}-\x{F6}\x{F8}-\x{FF}]+)"
#: Words of texts with an apostrophe, by the tokenizer's own pre-tokenizer (fixed value).
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\s0-9a-zß-öø-ÿ]+")
_MEMO_WORDS = 600_000
_CHUNK_BYTES = 1 << 20


_BYTE_VALUES = np.random.default_rng(1).integers(1 << 63, size=(2, 256), dtype=np.uint64)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _word_hashes(words: pa.StringArray) -> list[np.ndarray]:
    """Two 64-bit hashes of the bytes of each word."""
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[bounds[0]:bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    sizes = np.diff(bounds)
    within = np.arange(len(data)) - np.repeat(bounds[:-1] - bounds[0], sizes)
    out = []
    for values, base in zip(_BYTE_VALUES, _BASES):
        powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, base, np.uint64))
        mixed = np.add.reduceat(values[data] * powers[within], bounds[:-1] - bounds[0]) + sizes.astype(np.uint64)
        out.append(mixed ^ (mixed >> np.uint64(29)))
    return out


class Encoder:
    """Encodes batches with the tokenizers library, each distinct word once while the memo holds it.

    The library merges inside words only, so the ids of a text are those of its words in order.
    The memo takes about 50 bytes a word and is cleared when full; a text with unusual characters or special-token marks is
    encoded by the library as a whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.hashes, self.checks, self.place = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.starts = array("i"), array("q", [0])

    def _places(self, words: pa.StringArray) -> np.ndarray:
        """Memo places of distinct words, found by two 64-bit hashes; absent ones are encoded."""
        first, second = _word_hashes(words)
        places = np.full(len(words), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, first), len(self.hashes) - 1)
            found = (self.hashes[at] == first) & (self.checks[at] == second)
            places[found] = self.place[at[found]]
        absent = np.flatnonzero(places < 0)
        if not len(absent):
            return places
        if len(self.hashes) and len(self.hashes) + len(absent) > _MEMO_WORDS:
            self._reset()
            absent = np.arange(len(words))
        fresh = np.array(words.take(pa.array(absent)).to_pylist(), object)
        letters = np.array([w.isalpha() for w in fresh], bool)
        for part, encode in ((letters, self._split), (~letters, self._each)):
            new = absent[part]
            places[new] = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(new))
            for ids in encode(fresh[part].tolist()):
                self.flat.extend(ids)
                self.starts.append(len(self.flat))
        order = absent[np.argsort(first[absent], kind="stable")]
        at = np.searchsorted(self.hashes, first[order])
        self.hashes, self.checks = np.insert(self.hashes, at, first[order]), np.insert(self.checks, at, second[order])
        self.place = np.insert(self.place, at, places[order].astype(np.int32))
        return places

    def _each(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _split(self, words: list[str], together: int = 100) -> list[list[int]]:
        """Ids of words of letters: encoded as one text, then cut after the ids that end a word."""
        if not words:
            return []
        joined = [" ".join(words[i:i + together]) for i in range(0, len(words), together)]
        flat = [i for x in self.library.encode_batch_fast(joined, add_special_tokens=False) for i in x.ids]
        cuts = np.append(0, np.flatnonzero(self.ends_word[flat]) + 1).tolist()
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _joined(self, words: pa.Array, bounds: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts whose words stand between bounds."""
        coded = words.dictionary_encode()
        places = self._places(coded.dictionary) if len(coded.dictionary) else np.zeros(0, np.int64)
        starts = np.frombuffer(self.starts, np.int64)
        codes = coded.indices.to_numpy()
        sizes, begin = np.diff(starts)[places][codes], starts[places][codes]
        ends = np.append(0, np.cumsum(sizes))
        at = np.repeat((begin - ends[:-1]).astype(np.int32), sizes)
        at += np.arange(len(at), dtype=np.int32)
        ids = np.frombuffer(self.flat, np.int32)[at] if len(at) else np.zeros(0, np.int32)
        cuts = ends[bounds]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(pa.array(texts, pa.string())), _BETWEEN, r" \1 "))
        words, bounds = lists.values, lists.offsets.to_numpy()
        filled = pc.not_equal(words, "")  # white space at a text's ends leaves empty words
        return self._joined(words.filter(filled), np.append(0, np.cumsum(filled.to_numpy(zero_copy_only=False)))[bounds])

    def _contracted(self, texts: list[str]) -> list[np.ndarray]:
        lists = [_WORDS.findall(t.lower()) for t in texts]
        bounds = np.append(0, np.cumsum([len(x) for x in lists]))
        return self._joined(pa.array([w for x in lists for w in x], pa.string()), bounds)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        held = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(held, _OTHER).to_numpy(zero_copy_only=False)
        quoted = pc.match_substring(held, "'").to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for i in np.flatnonzero(odd):
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.int32)
        for which, encode in ((~odd & ~quoted, self._plain), (~odd & quoted, self._contracted)):
            at = np.flatnonzero(which)
            if len(at):
                for i, ids in zip(at, encode([texts[i] for i in at])):
                    out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}  # one per Python worker and file


def _encode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        ordinal = 0

        def flush(doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
            nonlocal ordinal
            rows = [np.append(x, np.int32(END_ID)) for x in encoder.encode(texts)]
            offsets = np.append(0, np.cumsum([len(x) for x in rows])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
            numbers = np.arange(ordinal, ordinal + len(rows), dtype=np.int64)
            ordinal += len(rows)
            return pa.RecordBatch.from_arrays([doc_ids, pa.array(numbers), lists], ["doc_id", "ordinal", "ids"])

        for batch in batches:
            for part in slices(batch, "text", _CHUNK_BYTES):
                yield flush(part.column("doc_id"), [t or "" for t in part.column("text").to_pylist()])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode docs (doc_id, text; other columns are not read) into ORC files in ascending doc_id order.

    File names ascend with the ids they hold and ordinal numbers the rows of a file. A null or
    empty text is the end id alone; a null doc_id comes first; repeated rows are written each; an
    empty table gives files without rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    encoded = rows.mapInArrow(_encode_batches(tokenizer), "doc_id bigint, ordinal bigint, ids array<int>")
    encoded.write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files with the name of the file that holds each; filters on doc_id skip stripes."""
    return spark.read.schema("doc_id bigint, ordinal bigint, ids array<int>").orc(path).select(
        "doc_id", "ordinal", "ids", F.col("_metadata.file_name").alias("file"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values, bounds = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ordinal"), batch.column("file"), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "ordinal", "file", "n_tokens", "ids_crc32"])


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    start sums the files before (one row per file) and the rows before in the file.
    """
    rows = staged(read_tokens(spark, path).mapInArrow(
        _checksums, "doc_id bigint, ordinal bigint, file string, n_tokens bigint, ids_crc32 bigint"), "token-rows")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    files = files.select("file", F.coalesce(F.sum("held").over(rows_before([], ["file"])), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("n_tokens").over(rows_before(["file"], ["ordinal"])), F.lit(0))
    return rows.withColumn("inside", inside).join(files, "file").select(
        "doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokenize_documents(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the token files of docs (to a fresh shared folder unless path is given) and describe them."""
    path = path or fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return token_table(docs.sparkSession, path)
