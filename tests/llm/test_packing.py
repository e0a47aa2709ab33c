"""Packing against its contract: every id once, no gaps, no padding, and resembling documents side by side."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from marketframe.llm import packing
from marketframe.llm.hilbert import hilbert_keys
from marketframe.llm.queries import tokenizer_file

from .conftest import words


@pytest.mark.parametrize("dimensions,bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_in_steps_of_one(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def texts():
    rng = random.Random(5)
    plain = [" ".join(rng.choice("red green blue grey black".split()) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    return [None, "", "  ", "é <|endoftext|> 漢字", words(9000), *plain, plain[0], plain[0]]


def encoded(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(spark, clashing):
    docs = clashing(*enumerate(texts()), (3, texts()[3]), (None, "no id"))
    pieces = [r.asDict() for r in packing.pack(docs, tokenizer_file(), size=256).collect()]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0 and zlib.crc32(p["ids"]) == p["ids_crc32"]
        by_doc[p["doc_id"]].append((p["start"], ids, p["doc_tokens"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    expected = {i: encoded(t) for i, t in [*enumerate(texts()), (None, "no id")]}
    assert by_doc.keys() == expected.keys()
    for i, ids in expected.items():
        times = 2 if i == 3 else 1
        assert all(n == len(ids) for _, _, n in by_doc[i])
        seen = sorted((start + k, token) for start, part, _ in by_doc[i] for k, token in enumerate(part))
        assert seen == sorted([*enumerate(ids)] * times)
    sizes = {}
    for sequence, held in by_sequence.items():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        sizes[sequence] = at
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n == 256 or n & (n - 1) == 0 and n < 256 for n in sizes.values())
    assert sum(n == 256 for n in sizes.values()) == sum(sizes.values()) // 256
    assert packing.pack(docs.limit(0), tokenizer_file()).count() == 0


def test_whole_sequences_hold_their_pieces(docs):
    pieces = packing.pack(docs(*enumerate(texts())), tokenizer_file(), size=512)
    rows = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 4 * r.n_tokens == 4 * sum(r.lengths) for r in rows)
    assert sum(r.n_tokens for r in rows) == sum(len(encoded(t)) for t in texts())


def test_documents_that_resemble_each_other_are_neighbours(docs):
    rng = random.Random(2)
    topics = [[f"{tag}{rng.randrange(60)}" for _ in range(400)] for tag in ("harbour", "violin", "granite", "orchard") for _ in range(12)]
    rows = [(i, " ".join(t)) for i, t in enumerate(topics)]
    order = rows.copy()
    rng.shuffle(order)
    pieces = packing.pack(docs(*order), tokenizer_file(), size=1 << 14, with_ids=False)
    line = [r.doc_id // 12 for r in pieces.filter("start = 0").orderBy("sequence_id", "offset").collect()]
    assert sum(a == b for a, b in zip(line, line[1:])) >= 40  # 44 at best, 11 by chance


def test_copies_of_one_text_can_be_split_over_ranges(spark, docs):
    rows = docs(*((i, "the same text again") for i in range(3000)))
    pieces = packing.pack(rows.repartition(7), tokenizer_file(), size=64, with_ids=False)
    total = pieces.agg({"length": "sum"}).first()[0]
    assert total == 3000 * len(encoded("the same text again"))
    assert pieces.groupBy("sequence_id").sum("length").filter("`sum(length)` <> 64").count() == bin(total % 64).count("1")
