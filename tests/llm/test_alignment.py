"""Alignment of two tokenizers against a plain version that walks over bytes and sets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketframe.llm import alignment
from marketframe.llm.queries import tokenizer_file

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_find_the_same_common_ends(piece):
    rng = random.Random(piece)
    for _ in range(60):
        a, b = (np.array(sorted(rng.sample(range(40), rng.randint(0, 25))), np.int64) for _ in "ab")
        found = alignment.common_ends(a, b, piece)
        both = sorted({*a.tolist()} & {*b.tolist()})
        assert [(x, y) for x, y in zip(*(f.tolist() for f in found))] == [((a <= v).sum(), (b <= v).sum()) for v in both]


def test_diagonals_divide_the_merge_evenly():
    a, b = np.arange(0, 3000, 3), np.arange(0, 3000, 2)
    d = np.arange(0, 2501, 100)
    in_a = alignment.crossings(a, b, d)
    merged = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
    assert in_a.tolist() == [sum(side == 0 for _, side in merged[:n]) for n in d]


def plain_rows(rows):
    """doc number -> the eight figures, from groups found by walking over all byte offsets."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, other = Tokenizer.from_file(FILES[0]), SentencePieceProcessor(model_file=FILES[1])
    one.encode_special_tokens = True
    pair = alignment.pair_of(*FILES)
    groups = []
    for _, text in rows:
        a, b = ([], []) if not text else (one.encode(" " + text, add_special_tokens=False).ids, other.encode(text))
        raw = b"" if not text else b" " + text.encode()
        if b"".join(pair.bytes_a[i] for i in a) != raw or b"".join(pair.bytes_b[i] for i in b) != raw:
            a, b = [], []
        found, left_a, left_b, held_a, held_b, ia, ib = [], 0, 0, [], [], 0, 0
        while ia < len(a) or ib < len(b):
            if left_a <= left_b:
                held_a.append(a[ia])
                left_a += len(pair.bytes_a[a[ia]])
                ia += 1
            else:
                held_b.append(b[ib])
                left_b += len(pair.bytes_b[b[ib]])
                ib += 1
            if left_a == left_b:
                found.append((held_a, held_b))
                held_a, held_b = [], []
        groups.append(found)
    counts = Counter(p for g in groups for p in {(x, y) for xs, ys in g for x in xs for y in ys})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), g in zip(rows, groups):
        links = [(x, y) for xs, ys in g for x in xs for y in ys]
        written = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in g)
        out.append((doc_id, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(counts[p] == best[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(written.encode()).hexdigest() if written else ""))
    return out


def texts():
    rng = random.Random(8)
    odd = ["", " ", "\t\n", " leading and trailing ", "<|endoftext|> is text", "<s> </s> <unk> <0x0A>", "▁under▁", "été 漢字かな 🙂🙂 ​", "a\x00b", "aaaa" * 900, "-" * 700, "x" * 40_000,
           "0123456789" * 50, "é ﬁ Å", "word " * 9000]
    return [None, *odd, *(" ".join(rng.choice(["alpha", "beta", "12.5", "gamma-ray", "naïve", "don't"]) for _ in range(rng.randint(1, 80))) for _ in range(30))]


def test_alignment_equals_the_plain_version(docs, clashing):
    rows = [*enumerate(texts()), (5, texts()[5]), (None, "no id here"), (7, "another text of one id")]
    expected = Counter(plain_rows(rows))
    for most in (alignment.BROADCAST_PAIRS, 20, 0):  # all pairs broadcast, some, none
        found = alignment.alignment_table(clashing(*rows).repartition(5), *FILES, broadcast_pairs=most)
        assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert Counter(map(tuple, found.collect())) == expected
    assert any(r[1] == 0 and t for r, t in zip(plain_rows(rows), texts()))  # a text that does not come back
    assert alignment.alignment_table(docs(), *FILES).count() == 0


def test_large_groups_are_counted_by_distinct_ids(docs, monkeypatch):
    rows = [*enumerate(texts())]
    pair = alignment.pair_of(*FILES)
    plain = pair.groups([t for _, t in rows]).pairs()
    monkeypatch.setattr(alignment, "LARGE_GROUP", 0)
    for x, y in zip(plain, pair.groups([t for _, t in rows]).pairs()):
        assert (x == y).all()
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1 << 12)
    a, b = [np.array(rng.integers(1, 300, 2000)) for rng in (np.random.default_rng(1), np.random.default_rng(2))]
    one = type("OneGroup", (), {"pair": pair, "a": a, "b": b, "texts": np.array([0, 1]), "ends_a": np.array([2000]), "ends_b": np.array([2000]),
                                "begin_a": np.array([0]), "begin_b": np.array([0]), "links": np.array([4_000_000])})()
    _, keys, times = alignment.Groups.pairs(one)
    counts = Counter(a.tolist()), Counter(b.tolist())
    assert {k: t for k, t in zip(keys.tolist(), times.tolist())} == {x << 32 | y: n * m for x, n in counts[0].items() for y, m in counts[1].items()}


def test_pair_table_and_groups_of_texts(clashing, docs):
    aligned = alignment.align(docs((1, "the cat"), (2, "the dog"), (3, "the")), *FILES)
    table = {(r.a_id, r.b_id): (r.n_docs, r.best) for r in alignment.pair_table(aligned).collect()}
    pair = alignment.pair_of(*FILES)
    the = pair.a.encode(" the", add_special_tokens=False).ids[0], pair.b.encode("the")[0]
    assert table[the] == (3, True)
    frame = clashing((1, "the cat"), (2, None)).withColumnRenamed("n", "groups")
    found = alignment.with_alignment(frame, *FILES)
    assert found.columns == [*frame.columns, "groups_"]
    rows = {r.doc_id: r["groups_"] for r in found.collect()}
    assert [(g.a, g.b) for g in rows[1]][0] == ([the[0]], [the[1]]) and rows[2] == []


def test_pieces_between_spaces_give_the_ids_of_whole_texts(monkeypatch):
    pair = alignment.Pair(*FILES)
    texts = ["a plain text", " led", "ends ", "two  spaces", "tab\t and\nline \n breaks ", "don't you'll I 'm", "日本語 テキスト　幅  thin", "é ́ x", "a\x1c b \x85 c",
             "<|endoftext|> <|endoftext|>", " ", "  ", "\n", "x", "12 34 5,6 -7 %", "word " * 300, "a​ b", "🙂 🙂🙂 end"]
    whole = [x.ids for x in pair.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert pair.divides and [x.tolist() for x in pair.encode_a(texts)] == whole
    given = len(pair.known)
    assert [x.tolist() for x in pair.encode_a(texts + texts)] == whole + whole and len(pair.known) == given  # each piece once
    monkeypatch.setattr(alignment, "KNOWN_PIECES", 3)
    assert [x.tolist() for x in pair.encode_a(texts)] == whole
