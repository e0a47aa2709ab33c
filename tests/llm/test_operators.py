"""Each operator against a plain version of its contract, with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import pytest

from marketframe.llm import components, decontaminate, exact, jaccard, langid, licenses, mixing, pii, repeats, sharding, tokens
from marketframe.llm.common import fresh_path

from .conftest import words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_counts_score_and_edge_cases(docs, clashing):
    english = [(i, f"the weather of the day was very good number {i}", "en") for i in range(40)]
    french = [(100 + i, f"le temps de la journée était très beau numéro {i}", "fr") for i in range(40)]
    odd = [(1000, None, "en"), (1001, "", "fr"), (1002, "12 ... 34", None), (1003, "the good day " * 30_000, None), (1003, "le beau temps", None), (None, "the day", "en")]
    rows = {(r.doc_id, r.lang_pred, r.score > 0.5, r.held_out) for r in langid.identify(docs(*english, *french, *odd)).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(1004)}
    assert {(i, "en", True, held[i]) for i, *_ in english} | {(i, "fr", True, held[i]) for i, *_ in french} <= rows
    assert {(i, "und", False, held[i]) for i in (1000, 1001, 1002)} <= rows
    assert (1003, "en", True, held[1003]) in rows and (1003, "fr", True, held[1003]) in rows and (None, "en", True, False) in rows
    kept = langid.keep_identified(clashing(*english, *odd))
    assert kept.columns == clashing(*english).columns and kept.count() == 43
    assert langid.identify(docs()).count() == 0
    assert {r.lang_pred for r in langid.identify(docs((1, "abc"))).collect()} == {"und"}


def test_language_model_is_multinomial_naive_bayes(docs):
    train = [(0, "abc ab", "x"), (1, "abd é b", "y"), (2, "Abc", "x")]
    model = langid.fit(docs(*train))

    def grams(text):
        out = Counter()
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            marked = f" {word} "
            parts = list(word) + [marked[i:i + 2] for i in range(len(marked) - 1)] + [marked[i:i + 3] for i in range(len(marked) - 2)]
            out.update(parts)
        return out

    counts = {"x": grams("abc ab") + grams("Abc"), "y": grams("abd é b")}
    found = model.score(["ab qq"])
    score = {k: math.log(n / 3) + sum(m * math.log((counts[k][g] + 0.5) / (sum(counts[k].values()) + 0.5 * langid.BUCKETS))
                                      for g, m in grams("ab qq").items()) for k, n in (("x", 2), ("y", 1))}
    assert found[0] == ["x"] and found[1][0] == pytest.approx(1 / (1 + math.exp(score["y"] - score["x"])), rel=1e-9)
    assert list(langid._pieces("ab " * (1 << 20)))[0].endswith(" ") and "".join(langid._pieces("é" * (3 << 20))) == "é" * (3 << 20)


def test_license_words_base_phrases_and_suppression(docs, clashing):
    texts = [None, "", "Released under the MIT License.", "CC-BY cc by, MIT-License; GNU general public License mit", "Licence sans mit", "été licensed under the Apache License, Version 2.0",
             "SPDX-License-Identifier: LGPL-2.1-or-later", "x " * 30_000 + "Apache\nLicense", "Creative Commons Attribution-NonCommercial 4.0", "bsdx freebsd"]
    rows = {r.doc_id: r for r in licenses.license_table(docs(*enumerate(texts), (2, texts[2]))).collect()}
    for i, text in enumerate(texts):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        at = [(k, label) for phrase, label in licenses.BASE for k in range(len(found)) if found[k:k + len(phrase.split())] == phrase.split()]
        starts = [k for k, _ in at]
        row = rows[i]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == (
            len(found), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)
    assert rows[5].labels == "apache,apache-2.0" and rows[6].labels == "lgpl-2.1" and rows[8].labels == "cc-by-nc-4.0" and rows[9].labels == "bsd-2-clause"
    assert licenses.license_table(docs()).count() == 0
    wide = licenses.scan_licenses(clashing((1, "MIT license"))).first()
    assert wide["base"] == "base" and wide["base_"][0].label == "mit"


def test_license_names_without_version_short_forms_and_neighbours(docs):
    named = {"GNU Lesser General Public License": "lgpl", "GNU Lesser General Public License version 2": "lgpl-2.0", "Mozilla Public License": "mpl",
             "Eclipse Public License": "epl", "European Union Public Licence": "eupl", "BSD license": "bsd", "Licensed under GPLv3": "gpl-3.0",
             "GPL-3.0-or-later": "gpl-3.0", "license: MIT": "mit", "released under the Apache Licence 2.0": "apache-2.0", "GNU Library General Public License v2.1": "lgpl-2.1",
             "LGPLv2.1": "lgpl-2.1", "Mozilla Public Licence, version 2.0": "mpl-2.0", "AGPL v3": "agpl-3.0", "gplus 3": "", "simple general public": "", "MIT licensee": ""}
    rows = {r.doc_id: r for r in licenses.license_table(docs(*enumerate(named))).collect()}
    assert {text: rows[i].labels for i, text in enumerate(named)} == named


def test_license_matches_of_one_text_cost_no_square(docs):
    import time

    unit = "mit license, cc by x "  # 5 words, two phrases
    begun = time.monotonic()
    row = licenses.license_table(docs((1, unit * 25_000))).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.labels) == (125_000, 50_000, 0, 124_997, "cc-by,mit")
    assert time.monotonic() - begun < 60
    # A match over a border of blocks, and one right before and behind it.
    for at in (licenses.BLOCK - 2, licenses.BLOCK - 1, licenses.BLOCK):
        text = "w " * at + "GNU General Public License version 3 " + "w " * 600
        found = licenses.scan_licenses(docs((1, text))).first()
        assert [(s.start, s.end) for s in found.base] == [(at, at + 4)] and [(s.start, s.end, s.label) for s in found.found] == [(at, at + 6, "gpl-3.0")]


def test_every_license_rule_passes_its_gates():
    for rule in licenses.rules():
        sample = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)[?]?|\[\^ \]\+|\(.*?\)|[?*+]|\{[0-9,]+\}", lambda m: m.group(1) or "", rule.pattern)
        assert rule.keyword in sample or re.search(rule.keyword, rule.pattern), rule
    assert len(licenses.rules()) > 200


def shortest_texts(pattern):
    """The shortest match of every alternative of a pattern."""
    from re import _parser

    def texts(tree):
        out = [""]
        for op, av in tree:
            name = str(op)
            if name == "LITERAL":
                ends = [chr(av)]
            elif name == "IN":
                kind, value = av[0]
                ends = ["x"] if str(kind) == "NEGATE" else [chr(value[0] if isinstance(value, tuple) else value)]
            elif name == "NOT_LITERAL":
                ends = ["x"]
            elif name == "MAX_REPEAT":
                ends = [t * av[0] for t in texts(av[2])] if av[0] else [""]
            elif name == "SUBPATTERN":
                ends = texts(av[-1])
            else:
                assert name == "BRANCH", name
                ends = [t for branch in av[1] for t in texts(branch)]
            out = [a + b for a in out for b in ends]
        return out

    return texts(_parser.parse(pattern))


def test_every_license_rule_passes_the_text_gate():
    for rule in licenses.rules():
        for text in shortest_texts(rule.pattern):
            assert re.fullmatch(rule.pattern, text) and re.search(licenses._GATE, text), (rule, text)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_token_files_round_trip(spark, docs, tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    texts = ["Hello, World!  it's 5's x", None, "", "ÀÉ ß 日本 <|endoftext|>", "word " * 60_000, "a" * 30_000, "don't 'S ''t"]
    rows = [(i * 7 % 11, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again")]
    path = fresh_path(spark, "tokens")
    tokens.write_tokens(docs(*rows), path, tokenizer)
    got = sorted(map(tuple, tokens.token_table(spark, path).collect()), key=lambda r: (r[0], r[1]))
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted(want)
    for doc_id, at, size, _ in got:
        assert at == start
        start += size
    assert tokens.read_tokens(spark, path).filter("doc_id = 3").count() == 3
    assert tokens.tokenize_documents(docs(), tokenizer).count() == 0


def shingles(text):
    found = WORD.findall((text or "").translate(LOWER))
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} if found else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * union:
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc_id, _) in enumerate(rows):
        key = find(i)
        least[key] = doc_id if least[key] is None else min(least[key], doc_id)
    return sorted((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


def edited(rng, text, n):
    found = text.split(" ")
    for _ in range(n):
        found[rng.randrange(len(found))] = f"e{rng.random():.6f}"
    return " ".join(found)


def test_jaccard_components_equal_all_pairs(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 3)  # several rounds of pivots
    rng = random.Random(5)
    bases = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice((60, 90, 300)))) for _ in range(5)]
    passage = words(46, "p")
    rows = [(i, edited(rng, bases[i % 5], rng.randrange(0, 5))) for i in range(70)]
    rows += [(100 + i, f"{words(20, f'x{i}')} {passage} {words(20, f'y{i}')}") for i in range(25)]
    rows += [(200, None), (201, ""), (202, "one two"), (203, "ONE\ttwo"), (204, " \n"), (205, words(40_000)), (206, words(40_001)), (207, "é É"), (208, "é é")]
    rows += [(0, rows[0][1]), (300, rows[1][1].upper())]
    got = sorted(map(tuple, jaccard.component_table(docs(*rows)).collect()))
    assert got == brute_components(rows)


def test_jaccard_keeps_one_of_each_group_and_all_columns(docs, clashing):
    text = words(50)
    df = clashing((3, text), (1, text), (2, edited(random.Random(1), text, 1)), (4, "other words"), (5, None), (6, ""), (None, words(30, "z")))
    kept = jaccard.keep_one_per_component(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "6", "None"]
    assert jaccard.component_table(docs()).count() == 0 and jaccard.component_table(docs((1, "a b"))).collect()[0].component_id == 1


def test_components_of_paths_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (1, 0)]
    got = dict(map(tuple, components.components(spark.createDataFrame(chain, "u long, v long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_exact_dedup_groups(docs, clashing):
    rows = [(1, "Abc"), (5, "aBC"), (3, "abc"), (2, None), (4, ""), (6, "é"), (7, "É"), (8, "long " * 50_000), (9, "LONG " * 50_000), (6, "é")]
    got = sorted(map(tuple, exact.group_table(docs(*rows)).collect()))
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    want = sorted((i, max(g), len(g), i == max(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for i in g)
    assert got == want
    df = clashing(*rows)
    kept = exact.exact_dedup(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 6, 7, 9]
    assert exact.group_table(docs()).count() == 0 and exact.group_table(docs((None, "x"))).first().kept is True


def test_shards_are_even_and_slots_gapless(docs, clashing):
    rng = random.Random(2)
    rows = [(i, "hot text" if i % 3 == 0 else "x" * rng.randrange(0, 300)) for i in range(900)] + [(5000, None), (5001, "y" * 20_000), (7, "same"), (7, "same")]
    got = sharding.shard_table(docs(*rows), 10).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len(t or "") + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    load, slots = Counter(), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(load) <= set(range(10)) and max(load.values()) - min(load.values()) <= 2 * 20_016
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sorted(map(tuple, sharding.shard_table(docs(*reversed(rows)).repartition(7), 10).collect()))
    assert again == sorted(map(tuple, got))
    df = clashing(*rows)
    wide = sharding.shard(df, 10)
    assert wide.columns == [*df.columns, "shard_"] and wide.count() == len(rows)
    assert sharding.shard(docs(), 10).count() == 0 and sharding.shard_table(docs((1, "")), 40).count() == 1


def test_overfull_ranges_are_sampled_anew(docs, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 1)
    rows = sharding.keyed(docs(*[(i, "hot") for i in range(500)], *[(i, f"t{i}") for i in range(500, 600)]))
    assert len(sharding.splitters_of(rows, 5, rounds=2)) > len(sharding.splitters_of(rows, 5, rounds=0))


CASES = [None, "", "a@b.c_d@e.f x@y %@.a a.b@c-d.e..f", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3", "+1 (523) 555-1055. +12--345 6789012 ++44 20 7946 0958 +1234567890123456",
         "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112222", "😀é 4111111111111111 x😀@a.b", "9" * 3000, "a" * 20_000, "a.b" * 3000 + "@" + "c." * 3000 + "d", "+1(" * 4000]


def base_entities(text):
    out = []
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for rank, kind in enumerate(pii.KINDS):
        for m in re.finditer(plain[kind], text):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            valid = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}
            if valid[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def test_copies_stay_linked_when_one_has_no_id(docs):
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " tail"
    got = jaccard.component_table(docs((None, text), (5, text), (7, text), (3, near))).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("3", 3), ("5", 3), ("7", 3), ("None", 3)]
    got = jaccard.component_table(docs((None, text), (5, text), (7, text))).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("5", 5), ("7", 5), ("None", 5)]


def test_pii_base_spans(docs, clashing):
    rng = random.Random(3)
    texts = CASES + ["".join(rng.choices("0123456789.@+-() ab", k=rng.randint(1, 80))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(2, texts[2]), (None, texts[3])]
    got = pii.entity_table(docs(*rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base_entities((texts[3] if r.doc_id is None else texts[r.doc_id]) or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(f"{k}:") for k in pii.KINDS]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    assert pii.entity_table(docs()).count() == 0 and pii.entity_table(clashing((1, "a@b.c"))).first().spans == "email:0:5"


def test_pii_bootstrap_finds_unseen_shapes_after_good_cues(docs):
    seeds = [(i, f"Tel: +1 (523) 555-{1000 + i} ok") for i in range(8)]
    more = [(20, "Tel: 555-1234-99, ok"), (21, "room: 555-1234-99"), (22, "Tel: none")]
    got = {r.doc_id: r.spans for r in pii.entity_table(docs(*seeds, *more)).collect()}
    assert got[20] == "phone:5:16" and got[21] == got[22] == "" and got[0] == "phone:5:22"


def test_pii_bootstrap_learns_words_on_both_sides_and_drops_imprecise_ones(docs):
    seeds = [(i, f"please call me at +1 (523) 555-{1000 + i} today then") for i in range(8)]
    mixed = [(100 + i, f"so the +1 (523) 555-{2000 + i} a{i}") for i in range(5)] + [(200 + i, f"so the {5550000 + i} b{i}") for i in range(5)]
    more = [(20, "please call me at 555-1234-99, ok"), (21, "x 555-1234-98 today then y"), (22, "xx 555-1234-97 yy")]
    got = {r.doc_id: r.spans for r in pii.entity_table(docs(*seeds, *mixed, *more)).collect()}
    assert got[20] == "phone:18:29" and got[21] == "phone:2:13" and got[22] == "" and got[200] == got[204] == ""


def test_pii_bootstrap_finds_spaced_and_glued_forms(docs):
    seeds = [(i, f"Tel: +1 (523) 555-{1000 + i} ok") for i in range(8)] + [(50 + i, f"phone=+1523555{1000 + i}") for i in range(8)]
    cards = ("4111 1111 1111 1111", "5500 0000 0000 0004", "3782 822463 10005", "6011 0000 0000 0004", "3056 930902 5904")
    seeds += [(80 + i, f"Card: {c}") for i, c in enumerate(cards)]
    more = [(20, "Tel: (523) 555 1055"), (21, "Card: 4111 1111 1112"), (22, "phone=5551234567"), (23, "Tel: 555-1234 (4111 1111 1111 1111)"), (24, "room=5551234567")]
    got = {r.doc_id: r.spans for r in pii.entity_table(docs(*seeds, *more)).collect()}
    assert got[20] == "phone:5:19" and got[21] == "card:6:20" and got[22] == "phone:6:16" and got[24] == ""
    assert got[23] == "phone:5:13,card:15:34"


def distance(pattern, text):
    previous, out = list(range(len(pattern) + 1)), []
    for c in text:
        row = [0]
        for i, p in enumerate(pattern, 1):
            row.append(min(previous[i] + 1, row[i - 1] + 1, previous[i - 1] + (p != c)))
        previous = row
        out.append(row[-1])
    return out


def test_bit_parallel_distances_and_matches_equal_dynamic_programming():
    rng = random.Random(4)
    for _ in range(300):
        p, t = ("".join(rng.choices("abc", k=rng.randint(1, 70))), "".join(rng.choices("abc", k=rng.randint(0, 90))))
        assert distance(p, t) == list(decontaminate.edit_distances(p, t))
    for _ in range(200):
        item = "".join(rng.choices("abcdefgh  ", k=rng.randint(20, 120)))
        part = list(item)
        for _ in range(rng.randint(0, 8)):
            k = rng.randrange(len(part))
            part[k:k + 1] = rng.choice(["X", "qq", ""])
        text = "".join(rng.choices("abcdefgh  \n", k=100)) + "".join(part) + "".join(rng.choices("ABCdefgh  ", k=100))
        found = list(decontaminate.Matcher([(7, item)], 0.05).matches(text))
        pattern = decontaminate.normalised(item)
        best = min(distance(pattern, decontaminate.normalised(text)))
        assert bool(found) == (best <= int(0.05 * len(pattern))) and (not found or found[0][1] == best)


def test_decontamination_spans_blocks_and_edge_cases(spark, docs, clashing, monkeypatch):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog today"), (2, None), (3, " "), (4, "second item of the benchmark, word for word")], "item_id long, text string")
    leak = "Aa the QUICK  brown fox\njumps over the lazy dag today bb"
    rows = [(1, leak), (2, None), (3, ""), (4, "clean text"), (5, "x" * 200_000 + leak), (1, leak), (None, leak + " second item of the benchmark, word for word")]
    for block in (4 << 20, 30):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
        got = sorted(map(tuple, decontaminate.find_leaks(docs(*rows), items).collect()), key=str)
        assert [g[:3] for g in got] == [(1, 1, 1), (1, 1, 1), (5, 1, 1), (None, 1, 1), (None, 4, 0)]
        assert leak[got[0][3]:got[0][4]] == "the QUICK  brown fox\njumps over the lazy dag today"
        kept = decontaminate.drop_leaks(clashing(*rows), items)
        assert kept.columns == clashing(*rows).columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs(*rows), none).count() == 0 and decontaminate.drop_leaks(docs(*rows), none).count() == len(rows)
    assert decontaminate.find_leaks(docs(), items).count() == 0


def brute_repeats(rows):
    lists, seen = defaultdict(list), defaultdict(set)
    for i, t in rows:
        lists[i].append(WORD.findall((t or "").translate(LOWER)))
    for i, all_ in lists.items():
        for w in all_:
            for k in range(len(w) - 49):
                seen[tuple(w[k:k + 50])].add(i)
    out = set()
    for i, all_ in lists.items():
        spans = sorted((k, k + 50, min(seen[tuple(w[k:k + 50])])) for w in all_ for k in range(len(w) - 49) if len(seen[tuple(w[k:k + 50])]) > 1)
        merged = []
        for a, b, e in spans:
            if merged and a <= merged[-1][1]:
                merged[-1] = [merged[-1][0], max(b, merged[-1][1]), min(e, merged[-1][2])]
            else:
                merged.append([a, b, e])
        out |= {(i, a, b, b - a, e) for a, b, e in merged}
    return out


def test_repeated_passages_equal_all_windows(docs):
    rng = random.Random(6)
    passages = [words(n, f"p{n}x") for n in (49, 50, 55, 70, 200)]
    rows = [(i, " ".join(rng.choice(passages) if rng.random() < 0.5 else words(rng.randrange(1, 60), f"d{i}k{k}") for k in range(6))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "la " * 400), (103, "LA\n" * 90), (104, words(30_000)), (105, words(30_000)), (106, "la " * 60), (0, rows[0][1])]
    assert set(map(tuple, repeats.repeated_passages(docs(*rows)).collect())) == brute_repeats(rows)
    assert repeats.repeated_passages(docs()).count() == 0


def test_mixing_reaches_capped_targets(docs, clashing):
    rng = random.Random(7)
    rows = [(i, words(rng.randrange(0, 200), "m"), None, rng.choice(["a", "a", "a", "a", "a", "a", "b", "c", None])) for i in range(600)]
    rows += [(9000, None, None, "a"), (9001, "", None, "only empty"), (9002, words(20_000), None, "b"), (3, "same", None, "c"), (3, "same", None, "c")]
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3 * sizes[s] for s in over}
        free -= over
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    out, at = mixing.with_repeats(docs(*rows))
    got = out.collect()
    taken = defaultdict(int)
    for r in got:
        assert r[at["target"]] == pytest.approx(target[r.source]) and r[at["source_size"]] == sizes[r.source]
        assert r[at["size"]] == len((r.text or "").split()) and 0 <= r[at["repeats"]] <= 3
        taken[r.source] += r[at["size"]] * r[at["repeats"]]
    longest = {s: max(len((t or "").split()) for _, t, _, x in rows if x == s) for s in names}
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in names)
    again, _ = mixing.with_repeats(docs(*reversed(rows)).repartition(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    df = clashing(*rows)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r[at["repeats"]] for r in got)
    assert mixing.mix(docs()).count() == 0
