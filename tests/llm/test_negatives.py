"""Hard negatives against a plain version that scores every pair."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from marketframe.llm import negatives

SCHEMA = "id long, label int, vector array<float>, is_anchor boolean, block string, score string"


def plain(rows, positives=5, share=(50, 95), k=3):
    usable = [(i, label, [math.floor(256 * float(np.float32(x))) for x in v], anchor) for i, label, v, anchor in rows
              if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = 1 << 70
    out = []
    for i, label, v, anchor in usable:
        if not anchor:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), last if j is None else j, other == label) for j, other, w, _ in usable]
        own = sorted((s, j) for s, j, same in scored if same and j != i)[:positives]
        for s, j in own:
            inside = sorted((t, n) for t, n, same in scored if not same and share[0] * -s <= 100 * -t <= share[1] * -s)[:k]
            out += [(i, None if j == last else j, r, None if n == last else n, -s, -t) for r, (t, n) in enumerate(inside, 1)]
    return Counter(out)


def found(spark, rows, **more):
    items = spark.createDataFrame([(*r, "b", "s") for r in rows], SCHEMA)
    out = negatives.hard_negatives(items, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, out.collect()))


def vectors(n, seed, spread, dimensions=8, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimensions))
    at = rng.integers(12, size=n)
    return [(i, int(rng.integers(labels)), [float(x) for x in centres[c] + spread * rng.normal(size=dimensions)], i % 10 == 0) for i, c in enumerate(at)]


@pytest.mark.parametrize("spread,block,group", [(0.1, 16, 8), (1.0, 64, 16), (0.02, 7, 3)])
def test_negatives_equal_those_of_all_pairs(spark, spread, block, group):
    rows = vectors(400, block, spread)
    assert found(spark, rows, block_rows=block, group_rows=group) == plain(rows)


def test_defined_results_of_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, i % 2, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)], i % 5 == 0) for i in range(60)]  # many ties
    rows += [(60, 0, None, True), (61, None, [1.0, 1.0, 1.0], True), (62, 1, [1.0, None, 1.0], True), (63, 1, [float("nan"), 1.0, 1.0], True), (64, 1, [float("inf")] * 3, True)]
    rows += [(65, 0, [], True), (66, 1, [2.0], True), (None, 0, [1.0, 1.0, 0.0], False), (None, 1, [1.0, 0.5, 0.0], None), (10, 0, [1.0, 1.0, 1.0], True), (10, 0, [1.0, 1.0, 1.0], True)]
    assert found(spark, rows, block_rows=8, group_rows=4) == plain(rows)
    same = [(i, i % 3, [1.0, 0.9], i % 4 == 0) for i in range(50)]  # one hot vector, no negative inside a window
    assert found(spark, same) == plain(same) == Counter()
    assert found(spark, []) == Counter() and found(spark, [(1, 1, [1.0], True)]) == Counter() and found(spark, rows[1:5]) == Counter()


@pytest.mark.parametrize("size", [3.0, 3e4, 3e6])
def test_scores_are_exact_in_every_number_type(spark, size):
    rng = np.random.default_rng(int(size))
    rows = [(i, int(i % 3), [float(np.float32(x)) for x in size * rng.random(4)], i % 6 == 0) for i in range(60)]
    assert found(spark, rows, block_rows=16) == plain(rows)


def test_number_types_follow_the_largest_score():
    assert [negatives.Numbers(64, q).exact for q in (160, 40_000, 1 << 27, 1 << 40)] == [np.float32, np.float64, np.int64, object]
    huge = negatives.Numbers(2, 1 << 62)
    assert huge.whole(huge.matrix(np.array([[1 << 62, 1 << 62]], "<i8").tobytes()) @ np.array([[4], [4]], object)).tolist() == [[(1 << 63) - 1]]


def test_bounds_hold_and_far_blocks_are_not_read(spark):
    rng = np.random.default_rng(3)
    anchors, low = rng.integers(-50, 50, (20, 6)).astype(float), rng.integers(-50, 50, (9, 6)).astype(float)
    high = low + rng.integers(0, 30, (9, 6))
    least, most = negatives.score_bounds(anchors, low, high)
    for z in range(9):
        corners = np.array(np.meshgrid(*zip(low[z], high[z]))).reshape(6, -1)
        assert (least[:, z] == (anchors @ corners).min(axis=1)).all() and (most[:, z] == (anchors @ corners).max(axis=1)).all()
    rows = vectors(1200, 6, 0.02, dimensions=6, labels=3)
    items = spark.createDataFrame([(*r, "b", "s") for r in rows], SCHEMA)
    searcher = negatives.Searcher(items, 256, block_rows=16, group_rows=8)
    groups = searcher.groups.selectExpr("group", "explode(sequence(0L, n - 1)) AS slot")
    windows = groups.selectExpr("group", "slot", "0L AS number", "300000L AS low", "9223372036854775807L AS high")
    asked = searcher._asked(windows)
    chosen, every = searcher._chosen(asked, False).count(), searcher.groups.count() * searcher.blocks.count()
    assert 0 < chosen < every / 3
