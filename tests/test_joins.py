import random

import pytest
from pyspark.sql import functions as F

from marketframe.operators.joins import asof_join, by_days, by_seconds
from tests.conftest import rows


def history(seed: int, hot: bool = False):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b"] if hot else ["a", "b", "c", "d"]
    left, right = {}, {}
    for _ in range(300):
        left[(rng.choice(keys), rng.randrange(400))] = rng.random()
    for _ in range(60):
        right[(rng.choice(keys), rng.randrange(400))] = rng.choice([None, rng.random()])
    return left, right


def frames(spark, left, right):
    base = F.lit("2020-01-01").cast("date")
    lf = spark.createDataFrame([(k, d, v) for (k, d), v in left.items()], "k string, d int, lv double").withColumn("t", F.date_add(base, F.col("d")))
    rf = spark.createDataFrame([(k, d, v) for (k, d), v in right.items()], "k string, rd int, rv double").withColumn("rt", F.date_add(base, F.col("rd")))
    return lf, rf


@pytest.mark.parametrize("width", [1, 7, 50, 366])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_equals_brute_force_for_every_chunk_width(spark, width, strict, how):
    left, right = history(width, hot=True)
    lf, rf = frames(spark, left, right)
    got = asof_join(lf, rf, ["k"], "t", "rt", ["rd", "rv"], how=how, strict=strict, chunk=by_days(width))
    want = []
    for (k, d), v in left.items():
        before = [rd for (rk, rd) in right if rk == k and (rd < d if strict else rd <= d)]
        if before:
            want.append((k, d, v, max(before), right[(k, max(before))]))
        elif how == "left":
            want.append((k, d, v, None, None))
    assert sorted(rows(got.select("k", "d", "lv", "rd", "rv")), key=repr) == sorted(want, key=repr)


def test_many_left_rows_may_share_a_time(spark):
    left, right = history(3)
    lf, rf = frames(spark, left, right)
    tripled = lf.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    once = asof_join(lf, rf, ["k"], "t", "rt", ["rv"])
    many = asof_join(tripled, rf, ["k"], "t", "rt", ["rv"], left_unique=False)
    assert many.count() == 3 * once.count()
    assert sorted(rows(many.select("k", "d", "rv").distinct()), key=repr) == sorted(rows(once.select("k", "d", "rv")), key=repr)


def test_null_keys_never_match_but_stay_on_the_left(spark):
    lf = spark.sql("SELECT CAST(NULL AS STRING) k, DATE '2020-01-05' t UNION ALL SELECT 'a', DATE '2020-01-05'")
    rf = spark.sql("SELECT CAST(NULL AS STRING) k, DATE '2020-01-01' rt, 1 v UNION ALL SELECT 'a', DATE '2020-01-01', 2")
    assert sorted(rows(asof_join(lf, rf, ["k"], "t", "rt", ["v"]).select("k", "v")), key=repr) == [("a", 2), (None, None)]


def test_output_names_must_be_new(spark):
    lf = spark.sql("SELECT 'a' k, DATE '2020-01-05' t, 1 v")
    rf = spark.sql("SELECT 'a' k, DATE '2020-01-01' rt, 2 v")
    with pytest.raises(ValueError, match="already on the left"):
        asof_join(lf, rf, ["k"], "t", "rt", ["v"])
    assert rows(asof_join(lf, rf, ["k"], "t", "rt", {"v": "rv"}).select("v", "rv")) == [(1, 2)]


def test_no_group_spans_a_whole_key(spark):
    """The row window is partitioned by key and chunk; the per-key one sees one row per chunk."""
    left, right = history(5, hot=True)
    lf, rf = frames(spark, left, right)
    plan = asof_join(lf, rf, ["k"], "t", "rt", ["rv"])._jdf.queryExecution().executedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "Window [last(_value" in line]
    assert row_windows and all("_chunk" in line.split("windowspecdefinition")[1].split("_tick")[0] for line in row_windows)


@pytest.mark.parametrize("seconds", [1, 60, 86400])
def test_asof_on_timestamps(spark, seconds):
    rng = random.Random(seconds)
    left = sorted({rng.randrange(10_000_000_000) for _ in range(200)})
    right = sorted({rng.randrange(10_000_000_000) for _ in range(40)})
    start = "timestampadd(MICROSECOND, m, TIMESTAMP_NTZ '2024-01-01 00:00:00')"
    lf = spark.createDataFrame([("k", m) for m in left], "k string, m long").withColumn("t", F.expr(start))
    rf = spark.createDataFrame([("k", m) for m in right], "k string, m long").selectExpr("k", f"{start} AS rt", "m AS rm")
    got = asof_join(lf, rf, ["k"], "t", "rt", ["rm"], strict=True, chunk=by_seconds(seconds))
    want = [(m, max((r for r in right if r < m), default=None)) for m in left]
    assert rows(got.select("m", "rm"), "m") == want


@pytest.fixture
def many_ranges(spark):
    """Every range sort makes eight ranges, however small the data."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


MOMENT = "timestampadd(MICROSECOND, m, TIMESTAMP_NTZ '2025-01-01 00:00:00')"


def moments(spark, left, right):
    lf = spark.createDataFrame(left, "k string, g int, m long, i int").withColumn("t", F.expr(MOMENT))
    rf = spark.createDataFrame(right, "k string, g int, m long, v int").selectExpr("k", "g", f"{MOMENT} AS rt", "m AS rm", "v")
    return lf, rf


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_equal_brute_force(spark, many_ranges, strict, how, seed):
    rng = random.Random(seed)
    keys = [("a", 1), ("a", 2), ("b", None), (None, 1), ("hot", 1)]
    right = {(*rng.choice(keys[: 3 + seed % 2]), rng.randrange(-50, 400)): rng.choice([None, rng.randrange(99)]) for _ in range(60)}
    right |= {("hot", 1, rng.randrange(-50, 400)): rng.randrange(99) for _ in range(seed * 4)} | {("a", 1, None): 5}
    left = [(*rng.choice(keys + keys[-1:] * 20), rng.choice([None, 7, *range(300)]), i) for i in range(500)]
    lf, rf = moments(spark, left, [(*k, v) for k, v in right.items()])
    got = asof_join(lf, rf, ["k", "g"], "t", "rt", {"rm": "found", "v": "v"}, how=how, strict=strict)
    want = []
    for k, g, m, i in left:
        before = [rm for rk, rg, rm in right if None not in (m, rm, rk, rg) and (rk, rg) == (k, g) and (rm < m if strict else rm <= m)]
        if before:
            want.append((i, max(before), right[(k, g, max(before))]))
        elif how == "left":
            want.append((i, None, None))
    assert got.columns == ["k", "g", "m", "i", "t", "found", "v"]
    assert rows(got.select("i", "found", "v"), "i") == sorted(want)


def test_one_key_and_one_moment_are_spread_over_ranges(spark, many_ranges, monkeypatch):
    """A key with nearly all rows, half of them at one moment: no task reads more than its share."""
    from marketframe.operators import ranges

    seen = []
    whole = ranges.staged
    monkeypatch.setattr(ranges, "staged", lambda df, name: seen.append(whole(df, name)) or seen[-1])
    left = [("hot", 1, 500 if i % 2 else i, i) for i in range(8000)] + [("cold", 1, 3, -1)]
    lf, rf = moments(spark, left, [("hot", 1, 200, 7)])
    calls = []
    monkeypatch.setattr(type(lf), "count", lambda self: calls.append(self))  # nothing is counted while planning
    got = asof_join(lf.repartition(5), rf, ["k", "g"], "t", "rt", ["v"])
    assert not calls
    assert rows(got.groupBy("v").agg(F.count("*"))) in ([(None, 101), (7, 7900)], [(7, 7900), (None, 101)])
    shares = [r["n"] for r in seen[0].where("_kind = 0").groupBy("_part").agg(F.count("*").alias("n")).collect()]
    assert len(shares) >= 7 and max(shares) < 2000
    moment = seen[0].where(f"_kind = 0 AND _l2 = 500").select("_part").distinct().collect()
    assert len(moment) >= 3


def test_ranges_of_empty_sides(spark):
    lf, rf = moments(spark, [("a", 1, 5, 1)], [("a", 1, 5, 2)])
    empty = asof_join(lf, rf.limit(0), ["k", "g"], "t", "rt", ["v"])
    assert rows(empty.select("i", "v")) == [(1, None)]
    assert asof_join(lf, rf.limit(0), ["k", "g"], "t", "rt", ["v"], how="inner").count() == 0
    assert asof_join(lf.limit(0), rf, ["k", "g"], "t", "rt", ["v"]).count() == 0
