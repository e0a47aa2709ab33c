"""Exact Jaccard join on word shingles as a metric-space join.

Jaccard distance is a metric. The join works on distinct shingle sets (copies collapse first):

1. Regions. Linked sets share one of their first |x| - ceil(0.8 |x|) + 1 shingles in any common
   order, so every such shingle is a region and only sets that meet in a region can link. The
   order puts frequent shingles last, which keeps passages shared by many documents from filling regions.
2. Pivots. In a region too large to compare outright the central set becomes the pivot and all
   members are measured against it: those within the threshold form its cell.
3. Windows. By the triangle inequality x and y can only link if |d(x, p) - d(y, p)| <= 0.2. Members
   of one component need no comparison either. So a member outside the region's main component is
   compared with the others inside its window only, wherever the cell boundary runs.
4. Recursion. Such members become the pivots of the next round, ever more at a time, until every
   region lies in one component or has no pair left.

A dense group is joined by stars instead of all its pairs, and no link between groups is lost:
the components are exact. Sets are compared by 64-bit shingle hashes and classes are named by a 64-bit
hash, so n sets meet a false match with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import own_columns, slices, staged
from .components import components

WIDTH = 5
PERCENT = 80
#: Regions up to this size are compared outright.
LEAF = 6
#: Frequent shingles that are ordered last; any choice gives the same links.
MAX_FREQUENT, LOCAL_FREQUENT, LOCAL_MIN = 1 << 18, 8192, 2
#: Members measured against a pivot by one task at a time.
MEMBERS_PER_TASK = 256
#: A class table of up to so many rows (16 bytes each) is broadcast.
BROADCAST_ROWS = 1_000_000
_CHUNK_BYTES = 2 << 20
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased, between ASCII white space) and the bounds of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    words = lists.values
    filled = pc.not_equal(words, "")
    bounds = np.append(0, np.cumsum(filled.to_numpy(zero_copy_only=False)))[lists.offsets.to_numpy()]
    coded = words.filter(filled).dictionary_encode()
    table = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return table[coded.indices.to_numpy()] if len(table) else np.zeros(0, np.uint64), bounds


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: of every 5 words, or of all words if fewer; none for no word."""
    hashes, bounds = word_hashes(texts)
    last = max(len(hashes) - WIDTH + 1, 0)
    with np.errstate(over="ignore"):
        windows = np.zeros(last, np.uint64)
        for j in range(WIDTH):
            windows += hashes[j:j + last] * _FACTORS[j]
        windows = _mixed(windows)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= WIDTH:
                out.append(np.unique(windows[a:b - WIDTH + 1]))
            elif b > a:
                whole = (hashes[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(_mixed(np.array([whole], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _chunks(batch: pa.RecordBatch) -> Iterator[list[str]]:
    for part in slices(batch, "text", _CHUNK_BYTES):
        yield [t or "" for t in part.column("text").to_pylist()]


def sets_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for chunk in _chunks(batch):
        yield from shingle_sets(chunk)


def _class_of(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def _frequent_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that several distinct sets of a chunk hold, the most frequent ones, with their counts."""
    seen: set[int] = set()
    for batch in batches:
        for chunk in _chunks(batch):
            fresh = []
            for found in shingle_sets(chunk):
                name = _class_of(found)
                if name not in seen:
                    seen.add(name)
                    fresh.append(found)
            values, counts = np.unique(np.concatenate(fresh), return_counts=True) if fresh else (np.zeros(0, np.uint64), np.zeros(0, int))
            at = np.flatnonzero(counts >= LOCAL_MIN)
            if len(at) > LOCAL_FREQUENT:
                at = at[np.argsort(-counts[at], kind="stable")[:LOCAL_FREQUENT]]
            yield pa.RecordBatch.from_pydict({"token": values[at].view(np.int64), "n": counts[at].astype(np.int64)})


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """At most MAX_FREQUENT shingles, from summaries of all documents. They only shape the order."""
    counted = docs.select("text").mapInArrow(_frequent_batches, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    found = counted.orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).select("token").toArrow()
    return np.sort(found.column("token").to_numpy().astype(np.int64).view(np.uint64))


def _profile_batches(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = frequent.value
        seen: set[int] = set()
        for batch in batches:
            classes, sizes, prefixes = [], [], []
            for found in sets_of(batch):
                name = _class_of(found)
                classes.append(name)
                sizes.append(len(found))
                if name in seen or not len(found):  # copies in this partition are in the same regions
                    prefixes.append(found[:0])
                    continue
                seen.add(name)
                length = len(found) - -(-PERCENT * len(found) // 100) + 1
                if len(common):
                    late = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found
                    found = np.concatenate([found[~late][:length], found[late][:length]])
                prefixes.append(found[:length])
            bounds = np.append(0, np.cumsum([len(p) for p in prefixes])).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), lists],
                ["doc_id", "text_hash", "n", "class", "prefix"])

    return run


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n (set size), class (names the set) and, once per partition and class, its regions."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_profile_batches(frequent), "doc_id bigint, text_hash bigint, n bigint, class bigint, prefix array<bigint>")


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by hub, its own text first; each member's set is held against the hub's."""
    current = np.zeros(0, np.uint64)
    for batch in batches:
        hubs, members = batch.column("hub").to_pylist(), batch.column("class").to_pylist()
        out = []
        for hub, member, found in zip(hubs, members, sets_of(batch)):
            if hub == member:
                current = found
                continue
            both = len(np.intersect1d(current, found, assume_unique=True))
            union = len(current) + len(found) - both
            out.append((hub, member, 100 * both >= PERCENT * union, 1.0 - both / union))
        columns = list(zip(*out)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.float64()))], ["hub", "class", "linked", "distance"])


def measured(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """hub, class, linked and distance for distinct pairs (hub, class).

    A hub with many members is dealt to several tasks, its own text going to each of them.
    """
    counts = pairs.groupBy("hub").agg(F.count("*").alias("members"))
    dealt = pairs.join(counts, "hub").select(
        "hub", F.pmod(F.xxhash64("class"), F.ceil(F.col("members") / MEMBERS_PER_TASK)).alias("part"), "class", F.lit(1).alias("kind"))
    own = dealt.select("hub", "part").distinct().select("hub", "part", F.col("hub").alias("class"), F.lit(0).alias("kind"))
    rows = _broadcast_small(dealt.union(own)).join(texts, "class").select("hub", "part", "kind", "class", "text")
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "kind")
    return rows.select("hub", "class", "text").mapInArrow(_measure_batches, "hub bigint, class bigint, linked boolean, distance double")


def marked(regions: DataFrame) -> DataFrame:
    """Per class its size n, marks (16 bits of each region it shares with others, distinct) and hidden (regions less marks).

    Common regions have common marks, so two sets share at most as many regions as marks, and the fewer hidden ones more.
    """
    mark = (F.pmod("token", F.lit(1 << 16)) - (1 << 15)).cast("smallint")
    found = regions.groupBy("class", "n").agg(F.collect_set(mark).alias("marks"), F.count("*").alias("held"))
    return found.select("class", "n", "marks", (F.col("held") - F.size("marks")).cast("int").alias("hidden"))


def may_link(other: str):
    """Whether two sets (n, marks, hidden; those of the second with a prefix) can be linked at all.

    A common shingle is a common region, or it lies past the regions of one of the two; that bounds the overlap.
    """
    n, other_n = "n", f"{other}_n"

    def past(size: str):
        return F.expr(f"{size} - ({size} - int(ceil({size} * {PERCENT} / 100.0)) + 1)")

    regions = F.size(F.array_intersect("marks", f"{other}_marks")) + F.least("hidden", f"{other}_hidden")
    most = regions + F.greatest(past(n), past(other_n))
    most = F.least(most, F.col(n), F.col(other_n))
    return 100 * most >= PERCENT * (F.col(n) + F.col(other_n) - most)


def possible(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Of distinct pairs (hub, class) those whose sets may be linked; marks is that of marked()."""
    own = marks.select(F.col("class").alias("hub"), *[F.col(c).alias(f"hub_{c}") for c in ("n", "marks", "hidden")])
    joined = _broadcast_small(pairs).join(marks, "class").join(own, "hub")
    return joined.filter(may_link("hub")).select("hub", "class")


def _broadcast_small(rows: DataFrame) -> DataFrame:
    """rows, written once, and broadcast if there are few enough of them."""
    rows = staged(rows, "small")
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _close(a: str, b: str):
    """Sizes allow a link."""
    return (F.col(a) * 100 >= F.col(b) * PERCENT) & (F.col(b) * 100 >= F.col(a) * PERCENT)


def _leaf_pairs(regions: DataFrame) -> DataFrame:
    """All pairs of small regions whose sizes allow a link."""
    grouped = regions.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("class", "n"))).alias("m"))
    numbered = grouped.select(F.posexplode("m").alias("i", "hub"), "m").select(
        F.col("hub.class").alias("hub"), F.col("hub.n").alias("hub_n"), F.explode(F.expr("slice(m, i + 2, size(m))")).alias("x"))
    return numbered.select("hub", "hub_n", F.col("x.class").alias("class"), F.col("x.n").alias("n")).filter(_close("hub_n", "n")).select("hub", "class")


def _measured_links(pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The exact distances of distinct pairs, and the links (u, v) among them."""
    result = staged(measured(pairs, texts), "measured")
    return result, result.filter("linked").select(F.col("hub").alias("u"), F.col("class").alias("v"))


def _around_centres(large: DataFrame) -> DataFrame:
    """Members with their weight and the centre of their region.

    The centre is the member that meets most others anywhere: it lies close to most of its group.
    """
    weighted = large.withColumn("weight", F.sum("members").over(Window.partitionBy("class"))).drop("members")
    weighted = staged(weighted, "weighted")
    centre = F.max_by(F.struct("class", "n"), F.struct("weight", -F.col("class"))).alias("pivot")
    centres = weighted.groupBy("token").agg(centre).select("token", F.col("pivot.class").alias("pivot"), F.col("pivot.n").alias("pivot_n"))
    return weighted.join(centres, "token")


def _open_regions(rest: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of regions that span several components, with their root, and minor if it is not the main one."""
    labelled = staged(rest.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")), "labelled")
    sizes = labelled.groupBy("token", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("token").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1")
    return labelled.join(main.drop("roots"), "token").withColumn("minor", F.col("root") != F.col("main")).drop("main")


def _without_twins(regions: DataFrame) -> DataFrame:
    """Of regions with the same members one: the others would only name the same pairs again."""
    one, two = F.xxhash64("class"), F.xxhash64("class", F.lit(1))
    named = regions.groupBy("token").agg(F.count("*").alias("members"), F.bit_xor(one).alias("one"), F.bit_xor(two).alias("two"))
    kept = named.groupBy("members", "one", "two").agg(F.min("token").alias("token"))
    return regions.join(kept.select("token", "members"), "token").filter("members > 1")


def component_roots(regions: DataFrame, texts: DataFrame) -> DataFrame:
    """class and root of every class that has a link; regions holds token, class, n.

    First every region is measured against its centre. Then, in regions that still span several
    components, members outside the largest one become pivots, 64 times as many in each round: they
    meet the members of other components inside their window, and then leave the region.
    """
    marks = staged(marked(regions), "marks")
    counted = staged(_without_twins(regions), "regions")
    pairs = _leaf_pairs(counted.filter(F.col("members") <= LEAF).drop("members"))
    met = staged(_around_centres(counted.filter(F.col("members") > LEAF)).filter("class <> pivot"), "met")
    star = met.filter(_close("n", "pivot_n")).select(F.col("pivot").alias("hub"), "class")
    once = pairs.union(star).select(F.least("hub", "class").alias("hub"), F.greatest("hub", "class").alias("class")).distinct()
    result, found = _measured_links(staged(possible(once, marks), "checked"), texts)
    both = result.union(result.select("class", "hub", "linked", "distance")).toDF("pivot", "class", "linked", "distance")
    rest, pivots = met.join(both.drop("linked"), ["pivot", "class"], "left").select("token", "class", "n", "weight", "distance"), 16
    while True:
        roots = components(found).withColumnRenamed("node", "class")
        opened = staged(_open_regions(rest, roots), "open-regions")
        if opened.isEmpty():
            return roots
        best = Window.partitionBy("token").orderBy(F.desc("weight"), "class")
        ranked = opened.filter("minor").withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= pivots)
        chosen = staged(ranked.select("token", "class", "n", "root", "distance"), "pivots")
        # The open regions before this one and the marks of all regions go with every row: they decide inside the join.
        known = opened.groupBy("class").agg(F.collect_list("token").alias("open")).join(marks.drop("n"), "class")
        known = staged(known, "known")

        def with_known(rows: DataFrame) -> DataFrame:
            return rows.join(known, "class").withColumn("before", F.expr("filter(open, t -> t < token)")).drop("open")

        columns = ("class", "n", "root", "distance", "before", "marks", "hidden")
        pivot = with_known(chosen).select("token", *[F.col(c).alias(f"pivot_{c}") for c in columns])
        window = F.coalesce(F.abs(F.col("distance") - F.col("pivot_distance")) <= 1 - PERCENT / 100 + 1e-9, F.lit(True))
        # A pair is named in the first open region that both are in. A pivot that is chosen elsewhere stays there until it is chosen there.
        first = ~F.arrays_overlap("before", "pivot_before")
        apart = (F.col("root") != F.col("pivot_root")) & window & _close("n", "pivot_n")
        near = with_known(opened.drop("weight", "minor")).join(pivot, "token").filter(apart & first & may_link("pivot"))
        once = near.select(F.least("pivot_class", "class").alias("hub"), F.greatest("pivot_class", "class").alias("class")).distinct()
        found = staged(found.union(_measured_links(once, texts)[1]), "links")
        rest = opened.drop("root", "minor").join(chosen.select("token", "class"), ["token", "class"], "left_anti")
        pivots *= 64


def _class_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """class and text of the representatives in wanted (class, doc_id, text_hash)."""
    n_wanted = wanted.count()
    if n_wanted <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    same = [rows["doc_id"].eqNullSafe(wanted["doc_id"]), rows["text_hash"] == wanted["text_hash"]]
    found = staged(rows.join(wanted, same).select("class", "text"), "class-texts")
    # Rows that repeat one id and text are rare; only they cost a shuffle of the texts.
    return found if found.count() == n_wanted else staged(found.groupBy("class").agg(F.min("text").alias("text")), "class-texts")


def classes_and_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per row doc_id, text_hash, n, class; per class its component_id, the smallest doc_id in reach."""
    rows = staged(profiles(docs), "profiles")
    classes = rows.filter("n > 0").groupBy("class").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("doc_id").alias("smallest"))  # only the second skips null ids
    regions = rows.select("class", "n", F.explode("prefix").alias("token"))
    together = Window.partitionBy("token")
    shared = regions.withColumns({"low": F.min("class").over(together), "high": F.max("class").over(together)}).filter("low <> high")
    shared = staged(shared.select("token", "class", "n").distinct(), "shared-regions")
    wanted = shared.select("class").distinct().join(classes, "class").select("class", "first.doc_id", "first.text_hash")
    texts = _class_texts(docs, staged(wanted, "wanted"))
    roots = component_roots(shared, texts)
    joined = classes.select("class", "smallest").join(roots, "class", "left")
    joined = joined.withColumn("root", F.coalesce("root", "class"))
    smallest = joined.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return rows.drop("prefix"), joined.join(smallest, "root").select("class", "component_id")


def component_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs (doc_id, text).

    Null texts and texts without a word have no set and are linked with nothing; equal sets are
    linked; repeated rows repeat; an empty table gives none. A null doc_id is never the smallest.
    """
    rows, found = classes_and_components(docs)
    joined = rows.join(found, "class", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay: of each component the smallest doc_id, and every row without a word.

    The columns stay as they are. Rows that repeat the surviving doc_id of a component stay together.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, found = classes_and_components(plain)
    gone = rows.join(found, "class").filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_hash").distinct()
    key, mark = own_columns(docs, "gone_id", "gone_hash")
    gone = gone.select(F.col("doc_id").alias(key), F.col("text_hash").alias(mark))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = docs[doc_id].cast("long").eqNullSafe(gone[key]) & (F.xxhash64(docs[text]) == gone[mark])
    return docs.join(gone, same, "left_anti")
