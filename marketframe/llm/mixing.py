"""Mixing sources to target weights: capped water-filling, then seeded repetition of documents.

Native: everything is DataFrame operations. No source is ever gathered in one task: the cut of a
source is found in a histogram of hash buckets, then inside the one bucket that holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, digest60, own_columns, rows_before, staged

#: The 60-bit order of documents is cut into 2^20 buckets for the first step.
_BUCKET_BITS, _ORDER_BITS = 20, 60


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycling_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, .. cycle, 1, .. for sources in code-point order, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source_null"), F.col("source_key")))
    return sources.withColumn("weight", ((rank - 1) % cycle + 1).cast("double"))


def water_fill(sources: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """Targets that sum to the size of all sources, in proportion to weight, none above its cap.

    A source whose share exceeds max_epochs times its size is clamped there and the excess goes to
    the others by weight, until none is above. Clamping in the order of cap / weight reaches the
    same fixed point in one pass: the clamped sources are always a prefix of that order. The
    windows see one row per source.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_null", "source_key")
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole)
    caps = (
        sources.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("total", total.cast("double"))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("clamped", F.col("cap") * F.col("weight_left") < (F.col("total") - F.col("cap_before")) * F.col("weight"))
    )
    used = F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(whole), F.lit(0.0))
    free = F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(whole)
    target = F.when(F.col("clamped"), F.col("cap")).otherwise((F.col("total") - used) * F.col("weight") / free)
    return caps.withColumn("target", target).select("source_null", "source_key", "source_size", "target")


def sized(docs: DataFrame, seed: int, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> tuple[DataFrame, dict]:
    """The documents with size, source key and seeded order; also the names given to these columns."""
    names = ("size", "source_null", "source_key", "order")
    cols = dict(zip(names, own_columns(docs, *names)))
    identity = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return docs.withColumns({
        cols["size"]: n_words(F.col(text)),
        cols["source_null"]: F.col(source).isNull(),
        cols["source_key"]: F.coalesce(F.col(source), F.lit("")),
        cols["order"]: digest60(identity),
    }), cols


def mixing_plan(items: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """One row per source: its target, whole repetitions, and the order below which one more is due.

    items has source_null, source_key, size and order. Documents of a source stand in a seeded
    random order; the first ones, up to the words that whole repetitions leave missing, are taken
    once more. The document at the cut is in if more than half of it fits, so a source misses its
    target by at most half a document. Documents with one order value share their fate.
    """
    keys = ["source_null", "source_key"]
    sources = items.groupBy(*keys).agg(F.sum("size").alias("source_size"))
    rate = F.col("target") / F.col("source_size")
    targets = (
        water_fill(cycling_weights(sources), max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(rate)).otherwise(F.lit(0)).cast("long"))
        .withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    targets = staged(targets, "mix-targets")
    bucket = F.shiftright(F.col("order"), _ORDER_BITS - _BUCKET_BITS).alias("bucket")
    histogram = items.groupBy(*keys, bucket).agg(F.sum("size").alias("filled"))
    histogram = histogram.withColumn("before", F.coalesce(F.sum("filled").over(rows_before(keys, ["bucket"])), F.lit(0)))
    cut_bucket = (
        histogram.join(targets, keys)
        .filter((F.col("before") <= F.col("missing")) & (F.col("missing") < F.col("before") + F.col("filled")))
        .select(*keys, "bucket", "before", "missing")
    )
    same_order = items.withColumn("bucket", bucket).groupBy(*keys, "bucket", "order").agg(F.sum("size").alias("size"))
    inside = same_order.join(cut_bucket, [*keys, "bucket"])
    ahead = F.col("before") + F.coalesce(F.sum("size").over(rows_before([*keys, "bucket"], ["order"])), F.lit(0))
    fits = ahead + F.col("size") / 2 <= F.col("missing")
    cuts = (
        inside.withColumn("fits", fits)
        .groupBy(*keys)
        .agg(F.coalesce(F.max(F.when(F.col("fits"), F.col("order"))),
                        F.shiftleft(F.min("bucket"), _ORDER_BITS - _BUCKET_BITS) - 1).alias("cut"))
    )
    # No bucket holds the cut of a source that misses nothing it has: all or none of it is due.
    edge = F.when(F.col("missing") > 0, F.lit((1 << _ORDER_BITS) - 1)).otherwise(F.lit(-1))
    return targets.join(cuts, keys, "left").withColumn("cut", F.coalesce("cut", edge)).select(
        *keys, "source_size", "target", "whole", "cut")


def with_repeats(docs: DataFrame, seed: int = 17, max_epochs: float = 3.0, **columns: str) -> tuple[DataFrame, dict]:
    """Every document with its size, its source's size and target, and how often the mix takes it.

    docs keeps all its columns, whatever their names; the second result maps size, source_size,
    target and repeats to the names they got. Null or empty texts have size 0 and cost nothing;
    a null source is a source of its own, ordered last; repeated rows count each; an empty table
    gives an empty table. No document is repeated more than ceil(max_epochs) times.
    """
    frame, cols = sized(docs, seed, **columns)
    narrow = staged(frame.select(*[F.col(cols[c]).alias(c) for c in ("size", "source_null", "source_key", "order")]), "mix-items")
    # One row per source; written, so that its size is known and Spark need not shuffle the texts to meet it.
    plan = staged(mixing_plan(narrow, max_epochs), "mix-plan")
    added = ("source_size", "target", "repeats", "whole", "cut")
    names = dict(zip(added, own_columns(frame, *added)))
    plan = plan.select(
        F.col("source_null").alias(cols["source_null"]), F.col("source_key").alias(cols["source_key"]),
        *[F.col(c).alias(names[c]) for c in ("source_size", "target", "whole", "cut")],
    )
    joined = frame.join(plan, [cols["source_null"], cols["source_key"]])
    repeats = F.col(names["whole"]) + (F.col(cols["order"]) <= F.col(names["cut"])).cast("long")
    out = joined.withColumn(names["repeats"], repeats)
    out = out.drop(cols["source_null"], cols["source_key"], cols["order"], names["whole"], names["cut"])
    return out, {"size": cols["size"], **{c: names[c] for c in ("source_size", "target", "repeats")}}


def mix(docs: DataFrame, seed: int = 17, max_epochs: float = 3.0) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with the columns of docs."""
    out, cols = with_repeats(docs, seed, max_epochs)
    copies = F.sequence(F.lit(1), F.col(cols["repeats"]).cast("int"))
    kept = out.filter(F.col(cols["repeats"]) > 0).withColumn(own_columns(out, "copy")[0], F.explode(copies))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
