"""Industry hierarchy: derive it from names, and expand memberships to all levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import SHARE_BOARDS, in_boards
from .merge import dedup_last

# Fixed value: first day of the newer classification version.
NEW_VERSION_SINCE = "2021-07-30"


def cell_text(cell: Column) -> Column:
    """Trimmed text; NULL and ``nan`` read as empty."""
    bare = F.trim(F.coalesce(cell.cast("string"), F.lit("")))
    return F.when(F.lower(bare) == "nan", "").otherwise(bare)


def industry_code_text(cell: Column) -> Column:
    """Repair codes that went through a float (``110000.0``)."""
    return F.regexp_replace(cell_text(cell), r"^(\d+)\.0$", "$1")


def derive_hierarchy(
    raw: DataFrame, version: str, code: str, level1: str, level2: str, level3: str, order: str
) -> DataFrame:
    """Level, own name and parent code from one row per node with its three level names.

    A blank second name marks level 1, a blank third name level 2. Parents are looked up by
    name path among the rows of the level above; where a name path repeats, the last row in
    ``order`` is the parent. Duplicate codes keep their last row.
    """
    nodes = raw.select(
        industry_code_text(F.col(code)).alias("industry_code"),
        cell_text(F.col(level1)).alias("_l1"),
        cell_text(F.col(level2)).alias("_l2"),
        cell_text(F.col(level3)).alias("_l3"),
        F.col(order).alias("_order"),
    ).where(F.col("industry_code") != "")
    level = F.when(F.col("_l2") == "", 1).when(F.col("_l3") == "", 2).otherwise(3)
    nodes = nodes.withColumn("sw_level", level)
    name = F.when(F.col("sw_level") == 1, F.col("_l1")).when(F.col("sw_level") == 2, F.col("_l2")).otherwise(F.col("_l3"))
    # A node's parent path: nothing for level 1, (l1) for level 2, (l1, l2) for level 3.
    parent_l2 = F.when(F.col("sw_level") == 2, F.lit("")).otherwise(F.col("_l2"))
    parents = (
        nodes.where(F.col("sw_level") < 3)
        .groupBy(F.col("_l1").alias("_p1"), F.when(F.col("sw_level") == 2, F.col("_l2")).otherwise("").alias("_p2"))
        .agg(F.max_by("industry_code", "_order").alias("_parent"))
    )
    linked = (
        nodes.withColumn("_up1", F.when(F.col("sw_level") > 1, F.col("_l1")))
        .withColumn("_up2", F.when(F.col("sw_level") > 1, parent_l2))
        .join(parents, (F.col("_up1") == F.col("_p1")) & (F.col("_up2") == F.col("_p2")), "left")
    )
    rows = linked.select(
        F.lit(version).alias("sw_version"), "industry_code", name.alias("industry_name"), "sw_level",
        F.col("_parent").alias("parent_code"), "_order",
    )
    return dedup_last(rows, ["sw_version", "industry_code"], ["_order"]).drop("_order")


def expand_membership(history: DataFrame, master: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Membership history with version and the code and name of all three levels.

    The hierarchy first collapses to one row per (version, level-3 code) with its whole
    path, so the history is joined once. Levels that are not found stay NULL.
    """
    versioned = history.withColumn(
        "sw_version",
        F.when(F.col("start_date") < F.lit(NEW_VERSION_SINCE).cast("date"), "2014").otherwise("2021"),
    )

    def level(n: int) -> DataFrame:
        return hierarchy.where(F.col("sw_level") == n).select(
            "sw_version",
            F.col("industry_code").alias(f"sw_l{n}_code"),
            F.col("industry_name").alias(f"sw_l{n}_name"),
            F.col("parent_code").alias(f"_up{n}"),
        )

    paths = level(3)
    for lower, upper in ((3, 2), (2, 1)):
        above = level(upper).withColumnRenamed(f"sw_l{upper}_code", "_code")
        paths = (
            paths.join(
                above.withColumnRenamed("_code", f"_up{lower}"), ["sw_version", f"_up{lower}"], "left"
            )
            .withColumn(f"sw_l{upper}_code", F.when(F.col(f"sw_l{upper}_name").isNotNull(), F.col(f"_up{lower}")))
        )
    shares = master.where(in_boards(F.col("board"), SHARE_BOARDS)).select("symbol", "code")
    return (
        versioned.join(shares, "symbol")
        .join(
            paths.withColumn("industry_code", F.col("sw_l3_code")), ["sw_version", "industry_code"], "left"
        )
        .select(
            "code", "symbol", "start_date", F.col("start_date").alias("effective_date"), "sw_version",
            "sw_l1_code", "sw_l1_name", "sw_l2_code", "sw_l2_name", "sw_l3_code", "sw_l3_name",
            "industry_code", "update_time", "updated_at",
        )
    )
