"""Keyed merges: one operator with a rule per column, plus source precedence."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import DateLike, as_date, between_days

OVERWRITE = "overwrite"  # the batch value wins, NULL included
COALESCE = "coalesce"    # a non-NULL batch value wins
KEEP = "keep"            # the stored value stays; new rows take the batch value or the stamp
NOW = "now"              # stamped whenever the batch touches the row
RULES = (OVERWRITE, COALESCE, KEEP, NOW)


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key in the given order.

    The rank-1 filter is pushed below the shuffle, so a key with very many copies leaves at
    most one row per input partition before rows move.
    """
    latest_first = [F.col(c).desc_nulls_last() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def merge_keyed(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    rules: dict[str, str],
    *,
    now: dt.datetime | None = None,
    only_if_changed: Sequence[str] | None = None,
    insert: bool = True,
    defaults: dict[str, object] | None = None,
    carried_from: tuple[str, dict[str, int]] | None = None,
) -> DataFrame:
    """Merge ``updates`` into ``target`` on ``keys`` and return the whole merged table.

    ``rules`` names the columns the batch owns. Other columns keep the stored value, and
    take ``defaults`` (else NULL) on inserted rows. ``only_if_changed`` leaves a stored row
    untouched unless one of those columns differs, NULLs compared as values.
    ``insert=False`` never adds keys. ``updates`` must be unique on ``keys``.

    ``carried_from`` is for batches that mix layouts: it names a batch column and, per owned
    column, the least value of it from which a row carries that column. A row that does not
    carry a column leaves the stored value, while a carried NULL is merged by its rule.
    """
    unknown = {r for r in rules.values()} - set(RULES)
    if unknown:
        raise ValueError(f"unknown merge rules: {sorted(unknown)}")
    stray = [c for c in rules if c not in target.columns]
    if stray:
        raise ValueError(f"columns not in the target: {stray}")
    missing = [c for c in keys if c not in updates.columns]
    if missing:
        raise ValueError(f"updates lack key columns: {missing}")
    types = dict(target.dtypes)
    carried = {c for c in updates.columns if c in types and c not in keys}
    stored = target.selectExpr(
        *[_id(k) for k in keys], *[f"{_id(c)} AS {_id('_t_' + c)}" for c in types if c not in keys], "true AS _t"
    )
    batch = updates.selectExpr(
        *[f"CAST({_id(k)} AS {types[k]}) AS {_id(k)}" for k in keys],
        *[f"CAST({_id(c)} AS {types[c]}) AS {_id('_u_' + c)}" for c in types if c in carried],
        "true AS _u",
        *([f"{_id(carried_from[0])} AS _layout"] if carried_from else []),
    )
    joined = stored.join(batch, list(keys), "full" if insert else "left")

    applies = "_u IS NOT NULL"
    if only_if_changed:
        same = " AND ".join(f"{_id('_t_' + c)} <=> {_id('_u_' + c)}" for c in only_if_changed)
        applies = f"_u IS NOT NULL AND (_t IS NULL OR NOT ({same}))"
    out = []
    for c in types:
        if c in keys:
            out.append(F.col(_id(c)))
            continue
        old, new, rule = _id("_t_" + c), _id("_u_" + c), rules.get(c)
        stamp = f"TIMESTAMP_NTZ '{now.isoformat(sep=' ')}'" if now is not None else "localtimestamp()"
        needed = carried_from[1].get(c) if carried_from else None
        owned = applies if needed is None else f"({applies}) AND _layout >= {needed}"
        if rule == NOW:
            value = f"CASE WHEN {applies} THEN {stamp} ELSE {old} END"
        elif rule == KEEP:
            value = f"CASE WHEN _t THEN {old} ELSE {new if c in carried else stamp} END"
        elif rule is None or c not in carried:  # not owned, or owned but absent from this batch
            default = F.lit((defaults or {}).get(c)).cast(types[c])
            out.append(F.when(F.col("_t"), F.col(old)).otherwise(default).cast(types[c]).alias(c))
            continue
        elif rule == COALESCE:
            value = f"CASE WHEN {owned} THEN coalesce({new}, {old}) ELSE {old} END"
        else:
            value = f"CASE WHEN {owned} THEN {new} ELSE {old} END"
        out.append(F.expr(f"CAST({value} AS {types[c]}) AS {_id(c)}"))
    return joined.select(*out)


def _id(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Partition units of a store: what a dynamic overwrite replaces as a whole.
DAY, MONTH = "day", "month"
#: Distinct days that are listed alone in a filter; more get bounds by month too, which prune better.
MAX_LISTED_DAYS = 200


def partition_unit(touched: str | None) -> str | None:
    """DAY or MONTH as named; None (or anything empty) for the whole table."""
    unit = touched or None
    if unit not in (None, DAY, MONTH):
        raise ValueError(f"name the unit the store is partitioned by, {DAY!r} or {MONTH!r}, not {touched!r}")
    return unit


def month_bounds(first: dt.date, last: dt.date) -> tuple[dt.date, dt.date | None]:
    """First day of the first month and first day after the last one, None after December 9999."""
    after = last.year * 12 + last.month
    return dt.date(first.year, first.month, 1), dt.date(after // 12, after % 12 + 1, 1) if after < 120000 else None


def in_partitions(day: Column, begin: DateLike | None, end: DateLike | None, unit: str | None) -> Column:
    """``between_days`` widened to whole partitions."""
    if unit != MONTH:
        return between_days(day, begin, end)
    first = None if begin is None else month_bounds(as_date(begin), as_date(begin))[0]
    after = None if end is None else month_bounds(as_date(end), as_date(end))[1]
    until = between_days(day, first, None)
    return until if after is None else until & (day < F.lit(after))


def touched(updates: DataFrame, day: str, kind: str = "date", unit: str = DAY) -> Column | None:
    """Filter on ``day`` for the partitions (days or whole months) that ``updates`` has rows for.

    The unit alone decides which rows pass, never the number of days. Rows without a day are a
    partition too. The days are read first: at most one row per calendar day (about 36,500 a
    century). Listed days or spans of months keep one stale row from widening the filter to all
    history. None when there is no row at all.
    """
    found = [r["d"] for r in updates.select(F.col(day).cast(kind).alias("d")).distinct().collect()]
    days = sorted(d for d in found if d is not None)
    dayless = F.col(day).isNull() if len(days) < len(found) else None
    if not days:
        return dayless
    inside = F.lit(False)
    spans: list[list[dt.date | None]] = []
    for d in days if unit == MONTH or len(days) > MAX_LISTED_DAYS else []:
        first, after = month_bounds(d, d)
        if spans and (spans[-1][1] is None or spans[-1][1] >= first):
            spans[-1][1] = after
        else:
            spans.append([first, after])
    for first, after in spans:
        span = F.col(day) >= F.lit(first)
        inside = inside | (span if after is None else span & (F.col(day) < F.lit(after)))
    if unit == DAY:
        inside = inside & F.col(day).isin(days) if spans else F.col(day).isin(days)
    return inside if dayless is None else inside | dayless


def merge_touched(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], rules: dict[str, str], day: str, unit: str | None, **options
) -> DataFrame:
    """``merge_keyed`` that reads and returns only the partitions the batch has, whole.

    ``unit`` is what the store is partitioned by, DAY or MONTH: all rows of those partitions come
    back, so a dynamic overwrite loses none. Without it (None) the days of the batch are joined and the rest of
    the target follows unchanged; it is read apart and never shuffled. The filter on ``day``
    reaches the target's scan and prunes partitions and row groups.
    """
    inside = touched(updates, day, dict(target.dtypes)[day], unit or DAY)
    if inside is None:  # an empty batch touches nothing
        inside = F.lit(False)
    merged = merge_keyed(target.where(inside), updates, keys, rules, **options)
    return merged if unit else target.where(~F.coalesce(inside, F.lit(False))).unionByName(merged)


def merge_window(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], rules: dict[str, str], day: str, **options
) -> DataFrame:
    """``merge_keyed`` that joins only the days the batch spans.

    The span is read first (one row); the target outside it passes through without a
    shuffle, and the filter on ``day`` prunes partitions and row groups of the part inside.
    """
    span = updates.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if span["first"] is None:
        return target
    inside = F.coalesce(F.col(day).between(F.lit(span["first"]), F.lit(span["last"])), F.lit(False))
    merged = merge_keyed(target.where(inside), updates, keys, rules, **options)
    return target.where(~inside).unionByName(merged)


def update_keyed(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Set computed columns on matching rows; never adds or drops a key."""
    return merge_keyed(target, updates, keys, {c: OVERWRITE for c in columns}, insert=False)


def dedup_by_values(df: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the last by ``order``, and of rows that tie the greatest by all other columns.

    The result depends on the rows alone, never on their arrival.
    """
    others = [c for c, kind in df.dtypes if c not in keys and c != order and not kind.startswith("map")]
    return dedup_last(df, keys, [*([order] if order else []), *others]) if order or others else df.dropDuplicates(list(keys))


def merge_present(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], owned: Sequence[str], *, day: str | None = None, unit: str | None = None, **options
) -> DataFrame:
    """Overwrite only those owned columns that the batch carries; stamp ``updated_at``.

    With ``day`` only the days of the batch are joined, and with ``unit`` only their whole partitions are returned.
    """
    rules = {c: OVERWRITE for c in owned if c in updates.columns}
    if "updated_at" in target.columns:
        rules["updated_at"] = NOW
    if day is not None:
        return merge_touched(target, updates, keys, rules, day, unit, **options)
    return merge_keyed(target, updates, keys, rules, **options)


def fallback_union(primary: DataFrame, secondary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Primary rows plus the secondary rows of those ``on`` groups the primary lacks.

    The group list is made distinct map-side before it moves; the anti-join then follows
    its measured size.
    """
    covered = primary.select(*on).distinct()
    return primary.unionByName(
        secondary.join(covered, list(on), "left_anti"), allowMissingColumns=True
    )


def first_available(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Row-level source precedence: for each key the row of the earliest source that has it."""
    if not sources:
        raise ValueError("no sources given")
    ranked = None
    for priority, source in enumerate(sources):
        tagged = source.withColumn("_priority", F.lit(-priority))
        ranked = tagged if ranked is None else ranked.unionByName(tagged, allowMissingColumns=True)
    return dedup_last(ranked, keys, ["_priority"]).drop("_priority")


def concat_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Stack per-source frames by column name; a column a source lacks is NULL."""
    if not sources:
        raise ValueError("no sources given")
    stacked = sources[0]
    for source in sources[1:]:
        stacked = stacked.unionByName(source, allowMissingColumns=True)
    return stacked
