"""As-of matching over sampled ranges, for times that no chunk width bounds.

Both sides are dealt to tasks by ranges of (key, time) and sorted there. A task runs through its
range once and hands every left row the last right row of its key so far; it holds one batch. What
a range needs from earlier ones is the last right row of its first key, found over one row per
range. A range boundary can fall anywhere, also inside one key and one moment, so neither has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged

_ROW, _HEAD, _TAIL = 0, 1, 2  # kinds of rows a range returns: a left row, its first key, its last key with what is known there


def _differs(column: pa.Array) -> np.ndarray:
    """For every row but the first, whether it differs from the row before; nulls equal nulls."""
    now, before = column.slice(1), column.slice(0, len(column) - 1)
    unequal = pc.fill_null(pc.not_equal(now, before), False).to_numpy(zero_copy_only=False)
    return unequal | (now.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))


def _scan(keys: list[str], values: list[str], names: list[str]):
    """Run through one range. ``names`` are the columns to return; ``values`` are null on left rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None  # one row: the key so far, and the last known values of it
        in_first_key = True

        def returned(table: pa.Table, kind: int, open_: np.ndarray) -> list[pa.RecordBatch]:
            n = table.num_rows
            extra = {"_part": pa.array(np.full(n, part, np.int32)), "_kind": pa.array(np.full(n, kind, np.int32)), "_open": pa.array(open_)}
            return table.append_column("_part", extra["_part"]).append_column("_kind", extra["_kind"]).append_column(
                "_open", extra["_open"]).select(names).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if last is None:
                yield from returned(rows.slice(0, 1), _HEAD, np.array([False]))
            else:
                rows = pa.concat_tables([last, rows])
            rows = rows.combine_chunks()
            n = rows.num_rows
            fresh = np.zeros(n, bool)
            for k in keys:
                fresh[1:] |= _differs(rows.column(k).combine_chunks())
            begin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
            known = rows.column("_hit").is_valid().to_numpy()
            at = np.maximum.accumulate(np.where(known, np.arange(n), -1))
            found = at >= begin
            still_first = (begin == 0) & in_first_key
            in_first_key = bool(still_first[-1])
            source = pa.array(at, mask=~found)
            filled = rows
            for name in values:
                i = filled.schema.get_field_index(name)
                filled = filled.set_column(i, filled.schema.field(i), rows.column(name).take(source))
            last = filled.slice(n - 1, 1)
            left = rows.column("_is_left").to_numpy().copy()
            left[: n - batch.num_rows] = False  # the row handed on is not returned again
            kept = np.flatnonzero(left)
            yield from returned(filled.take(pa.array(kept)), _ROW, (still_first & ~found)[kept])
        if last is not None:
            yield from returned(last, _TAIL, np.array([False]))

    return run


def asof_ranges(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, names: dict[str, str], how: str, strict: bool,
    tick: tuple[Column, Column],
) -> DataFrame:
    """``joins.asof_join`` by ranges: any number of left rows may share a key and a time.

    ``tick`` is the order of the left and of the right times. Rows without a key or a time match nothing.
    Needs a shared folder: sorted ranges are written once and read twice.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    held = [f"_l{i}" for i in range(len(left.columns))]
    values = [f"_v{i}" for i in range(len(names))] + ["_hit"]
    left_first = 0 if strict else 1
    lefts = left.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)], *[F.col(f"`{c}`").alias(h) for c, h in zip(left.columns, held)],
        tick[0].alias("_tick"), F.lit(left_first).alias("_side"), F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]).alias("_tie"), F.lit(True).alias("_is_left"))
    complete = tick[1].isNotNull()
    for c in on:
        complete &= F.col(f"`{c}`").isNotNull()
    rights = right.where(complete).select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)], *[F.col(f"`{c}`").alias(v) for c, v in zip(names, values)],
        F.lit(True).alias("_hit"), tick[1].alias("_tick"), F.lit(1 - left_first).alias("_side"), F.lit(0).cast("long").alias("_tie"), F.lit(False).alias("_is_left"))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    order = [*keys, "_tick", "_side", "_tie"]
    ranged = both.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tick", "_side", "_tie")
    kept = [c for c in ranged.columns if c != "_is_left"]
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_kind", T.IntegerType()), T.StructField("_open", T.BooleanType()),
                           *(T.StructField(c, ranged.schema[c].dataType) for c in kept)])
    scanned = staged(ranged.mapInArrow(_scan(keys, values, schema.names), schema), "asof-ranges")

    # One row per range from here on, until the rows themselves are filled.
    known = F.when(F.col("_hit"), F.struct(*values))
    ends = scanned.where(F.col("_kind") != _ROW).select("_part", "_kind", *keys, F.when(F.col("_kind") == _TAIL, known).alias("_tail"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carry", F.last("_tail", ignorenulls=True).over(earlier)).where((F.col("_kind") == _HEAD) & F.col("_carry").isNotNull())
    rows = scanned.where(F.col("_kind") == _ROW).join(F.broadcast(carried.select("_part", "_carry")), "_part", "left")
    own = F.struct(*values)
    match = F.when(F.col("_hit"), own).when(F.col("_open"), F.col("_carry"))
    matched = rows.withColumn("_match", match)
    if how == "inner":
        matched = matched.where(F.col("_match").isNotNull())
    return matched.select(*[F.col(h).alias(c) for h, c in zip(held, left.columns)],
                          *[F.col("_match")[v].alias(target) for v, target in zip(values, names.values())])
