"""Ordered operators without a single-task window: numbering, running totals, ranks.

All rest on range blocks: rows are range-partitioned by the ordering, each row remembers its
block, and the result is written once. Work inside a block is an ordinary window over that
block; what links the blocks is one row per block (and group). No task ever sees more than its
own range, however large one group is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage

BLOCK = "_block"


def range_blocks(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Range-partition by ``order`` and keep the partition number as a column.

    Adaptive execution joins neighbouring ranges of a small table, so their number follows the
    data's bytes; ``blocks`` fixes it where the work on a row is what counts. The table is written because the bounds come from a sample: two evaluations could cut
    differently, and offsets and rows must agree on the cut.
    """
    sizes = [] if blocks is None else [blocks]
    ranged = df.repartitionByRange(*sizes, *order).withColumn(BLOCK, F.spark_partition_id())
    return stage(ranged, "blocks")


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the left key columns are kept."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], F.lit(True))
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in keys])


def running_total(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    running: str = "running",
    total: str = "total",
) -> DataFrame:
    """Inclusive running sum of ``value`` in ``order`` per group, plus the group's total.

    ``order`` must be unique within a group, as it is after aggregating on it.
    """
    by = list(by)
    blocks = range_blocks(df, [*by, *order])
    keys = [*by, BLOCK]
    sums = blocks.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    group = Window.partitionBy(*by)
    before = group.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(group).alias(total),
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocks.withColumn("_inside", F.sum(value).over(inside))
    joined = null_safe_join(summed, offsets, keys)
    return joined.select(
        *df.columns, (F.col("_inside") + F.col("_before")).alias(running), total
    )


def dense_numbers(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in ``order`` (unique rows), counted per range block.

    A block is sorted before it is written, and each row keeps its place there, so blocks are neither
    shuffled nor sorted again to number them.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id is the partition's number, then 33 bits for the row's place in it.
    blocks = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "blocks")
    blocks = blocks.withColumn(BLOCK, F.shiftright("_place", 33))
    sizes = blocks.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per block, so it may be sent to every task.
    joined = blocks.join(F.broadcast(offsets), BLOCK)
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    number = inside + F.col("_before") + F.lit(start)
    return joined.select(*df.columns, number.cast("long").alias(name))


def average_ranks(df: DataFrame, score: str, by: Sequence[str] = (), count: str = "n") -> DataFrame:
    """Average rank of each distinct score, ties sharing their mean rank.

    ``df`` holds one row per distinct score (and group) with its number of rows in ``count``.
    """
    ranked = running_total(df, count, [score], by)
    middle = F.col("running") - (F.col(count) - 1) / F.lit(2.0)
    return ranked.withColumn("avg_rank", middle.cast("double"))
