"""Contiguous shards of near equal bytes, cut from global prefix sums of sizes.

Rows are ordered by ``order_by``, dealt by range into blocks, and each block's own running sums are taken in
the task that sorts it. The blocks' totals, one row per block, give each block its offset in rows and
bytes. The bytes before a row and half its own place it on the line from 0 to the total, which is cut into
``shards`` equal parts: a shard's bytes differ from a part by no more than about the sizes of the rows
at its two cuts.

The rows are written once with a number each before they are dealt. Rows that are equal in all columns
of ``order_by`` are ordered by that number, so that a key with a third of all rows is cut into
several blocks like any other rows; a retried task reads the same rows again and places them alike. The result
depends on nothing but the data if ``order_by`` tells all rows apart that differ in the result.

Defined results: null sizes count as 0 and negative ones are an error; null keys come first; repeated rows
are placed one after the other; an empty table gives no rows; a row that is larger than a part may leave
shards empty; with a total of 0 all rows are in shard 0; further columns are carried along, and names of
working columns give way to them. ``shards * 2 * total`` must fit a long: 100 TB in 40,000 shards do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import stage
from .common import beside, free_name, partitions_for

BLOCK_ROWS = 500_000
BLOCK_BYTES = 256 << 20


def _running(size: str, block: str, row: str, before: str):
    """Adds the block's number and the rows and bytes before each row in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(size)
            if batch.num_rows and pc.min(sizes).as_py() < 0:
                raise ValueError(f"negative size in {size}")
            sums = pc.add(pc.cumulative_sum(sizes), total)
            columns = [
                *batch.columns,
                pa.repeat(pa.scalar(number, pa.int64()), batch.num_rows),
                pa.array(range(rows, rows + batch.num_rows), pa.int64()),
                pc.subtract(sums, sizes),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, block, row, before])
            if batch.num_rows:
                rows, total = rows + batch.num_rows, sums[-1].as_py()

    return run


def assign(rows: DataFrame, shards: int, order_by: list[str], size: str, per_block: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (position in the shard, from 0)."""
    if shards < 1:
        raise ValueError("at least one shard")
    names = {c.lower() for c in rows.columns}
    if {"shard", "slot"} & names:
        raise ValueError("the rows have a column named shard or slot")
    at, weight, block, row, before = (free_name(rows, c) for c in ("_at", "_weight", "_block", "_row", "_before"))
    fixed = stage(
        rows.withColumn(weight, F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long"))).withColumn(at, F.monotonically_increasing_id()),
        "numbered",
    )
    blocks = partitions_for(fixed.count(), per_block)
    dealt = fixed.repartitionByRange(blocks, *order_by, at).sortWithinPartitions(*order_by, at)
    long = lambda name: T.StructField(name, T.LongType())
    schema = T.StructType([*fixed.schema.fields, long(block), long(row), long(before)])
    placed = stage(dealt.mapInArrow(_running(weight, block, row, before), schema), "blocks")

    earlier = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    first, base, total = (free_name(placed, c) for c in ("_first", "_base", "_total"))
    totals = placed.groupBy(block).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("b"))
    offsets = stage(
        totals.select(
            block,
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(first),
            F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias(base),
            F.sum("b").over(Window.partitionBy()).alias(total),
        ),
        "offsets",
    )
    middle = 2 * (F.col(base) + F.col(before)) + F.col(weight)
    parted = (
        placed.join(beside(offsets), block)
        .withColumn("shard", _part(middle, F.col(total), shards))
        .withColumn(row, F.col(first) + F.col(row))
    )
    start = free_name(parted, "_start")
    starts = stage(parted.groupBy("shard").agg(F.min(row).alias(start)), "starts")
    # One row per shard.
    return parted.join(F.broadcast(starts), "shard").select(*rows.columns, "shard", (F.col(row) - F.col(start)).alias("slot"))


def _part(middle: Column, total: Column, shards: int) -> Column:
    """Number of the equal part that holds a point, given twice its distance from 0; integers throughout."""
    whole = 2 * F.greatest(total, F.lit(1).cast("long"))
    return F.least(F.call_function("div", middle * F.lit(shards).cast("long"), whole), F.lit(shards - 1).cast("long")).cast("int")


def write(assigned: DataFrame, path: str, size: str, per_file: int = BLOCK_BYTES) -> None:
    """The shards as folders ``shard=...`` of Parquet files; within a shard, file by file, rows are in slot order."""
    total = assigned.agg(F.sum(size)).first()[0] or 0
    parts = partitions_for(total, per_file)
    assigned.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
