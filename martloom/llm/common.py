"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that ends a word, as the contracts name it (space, tab to CR).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_crc(column: str) -> Column:
    """crc32 of a key as text; null keys count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def partitions_for(rows: int, per_task: int) -> int:
    """Number of blocks that keeps each near ``per_task`` rows."""
    return max(1, -(-rows // per_task))


def beside(small: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """A written table of narrow rows as a join side: sent to all tasks if it has at most
    ``max_rows`` rows (tens of MB), else left to a shuffled join."""
    if small.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(small)
    return small


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def in_large_files(df: DataFrame, source: DataFrame, column: str = "text", per_task: int = 128 << 20) -> DataFrame:
    """``df``, made from the rows of ``source``, in no more partitions than its text fills or there
    are cores, so that many small partitions aren't written as many small files."""
    total = source.agg(F.sum(F.octet_length(column))).first()[0] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, partitions_for(total, per_task)))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Lowers the rows of an Arrow batch for what is written inside: a worker that reads whole texts then holds
    a few MB of them at once instead of 10,000 texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release_memory() -> None:
    """Gives freed memory back to the system: idle Python workers of a stage live on beside the next one."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A mapper of batches that gives its memory back when its task ends."""

    def held(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return held
