"""Merge semantics as pure DataFrame functions of (target, batch)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import null_safe_join


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first in ``order``; an aggregate with map-side combine, so
    a key with very many rows is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    body, rank = F.struct(*rest), F.struct(*order)
    return df.groupBy(*keys).agg(F.min_by(body, rank).alias("_row")).select(*keys, "_row.*")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    body, rank = F.struct(*rest), F.struct(*order)
    return df.groupBy(*keys).agg(F.max_by(body, rank).alias("_row")).select(*keys, "_row.*")


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Target plus the first row of every key it lacks."""
    return target.unionByName(insertable(target, batch, keys, order).select(*target.columns))


def insertable(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    return first_per_key(batch, keys, order).join(target.select(*keys), list(keys), "left_anti")


def upsert_overwrite(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Batch values replace the target's on equal keys; the last row of a key wins."""
    t = target.alias("t")
    s = last_per_key(batch, keys, order).withColumn("_hit", F.lit(True)).alias("s")
    same = reduce(and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    joined = t.join(s, same, "full_outer")
    out = []
    for c in target.columns:
        taken = F.when(F.col("s._hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        out.append(taken.alias(c))
    return joined.select(*out)


def additive(
    rows: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    firsts: Sequence[str],
    order: Sequence[str],
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key: ``sums`` added up, ``firsts`` from the row that came first, and further
    aggregates by name.

    Of rows equal in ``order`` that with the smallest ``firsts`` counts. Without ``extra`` the result has the same columns as the input, so merging is associative: contributions may
    be combined per batch, then across batches, in any grouping.
    """
    # Order and values in one struct: with a rank beside it the order would be moved twice.
    kept = F.min(F.struct(*order, *firsts)).alias("_first")
    added = [F.sum(c).cast(dict(rows.dtypes)[c]).alias(c) for c in sums]
    others = [c.alias(n) for n, c in (extra or {}).items()]
    merged = rows.groupBy(*keys).agg(*added, *others, kept)
    return merged.select(*keys, *sums, *[f"_first.{c}" for c in (*firsts, *order)], *(extra or {}))


def merge_counts(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """inserted = keys new to the target, updated = all other accepted rows of the batch."""
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    known = target.select(*keys).withColumn("_known", F.lit(True))
    joined = null_safe_join(per_key, known, keys, "left")
    fresh = F.count_if(F.col("_known").isNull())
    return joined.agg(
        fresh.alias("inserted"),
        (F.coalesce(F.sum("_rows"), F.lit(0)) - fresh).alias("updated"),
    )
