"""Duplicates without a window over the key.

A window would sort all rows of a key in one task. Here each key is first reduced map-side; only
keys that occur more than once are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import null_safe_join


def _rank(order: Sequence[str]) -> Column:
    """What orders rows: one column as it is, which a hash aggregate can hold if its width is fixed."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def repeated_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rank = _rank(order)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("group_size"), F.min(rank).alias("_first"))
        .filter("group_size > 1")
    )


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "is_duplicate"
) -> DataFrame:
    """True for every row of a key but the first in ``order`` (which must be unique)."""
    groups = repeated_keys(df, keys, order)
    joined = null_safe_join(df, groups, keys, "left")
    later = F.col("_first").isNotNull() & (_rank(order) != F.col("_first"))
    return joined.select(*df.columns, later.alias(name))


def all_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once, with the size of its group."""
    groups = repeated_keys(df, keys, order)
    return null_safe_join(df, groups, keys).select(*df.columns, "group_size")


def exact_duplicates(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Whole-row copies beyond the first, ignoring the columns in ``order``."""
    keys = [c for c in df.columns if c not in order]
    per_row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
