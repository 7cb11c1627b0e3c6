"""Key lookups against dimensions.

No join is hinted: the planner broadcasts a dimension when its known size allows and shuffles
otherwise, and adaptive execution splits a hot key on the fact side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dim: DataFrame,
    source: str | Column,
    key: str,
    id_column: str,
    unknown_id: int | None = -1,
) -> DataFrame:
    """Add ``id_column`` of the member whose ``key`` equals ``source``.

    ``key`` must be unique in ``dim``. A missing member gives ``unknown_id``; None keeps NULL.
    """
    src = F.col(source) if isinstance(source, str) else source
    right = dim.select(F.col(key).alias("_key"), F.col(id_column).alias("_id"))
    joined = df.join(right, src == F.col("_key"), "left")
    found = F.col("_id") if unknown_id is None else F.coalesce("_id", F.lit(unknown_id))
    return joined.withColumn(id_column, found).drop("_key", "_id")


def map_lookup(source: Column, ids: dict[str, int], unknown_id: int | None = -1) -> Column:
    """Id from a small fixed map, for domains that are known without a table."""
    pairs = [F.lit(x) for item in ids.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), source)
    return found if unknown_id is None else F.coalesce(found, F.lit(unknown_id))


def new_members(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-null values of ``column`` that the dimension lacks."""
    values = df.select(F.col(column).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return values.join(dim.select(key), key, "left_anti")


def rows_with_key(df: DataFrame, key: dict[str, object]) -> DataFrame:
    """All rows equal to one composite key."""
    cond = F.lit(True)
    for name, value in key.items():
        cond = cond & F.col(name).eqNullSafe(F.lit(value))
    return df.filter(cond)


def rows_with_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """All rows whose composite key occurs in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")
