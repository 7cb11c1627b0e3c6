"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from .common import partitions_for

ROWS = 250_000  # edges per written file
FEW = 100_000  # edges that one task finishes


def narrow(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` narrow rows, in as few partitions as they fill."""
    return df.coalesce(partitions_for(rows, ROWS))


def _smallest(edges: DataFrame) -> DataFrame:
    """Of each node ``u`` the smallest of itself and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of at most ``FEW`` edges by union of sets."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
            a, b = top(u), top(v)
            above[max(a, b)] = min(a, b)
    found = [(x, top(x)) for x in list(above)]
    yield pd.DataFrame([x for x in found if x[0] != x[1]], columns=["u", "v"], dtype="int64")


def components(edges: DataFrame, rows: int, label: str = "edges") -> tuple[DataFrame, int]:
    """Node and the smallest node of its component, for all nodes but those smallest ones, and
    how many rows that makes.

    ``edges``: about ``rows`` rows with columns ``a`` and ``b``. Every round links each node's neighbours to its smallest
    one, first the larger neighbours, then the smaller; it ends when nothing changes, after about as
    many rounds as the logarithm of the longest path. Each step is a map-side combined minimum and
    a join that adaptive execution may split, so a node with most edges is no hot group; each round is
    written, which cuts the lineage. Once there are at most ``FEW`` edges, one task ends it.
    """
    first = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stage(narrow(first, rows), label)
    before = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if 0 < seen[0] <= FEW:
            now = stage(now.coalesce(1).mapInPandas(_join, "u long, v long"), label)
            seen = now.agg(F.count(F.lit(1))).first()
            before = seen
        if seen == before or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")), seen[0]
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = _smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = stage(narrow(after, seen[0]), label)
