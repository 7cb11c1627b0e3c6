"""Statistics kept per batch and combined at read: counts, extremes, means and centred products.

A batch is read once, when it is added; what is kept of it is one record. Descriptions, correlations and
trends over any batches come from their records alone. Records are combined around the common mean, by
which sums of squares never cancel, however far the values lie from zero.

Records live in a numbered commit log, so a batch becomes visible as a whole, the last record of a batch is the one
that counts (a retry replaces, it doesn't add), and a reader opens a bounded number of files.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.commits import CommitLog
from .merge import last_per_key

PAIR = "x string, y string, n long, lo double, hi double, mean_x double, mean_y double, m2_x double, m2_y double, c double"
KEEP = [p.split()[0] for p in PAIR.split(", ")]


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with an array of ``PAIR`` structs: each column with itself (with its extremes), and each pair of
    columns over the rows where both are present. One pass; an empty table gives counts of zero."""
    pairs = [(c, c) for c in columns] + list(combinations(columns, 2))
    aggs, structs = [], []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        ends = [F.min(x), F.max(x)] if a == b else [F.lit(None).cast("double")] * 2
        parts = [F.count(x), *ends, F.avg(x), F.avg(y), F.var_pop(x), F.var_pop(y), F.covar_pop(x, y)]
        aggs += [p.alias(f"_{i}_{j}") for j, p in enumerate(parts)]
        n, lo, hi, *rest = [F.col(f"_{i}_{j}") for j in range(len(parts))]
        values = [F.lit(a), F.lit(b), n, lo, hi, *rest[:2], *[v * n for v in rest[2:]]]
        structs.append(F.struct(*[v.alias(name) for v, name in zip(values, KEEP)]))
    return df.agg(*aggs).select(F.array(*structs).cast(f"array<struct<{_typed()}>>").alias("pairs"))


def _typed() -> str:
    return ",".join(f"{name}:{kind}" for name, kind in (p.split() for p in PAIR.split(", ")))


def combine(records: DataFrame) -> DataFrame:
    """Rows of ``moments`` as one row per pair, of all batches together. Both aggregates combine map-side."""
    parts = records.select(F.inline("pairs")).filter("n > 0")
    n = F.col("n").cast("double")
    totals = parts.groupBy("x", "y").agg(
        F.sum("n").alias("_n"),
        F.min("lo").alias("_lo"),
        F.max("hi").alias("_hi"),
        (F.sum(n * F.col("mean_x")) / F.sum(n)).alias("_x"),
        (F.sum(n * F.col("mean_y")) / F.sum(n)).alias("_y"),
    )
    off_x, off_y = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    whole = parts.join(totals, ["x", "y"]).groupBy("x", "y", "_n", "_lo", "_hi", "_x", "_y")
    summed = whole.agg(
        F.sum(F.col("m2_x") + n * off_x * off_x).alias("m2_x"),
        F.sum(F.col("m2_y") + n * off_y * off_y).alias("m2_y"),
        F.sum(F.col("c") + n * off_x * off_y).alias("c"),
    )
    names = {"_n": "n", "_lo": "lo", "_hi": "hi", "_x": "mean_x", "_y": "mean_y"}
    return summed.withColumnsRenamed(names).select(*KEEP)


def _listed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    kinds = [p.split() for p in schema.split(", ")]
    cells = [F.struct(*[F.lit(v).cast(k).alias(n) for v, (n, k) in zip(r, kinds)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def describe(combined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``stats.describe`` of all rows; a column without values has a count of zero."""
    names = _listed(combined.sparkSession, [(c,) for c in columns], "column_name string")
    own = combined.filter("x = y")
    spread = F.sqrt(F.try_divide(F.col("m2_x"), F.col("n").cast("double") - 1))
    return names.join(own, F.col("column_name") == F.col("x"), "left").select(
        "column_name",
        F.coalesce("n", F.lit(0)).cast("long").alias("value_count"),
        F.col("lo").alias("min_value"),
        F.col("hi").alias("max_value"),
        F.col("mean_x").alias("mean_value"),
        spread.alias("std_value"),
    )


def _r() -> Column:
    return F.try_divide(F.col("c"), F.sqrt("m2_x") * F.sqrt("m2_y"))


def correlation_matrix(combined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``stats.correlation_matrix`` of all rows; NULL where a column doesn't vary."""
    cells = [(a, b, *sorted((a, b), key=columns.index)) for a in columns for b in columns]
    asked = _listed(combined.sparkSession, cells, "x string, y string, _a string, _b string")
    found = combined.select(F.col("x").alias("_a"), F.col("y").alias("_b"), _r().alias("_r"))
    joined = asked.join(found, ["_a", "_b"], "left")
    value = F.when(F.col("x") == F.col("y"), F.lit(1.0)).otherwise(F.col("_r"))
    return joined.select("x", "y", value.alias("correlation"))


def linear_trend(combined: DataFrame, x: str, y: str) -> DataFrame:
    """As ``stats.linear_trend`` of all rows: least squares of ``y`` on ``x``, two different columns."""
    forth, back = (F.col("x") == x) & (F.col("y") == y), (F.col("x") == y) & (F.col("y") == x)
    flip = lambda a, b: F.when(F.col("x") == x, F.col(a)).otherwise(F.col(b))
    slope = F.try_divide(F.col("c"), flip("m2_x", "m2_y"))
    return combined.filter(forth | back).select(
        F.col("n").alias("pair_count"),
        slope.alias("slope"),
        (flip("mean_y", "mean_x") - slope * flip("mean_x", "mean_y")).alias("intercept"),
        (_r() * _r()).alias("r2"),
    )


class MomentStore:
    """Records of batches under ``path``, for fixed ``columns``."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str]):
        self.columns = list(columns)
        self.log = CommitLog(spark, path, f"batch_id string, pairs array<struct<{_typed()}>>")

    def add(self, batch_id: str, df: DataFrame) -> int:
        """Reads the batch once and commits its record, in place of an earlier one of the same id."""
        record = moments(df, self.columns).first().asDict(recursive=True)
        return self.log.append({"batch_id": batch_id, "pairs": record["pairs"]})

    def withdraw(self, batch_id: str) -> int:
        return self.log.append({"batch_id": batch_id, "pairs": []})

    def records(self, as_of: int | None = None) -> DataFrame:
        """The record of every batch, as of a position of the log if one is named."""
        return last_per_key(self.log.table(as_of), ["batch_id"], ["seq"])

    def combined(self, as_of: int | None = None) -> DataFrame:
        return combine(self.records(as_of))
