"""Descriptive statistics as aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..workspace import stage
from .ordered import null_safe_join
from .profile import unpivot_row
from .selection import exact_quantiles


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, min, max, mean and sample deviation per column, in one pass."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"{c}_n"),
            F.min(x).alias(f"{c}_lo"),
            F.max(x).alias(f"{c}_hi"),
            F.avg(x).alias(f"{c}_mean"),
            F.stddev_samp(x).alias(f"{c}_std"),
        ]
    names = ["value_count", "min_value", "max_value", "mean_value", "std_value"]
    parts = ["n", "lo", "hi", "mean", "std"]
    fields = {c: [F.col(f"{c}_{p}") for p in parts] for c in columns}
    return unpivot_row(df.agg(*aggs), fields, names)


def with_scalars(df: DataFrame, row: DataFrame, name: str = "_s") -> DataFrame:
    """Attach a one-row table as a struct column through a scalar subquery."""
    return df.withColumn(name, row.select(F.struct(*row.columns)).scalar())


def outlier_counts(df: DataFrame, columns: Sequence[str], sigmas: float = 3.0) -> DataFrame:
    """Values farther than ``sigmas`` sample deviations from the mean, per column: one pass for
    the moments of all columns and one for all counts."""
    moments = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_m") for c in columns],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"{c}_s") for c in columns],
    )
    framed = with_scalars(df.select(*columns), moments)
    counts = []
    for c in columns:
        mean, std = F.col("_s").getField(f"{c}_m"), F.col("_s").getField(f"{c}_s")
        x = F.col(c).cast("double")
        far = (x < mean - F.lit(sigmas) * std) | (x > mean + F.lit(sigmas) * std)
        counts.append(F.count_if(far).alias(c))
    return unpivot_row(
        framed.agg(*counts), {c: [F.col(c)] for c in columns}, ["outlier_count"]
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins over [min, max], numbered from 1; the maximum belongs to the
    last bin. Empty bins are left out."""
    x = F.col(column).cast("double")
    limits = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    framed = with_scalars(df.select(x.alias("x")).filter("x is not null"), limits)
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    share = F.try_divide(F.col("x") - lo, hi - lo)
    index = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins) + 1, F.lit(bins))
    return framed.groupBy(index.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("x").alias("min_value"),
        F.max("x").alias("max_value"),
    )


def boxplot_stats(df: DataFrame, by: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and number of points beyond them, per group."""
    v = F.col(value).cast("double")
    rows = stage(df.select(by, v.alias("_v")).filter("_v is not null"), "values")
    quartiles = exact_quantiles(
        rows, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by], stored=True
    )
    counts = rows.groupBy(by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    joined = null_safe_join(counts, quartiles, [by])
    span = F.lit(reach) * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - span, F.col("q3") + span
    inside = F.col("_v").between(low, high)
    return joined.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outlier_count"),
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson's r over the rows where both are present; NULL where one of them doesn't vary."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all column pairs in long form, both directions, from one pass.
    Each pair uses the rows where both values are present."""
    pairs = list(combinations(columns, 2))
    x = {c: F.col(c).cast("double") for c in columns}
    row = df.agg(*[correlation(x[a], x[b]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells += [(a, b, F.col(f"c{i}")), (b, a, F.col(f"c{i}"))]
    cells += [(c, c, F.lit(1.0)) for c in columns]
    structs = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.alias("correlation"))
        for a, b, r in cells
    ]
    return row.select(F.inline(F.array(*structs)))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """r, number of complete pairs and the t statistic of r, for named pairs."""
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        aggs += [
            correlation(x, y).alias(f"r{i}"),
            F.count_if(x.isNotNull() & y.isNotNull()).alias(f"n{i}"),
        ]
    structs = []
    for i, (a, b) in enumerate(pairs):
        r, n = F.col(f"r{i}"), F.col(f"n{i}")
        t = r * F.sqrt(F.try_divide((n - 2).cast("double"), F.lit(1.0) - r * r))
        structs.append(
            F.struct(
                F.lit(a).alias("x"),
                F.lit(b).alias("y"),
                n.alias("pair_count"),
                r.alias("correlation"),
                t.alias("t_stat"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def pooled_t(df: DataFrame, value: str, label: str) -> DataFrame:
    """Two-sample t statistic with pooled variance of group 0 against group 1."""
    x = F.col(value).cast("double")
    zero, one = F.when(F.col(label) == 0, x), F.when(F.col(label) == 1, x)
    row = df.agg(
        F.count(zero).alias("n0"),
        F.count(one).alias("n1"),
        F.avg(zero).alias("mean0"),
        F.avg(one).alias("mean1"),
        F.var_samp(zero).alias("_v0"),
        F.var_samp(one).alias("_v1"),
    )
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    pooled = F.try_divide((n0 - 1) * F.col("_v0") + (n1 - 1) * F.col("_v1"), n0 + n1 - 2)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n0) + F.try_divide(F.lit(1.0), n1)))
    t = F.try_divide(F.col("mean0") - F.col("mean1"), error)
    return row.select("n0", "n1", "mean0", "mean1", t.alias("t_stat"), (n0 + n1 - 2).alias("df"))


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction (Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    out = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * out / a


def t_p_value(t: float, freedom: float) -> float:
    """Two-sided p-value of a t statistic."""
    if t != t or freedom <= 0:
        return float("nan")
    return _incomplete_beta(freedom / 2.0, 0.5, freedom / (freedom + t * t))


@F.pandas_udf(DoubleType())
def p_value(t: pd.Series, freedom: pd.Series) -> pd.Series:
    """p-values of statistics already aggregated to a few rows."""
    return pd.Series([t_p_value(a, b) for a, b in zip(t.astype(float), freedom.astype(float))])


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = slope * x + intercept."""
    a, b = F.col(y).cast("double"), F.col(x).cast("double")
    return df.agg(
        F.regr_count(a, b).alias("pair_count"),
        F.regr_slope(a, b).alias("slope"),
        F.regr_intercept(a, b).alias("intercept"),
        F.regr_r2(a, b).alias("r2"),
    )


def mutual_information(
    df: DataFrame, features: Sequence[str], label: str, bins: int = 4
) -> DataFrame:
    """Mutual information (nats) of each binned feature with the label, highest first.

    Cut points are exact quantiles per feature; missing values form a bin of their own. What
    leaves the map side is the contingency table only.
    """
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in features
    ]
    long = df.filter(F.col(label).isNotNull()).select(
        F.col(label).alias("_y"), F.inline(F.array(*pairs))
    )
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    cuts = exact_quantiles(long, "value", probs, ["feature"]).drop("n")
    cells = long.groupBy("feature", "value", "_y").agg(F.count(F.lit(1)).alias("_n"))
    placed = cells.join(cuts, "feature", "left")
    index: Column = F.lit(0)
    for q in probs:
        index = index + F.when(F.col("value") > F.col(q), 1).otherwise(0)
    binned = (
        placed.withColumn("_bin", F.when(F.col("value").isNull(), -1).otherwise(index))
        .groupBy("feature", "_bin", "_y")
        .agg(F.sum("_n").cast("double").alias("_n"))
    )
    by_bin = binned.groupBy("feature", "_bin").agg(F.sum("_n").alias("_b"))
    by_label = binned.groupBy("feature", "_y").agg(F.sum("_n").alias("_l"))
    total = binned.groupBy("feature").agg(F.sum("_n").alias("_t"))
    joined = binned.join(by_bin, ["feature", "_bin"]).join(by_label, ["feature", "_y"])
    joined = joined.join(total, "feature")
    term = (
        F.col("_n") / F.col("_t") * F.log(F.col("_n") * F.col("_t") / (F.col("_b") * F.col("_l")))
    )
    return joined.groupBy("feature").agg(F.sum(term).alias("mutual_info")).orderBy(
        F.desc("mutual_info"), "feature"
    )


def mismatch_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows where each named condition holds."""
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    structs = [
        F.struct(F.lit(n).alias("check_name"), F.col(n).alias("row_count")) for n in checks
    ]
    return row.select(F.inline(F.array(*structs)))
