"""Evaluation of scores against 0/1 labels: exact AUC, threshold metrics, Brier, bootstrap."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import confidence, outcome, predicted_class, verdict
from ..workspace import stage
from .ordered import BLOCK, average_ranks, null_safe_join, range_blocks


def roc_auc(
    df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Exact area under the ROC curve, ties counting half; NULL with one class only.

    Rows collapse to distinct scores before any ordering; ranks come from range blocks, so
    neither a frequent score nor a large group is held by one task.
    """
    by = list(by)
    s = F.col(score).cast("double")
    counts = (
        df.select(*by, s.alias("_score"), F.col(label).alias("_label"))
        .filter("_score is not null and _label is not null")
        .groupBy(*by, "_score")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("_label") == 1).alias("_pos"),
        )
    )
    ranked = average_ranks(counts, "_score", by)
    sums = ranked.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        F.sum("_pos").alias("positives"),
        F.sum(F.col("_pos") * F.col("avg_rank")).alias("_ranks"),
    )
    n1 = F.col("positives").cast("double")
    n0 = F.col("rows").cast("double") - n1
    auc = F.try_divide(F.col("_ranks") - n1 * (n1 + 1.0) / 2.0, n1 * n0)
    return sums.select(*by, "rows", "positives", auc.alias("auc"))


def threshold_metrics(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    threshold: float = 0.5,
) -> DataFrame:
    """Confusion counts, accuracy and F1 at a threshold, from one aggregate."""
    guess, truth = predicted_class(F.col(score), threshold), F.col(label)
    counts = df.groupBy(*by).agg(
        F.count_if((guess == 1) & (truth == 1)).alias("tp"),
        F.count_if((guess == 1) & (truth == 0)).alias("fp"),
        F.count_if((guess == 0) & (truth == 1)).alias("fn"),
        F.count_if((guess == 0) & (truth == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
            "f1": F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0)),
        }
    )


def brier(
    df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    gap = F.col(score).cast("double") - F.col(label).cast("double")
    return df.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def brier_improvement(df: DataFrame, score: str, baseline: str, label: str) -> DataFrame:
    """Brier scores of a model and a baseline, and the relative improvement in percent."""
    p, q, y = (F.col(c).cast("double") for c in (score, baseline, label))
    row = df.agg(
        F.avg((p - y) * (p - y)).alias("brier"), F.avg((q - y) * (q - y)).alias("brier_baseline")
    )
    better = F.try_divide(F.col("brier_baseline") - F.col("brier"), F.col("brier_baseline"))
    return row.withColumn("improvement_pct", better * 100.0)


# -- bootstrap ---------------------------------------------------------------------------------

# Distinct (score, label) of a block. All replicates are drawn for each, so blocks are cut by rows: by bytes
# adaptive execution would leave this work to a task or two.
CELLS_PER_BLOCK = 20_000


def poisson_draws(n: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Poisson(n) quantiles of the uniforms ``u`` (one row per n), per distinct n."""
    out = np.empty(u.shape, dtype=np.float64)
    for size in np.unique(n):
        rows = n == size
        spread = 12.0 * np.sqrt(size) + 20.0
        low, high = max(0, int(size - spread)), int(size + spread)
        k = np.arange(low, high + 1, dtype=np.float64)
        steps = np.concatenate(([0.0], np.cumsum(np.log(size / k[1:]))))
        mass = np.exp(steps - steps.max())
        cdf = np.cumsum(mass) / mass.sum()
        out[rows] = low + np.searchsorted(cdf, u[rows])
    return out


def uniforms(seeds: np.ndarray, replicates: np.ndarray) -> np.ndarray:
    """Uniform numbers for (row seed, replicate) by an integer mixing function: the same pair
    gives the same number in any task and on any partitioning."""
    with np.errstate(over="ignore"):
        x = seeds.astype(np.uint64)[:, None] + (
            replicates.astype(np.uint64)[None, :] + np.uint64(1)
        ) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def bootstrap_auc(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    replicates: int = 1000,
    chunk: int = 20,
) -> DataFrame:
    """AUC of each bootstrap replicate; replicates with one class only are left out.

    A resample gives a row that stands for n equal rows a Poisson(n) weight. Scores are cut into
    range blocks; a task returns, per block and replicate, the weight of positives and negatives
    and the concordant weight inside the block. Blocks are then linked by a running sum over at
    most (blocks x replicates) rows: data rows are never multiplied by the replicates.
    """
    s = F.col(score).cast("double")
    cells = (
        df.select(s.alias("_score"), F.col(label).cast("int").alias("_label"))
        .filter("_score is not null and _label is not null")
        .groupBy("_score", "_label")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_seed", F.xxhash64("_score", "_label"))
    )
    cells = stage(cells, "cells")
    pieces = max(1, -(-cells.count() // CELLS_PER_BLOCK))
    blocks = range_blocks(cells, ["_score"], pieces)

    def weigh(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["_score", "_label"])
        n = block["_n"].to_numpy()
        seeds = block["_seed"].to_numpy()
        positive = (block["_label"] == 1).to_numpy()
        starts = np.unique(block["_score"].to_numpy(), return_index=True)[1]
        parts = []
        # As many replicates at a time as keep a matrix of weights near two million cells.
        step = max(1, min(chunk, 2_000_000 // len(block)))
        for first in range(0, replicates, step):
            reps = np.arange(first, min(first + step, replicates))
            w = poisson_draws(n, uniforms(seeds, reps))
            pos = np.add.reduceat(np.where(positive[:, None], w, 0.0), starts, axis=0)
            neg = np.add.reduceat(np.where(positive[:, None], 0.0, w), starts, axis=0)
            below = np.cumsum(neg, axis=0) - neg
            parts.append(
                pd.DataFrame(
                    {
                        BLOCK: int(block[BLOCK].iloc[0]),
                        "replicate": reps,
                        "pos": pos.sum(axis=0),
                        "neg": neg.sum(axis=0),
                        "inside": (pos * (below + neg / 2.0)).sum(axis=0),
                    }
                )
            )
        return pd.concat(parts)

    schema = f"{BLOCK} int, replicate int, pos double, neg double, inside double"
    weights = blocks.repartition(pieces, BLOCK).groupBy(BLOCK).applyInPandas(weigh, schema)
    before = (
        Window.partitionBy("replicate")
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.coalesce(F.sum("neg").over(before), F.lit(0.0))
    linked = weights.withColumn("_won", F.col("inside") + F.col("pos") * lower)
    sums = linked.groupBy("replicate").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("_won").alias("won")
    )
    whole = sums.filter((F.col("pos") > 0) & (F.col("neg") > 0))
    return whole.select("replicate", (F.col("won") / (F.col("pos") * F.col("neg"))).alias("auc"))


def bootstrap_interval(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    replicates: int = 1000,
    level: float = 0.95,
) -> DataFrame:
    """Percentile interval of the AUC; the percentiles run over the replicates only."""
    aucs = bootstrap_auc(df, score, label, replicates)
    tail = (1.0 - level) / 2.0
    return aucs.agg(
        F.count(F.lit(1)).alias("replicates"),
        F.percentile("auc", F.lit(tail)).alias("lower"),
        F.percentile("auc", F.lit(1.0 - tail)).alias("upper"),
    )


# -- comparison and errors ---------------------------------------------------------------------


def model_table(df: DataFrame, scores: dict[str, str], label: str, split: str) -> DataFrame:
    """One row per model: AUC on validation and test, their difference, F1 and accuracy on test,
    and the verdict against the first model by validation AUC.

    All models' scores are unpivoted, so one pass evaluates every model.
    """
    pairs = [
        F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("score"))
        for name, c in scores.items()
    ]
    long = df.select(
        F.col(label).alias("label"), F.col(split).alias("split"), F.inline(F.array(*pairs))
    )
    keys = ["model", "split"]
    aucs = roc_auc(long, by=keys)
    fits = threshold_metrics(long, by=keys).select(*keys, "f1", "accuracy")
    both = null_safe_join(aucs, fits, keys)

    def at(part: str, column: str) -> Column:
        return F.max(F.when(F.col("split") == part, F.col(column)))

    wide = both.groupBy("model").agg(
        at("validation", "auc").alias("validation_auc"),
        at("test", "auc").alias("test_auc"),
        at("test", "f1").alias("test_f1"),
        at("test", "accuracy").alias("test_accuracy"),
    )
    reference = next(iter(scores))
    base = wide.filter(F.col("model") == reference).select("validation_auc").scalar()
    gap = F.col("validation_auc") - base
    return wide.withColumns(
        {
            "test_minus_validation": F.col("test_auc") - F.col("validation_auc"),
            "vs_first": gap,
            "verdict": verdict(gap),
        }
    )


def rank_models(table: DataFrame, score: str = "validation_auc") -> DataFrame:
    return table.orderBy(F.desc(score), "model")


def best_model(table: DataFrame, score: str = "validation_auc") -> DataFrame:
    return rank_models(table, score).limit(1)


def with_outcome(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    s = F.col(score)
    return df.withColumns(
        {
            "pred_class": predicted_class(s, threshold),
            "outcome": outcome(F.col(label), s, threshold),
            "confidence": confidence(s, threshold),
        }
    )


def confident_errors(judged: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The wrong rows farthest from the threshold."""
    wrong = judged.filter(F.col("outcome") != "Correct")
    return wrong.orderBy(F.desc("confidence"), *order).limit(n)


def outcome_profile(judged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and mean of the columns per outcome."""
    means = [F.avg(F.col(c).cast("double")).alias(c) for c in columns]
    return judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"), *means)


def error_rate_by(judged: DataFrame, period: str) -> DataFrame:
    wrong = F.count_if(F.col("outcome") != "Correct")
    total = F.count(F.lit(1))
    return judged.groupBy(period).agg(
        total.alias("row_count"),
        wrong.alias("error_count"),
        (wrong * F.lit(100.0) / total.cast("double")).alias("error_rate_pct"),
    )


def union_outcomes(judged: DataFrame) -> DataFrame:
    """Correct rows, false positives and false negatives put together under a tag."""
    parts = [
        judged.filter(F.col("outcome") == name).withColumn("type", F.lit(name))
        for name in ("Correct", "False Positive", "False Negative")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
