"""Classifiers on the panel with pyspark.ml: pipelines, grids, cross-validation, diagnostics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluate import roc_auc
from .panel import FEATURES, guard_features

SEED = 42

# The parameter grids of the study.
C_GRID = [0.001, 0.01, 0.1, 1, 10]
PENALTIES = {"l1": 1.0, "l2": 0.0}
FOREST_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [3, 5, 7, 30],
    "minInstancesPerNode": [3, 5, 10],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
}
BOOST_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 4, 5],
    "stepSize": [0.05, 0.1],
    "subsamplingRate": [0.8, 1.0],
    "minInstancesPerNode": [5, 10],
}
COLSAMPLE_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 4, 5],
    "stepSize": [0.01, 0.05, 0.1],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
}
CUTOFFS = [2003, 2005, 2007]


def prepare_stages(features: Sequence[str], scale: bool) -> list:
    """Mean imputation, one vector column, standardisation: fitted on whatever the pipeline is
    fitted on, that is the training rows only."""
    names = guard_features(features)
    filled = [f"{c}_filled" for c in names]
    stages = [
        Imputer(inputCols=names, outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol="raw_features" if scale else "features"),
    ]
    if scale:
        stages.append(
            StandardScaler(
                inputCol="raw_features", outputCol="features", withMean=True, withStd=True
            )
        )
    return stages


def as_model_input(df: DataFrame, features: Sequence[str], label: str = "target") -> DataFrame:
    kept = [c for c in df.columns if c not in features and c != label]
    return df.select(
        *kept,
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(label).cast("double").alias(label),
    )


def logistic(label: str = "target", c: float = 1.0, penalty: str = "l2", rows: int = 1):
    """Penalty strength 1/(C n): the mean loss Spark minimises against a summed one."""
    return LogisticRegression(
        labelCol=label, regParam=1.0 / (c * rows), elasticNetParam=PENALTIES[penalty], maxIter=1000
    )


def logistic_grid(estimator, rows: int, cs=C_GRID, penalties=("l1", "l2")) -> list[dict]:
    return [
        {
            estimator.regParam: 1.0 / (c * rows),
            estimator.elasticNetParam: PENALTIES[p],
        }
        for c, p in product(cs, penalties)
    ]


def forest(label: str = "target", **params):
    return RandomForestClassifier(labelCol=label, seed=SEED, **params)


def boosting(label: str = "target", **params):
    return GBTClassifier(labelCol=label, seed=SEED, **params)


def param_grid(estimator, grid: dict[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def with_folds(df: DataFrame, keys: Sequence[str], folds: int = 5) -> DataFrame:
    """Fold number from a hash of the row's key: the same on any partitioning."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int"))


def grid_search(
    train: DataFrame,
    estimator,
    grid: list[dict],
    features: Sequence[str] = FEATURES,
    label: str = "target",
    keys: Sequence[str] = ("team", "year"),
    folds: int = 5,
    scale: bool = False,
    parallelism: int = 4,
):
    """Cross-validated grid by AUC; the best parameters refitted on all training rows."""
    rows = with_folds(as_model_input(train, features, label), keys, folds)
    pipe = Pipeline(stages=[*prepare_stages(features, scale), estimator])
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    search = CrossValidator(
        estimator=pipe,
        estimatorParamMaps=grid,
        evaluator=judge,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    kept = rows.persist()
    try:
        return search.fit(kept)
    finally:
        kept.unpersist()


def grid_table(fitted, spark) -> DataFrame:
    """Cross-validated AUC per parameter setting, best first."""
    rows = []
    for params, score in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name))
        rows.append((text, float(score)))
    table = spark.createDataFrame(rows, "params string, cv_auc double")
    return table.orderBy(F.desc("cv_auc"), "params")


def fit(
    train: DataFrame,
    estimator,
    features: Sequence[str] = FEATURES,
    label: str = "target",
    scale: bool = False,
) -> PipelineModel:
    pipe = Pipeline(stages=[*prepare_stages(features, scale), estimator])
    return pipe.fit(as_model_input(train, features, label))


def predict(
    model, df: DataFrame, features: Sequence[str] = FEATURES, label: str = "target"
) -> DataFrame:
    """Rows with ``score``, the probability of class 1."""
    scored = model.transform(as_model_input(df, features, label))
    kept = [c for c in df.columns]
    return scored.select(*kept, vector_to_array("probability")[1].alias("score"))


def weights(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """Signed coefficients of a linear model or importances of a tree model, highest first."""
    last = model.stages[-1]
    values = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(f, float(v)) for f, v in zip(features, values.toArray())]
    return spark.createDataFrame(rows, "feature string, weight double").orderBy(
        F.desc("weight"), "feature"
    )


def at_once(jobs: Sequence[Callable]) -> list:
    """Results of independent fits, started together: small fits leave most cores idle."""
    with ThreadPoolExecutor(max(1, min(8, len(jobs)))) as pool:
        return list(pool.map(lambda job: job(), jobs))


def cutoff_sensitivity(
    labelled: DataFrame,
    estimator,
    cutoffs: Sequence[int] = CUTOFFS,
    test_from: int = 2009,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Test AUC of refits on training periods of different length, on the same test rows."""
    test = labelled.filter(F.col("target_year") >= test_from)
    until = lambda cutoff: labelled.filter(F.col("target_year") <= cutoff)
    models = at_once([lambda c=c: fit(until(c), estimator, features) for c in cutoffs])
    parts = [predict(m, test, features).withColumn("cutoff", F.lit(c)) for m, c in zip(models, cutoffs)]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return roc_auc(scored, "score", "target", ["cutoff"])


def ablation(
    train: DataFrame, test: DataFrame, estimator, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Test AUC with each feature left out, and its change against the full model."""
    scored = None
    without = {f: [x for x in features if x != f] for f in ["", *features]}
    models = at_once([lambda used=used: fit(train, estimator, used) for used in without.values()])
    for (left_out, used), model in zip(without.items(), models):
        part = predict(model, test, used)
        part = part.select("target", "score", F.lit(left_out).alias("left_out"))
        scored = part if scored is None else scored.unionByName(part)
    table = roc_auc(scored, "score", "target", ["left_out"]).select("left_out", "auc")
    full = table.filter(F.col("left_out") == "").select("auc").scalar()
    return table.filter(F.col("left_out") != "").withColumn("impact", F.col("auc") - full)
