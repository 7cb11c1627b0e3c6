"""Entity-by-period panels: pairing, labels, temporal splits, consistency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from .selection import group_median

# Feature columns and the columns known only after the next season.
FEATURES = [
    "win_rate", "goal_diff", "goals_for", "goals_against", "wins", "losses", "ot_losses",
]
FUTURE_COLUMNS = ["next_win_rate", "median_next_win_rate", "target", "target_year"]


class FutureLeak(ValueError):
    pass


def guard_features(features: Sequence[str], future: Sequence[str] = FUTURE_COLUMNS) -> list[str]:
    """The feature list, refused when it holds a column from the future."""
    leaked = [c for c in features if c in future]
    if leaked:
        raise FutureLeak(f"not known at prediction time: {leaked}")
    return list(features)


def next_period_join(
    df: DataFrame, value: str, name: str, entity: str = "team", period: str = "year"
) -> DataFrame:
    """Rows paired with the same entity's row exactly one period later."""
    after = df.select(
        F.col(entity).alias("_entity"),
        (F.col(period) - 1).alias("_period"),
        F.col(value).alias(name),
    )
    joined = df.join(
        after, (df[entity] == F.col("_entity")) & (df[period] == F.col("_period"))
    )
    return joined.drop("_entity", "_period")


def lead_pairs(
    df: DataFrame, value: str, name: str, entity: str = "team", period: str = "year"
) -> DataFrame:
    """The same pairs by a window: an entity has one row per period, so its window is as long as
    the calendar."""
    w = Window.partitionBy(entity).orderBy(period)
    led = df.withColumns({name: F.lead(value).over(w), "_next": F.lead(period).over(w)})
    return led.filter(F.col("_next") == F.col(period) + 1).drop("_next")


def unpaired_by_period(df: DataFrame, entity: str = "team", period: str = "year") -> DataFrame:
    """Rows without a next-period partner, per period."""
    after = df.select(F.col(entity), (F.col(period) - 1).alias(period))
    alone = df.join(after, [entity, period], "left_anti")
    return alone.groupBy(period).agg(F.count(F.lit(1)).alias("unpaired_rows"))


def with_period_median(
    df: DataFrame, value: str, period: str = "year", name: str = "period_median"
) -> DataFrame:
    """Attach each period's exact median; the medians are one row per period."""
    medians = group_median(df, value, [period], name)
    return df.join(medians, period, "left")


def label_next_period(df: DataFrame, entity: str = "team", period: str = "year") -> DataFrame:
    """target = 1 when the entity's next value beats the median of *all* entities of that next
    period; a value equal to the median gives 0."""
    pairs = next_period_join(df, "win_rate", "next_win_rate", entity, period)
    pairs = pairs.withColumn("target_year", F.col(period) + 1)
    medians = group_median(df, "win_rate", [period], "median_next_win_rate")
    medians = medians.withColumnRenamed(period, "target_year")
    labelled = pairs.join(medians, "target_year")
    beats = F.col("next_win_rate") > F.col("median_next_win_rate")
    return labelled.withColumns(
        {
            "target": F.when(beats, 1).otherwise(0),
            "ot_losses": F.coalesce(F.col("ot_losses"), F.lit(0)),
        }
    )


def median_ties(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(F.col("next_win_rate") == F.col("median_next_win_rate")).alias("median_ties"),
        F.coalesce(F.sum("target"), F.lit(0)).alias("positives"),
    )


def split_of(period: Column, train_to: int, validation_to: int) -> Column:
    return (
        F.when(period <= train_to, "train")
        .when(period <= validation_to, "validation")
        .otherwise("test")
    )


def with_split(
    labelled: DataFrame, train_to: int = 2005, validation_to: int = 2008
) -> DataFrame:
    """Split by the period being predicted, so no row sees its future."""
    return labelled.withColumn("split", split_of(F.col("target_year"), train_to, validation_to))


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.min("target_year").alias("first_year"),
        F.max("target_year").alias("last_year"),
        F.count(F.lit(1)).alias("row_count"),
        (F.sum("target").cast("double") / F.count(F.lit(1)).cast("double")).alias("positive_share"),
    )


def period_success(labelled: DataFrame, period: str = "target_year") -> DataFrame:
    return labelled.groupBy(period).agg(
        F.count(F.lit(1)).alias("entity_count"),
        (F.sum("target").cast("double") / F.count(F.lit(1)).cast("double")).alias("success_rate"),
    )


def early_late(labelled: DataFrame, period: str = "target_year") -> DataFrame:
    """Mean of the yearly success rates before and after the midpoint of the period range."""
    yearly = period_success(labelled, period)
    middle = yearly.agg(F.floor((F.min(period) + F.max(period)) / 2).cast("int")).scalar()
    half = F.when(F.col(period) <= middle, "early").otherwise("late")
    return yearly.groupBy(half.alias("half")).agg(
        F.min(period).alias("first_year"),
        F.max(period).alias("last_year"),
        F.avg("success_rate").alias("mean_success_rate"),
    )


def consistency_checks(games: int = 82, tolerance: float = 0.01) -> dict[str, Column]:
    """Conditions that mark a panel row as inconsistent."""
    c = F.col
    won = ratio(c("wins"), c("losses"), c("ot_losses"))
    played = c("wins") + F.coalesce(c("losses"), F.lit(0)) + F.coalesce(c("ot_losses"), F.lit(0))
    return {
        "win_rate_mismatch": F.abs(c("win_rate") - won) > F.lit(tolerance),
        "games_mismatch": played != F.lit(games),
        "goal_diff_mismatch": c("goal_diff") != c("goals_for") - c("goals_against"),
    }


def entity_history(
    df: DataFrame, entity: str, period: str = "year", key: str = "team", n: int | None = None
) -> DataFrame:
    """One entity's rows in time order."""
    rows = df.filter(F.col(key) == entity).orderBy(period)
    return rows if n is None else rows.limit(n)
