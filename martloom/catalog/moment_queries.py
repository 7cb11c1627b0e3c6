"""Statistics from the records of three batches, one of them loaded twice, against the full pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..operators import moments as M
from ..workspace import fresh_dir
from .join_queries import weekly_with_macro
from .registry import REGISTRY, query
from .sqltext import sql
from .study_queries import CORRELATED, INDICATORS, WEEKLY, rounded

FIRST_YEARS = (1994, 1996)


def three_batches(spark: SparkSession, rows: DataFrame, columns: list[str]) -> DataFrame:
    """The batches by year; the second is first loaded short, then again as a whole."""
    store = M.MomentStore(spark, fresh_dir(spark, "moments"), columns)
    year = F.year("date")
    early, late = FIRST_YEARS
    middle = rows.filter(year.between(early, late - 1))
    store.add("early", rows.filter(year < early))
    store.add("middle", middle.filter(F.month("date") < 6))
    store.add("late", rows.filter(~(year < late) | F.col("date").isNull()))
    store.add("middle", middle)
    return store.combined()


@query("describe_batches", REGISTRY["describe"][1])
def describe_batches(spark: SparkSession, sf: str) -> DataFrame:
    found = three_batches(spark, B.sales(spark, sf, "date", *INDICATORS), INDICATORS)
    return rounded(M.describe(found, INDICATORS), 4, "mean_value", "std_value")


@query("corr_matrix_batches", REGISTRY["corr_matrix"][1])
def corr_matrix_batches(spark: SparkSession, sf: str) -> DataFrame:
    found = three_batches(spark, weekly_with_macro(spark, sf), CORRELATED)
    return rounded(M.correlation_matrix(found, CORRELATED), 3, "correlation")


@query(
    "trend_batches",
    sql(
        f"""WITH {WEEKLY} SELECT regr_count(revenue_cents, units) AS pair_count,
        round(regr_slope(revenue_cents, units), 3) AS slope,
        round(regr_r2(revenue_cents, units), 6) AS r2 FROM j""",
        "sales",
        "macro_w",
    ),
)
def trend_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue on units by week; the units come second among the columns."""
    found = three_batches(spark, weekly_with_macro(spark, sf), ["revenue_cents", "units"])
    trend = rounded(rounded(M.linear_trend(found, "units", "revenue_cents"), 3, "slope"), 6, "r2")
    return trend.select("pair_count", "slope", "r2")
