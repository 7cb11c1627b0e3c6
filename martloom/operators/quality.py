"""Validation outcome, error tables, metrics and table constraints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, annotate, flag_columns
from ..workspace import CODEC


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter("is_valid").drop("is_valid", "broken")


def invalid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter("not is_valid").drop("is_valid")


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their flags)."""
    annotated = annotate(df, rules)
    return valid_rows(annotated), invalid_rows(annotated)


def fork(
    df: DataFrame, rules: Sequence[Rule], path: str
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """As ``split``, with the annotated rows written once, plus their counts.

    The table is partitioned by outcome, so each branch reads only its own half and the source
    is evaluated a single time, also after a lost executor. The counts are taken from the written
    flags alone.
    """
    annotated = annotate(df, rules)
    annotated.write.mode("overwrite").partitionBy("is_valid").parquet(path, compression=CODEC)
    back = df.sparkSession.read.schema(annotated.schema).parquet(path)
    hits = [F.get("broken", F.lit(i)).cast("long") for i in range(len(rules))]
    counts = back.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
        F.coalesce(F.sum(reduce(add, hits, F.lit(0))), F.lit(0)).alias("error_count"),
    ).first()
    return valid_rows(back), invalid_rows(back), counts.asDict()


def error_rows(invalid: DataFrame, rules: Sequence[Rule], row_id: str) -> DataFrame:
    """One row per broken rule, with the whole original row as JSON. ``rules`` are those the rows
    were annotated with."""
    kept = [c for c in invalid.columns if c != "broken"]
    origin = ["source_file"] if "source_file" in kept else []
    whole = F.to_json(F.struct(*kept)).alias("original_data")
    hits = invalid.select(*kept, whole, F.posexplode("broken").alias("_rule", "_hit")).filter(
        "_hit"
    )

    def per_rule(values: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_rule"))

    value = F.lit(None).cast("string")
    for column in dict.fromkeys(r.column for r in rules):
        places = [i for i, r in enumerate(rules) if r.column == column]
        value = F.when(F.col("_rule").isin(places), F.col(column).cast("string")).otherwise(value)
    return hits.select(
        F.col(row_id).alias("row_index"),
        per_rule([r.column for r in rules]).alias("column"),
        value.alias("value"),
        per_rule([r.error_type for r in rules]).alias("error_type"),
        F.concat(per_rule([r.reason for r in rules]), F.coalesce(value, F.lit(""))).alias(
            "error_message"
        ),
        "original_data",
        *origin,
    )


def metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Row and error counts in one aggregate; the rate counts rows, 0 for an empty input."""
    parsed, flags = flag_columns(df, rules)
    hits = {f"_rule{i}": f for i, f in enumerate(flags)}
    bad = reduce(or_, [F.col(h) for h in hits], F.lit(False))
    errors = reduce(add, [F.count_if(F.col(h)) for h in hits], F.lit(0).cast("long"))
    counted = parsed.withColumns(hits).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~bad).alias("valid_rows"),
        F.count_if(bad).alias("invalid_rows"),
        errors.alias("error_count"),
    )
    rate = F.try_divide(F.col("invalid_rows") * F.lit(100.0), F.col("total_rows").cast("double"))
    return counted.withColumn("error_rate_pct", F.coalesce(rate, F.lit(0.0)))


def error_distribution(errors: DataFrame) -> DataFrame:
    return (
        errors.groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("error_count"))
        .orderBy(F.desc("error_count"), "error_type")
    )


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking each rule, without building error records: one aggregate, then unpivot."""
    parsed, flags = flag_columns(df, rules)
    hits = [F.count_if(f).alias(f"r{i}") for i, f in enumerate(flags)]
    names = [(f"r{i}", r) for i, r in enumerate(rules)]
    rows = F.array(
        *[
            F.struct(
                F.lit(r.column).alias("column"),
                F.lit(r.error_type).alias("error_type"),
                F.lit(r.severity).alias("severity"),
                F.col(key).alias("broken_rows"),
            )
            for key, r in names
        ]
    )
    return parsed.agg(*hits).select(F.inline(rows))


def error_type_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The distribution of ``error_distribution`` without building error records: rules counted in
    one aggregate, and the few counts summed by type."""
    counts = rule_counts(df, rules).filter("broken_rows > 0")
    by_type = counts.groupBy("error_type").agg(F.sum("broken_rows").alias("error_count"))
    return by_type.orderBy(F.desc("error_count"), "error_type")


def constraint_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows violating each named condition; NULL does not violate, as in a SQL CHECK."""
    counts = [F.count_if(~cond).alias(name) for name, cond in checks.items()]
    rows = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in checks]
    )
    return df.agg(*counts).select(F.inline(rows))


def calendar_checks() -> dict[str, Column]:
    return {
        "month_range": F.col("month").between(1, 12),
        "week_range": F.col("week_of_year").between(1, 53),
        "quarter_range": F.col("quarter").between(1, 4),
    }


def measure_checks() -> dict[str, Column]:
    return {
        "units_not_negative": F.col("units") >= 0,
        "price_positive": F.col("unit_price") > 0,
        "revenue_not_negative": F.col("revenue") >= 0,
    }


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def orphans(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no member."""
    refs = df.filter(F.col(column).isNotNull())
    members = dim.select(F.col(key).alias("_member"))
    return refs.join(members, F.col(column) == F.col("_member"), "left_anti")


def members(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose reference exists."""
    known = dim.select(F.col(key).alias("_member"))
    return df.join(known, F.col(column) == F.col("_member"), "left_semi")


def revenue_gap(units: Column, price: Column, revenue: Column) -> Column:
    return F.abs(revenue - F.round(units * price, 2))


def revenue_mismatch(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Count and size of revenues that differ from units times price; nothing is rejected."""
    gap = revenue_gap(F.col("units"), F.col("unit_price"), F.col("revenue"))
    exact = F.col("revenue") == F.col("units") * F.col("unit_price")
    return df.agg(
        F.count_if(gap > F.lit(tolerance)).alias("mismatch_rows"),
        F.max(gap).alias("max_difference"),
        F.count_if(~exact).alias("inexact_rows"),
    )
