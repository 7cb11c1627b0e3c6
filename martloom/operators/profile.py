"""Table profiles: cardinality, nulls, coverage, value counts, group totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_row(row: DataFrame, fields: dict[str, Sequence[Column]], names: Sequence[str]):
    """A one-row aggregate as one row per key: ``fields[key]`` are the values for ``names``."""
    structs = [
        F.struct(F.lit(k).alias("column_name"), *[v.alias(n) for n, v in zip(names, vals)])
        for k, vals in fields.items()
    ]
    return row.select(F.inline(F.array(*structs)))


def inferred_types(df: DataFrame, declared: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    """Per text column the first of ``kinds`` (type: pattern) that all its cells match, else
    string, and how many cells match the pattern of the declared type. One aggregate."""
    fits = {c: {k: F.count_if(F.col(c).rlike(p)) for k, p in kinds.items()} for c in declared}
    row = df.agg(
        *[F.count(c).alias(f"{c}__cells") for c in declared],
        *[n.alias(f"{c}__{k}") for c in declared for k, n in fits[c].items()],
    )
    fields = {}
    for c, kind in declared.items():
        cells = F.col(f"{c}__cells")
        found = F.when(cells == 0, "string")
        for k in kinds:
            found = found.when(F.col(f"{c}__{k}") == cells, k)
        fits_declared = F.col(f"{c}__{kind}") if kind in kinds else cells
        fields[c] = [F.lit(kind), cells, found.otherwise("string"), fits_declared]
    return unpivot_row(row, fields, ["declared", "cells", "inferred", "fitting"])


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact counts go through (column, value) pairs: the pairs are deduplicated map-side before
    one shuffle, so repeated values do not travel and no column's values meet in one task.
    """
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return unpivot_row(row, {c: [F.col(c)] for c in columns}, ["distinct_values"])
    counts = (
        distinct_values(df, columns)
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )
    listed = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    joined = listed.join(counts, "column_name", "left")
    return joined.select(
        "column_name", F.coalesce("distinct_values", F.lit(0).cast("long")).alias("distinct_values")
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) pairs; rows, not an array, so the list may be of any length."""
    kinds = dict(df.dtypes)

    def text(c: str) -> Column:
        # Adding zero makes -0.0 and 0.0 one value, as they are everywhere else.
        value = F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c)
        return value.cast("string")

    pairs = [F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in columns]
    long = df.select(F.inline(F.array(*pairs)))
    return long.filter("value is not null").distinct()


def null_profile(df: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    percent = {
        c: F.try_divide(F.col(c) * F.lit(100.0), F.col("_rows").cast("double")) for c in df.columns
    }
    return unpivot_row(
        row, {c: [F.col(c), percent[c]] for c in df.columns}, ["null_count", "null_pct"]
    )


def temporal_coverage(df: DataFrame, day: str, sums: Sequence[str]) -> DataFrame:
    """First and last day, distinct days, totals.

    Rows are reduced per day first, so the distinct count runs over days only.
    """
    daily = df.groupBy(day).agg(*[F.sum(c).alias(c) for c in sums])
    return daily.agg(
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count(day).alias("distinct_dates"),
        *[F.sum(c).alias(f"total_{c}") for c in sums],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(F.desc("row_count"), column)


def most_common(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value; the lowest one on a tie."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(F.col(column).isNotNull()).orderBy(F.desc("row_count"), column).limit(1)


def sum_by(df: DataFrame, by: str, column: str, name: str) -> DataFrame:
    return df.groupBy(by).agg(F.sum(column).alias(name))


def mean_of_units(total: Column, count: Column, scale: int = 1) -> Column:
    """Mean from an exact whole-number total: one double division, no running error."""
    return total.cast("double") / (count * F.lit(scale)).cast("double")


def first_by(df: DataFrame, by: str, value: str, order: Sequence[str], name: str) -> DataFrame:
    """First non-null value of each group in ``order``."""
    rank = F.struct(*order)
    present = F.when(F.col(value).isNotNull(), rank)
    return df.groupBy(by).agg(F.min_by(value, present).alias(name))


def coverage_gap(left: DataFrame, day: str, right: DataFrame, other: str) -> DataFrame:
    """Days of ``left`` that ``right`` lacks."""
    return left.select(F.col(day)).distinct().subtract(right.select(F.col(other).alias(day)))


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def group_sizes(df: DataFrame, by: str, entity: str) -> DataFrame:
    """Rows and distinct entities per period."""
    pairs = df.groupBy(by, entity).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy(by).agg(
        F.sum("_n").alias("row_count"), F.count(entity).alias("entity_count")
    )


def prefix_consistency(
    df: DataFrame, prefix: Column, category: str, expected: dict[str, str]
) -> DataFrame:
    """Rows and categories seen per code prefix, compared with a fixed map."""
    from ..functions.columns import map_value

    pairs = (
        df.groupBy(prefix.alias("sku_prefix"), F.col(category).alias("category"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("expected_category", map_value(F.col("sku_prefix"), expected))
    )
    wrong = ~F.col("category").eqNullSafe(F.col("expected_category"))
    return pairs.groupBy("sku_prefix", "expected_category").agg(
        F.sum("_n").alias("row_count"),
        F.count("category").alias("category_count"),
        F.coalesce(F.sum(F.when(wrong, F.col("_n"))), F.lit(0)).alias("mismatch_rows"),
    )
