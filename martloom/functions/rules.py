"""Declarative row rules that compile to column expressions.

All rules of a set become one array of flags per row in a single projection: no UDF and no pass
per rule. Column, value, type and reason of an error are looked up by the flag's position after
the flags have been exploded, so valid rows never build them and the per-row code stays small
enough for the JVM to compile. Rules skip missing cells, except ``required``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import as_date, as_number

# Error types.
INVALID_DATE_FORMAT = "INVALID_DATE_FORMAT"
INVALID_TYPE = "INVALID_TYPE"
OUT_OF_RANGE = "OUT_OF_RANGE"
INVALID_CATEGORY = "INVALID_CATEGORY"
INVALID_FORMAT = "INVALID_FORMAT"
REQUIRED = "REQUIRED"
LATE_ROW = "LATE_ROW"

NUMBER = "_number_"


@dataclass(frozen=True)
class Rule:
    """``broken`` maps the cell (or, for ``numeric`` rules, cell and number) to a boolean;
    ``reason`` is followed by the value in the error message."""

    column: str
    error_type: str
    broken: Callable[..., Column]
    reason: str
    numeric: bool = False
    on_null: bool = False
    severity: str = "error"

    def fails(self, number: Column | None = None) -> Column:
        cell = F.col(self.column)
        if self.numeric:
            hit = self.broken(as_number(cell) if number is None else number)
        else:
            hit = self.broken(cell)
        if not self.on_null:
            hit = cell.isNotNull() & hit
        return F.coalesce(hit, F.lit(False))


def is_date(column: str, pattern: str = "yyyy-MM-dd") -> Rule:
    return Rule(
        column,
        INVALID_DATE_FORMAT,
        lambda c: as_date(c, pattern).isNull(),
        f"{column} is not a {pattern} date: ",
    )


def is_numeric(column: str) -> Rule:
    return Rule(
        column, INVALID_TYPE, lambda x: x.isNull(), f"{column} is not a number: ", numeric=True
    )


def in_range(
    column: str,
    low: float | None = None,
    high: float | None = None,
    open_low: bool = False,
    severity: str = "error",
) -> Rule:
    """Bounds are inclusive unless ``open_low``; non-numeric cells are left to ``is_numeric``."""

    def broken(x: Column) -> Column:
        hit = F.lit(False)
        if low is not None:
            hit = hit | ((x <= F.lit(float(low))) if open_low else (x < F.lit(float(low))))
        if high is not None:
            hit = hit | (x > F.lit(float(high)))
        return hit

    left = "(" if open_low else "["
    reason = f"{column} outside {left}{low}, {high}]: "
    return Rule(column, OUT_OF_RANGE, broken, reason, numeric=True, severity=severity)


def one_of(column: str, allowed: Sequence[str]) -> Rule:
    values = list(allowed)
    return Rule(column, INVALID_CATEGORY, lambda c: ~c.isin(values), f"unknown {column}: ")


def has_text(column: str, token: str = "-") -> Rule:
    return Rule(column, INVALID_FORMAT, lambda c: ~c.contains(token), f"{column} lacks '{token}': ")


def required(column: str) -> Rule:
    return Rule(column, REQUIRED, lambda c: c.isNull(), f"{column} is missing", on_null=True)


def flag_columns(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[Column]]:
    """``df`` with each numeric cell parsed once, and one flag expression per rule over it."""
    numbers = {r.column: F.col(f"{NUMBER}{r.column}") for r in rules if r.numeric}
    parsed = df.withColumns({f"{NUMBER}{c}": as_number(F.col(c)) for c in numbers})
    return parsed, [r.fails(numbers.get(r.column)) for r in rules]


def annotate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``is_valid`` and ``broken``, an array with one flag per rule in rule order."""
    parsed, flags = flag_columns(df, rules)
    every = reduce(or_, flags, F.lit(False))
    broken = F.array(*flags).cast("array<boolean>")
    return parsed.select(*df.columns, (~every).alias("is_valid"), broken.alias("broken"))


@dataclass(frozen=True)
class Bounds:
    """Allowed values of a sales row."""

    # Default limits of the numeric fields.
    units: tuple[float, float] = (0, 100000)
    unit_price: tuple[float, float] = (0.01, 100000.0)
    lumber_price_index: tuple[float, float] = (100.0, 2000.0)
    revenue_min: float = 0.0
    housing_starts_index: tuple[float, float] = (50.0, 200.0)
    mortgage_rate: tuple[float, float] = (0.0, 15.0)
    season_factor: tuple[float, float] = (0.0, 2.0)


def sales_rules(
    regions: Sequence[str],
    categories: Sequence[str],
    channels: Sequence[str],
    customer_types: Sequence[str],
    bounds: Bounds = Bounds(),
    critical: Sequence[str] = (),
) -> list[Rule]:
    """The rule set of a sales row; ``critical`` columns must also be present."""
    return [
        is_date("date"),
        is_numeric("units"),
        in_range("units", *bounds.units),
        is_numeric("unit_price"),
        in_range("unit_price", *bounds.unit_price, open_low=True),
        one_of("region", regions),
        one_of("product_category", categories),
        one_of("channel", channels),
        one_of("customer_type", customer_types),
        is_numeric("lumber_price_index"),
        in_range("lumber_price_index", *bounds.lumber_price_index),
        has_text("sku", "-"),
        *[required(c) for c in critical],
    ]


def warning_rules(bounds: Bounds = Bounds()) -> list[Rule]:
    """Ranges that are reported but never reject a row."""
    return [
        in_range("revenue", bounds.revenue_min, None, severity="warn"),
        in_range("housing_starts_index", *bounds.housing_starts_index, severity="warn"),
        in_range("mortgage_rate", *bounds.mortgage_rate, severity="warn"),
        in_range("season_factor", *bounds.season_factor, severity="warn"),
    ]
