"""Scalar column expressions: null tokens, typing, SKU parts, calendar fields, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text tokens read as missing, in their usual order.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Text that may be a plain number: no x, and a last character from the point to the nine before spaces.
PLAIN_NUMBER = r"^[^xX]*[./0-9] *\z"


def clean_null(c: Column) -> Column:
    """Missing-value tokens become NULL."""
    return F.when(~c.isin(NULL_TOKENS), c)


def clean_nulls(df: DataFrame) -> DataFrame:
    """Missing-value tokens and NaN become NULL in every column."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "string":
            c = clean_null(c)
        elif kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(name))
    return df.select(*out)


def as_number(c: Column) -> Column:
    """Double from text or number, NULL for anything else.

    The cast alone would also take ``12d``, ``0x1p3`` or ``Infinity``; a plain number ends in a
    digit, a point or a slash and has no x in it. One pattern, because a rule set holds this expression a dozen times
    and the JVM compiles no method of over 8,000 bytes of code.
    """
    text = c.cast("string")
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def as_int(c: Column) -> Column:
    """Whole number by truncation, so that ``12.7`` gives 12."""
    return as_number(c).try_cast("int")


def as_date(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Strict date: four-digit year, two-digit month and day, existing day."""
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit(pattern)))


def sku_prefix(c: Column) -> Column:
    """Text before the first hyphen."""
    return F.split_part(c, F.lit("-"), F.lit(1))


def sku_prefix3(c: Column) -> Column:
    """First three characters; ``UNK`` for shorter codes."""
    return F.when(F.length(c) >= 3, F.substring(c, 1, 3)).otherwise(F.lit("UNK"))


def short_code(c: Column) -> Column:
    return F.upper(F.substring(c, 1, 3))


def product_name(c: Column) -> Column:
    return F.concat(F.lit("Product "), c)


def map_value(c: Column, mapping: dict[str, str]) -> Column:
    """Look a small fixed map up; NULL when absent."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def date_id(c: Column) -> Column:
    """Date as the whole number YYYYMMDD."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def calendar(c: Column) -> dict[str, Column]:
    """Calendar fields of a date; Monday is day 0, weeks follow ISO."""
    return {
        "year": F.year(c),
        "month": F.month(c),
        "quarter": F.quarter(c),
        "week_of_year": F.weekofyear(c),
        "day_of_week": F.weekday(c),
        "day_name": F.date_format(c, "EEEE"),
    }


def calendar_ext(c: Column, fiscal_start: int = 1) -> dict[str, Column]:
    """Month name, weekend flag, and fiscal year and quarter for a fiscal year starting in
    month ``fiscal_start`` and named after the calendar year in which it ends."""
    shifted = F.add_months(c, 12 - fiscal_start + 1) if fiscal_start > 1 else c
    return {
        "month_name": F.date_format(c, "MMMM"),
        "is_weekend": F.weekday(c) >= 5,
        "fiscal_year": F.year(shifted),
        "fiscal_quarter": F.quarter(shifted),
    }


def ratio(part: Column, *addends: Column) -> Column:
    """part / (part + addends) with missing addends as 0; NULL for a zero base."""
    base = part.cast("double")
    for a in addends:
        base = base + F.coalesce(a.cast("double"), F.lit(0.0))
    return F.try_divide(part.cast("double"), base)


def predicted_class(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score >= F.lit(threshold), 1).otherwise(0)


def confidence(score: Column, threshold: float = 0.5) -> Column:
    return F.abs(score - F.lit(threshold))


def outcome(label: Column, score: Column, threshold: float = 0.5) -> Column:
    """Correct, False Positive or False Negative."""
    guess = predicted_class(score, threshold)
    return (
        F.when(guess == label, "Correct")
        .when(guess == 1, "False Positive")
        .otherwise("False Negative")
    )


def verdict(delta: Column, margin: float = 0.005) -> Column:
    """BETTER, WORSE or ~EQUAL within a margin."""
    return (
        F.when(delta > F.lit(margin), "BETTER")
        .when(delta < F.lit(-margin), "WORSE")
        .otherwise("~EQUAL")
    )
