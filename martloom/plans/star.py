"""Star schema: dimensions, key resolution, fact contributions, analytic views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import lookup as L
from ..operators import merge as M
from ..operators.ordered import dense_numbers
from ..operators.quality import valid_rows
from ..functions.rules import Rule, annotate
from ..workspace import stage

# Members, ids and codes of the closed dimensions, types of the macro values.
REGION_SEEDS = [
    (1, "East_North_Central", "East North Central"),
    (2, "Middle_Atlantic", "Middle Atlantic"),
    (3, "Pacific", "Pacific"),
    (4, "West_South_Central", "West South Central"),
    (5, "Mountain", "Mountain"),
    (6, "South_Atlantic", "South Atlantic"),
    (7, "West_North_Central", "West North Central"),
    (8, "East_South_Central", "East South Central"),
    (9, "New_England", "New England"),
]
CHANNEL_SEEDS = [
    (1, "pro_dealer", "Professional Dealer", "PRO"),
    (2, "big_box_diy", "Big Box DIY", "BBX"),
]
CUSTOMER_SEEDS = [
    (1, "remodeler", "Remodeler"),
    (2, "contractor", "Contractor"),
    (3, "homeowner_diy", "Homeowner DIY"),
    (4, "homebuilder", "Homebuilder"),
]
PREFIX_CATEGORIES = {
    "ROO": "roofing",
    "LUM": "lumber",
    "CON": "concrete_cement",
    "INS": "insulation",
    "PLU": "plumbing",
    "WIN": "windows_doors",
    "PNT": "paint_coatings",
    "DRY": "drywall",
    "HRD": "hardware_fasteners",
    "ELC": "electrical",
}

PRODUCT_SCHEMA = (
    "product_id long, sku string, sku_prefix string, product_name string, "
    "is_active boolean, category_id int"
)
BUSINESS_KEY = ["date_id", "region_id", "product_id", "channel_id", "customer_id"]
MACRO_COLUMNS = ["housing_starts_index", "lumber_price_index", "mortgage_rate"]
MACRO_DECIMALS = {
    "housing_starts_index": "decimal(6,2)",
    "lumber_price_index": "decimal(8,2)",
    "mortgage_rate": "decimal(5,3)",
    "season_factor": "decimal(5,3)",
}


# -- transform ---------------------------------------------------------------------------------


def typed_transactions(df: DataFrame) -> DataFrame:
    """Typed cells, SKU prefix, revenue recomputed as units times price, date renamed."""
    units, price = C.as_int(F.col("units")), C.as_number(F.col("unit_price"))
    typed = {
        "date": C.as_date(F.col("date")),
        "units": units,
        "unit_price": price,
        "revenue": units * price,
        "sku_prefix": C.sku_prefix(F.col("sku")),
    }
    for c in MACRO_COLUMNS:
        if c in df.columns:
            typed[c] = C.as_number(F.col(c))
    return df.withColumns(typed).withColumnRenamed("date", "transaction_date")


def transform_transactions(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Valid rows, typed. Ordering by date is left to the writer: see ``sorted_for_write``."""
    return typed_transactions(valid_rows(annotate(df, rules)))


def sorted_for_write(df: DataFrame, day: str = "transaction_date") -> DataFrame:
    """Order by date inside each partition, which is all a file's min/max statistics need."""
    return df.sortWithinPartitions(day)


def transform_macro(df: DataFrame, default_season: float = 1.0) -> DataFrame:
    renamed = df.withColumnRenamed("week", "week_date")
    return renamed.withColumn("week_date", F.col("week_date").cast("date")).fillna(
        {"season_factor": default_season}
    )


# -- dimensions --------------------------------------------------------------------------------


# Id and name of the member that stands for facts whose own member is unknown.
UNKNOWN_ID, UNKNOWN = -1, "unknown"


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A relation of constants. The planner knows its size, as it doesn't that of a Python list,
    so a closed dimension is joined without moving the rows it is looked up for."""
    fields = T.StructType.fromDDL(schema).fields
    value = lambda x, f: f"CAST({sql_literal(x)} AS {f.dataType.simpleString()})"
    body = ", ".join(f"({', '.join(value(x, f) for x, f in zip(row, fields))})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(f.name for f in fields)})")


def sql_literal(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        escaped = x.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(x).lower()


def seed_regions(spark: SparkSession, seeds=REGION_SEEDS, unknown_id: int = UNKNOWN_ID) -> DataFrame:
    """Region members and, last, the unknown one; as the other closed dimensions."""
    rows = literal_rows(
        spark,
        [*seeds, (unknown_id, UNKNOWN, UNKNOWN)],
        "region_id int, region_name string, census_division string",
    )
    return rows.withColumn("region_code", C.short_code(F.col("region_name")))


def seed_channels(spark: SparkSession, seeds=CHANNEL_SEEDS, unknown_id: int = UNKNOWN_ID) -> DataFrame:
    return literal_rows(
        spark,
        [*seeds, (unknown_id, UNKNOWN, UNKNOWN, None)],
        "channel_id int, channel_name string, channel_type string, channel_code string",
    )


def seed_customers(spark: SparkSession, seeds=CUSTOMER_SEEDS, unknown_id: int = UNKNOWN_ID) -> DataFrame:
    return literal_rows(
        spark,
        [*seeds, (unknown_id, UNKNOWN, UNKNOWN)],
        "customer_id int, customer_type string, segment string",
    )


def seed_categories(
    spark: SparkSession,
    prefixes: dict[str, str] = PREFIX_CATEGORIES,
    unknown_id: int = UNKNOWN_ID,
) -> DataFrame:
    """Categories named by the prefix map, numbered by name; those the lumber price moves are
    the ones whose prefix is LUM."""
    names = sorted(prefixes.items(), key=lambda item: item[1])
    rows = [(i, name, prefix, prefix == "LUM") for i, (prefix, name) in enumerate(names, start=1)]
    return literal_rows(
        spark,
        [*rows, (unknown_id, UNKNOWN, None, False)],
        "category_id int, category_name string, category_code string, is_lumber_sensitive boolean",
    )


def with_unknown_product(products: DataFrame, unknown_id: int = UNKNOWN_ID) -> DataFrame:
    """A product dimension with the member of facts whose SKU it lacks. Products without a
    category belong to the unknown one."""
    spark = products.sparkSession
    row = literal_rows(
        spark, [(unknown_id, UNKNOWN, None, UNKNOWN, False, unknown_id)], PRODUCT_SCHEMA
    )
    named = products.withColumn("category_id", F.coalesce("category_id", F.lit(unknown_id)))
    return named.select(*row.columns).unionByName(row)


def date_rows(df: DataFrame, day: str) -> DataFrame:
    """Calendar rows of the distinct dates of ``df``."""
    days = df.select(F.col(day).cast("date").alias("date")).filter("date is not null").distinct()
    d = F.col("date")
    fields = {**C.calendar(d), **C.calendar_ext(d)}
    named = [v.alias(k) for k, v in fields.items() if k != "fiscal_quarter"]
    return days.select(C.date_id(d).alias("date_id"), "date", *named)


def new_products(
    df: DataFrame, dim_product: DataFrame, categories: DataFrame, prefixes: dict[str, str]
) -> DataFrame:
    """Products the dimension lacks, numbered on from its highest id in SKU order."""
    fresh = L.new_members(df, "sku", dim_product, "sku")
    numbered = dense_numbers(fresh, ["sku"], "_n")
    top = dim_product.agg(F.greatest(F.max("product_id"), F.lit(0).cast("long"))).scalar()
    prefix = C.sku_prefix(F.col("sku"))
    rows = numbered.select(
        (F.col("_n") + top).alias("product_id"),
        "sku",
        prefix.alias("sku_prefix"),
        C.map_value(prefix, prefixes).alias("_category"),
        C.product_name(F.col("sku")).alias("product_name"),
        F.lit(True).alias("is_active"),
    )
    return L.lookup(rows, categories, "_category", "category_name", "category_id", None).drop(
        "_category"
    )


def macro_rows(df: DataFrame) -> DataFrame:
    """Macro dimension rows; the id is the week as YYYYMMDD, stable under any load order."""
    day = F.col("week_date")
    typed = [F.col(c).cast(t).alias(c) for c, t in MACRO_DECIMALS.items()]
    return df.filter(day.isNotNull()).select(
        C.date_id(day).alias("macro_id"), day.alias("week"), *typed
    )


# -- keys and fact -----------------------------------------------------------------------------


def resolve_small_keys(
    df: DataFrame, dims: dict[str, DataFrame], unknown_id: int = -1, day: str = "transaction_date"
) -> DataFrame:
    """Date id plus region, channel, customer and macro ids. An unmatched week stays NULL."""
    out = df.withColumn("date_id", C.date_id(F.col(day)))
    out = L.lookup(out, dims["region"], "region", "region_name", "region_id", unknown_id)
    out = L.lookup(out, dims["channel"], "channel", "channel_name", "channel_id", unknown_id)
    out = L.lookup(
        out, dims["customer"], "customer_type", "customer_type", "customer_id", unknown_id
    )
    return L.lookup(out, dims["macro"], day, "week", "macro_id", None)


def resolve_keys(
    df: DataFrame, dims: dict[str, DataFrame], unknown_id: int = -1, day: str = "transaction_date"
) -> DataFrame:
    """All surrogate keys, row by row."""
    out = resolve_small_keys(df, dims, unknown_id, day)
    return L.lookup(out, dims["product"], "sku", "sku", "product_id", unknown_id)


def contributions(
    df: DataFrame, dims: dict[str, DataFrame], order: Sequence[str], unknown_id: int = -1
) -> DataFrame:
    """What a batch adds to the fact: one row per business key.

    Small dimensions are resolved row by row. The product lookup, the one that may need a
    shuffle, comes after rows have been merged per natural key: a SKU with a third of all sales
    then enters that join as its few distinct keys only. Merged rows are written, a quarter of the bytes of their
    shuffle, so that the lookup doesn't hold both shuffles on disk.
    """
    merged = stage(natural_contributions(df, dims, order, unknown_id), "merged")
    return keyed_contributions(merged, dims, order, unknown_id)


def natural_contributions(
    df: DataFrame, dims: dict[str, DataFrame], order: Sequence[str], unknown_id: int = -1
) -> DataFrame:
    """One row per natural key, with the ids of the small dimensions and the SKU."""
    small = resolve_small_keys(df, dims, unknown_id)
    measured = small.select(
        "date_id",
        "region_id",
        "channel_id",
        "customer_id",
        "sku",
        F.col("units").cast("long").alias("units"),
        F.col("revenue").cast("decimal(15,2)").cast("decimal(25,2)").alias("revenue"),
        F.col("unit_price").cast("decimal(12,4)").alias("unit_price"),
        "macro_id",
        *[F.col(c).cast(MACRO_DECIMALS[c]).alias(c) for c in MACRO_COLUMNS],
        *order,
    )
    natural = ["date_id", "region_id", "channel_id", "customer_id", "sku"]
    firsts = ["unit_price", "macro_id", *MACRO_COLUMNS]
    return M.additive(measured, natural, ["units", "revenue"], firsts, order)


def keyed_contributions(
    merged: DataFrame, dims: dict[str, DataFrame], order: Sequence[str], unknown_id: int = -1
) -> DataFrame:
    """Rows of ``natural_contributions`` with the product's id in place of its SKU."""
    firsts = ["unit_price", "macro_id", *MACRO_COLUMNS]
    keyed = L.lookup(merged, dims["product"], "sku", "sku", "product_id", unknown_id)
    return keyed.select(*BUSINESS_KEY, "units", "revenue", *firsts, *order)


def merge_contributions(
    contrib: DataFrame, order: Sequence[str], extra: dict[str, Column] | None = None
) -> DataFrame:
    """The fact: contributions of all batches added up per business key; price and macro values
    stay those of the first contribution."""
    firsts = ["unit_price", "macro_id", *MACRO_COLUMNS]
    return M.additive(contrib, BUSINESS_KEY, ["units", "revenue"], firsts, order, extra)


# -- views -------------------------------------------------------------------------------------


def star_join(
    fact: DataFrame, dims: dict[str, DataFrame], extra: Sequence[str] = ()
) -> DataFrame:
    """Fact with all dimension attributes. Every dimension holds the unknown member, so each
    fact stays; macro values are optional."""
    f = fact.select(*BUSINESS_KEY, "macro_id", "units", "revenue", "unit_price", *extra)
    date = dims["date"].select("date_id", "date", "year", "month", "quarter")
    product = dims["product"].select("product_id", "sku", "category_id")
    category = dims["category"].select("category_id", "category_name", "is_lumber_sensitive")
    region = dims["region"].select("region_id", "region_name")
    channel = dims["channel"].select("channel_id", "channel_name")
    customer = dims["customer"].select("customer_id", "customer_type")
    macro = dims["macro"].select("macro_id", *MACRO_DECIMALS)
    return (
        f.join(date, "date_id")
        .join(region, "region_id")
        .join(channel, "channel_id")
        .join(customer, "customer_id")
        .join(macro, "macro_id", "left")
        .join(product, "product_id")
        .join(category, "category_id")
    )


def mean_price(price: str = "unit_price") -> Column:
    """Mean of a decimal column from its exact sum: one double division."""
    return F.sum(price).cast("double") / F.count(price).cast("double")


def weekly_sales_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Units, revenue, mean price and fact rows by every star attribute.

    ``fact`` has one row per business key, as ``merge_contributions`` leaves it, and members are unique by name, so every group is one fact row and nothing is shuffled to
    find that out.
    """
    price = F.col("unit_price").cast("double")
    single = fact.withColumns({"unit_price": price, "transaction_count": F.lit(1).cast("long")})
    return star_join(single, dims, ["transaction_count"]).select(
        *["date", "year", "month", "quarter", "region_name", "category_name", "sku"],
        *["channel_name", "customer_type", *MACRO_DECIMALS],
        F.col("units").alias("total_units"),
        F.col("revenue").alias("total_revenue"),
        F.col("unit_price").alias("avg_unit_price"),
        "transaction_count",
    )


def category_view(
    fact: DataFrame, dims: dict[str, DataFrame], approximate: bool = False
) -> DataFrame:
    """Units, revenue, mean price and distinct SKUs by year, month and category.

    Facts are summed per (month, product) before any product attribute is joined. That makes the
    distinct count a plain count of rows and shrinks the one join on a large dimension.
    ``approximate`` counts SKUs by sketch straight from the joined rows.
    """
    months = dims["date"].select("date_id", "year", "month")
    dated = fact.select("date_id", "product_id", "units", "revenue", "unit_price").join(
        months, "date_id"
    )
    product = dims["product"].select("product_id", "category_id")
    category = dims["category"].select("category_id", "category_name", "is_lumber_sensitive")
    keys = ["year", "month", "category_id", "category_name", "is_lumber_sensitive"]
    if approximate:
        joined = dated.join(product, "product_id").join(category, "category_id")
        return joined.groupBy(*keys).agg(
            F.sum("units").alias("total_units"),
            F.sum("revenue").alias("total_revenue"),
            mean_price().alias("avg_unit_price"),
            F.approx_count_distinct("product_id").alias("unique_skus"),
        )
    per_product = dated.groupBy("year", "month", "product_id").agg(
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.sum("unit_price").alias("_price"),
        F.count("unit_price").alias("_n"),
    )
    joined = per_product.join(product, "product_id").join(category, "category_id")
    return joined.groupBy(*keys).agg(
        F.sum("units").alias("total_units"),
        F.sum("revenue").alias("total_revenue"),
        (F.sum("_price").cast("double") / F.sum("_n").cast("double")).alias("avg_unit_price"),
        F.count("product_id").alias("unique_skus"),
    )


def macro_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Weekly revenue and units per macro week; weeks without sales keep NULL sums.

    Facts are summed per date first, so the join to the calendar and to the macro weeks runs on
    one row per day.
    """
    daily = fact.groupBy("date_id").agg(
        F.sum("revenue").alias("_revenue"), F.sum("units").alias("_units")
    )
    days = dims["date"].select("date_id", F.col("date").alias("_day"))
    dated = daily.join(days, "date_id").select("_day", "_revenue", "_units")
    macro = dims["macro"].select("week", *MACRO_DECIMALS)
    joined = macro.join(dated, F.col("week") == F.col("_day"), "left")
    return joined.groupBy("week", *MACRO_DECIMALS).agg(
        F.sum("_revenue").alias("weekly_revenue"), F.sum("_units").alias("weekly_units")
    )


def register_views(fact: DataFrame, dims: dict[str, DataFrame]) -> None:
    """Temporary views over the star, for SQL users."""
    for name, dim in dims.items():
        dim.createOrReplaceTempView(f"dim_{name}")
    fact.createOrReplaceTempView("fact_sales")
    weekly_sales_view(fact, dims).createOrReplaceTempView("v_weekly_sales")
    category_view(fact, dims).createOrReplaceTempView("v_sales_by_category")
    macro_view(fact, dims).createOrReplaceTempView("v_macro_impact")
