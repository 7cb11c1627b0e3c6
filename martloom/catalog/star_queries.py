"""Dimensions, fact and views of the star on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..functions.rules import required
from ..operators import merge as M
from ..plans import star as S
from ..workspace import stage, stored_once
from .registry import query
from .sqltext import sql

ORDER = ["row_key"]


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Valid, typed rows. Written, because the dimensions and facts of all star queries read them."""
    rules = [*B.landing_rules(), *[required(c) for c in ("date", "units", "unit_price")]]
    return stored_once(
        spark, ("clean", sf), lambda: S.transform_transactions(B.landing_layer(spark, sf), rules)
    )


def dimensions(spark: SparkSession, sf: str, clean: DataFrame) -> dict[str, DataFrame]:
    category = S.seed_categories(spark, B.PREFIXES)
    empty = spark.createDataFrame([], S.PRODUCT_SCHEMA)
    return {
        "region": S.seed_regions(spark, B.REGION_SEEDS),
        "channel": S.seed_channels(spark, B.CHANNEL_SEEDS),
        "customer": S.seed_customers(spark, B.CUSTOMER_SEEDS),
        "category": category,
        "date": S.date_rows(clean, "transaction_date"),
        "product": S.with_unknown_product(S.new_products(clean, empty, category, B.PREFIXES)),
        "macro": stage(S.macro_rows(S.transform_macro(B.macro(spark, sf))), "macro"),
    }


def built_star(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Stored dimensions and the fact over them. Stored tables have a known size, from which the
    planner tells a dimension worth broadcasting from one that is not."""
    clean = clean_rows(spark, sf)
    dims = dimensions(spark, sf, clean)
    for name in ("date", "product"):
        dims[name] = stage(dims[name], name)
    return S.contributions(clean, dims, ORDER), dims


@query(
    "transform_transactions",
    sql("SELECT * FROM clean", "clean"),
)
def transform_transactions(spark: SparkSession, sf: str) -> DataFrame:
    rules = [*B.landing_rules(), *[required(c) for c in ("date", "units", "unit_price")]]
    clean = S.transform_transactions(B.landing_layer(spark, sf), rules)
    return S.sorted_for_write(clean).drop("year", "month", "week_of_year")


@query("build_dim_date", sql("SELECT * FROM dim_date", "dim_date"))
def build_dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Dates inserted in two overlapping halves; the second one adds only what is new."""
    clean = clean_rows(spark, sf)
    first = S.date_rows(clean.filter("channel = 'pro_dealer'"), "transaction_date")
    both = M.insert_ignore(first, S.date_rows(clean, "transaction_date"), ["date_id"], ["date"])
    return both.drop("month_name", "is_weekend", "fiscal_year")


@query("build_dim_product", sql("SELECT * FROM dim_product", "dim_product"))
def build_dim_product(spark: SparkSession, sf: str) -> DataFrame:
    clean = clean_rows(spark, sf)
    empty = spark.createDataFrame([], S.PRODUCT_SCHEMA)
    return S.new_products(clean, empty, S.seed_categories(spark, B.PREFIXES), B.PREFIXES)


@query(
    "seed_dims",
    sql(
        """
        SELECT 'region' AS dim, region_id AS id, region_name AS name, count(*) AS row_count
        FROM sales JOIN dim_region ON region = region_name GROUP BY ALL
        UNION ALL SELECT 'channel', channel_id, channel_name, count(*)
        FROM sales JOIN dim_channel ON channel = channel_name GROUP BY ALL
        UNION ALL SELECT 'customer', customer_id, d.customer_type, count(*)
        FROM sales s JOIN dim_customer d ON s.customer_type = d.customer_type GROUP BY ALL
        """,
        "dim_region",
        "dim_channel",
        "dim_customer",
    ),
)
def seed_dims(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds inserted twice, then matched with the sales rows of each member."""
    seeds = {
        "region": (S.seed_regions(spark, B.REGION_SEEDS), "region", "region_name"),
        "channel": (S.seed_channels(spark, B.CHANNEL_SEEDS), "channel", "channel_name"),
        "customer": (S.seed_customers(spark, B.CUSTOMER_SEEDS), "customer_type", "customer_type"),
    }
    rows = B.sales(spark, sf, "region", "channel", "customer_type")
    parts = []
    for name, (seed, column, key) in seeds.items():
        dim = M.insert_ignore(seed, seed, [f"{name}_id"], [key])
        named = dim.select(F.col(f"{name}_id").alias("id"), F.col(key).alias("name"))
        counts = rows.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(named.join(counts, "name").select(F.lit(name).alias("dim"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "build_dim_category",
    sql(
        """
        SELECT category_id, category_name, category_code, is_lumber_sensitive,
          count(*) AS product_count
        FROM dim_category JOIN part ON p_type = category_name GROUP BY ALL
        """,
        "dim_category",
    ),
)
def build_dim_category(spark: SparkSession, sf: str) -> DataFrame:
    counts = (
        B.table(spark, sf, "part")
        .groupBy(F.col("p_type").alias("category_name"))
        .agg(F.count(F.lit(1)).alias("product_count"))
    )
    return S.seed_categories(spark, B.PREFIXES).join(counts, "category_name")


@query(
    "build_dim_macro",
    sql(
        """
        SELECT macro_id, week, cast(housing_starts_index AS double) AS housing_starts_index,
          cast(lumber_price_index AS double) AS lumber_price_index,
          cast(mortgage_rate AS double) AS mortgage_rate,
          cast(season_factor AS double) AS season_factor FROM dim_macro
        """,
        "dim_macro",
    ),
)
def build_dim_macro(spark: SparkSession, sf: str) -> DataFrame:
    """A first version without the drivers of open orders, overwritten by the full one."""
    full = S.macro_rows(S.transform_macro(B.macro(spark, sf)))
    stale = full.withColumn("lumber_price_index", F.lit(0).cast("decimal(8,2)"))
    merged = M.upsert_overwrite(stale, full, ["macro_id"], ["week"])
    return merged.select("macro_id", "week", *[F.col(c).cast("double") for c in S.MACRO_DECIMALS])


@query(
    "resolve_all_fks",
    sql(
        """SELECT row_key, date_id, region_id, channel_id, customer_id, macro_id, product_id
        FROM resolved""",
        "resolved",
    ),
)
def resolve_all_fks(spark: SparkSession, sf: str) -> DataFrame:
    clean = clean_rows(spark, sf)
    resolved = S.resolve_keys(clean, dimensions(spark, sf, clean))
    return resolved.select("row_key", *S.BUSINESS_KEY, "macro_id")


@query(
    "build_fact",
    sql(
        """SELECT date_id, region_id, product_id, channel_id, customer_id, units,
          cast(revenue AS double) AS revenue, cast(unit_price AS double) AS unit_price,
          nullif(macro_key, -1) AS macro_id FROM fact""",
        "fact",
    ),
)
def build_fact(spark: SparkSession, sf: str) -> DataFrame:
    fact, _ = built_star(spark, sf)
    return fact.select(
        *S.BUSINESS_KEY,
        "units",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("unit_price").cast("double").alias("unit_price"),
        "macro_id",
    )


# The fact by the names of its members, straight from the clean rows.
NAMED_SQL = """
  SELECT transaction_date AS date, region AS region_name, product_category AS category_name, sku,
    channel AS channel_name, customer_type, cast(sum(units) AS bigint) AS units,
    sum(cast(revenue AS decimal(15,2))) AS revenue,
    arg_min(cast(unit_price AS decimal(12,4)), row_key) AS unit_price
  FROM clean GROUP BY ALL
"""


@query(
    "star_join",
    sql(
        f"""SELECT n.date, region_name, category_name, sku, channel_name, customer_type,
          coalesce(season_factor, CASE WHEN week IS NOT NULL THEN 1 END) AS season_factor, units
        FROM ({NAMED_SQL}) n LEFT JOIN macro_w ON week = n.date""",
        "clean",
    ),
)
def star_join(spark: SparkSession, sf: str) -> DataFrame:
    return S.star_join(*built_star(spark, sf)).select(
        "date",
        "region_name",
        "category_name",
        "sku",
        "channel_name",
        "customer_type",
        F.col("season_factor").cast("double").alias("season_factor"),
        "units",
    )


@query(
    "v_weekly_sales",
    sql(
        f"""
        SELECT n.date, cast(year(n.date) AS integer) AS year, cast(month(n.date) AS integer) AS month,
          cast(quarter(n.date) AS integer) AS quarter, region_name, category_name, sku,
          channel_name, customer_type, housing_starts_index, lumber_price_index, mortgage_rate,
          coalesce(season_factor, CASE WHEN week IS NOT NULL THEN 1 END) AS season_factor,
          units AS total_units, cast(revenue AS double) AS total_revenue,
          cast(unit_price AS double) AS avg_unit_price, cast(1 AS bigint) AS transaction_count
        FROM ({NAMED_SQL}) n LEFT JOIN macro_w ON week = n.date
        """,
        "clean",
    ),
)
def v_weekly_sales(spark: SparkSession, sf: str) -> DataFrame:
    view = S.weekly_sales_view(*built_star(spark, sf))
    doubles = [*S.MACRO_DECIMALS, "total_revenue"]
    return view.withColumns({c: F.col(c).cast("double") for c in doubles})


@query(
    "v_sales_by_category",
    sql(
        f"""
        SELECT cast(year(date) AS integer) AS year, cast(month(date) AS integer) AS month,
          category_id, category_name, false AS is_lumber_sensitive,
          cast(sum(units) AS bigint) AS total_units,
          cast(sum(revenue) AS double) AS total_revenue,
          cast(sum(unit_price) AS double) / count(*)::double AS avg_unit_price,
          count(DISTINCT sku) AS unique_skus
        FROM ({NAMED_SQL}) JOIN dim_category USING (category_name) GROUP BY ALL
        """,
        "clean",
        "dim_category",
    ),
)
def v_sales_by_category(spark: SparkSession, sf: str) -> DataFrame:
    view = S.category_view(*built_star(spark, sf))
    return view.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query(
    "v_sales_by_category_approx",
)
def v_sales_by_category_approx(spark: SparkSession, sf: str) -> DataFrame:
    """As the view, with SKUs counted by sketch."""
    return S.category_view(*built_star(spark, sf), approximate=True)


MACRO_SQL = """
  SELECT week, housing_starts_index, lumber_price_index, mortgage_rate,
    coalesce(season_factor, 1) AS season_factor, cast(revenue AS double) AS weekly_revenue,
    units AS weekly_units
  FROM macro_w LEFT JOIN (
    SELECT transaction_date, sum(cast(revenue AS decimal(15,2))) AS revenue,
      cast(sum(c.units) AS bigint) AS units FROM clean c GROUP BY 1) ON week = transaction_date
"""


@query("v_macro_impact", sql(MACRO_SQL, "clean"))
def v_macro_impact(spark: SparkSession, sf: str) -> DataFrame:
    view = S.macro_view(*built_star(spark, sf))
    doubles = [*S.MACRO_DECIMALS, "weekly_revenue"]
    return view.withColumns({c: F.col(c).cast("double") for c in doubles})


@query(
    "unknown_members",
    sql(
        """
        SELECT view, category_name, cast(sum(units) AS bigint) AS units FROM (
          SELECT unnest(['v_weekly_sales', 'v_sales_by_category']) AS view, units,
            CASE WHEN product_category IN ('LARGE', 'SMALL') THEN 'unknown' ELSE product_category END
              AS category_name
          FROM clean) GROUP BY ALL
        """,
        "clean",
    ),
)
def unknown_members(spark: SparkSession, sf: str) -> DataFrame:
    """Units by category in both views, where one category's prefix is in no map and another's
    SKUs are in no dimension: all of them stay, under the unknown category."""
    clean = clean_rows(spark, sf)
    dims = dimensions(spark, sf, clean)
    known = {p: c for p, c in B.PREFIXES.items() if c != "LARGE"}
    dims["category"] = S.seed_categories(spark, known)
    empty = spark.createDataFrame([], S.PRODUCT_SCHEMA)
    listed = clean.filter("product_category <> 'SMALL'")
    products = S.new_products(listed, empty, dims["category"], known)
    dims |= {"product": stage(S.with_unknown_product(products), "product"), "date": stage(dims["date"], "date")}
    fact = S.contributions(clean, dims, ORDER)
    parts = [
        view(fact, dims).groupBy("category_name").agg(F.sum("total_units").alias("units")).withColumn("view", F.lit(name))
        for name, view in (("v_weekly_sales", S.weekly_sales_view), ("v_sales_by_category", S.category_view))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "macro_preserving_join",
    sql(
        """
        SELECT week, cast(sum(revenue_cents) AS bigint) AS revenue_cents,
          cast(sum(units) AS bigint) AS units
        FROM macro_w LEFT JOIN sales ON week = date GROUP BY 1
        """,
        "macro_w",
        "sales",
    ),
)
def macro_preserving_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every macro week, with or without sales."""
    weekly = (
        B.sales(spark, sf, "date", "revenue_cents", "units")
        .groupBy("date")
        .agg(F.sum("revenue_cents").alias("revenue_cents"), F.sum("units").alias("units"))
    )
    weeks = B.macro(spark, sf).select("week")
    return weeks.join(weekly, F.col("week") == F.col("date"), "left").drop("date")
