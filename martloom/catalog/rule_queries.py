"""Validation rules, constraints and scalar projections on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import columns as C
from ..functions import rules as R
from ..operators import quality as Q
from ..plans import star
from .registry import query
from .sqltext import sql


def one_rule(name: str, rule: R.Rule, column: str, where: str) -> None:
    """Register the rows that break one rule."""

    text = f"""SELECT row_key AS row_index, '{rule.column}' AS "column", {column} AS value,
      '{rule.error_type}' AS error_type FROM landing WHERE {where}"""

    @query(name, sql(text, "landing"))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = B.landing(spark, sf, "row_key", rule.column)
        errors = Q.error_rows(Q.invalid_rows(R.annotate(rows, [rule])), [rule], "row_key")
        return errors.select("row_index", "column", "value", "error_type")


one_rule(
    "rule_date",
    R.is_date("date"),
    "date",
    "date IS NOT NULL AND try_strptime(date, '%Y-%m-%d') IS NULL",
)
one_rule(
    "rule_units_type",
    R.is_numeric("units"),
    "units",
    "units IS NOT NULL AND try_cast(units AS double) IS NULL",
)
one_rule(
    "rule_units_range",
    R.in_range("units", *B.BOUNDS.units),
    "units",
    "try_cast(units AS double) < 1 OR try_cast(units AS double) > 49",
)
one_rule(
    "rule_price_type",
    R.is_numeric("unit_price"),
    "unit_price",
    "unit_price IS NOT NULL AND try_cast(unit_price AS double) IS NULL",
)
one_rule(
    "rule_price_range",
    R.in_range("unit_price", 50, 100000, open_low=True),
    "unit_price",
    "try_cast(unit_price AS double) <= 50 OR try_cast(unit_price AS double) > 100000",
)
one_rule(
    "rule_region",
    R.one_of("region", B.REGIONS),
    "region",
    "region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')",
)
one_rule(
    "rule_category",
    R.one_of("product_category", B.CATEGORIES),
    "product_category",
    "product_category NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')",
)
one_rule("rule_channel", R.one_of("channel", ["pro_dealer"]), "channel", "channel <> 'pro_dealer'")
one_rule(
    "rule_customer",
    R.one_of("customer_type", B.CUSTOMERS),
    "customer_type",
    "customer_type NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
)
one_rule(
    "rule_lumber",
    R.in_range("lumber_price_index", *B.BOUNDS.lumber_price_index),
    "lumber_price_index",
    "cast(lumber_price_index AS double) < 400 OR cast(lumber_price_index AS double) > 620",
)
one_rule("rule_sku_format", R.has_text("sku"), "sku", "strpos(sku, '-') = 0")
one_rule("rule_required", R.required("units"), "units", "units IS NULL")


def annotated(spark: SparkSession, sf: str) -> DataFrame:
    return R.annotate(B.landing_layer(spark, sf), B.landing_rules())


@query("validate_split", sql("SELECT * FROM valid", "valid"))
def validate_split(spark: SparkSession, sf: str) -> DataFrame:
    return Q.valid_rows(annotated(spark, sf))


@query(
    "error_rows",
    sql(
        """SELECT row_key AS row_index, "column", value, error_type, channel AS original_channel
        FROM errors JOIN landing USING (row_key)""",
        "errors",
    ),
)
def error_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Flat errors; the kept original is read back from its JSON."""
    errors = Q.error_rows(Q.invalid_rows(annotated(spark, sf)), B.landing_rules(), "row_key")
    original = F.get_json_object("original_data", "$.channel").alias("original_channel")
    return errors.select("row_index", "column", "value", "error_type", original)


@query(
    "validation_metrics",
    sql(
        """
        SELECT t AS total_rows, t - i AS valid_rows, i AS invalid_rows, e AS error_count,
          i * 100.0::double / cast(t AS double) AS error_rate_pct
        FROM (SELECT (SELECT count(*) FROM landing) AS t,
          (SELECT count(DISTINCT row_key) FROM errors) AS i, (SELECT count(*) FROM errors) AS e)
        """,
        "errors",
    ),
)
def validation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return Q.metrics(B.landing_layer(spark, sf), B.landing_rules())


@query(
    "error_distribution",
    sql("SELECT error_type, count(*) AS error_count FROM errors GROUP BY 1", "errors"),
)
def error_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return Q.error_type_counts(B.landing_layer(spark, sf), B.landing_rules())


@query(
    "check_constraints",
    sql(
        """
        WITH c AS (SELECT month, week_of_year, units, unit_price, revenue,
          cast(quarter(date) AS integer) AS quarter FROM sales)
        SELECT 'month_range' AS check_name, count(*) FILTER (NOT month BETWEEN 1 AND 12) AS violations
        FROM c
        UNION ALL SELECT 'week_range', count(*) FILTER (NOT week_of_year BETWEEN 1 AND 53) FROM c
        UNION ALL SELECT 'quarter_range', count(*) FILTER (NOT quarter BETWEEN 1 AND 4) FROM c
        UNION ALL SELECT 'units_not_negative', count(*) FILTER (NOT units >= 0) FROM c
        UNION ALL SELECT 'price_positive', count(*) FILTER (NOT unit_price > 0) FROM c
        UNION ALL SELECT 'revenue_not_negative', count(*) FILTER (NOT revenue >= 0) FROM c
        UNION ALL SELECT 'small_order', count(*) FILTER (NOT units <= 45) FROM c
        """,
        "sales",
    ),
)
def check_constraints(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(
        spark, sf, "date", "month", "week_of_year", "units", "unit_price", "revenue"
    ).withColumn("quarter", F.quarter("date"))
    checks = {**Q.calendar_checks(), **Q.measure_checks(), "small_order": F.col("units") <= 45}
    return Q.constraint_counts(rows, checks)


@query(
    "check_unique",
    sql(
        """SELECT date, region, sku, channel, customer_type, count(*) AS row_count
        FROM sales GROUP BY ALL HAVING count(*) > 1""",
        "sales",
    ),
)
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return Q.duplicate_keys(B.sales(spark, sf, *B.STAR_KEY), B.STAR_KEY)


@query(
    "check_fk",
    sql(
        """SELECT date, count(*) AS orphan_rows FROM sales
        WHERE date NOT IN (SELECT week FROM macro_w) GROUP BY 1""",
        "sales",
        "macro_w",
    ),
)
def check_fk(spark: SparkSession, sf: str) -> DataFrame:
    alone = Q.orphans(B.sales(spark, sf, "date"), "date", B.macro(spark, sf), "week")
    return alone.groupBy("date").agg(F.count(F.lit(1)).alias("orphan_rows"))


@query(
    "extra_ranges",
    sql(
        """
        WITH r AS (SELECT cast(revenue AS double) AS revenue,
          cast(housing_starts_index AS double) AS h, cast(mortgage_rate AS double) AS m
          FROM landing)
        SELECT 'revenue' AS "column", 'OUT_OF_RANGE' AS error_type, 'warn' AS severity,
          count(*) FILTER (revenue < 0) AS broken_rows FROM r
        UNION ALL SELECT 'housing_starts_index', 'OUT_OF_RANGE', 'warn',
          count(*) FILTER (h < 90 OR h > 110) FROM r
        UNION ALL SELECT 'mortgage_rate', 'OUT_OF_RANGE', 'warn',
          count(*) FILTER (m < 0.25::double OR m > 0.4::double) FROM r
        """,
        "landing",
    ),
)
def extra_ranges(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.landing(spark, sf, "revenue", "housing_starts_index", "mortgage_rate")
    rules = [r for r in R.warning_rules(B.BOUNDS) if r.column in rows.columns]
    return Q.rule_counts(rows, rules)


@query(
    "extra_ranges_macro",
    sql(
        """SELECT 'season_factor' AS "column", 'OUT_OF_RANGE' AS error_type, 'warn' AS severity,
          count(*) FILTER (season_factor < 0 OR season_factor > 1.5::double) AS broken_rows
        FROM macro_w""",
        "macro_w",
    ),
)
def extra_ranges_macro(spark: SparkSession, sf: str) -> DataFrame:
    rules = [r for r in R.warning_rules(B.BOUNDS) if r.column == "season_factor"]
    return Q.rule_counts(B.macro(spark, sf), rules)


@query(
    "revenue_mismatch",
    sql(
        """
        WITH g AS (SELECT abs(revenue_cents - price_cents * units) AS gap FROM sales)
        SELECT count(*) FILTER (gap > 1) AS mismatch_rows, round(max(gap) / 100.0::double, 2)
          AS max_difference, count(*) FILTER (gap > 0) AS differing_rows FROM g
        """,
        "sales",
    ),
)
def revenue_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """Price times units against revenue. In cents, so that a difference of exactly one cent is
    within the tolerance on both engines."""
    rows = B.sales(spark, sf, "units", "price_cents", "revenue_cents").select(
        "units", F.col("price_cents").alias("unit_price"), F.col("revenue_cents").alias("revenue")
    )
    found = Q.revenue_mismatch(rows, tolerance=1)
    return found.select(
        "mismatch_rows",
        F.round(F.col("max_difference").cast("double") / 100, 2).alias("max_difference"),
        F.col("inexact_rows").alias("differing_rows"),
    )


# -- projections -------------------------------------------------------------------------------


@query(
    "type_cast",
    sql(
        """
        SELECT row_key, cast(trunc(try_cast(units AS double)) AS integer) AS units,
          try_cast(unit_price AS double) AS unit_price, try_cast(revenue AS double) AS revenue,
          cast(try_strptime(date, '%Y-%m-%d') AS date) AS date
        FROM landing
        """,
        "landing",
    ),
)
def type_cast(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.landing(spark, sf, "row_key", "date", "units", "unit_price", "revenue")
    return rows.select(
        "row_key",
        C.as_int(F.col("units")).alias("units"),
        C.as_number(F.col("unit_price")).alias("unit_price"),
        C.as_number(F.col("revenue")).alias("revenue"),
        C.as_date(F.col("date")).alias("date"),
    )


@query(
    "sku_prefix",
    sql("SELECT row_key, sku, split_part(sku, '-', 1) AS prefix FROM landing", "landing"),
)
def sku_prefix(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.landing(spark, sf, "row_key", "sku")
    return rows.select("row_key", "sku", C.sku_prefix(F.col("sku")).alias("prefix"))


@query(
    "sku_prefix3",
    """
    SELECT s_suppkey, CASE WHEN length(cast(s_suppkey AS varchar)) >= 3
      THEN substr(cast(s_suppkey AS varchar), 1, 3) ELSE 'UNK' END AS prefix FROM supplier
    """,
)
def sku_prefix3(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier numbers as codes: some are shorter than three characters."""
    rows = B.table(spark, sf, "supplier")
    code = F.col("s_suppkey").cast("string")
    return rows.select("s_suppkey", C.sku_prefix3(code).alias("prefix"))


@query(
    "recompute_revenue",
    sql("SELECT row_key, units * unit_price AS revenue FROM sales", "sales"),
)
def recompute_revenue(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "row_key", "units", "unit_price")
    return rows.withColumn("revenue", F.col("units") * F.col("unit_price")).select(
        "row_key", "revenue"
    )


@query(
    "rename",
    sql(
        """SELECT transaction_date, count(*) AS row_count FROM clean GROUP BY 1""",
        "clean",
    ),
)
def rename(spark: SparkSession, sf: str) -> DataFrame:
    rules = [*B.landing_rules(), *[R.required(c) for c in ("date", "units", "unit_price")]]
    clean = star.transform_transactions(B.landing_layer(spark, sf), rules)
    return clean.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "fill_default",
    sql(
        "SELECT week AS week_date, coalesce(season_factor, 1.0::double) AS season_factor FROM macro_w",
        "macro_w",
    ),
)
def fill_default(spark: SparkSession, sf: str) -> DataFrame:
    return star.transform_macro(B.macro(spark, sf)).select("week_date", "season_factor")


@query(
    "date_id",
    sql(
        """SELECT date, cast(strftime(date, '%Y%m%d') AS integer) AS date_id, count(*) AS row_count
        FROM sales GROUP BY 1, 2""",
        "sales",
    ),
)
def date_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "date")
    return rows.groupBy("date", C.date_id(F.col("date")).alias("date_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "calendar",
    """
    SELECT DISTINCT d AS day, cast(year(d) AS integer) AS year, cast(month(d) AS integer) AS month,
      cast(quarter(d) AS integer) AS quarter, cast(week(d) AS integer) AS week_of_year,
      cast(isodow(d) - 1 AS integer) AS day_of_week, dayname(d) AS day_name
    FROM (SELECT cast(o_orderdate AS date) AS d FROM orders)
    """,
)
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Days of orders: every weekday occurs."""
    days = B.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    fields = [c.alias(n) for n, c in C.calendar(F.col("day")).items()]
    return days.distinct().select("day", *fields)


@query(
    "calendar_ext",
    """
    SELECT DISTINCT d AS day, monthname(d) AS month_name, isodow(d) >= 6 AS is_weekend,
      cast(year(d + INTERVAL 3 MONTH) AS integer) AS fiscal_year,
      cast(quarter(d + INTERVAL 3 MONTH) AS integer) AS fiscal_quarter
    FROM (SELECT cast(o_orderdate AS date) AS d FROM orders)
    """,
)
def calendar_ext(spark: SparkSession, sf: str) -> DataFrame:
    days = B.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    fields = [c.alias(n) for n, c in C.calendar_ext(F.col("day"), fiscal_start=10).items()]
    return days.distinct().select("day", *fields)


@query(
    "region_code",
    """
    SELECT c_custkey, upper(substr(r_name, 1, 3)) AS region_code,
      concat('Product ', c_name) AS display_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def region_code(spark: SparkSession, sf: str) -> DataFrame:
    rows = (
        B.table(spark, sf, "customer")
        .join(B.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(B.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.select(
        "c_custkey",
        C.short_code(F.col("r_name")).alias("region_code"),
        C.product_name(F.col("c_name")).alias("display_name"),
    )


@query(
    "prefix_to_category",
    sql(
        """SELECT sku, product_category AS category, count(*) AS row_count FROM sales
        GROUP BY 1, 2""",
        "sales",
    ),
)
def prefix_to_category(spark: SparkSession, sf: str) -> DataFrame:
    """Category out of the code prefix; must equal the part's own category."""
    rows = B.sales(spark, sf, "sku")
    category = C.map_value(C.sku_prefix(F.col("sku")), B.PREFIXES)
    return rows.groupBy("sku", category.alias("category")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "ratio",
    sql(
        """
        SELECT team, year, cast(wins AS double) /
          (cast(wins AS double) + cast(losses AS double) + coalesce(cast(ot_losses AS double), 0))
          AS won, goals_for - goals_against AS goal_gap
        FROM panel
        """,
        "panel",
    ),
)
def ratio(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.panel(spark, sf)
    won = C.ratio(F.col("wins"), F.col("losses"), F.col("ot_losses"))
    gap = F.col("goals_for") - F.col("goals_against")
    return rows.select("team", "year", won.alias("won"), gap.alias("goal_gap"))


@query(
    "threshold_class",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_quantity / 50 >= 0.5::double THEN 1 ELSE 0 END AS pred_class,
      round(abs(l_quantity / 50 - 0.5::double), 6) AS confidence,
      CASE WHEN (l_quantity / 50 >= 0.5::double) = (l_returnflag = 'R') THEN 'Correct'
        WHEN l_quantity / 50 >= 0.5::double THEN 'False Positive'
        ELSE 'False Negative' END AS outcome,
      CASE WHEN l_discount - 0.05::double > 0.005::double THEN 'BETTER'
        WHEN l_discount - 0.05::double < -0.005::double THEN 'WORSE' ELSE '~EQUAL' END AS verdict
    FROM lineitem
    """,
)
def threshold_class(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "lineitem")
    score = F.col("l_quantity") / 50
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        C.predicted_class(score).alias("pred_class"),
        F.round(C.confidence(score), 6).alias("confidence"),
        C.outcome(label, score).alias("outcome"),
        C.verdict(F.col("l_discount") - F.lit(0.05)).alias("verdict"),
    )
