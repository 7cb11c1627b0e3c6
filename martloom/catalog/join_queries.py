"""Joins, aggregates, duplicates, ordering and set operations on the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..operators import duplicates as D
from ..operators import lookup as L
from ..operators import panel as P
from ..operators import profile as R
from ..operators import quality as Q
from ..operators.ordered import average_ranks
from ..operators.selection import exact_quantiles
from ..plans import star
from .registry import query
from .sqltext import sql

def count_all() -> Column:
    return F.count(F.lit(1))


def id_counts(spark, sf, column, dim, key, id_column, unknown_id=-1) -> DataFrame:
    rows = L.lookup(B.sales(spark, sf, column), dim, column, key, id_column, unknown_id)
    return rows.groupBy(column, id_column).agg(count_all().alias("row_count"))


@query(
    "fk_product",
    sql(
        """
        WITH d AS (SELECT concat(upper(substr(p_type, 1, 3)), '-', cast(p_partkey AS varchar)) AS sku,
          p_partkey AS product_id FROM part WHERE p_size > 5)
        SELECT s.sku, coalesce(d.product_id, 1) AS product_id, count(*) AS row_count
        FROM sales s LEFT JOIN d ON s.sku = d.sku GROUP BY 1, 2
        """,
        "sales",
    ),
)
def fk_product(spark: SparkSession, sf: str) -> DataFrame:
    """Small parts are unknown to the dimension and fall to member 1."""
    dim = B.table(spark, sf, "part").filter("p_size > 5")
    code = F.concat(
        F.upper(F.substring("p_type", 1, 3)), F.lit("-"), F.col("p_partkey").cast("string")
    )
    dim = dim.select(code.alias("sku"), F.col("p_partkey").alias("product_id"))
    return id_counts(spark, sf, "sku", dim, "sku", "product_id", 1)


@query(
    "fk_region",
    sql(
        """SELECT region, coalesce(region_id, -1) AS region_id, count(*) AS row_count
        FROM sales LEFT JOIN (SELECT * FROM dim_region WHERE region_name <> 'ASIA')
          ON region = region_name GROUP BY 1, 2""",
        "dim_region",
    ),
)
def fk_region(spark: SparkSession, sf: str) -> DataFrame:
    """One region is missing from the dimension."""
    dim = star.seed_regions(spark, [s for s in B.REGION_SEEDS if s[1] != "ASIA"])
    return id_counts(spark, sf, "region", dim, "region_name", "region_id")


@query(
    "fk_region_map",
    sql(
        """SELECT region, coalesce(region_id, -1) AS region_id, count(*) AS row_count
        FROM sales LEFT JOIN (SELECT * FROM dim_region WHERE region_name <> 'ASIA')
          ON region = region_name GROUP BY 1, 2""",
        "dim_region",
    ),
)
def fk_region_map(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup from a literal map: no join at all."""
    ids = {name: i for i, name, _ in B.REGION_SEEDS if name != "ASIA"}
    rows = B.sales(spark, sf, "region")
    found = L.map_lookup(F.col("region"), ids)
    return rows.groupBy("region", found.alias("region_id")).agg(count_all().alias("row_count"))


@query(
    "fk_channel",
    sql(
        """SELECT channel, channel_id, count(*) AS row_count
        FROM sales JOIN dim_channel ON channel = channel_name GROUP BY 1, 2""",
        "dim_channel",
    ),
)
def fk_channel(spark: SparkSession, sf: str) -> DataFrame:
    dim = star.seed_channels(spark, B.CHANNEL_SEEDS)
    return id_counts(spark, sf, "channel", dim, "channel_name", "channel_id")


@query(
    "fk_customer",
    sql(
        """SELECT s.customer_type, customer_id, count(*) AS row_count
        FROM sales s JOIN dim_customer d ON s.customer_type = d.customer_type GROUP BY 1, 2""",
        "sales",
        "dim_customer",
    ),
)
def fk_customer(spark: SparkSession, sf: str) -> DataFrame:
    dim = star.seed_customers(spark, B.CUSTOMER_SEEDS)
    return id_counts(spark, sf, "customer_type", dim, "customer_type", "customer_id")


@query(
    "fk_macro",
    sql(
        """SELECT date, macro_id, count(*) AS row_count
        FROM sales LEFT JOIN dim_macro ON date = week GROUP BY 1, 2""",
        "sales",
        "dim_macro",
    ),
)
def fk_macro(spark: SparkSession, sf: str) -> DataFrame:
    dim = star.macro_rows(star.transform_macro(B.macro(spark, sf)))
    return id_counts(spark, sf, "date", dim, "week", "macro_id", None)


@query(
    "weekly_macro_join",
    sql(
        """
        WITH w AS (SELECT date, cast(sum(revenue_cents) AS bigint) AS revenue_cents,
          cast(sum(units) AS bigint) AS units FROM sales GROUP BY 1)
        SELECT w.*, housing_starts_index, lumber_price_index, mortgage_rate, season_factor
        FROM w LEFT JOIN macro_w ON date = week
        """,
        "sales",
        "macro_w",
    ),
)
def weekly_macro_join(spark: SparkSession, sf: str) -> DataFrame:
    return weekly_with_macro(spark, sf)


def weekly_with_macro(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly totals with that week's drivers; sales are summed before the join."""
    weekly = (
        B.sales(spark, sf, "date", "revenue_cents", "units")
        .groupBy("date")
        .agg(F.sum("revenue_cents").alias("revenue_cents"), F.sum("units").alias("units"))
    )
    macro = B.macro(spark, sf)
    return weekly.join(macro, F.col("date") == F.col("week"), "left").drop("week")


@query(
    "next_period_join",
    sql(
        """SELECT a.team, a.year, a.win_rate, b.win_rate AS next_win_rate
        FROM panel_gap a JOIN panel_gap b ON a.team = b.team AND b.year = a.year + 1""",
        "panel_gap",
    ),
)
def next_period_join(spark: SparkSession, sf: str) -> DataFrame:
    pairs = P.next_period_join(B.panel_with_gap(spark, sf), "win_rate", "next_win_rate")
    return pairs.select("team", "year", "win_rate", "next_win_rate")


@query(
    "unpaired_rows",
    sql(
        """SELECT a.year, count(*) AS unpaired_rows FROM panel_gap a
        LEFT JOIN panel_gap b ON a.team = b.team AND b.year = a.year + 1
        WHERE b.team IS NULL GROUP BY 1""",
        "panel_gap",
    ),
)
def unpaired_rows(spark: SparkSession, sf: str) -> DataFrame:
    return P.unpaired_by_period(B.panel_with_gap(spark, sf))


@query(
    "new_members",
    """
    SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'O'
    EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
    """,
)
def new_members(spark: SparkSession, sf: str) -> DataFrame:
    """Buyers with open orders that no filled order knows."""
    orders = B.table(spark, sf, "orders")
    known = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    return L.new_members(
        orders.filter("o_orderstatus = 'O'"), "o_custkey", known.distinct(), "custkey"
    )


@query(
    "exists_members",
    sql(
        """SELECT date, count(*) AS row_count FROM sales
        WHERE date IN (SELECT week FROM macro_w) GROUP BY 1""",
        "sales",
        "macro_w",
    ),
)
def exists_members(spark: SparkSession, sf: str) -> DataFrame:
    known = Q.members(B.sales(spark, sf, "date"), "date", B.macro(spark, sf), "week")
    return known.groupBy("date").agg(count_all().alias("row_count"))


@query(
    "key_lookup_rows",
    sql(
        """
        WITH k AS (SELECT date, region, product_category, sku, channel, customer_type FROM sales
          GROUP BY ALL HAVING count(*) > 1 ORDER BY 1, 2, 3, 4, 5, 6 LIMIT 1)
        SELECT row_key, units, revenue_cents FROM sales s JOIN k
          USING (date, region, product_category, sku, channel, customer_type)
        """,
        "sales",
    ),
)
def key_lookup_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of one composite key: the first repeated one."""
    rows = B.sales(spark, sf, "row_key", *B.DUPLICATE_KEY, "units", "revenue_cents")
    first = Q.duplicate_keys(rows, B.DUPLICATE_KEY).orderBy(*B.DUPLICATE_KEY).limit(1)
    return L.rows_with_keys(rows, first, B.DUPLICATE_KEY).select(
        "row_key", "units", "revenue_cents"
    )


# -- aggregates --------------------------------------------------------------------------------

PROFILED = ["date", "region", "product_category", "sku", "channel", "customer_type", "units"]


@query(
    "cardinality",
    sql(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM sales"
            for c in PROFILED
        ),
        "sales",
    ),
)
def cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return R.cardinality(B.sales(spark, sf, *PROFILED), PROFILED)


@query(
    "distinct_values",
    sql(
        "\nUNION\n".join(
            f"SELECT '{c}' AS column_name, {c} AS value FROM sales"
            for c in ("region", "product_category", "channel", "customer_type")
        ),
        "sales",
    ),
)
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["region", "product_category", "channel", "customer_type"]
    return R.distinct_values(B.sales(spark, sf, *columns), columns)


@query(
    "temporal_coverage",
    sql(
        """SELECT min(date) AS min_date, max(date) AS max_date,
          count(DISTINCT date) AS distinct_dates,
          cast(sum(revenue_cents) AS bigint) AS total_revenue_cents,
          cast(sum(units) AS bigint) AS total_units FROM sales""",
        "sales",
    ),
)
def temporal_coverage(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "date", "revenue_cents", "units")
    return R.temporal_coverage(rows, "date", ["revenue_cents", "units"])


@query(
    "null_profile",
    sql(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,
            count(*) FILTER ({c} IS NULL) * 100.0::double / cast(count(*) AS double) AS null_pct
            FROM landing"""
            for c in ("date", "sku", "units", "unit_price", "lumber_price_index")
        ),
        "landing",
    ),
)
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["date", "sku", "units", "unit_price", "lumber_price_index"]
    return R.null_profile(B.landing(spark, sf, *columns))


@query(
    "season_by_month",
    sql(
        """
        SELECT month(week)::integer AS month, round(cast(sum(m) AS double)
          / (1000 * count(m))::double, 3) AS season_factor
        FROM (SELECT week, cast(round(season_factor * 1000) AS bigint) AS m FROM macro_w)
        GROUP BY 1
        """,
        "macro_w",
    ),
)
def season_by_month(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.macro(spark, sf).select(
        F.month("week").alias("month"),
        F.round(F.col("season_factor") * 1000).cast("bigint").alias("m"),
    )
    mean = R.mean_of_units(F.sum("m"), F.count("m"), 1000)
    return rows.groupBy("month").agg(F.round(mean, 3).alias("season_factor"))


@query(
    "revenue_by_month",
    sql(
        """SELECT month, cast(sum(revenue_cents) AS bigint) AS revenue_cents
        FROM sales GROUP BY 1""",
        "sales",
    ),
)
def revenue_by_month(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "month", "revenue_cents")
    return R.sum_by(rows, "month", "revenue_cents", "revenue_cents")


@query(
    "category_stats",
    sql(
        """
        SELECT product_category, cast(sum(revenue_cents) AS bigint) AS revenue_cents,
          cast(sum(units) AS bigint) AS units,
          cast(cast(sum(revenue_cents) AS bigint) AS double) / (count(*) * 100)::double
            AS mean_revenue,
          cast(cast(sum(units) AS bigint) AS double) / count(*)::double AS mean_units,
          cast(cast(sum(price_cents) AS bigint) AS double) / (count(*) * 100)::double
            AS mean_price
        FROM sales GROUP BY 1
        """,
        "sales",
    ),
)
def category_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "product_category", "revenue_cents", "units", "price_cents")
    return (
        rows.groupBy("product_category")
        .agg(
            F.sum("revenue_cents").alias("revenue_cents"),
            F.sum("units").alias("units"),
            R.mean_of_units(F.sum("revenue_cents"), count_all(), 100).alias("mean_revenue"),
            R.mean_of_units(F.sum("units"), count_all()).alias("mean_units"),
            R.mean_of_units(F.sum("price_cents"), count_all(), 100).alias("mean_price"),
        )
        .orderBy("revenue_cents")
    )


@query(
    "weekly_first",
    sql(
        """SELECT date, arg_min(lumber_price_index, row_key) AS lumber_price_index
        FROM sales_m GROUP BY 1""",
        "sales_m",
    ),
)
def weekly_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "row_key", "date", "lumber_price_index")
    return R.first_by(rows, "date", "lumber_price_index", ["row_key"], "lumber_price_index")


@query(
    "weekly_sales",
    sql(
        """SELECT date, cast(sum(revenue_cents) AS bigint) AS revenue_cents,
        cast(sum(units) AS bigint) AS units FROM sales GROUP BY 1""",
        "sales",
    ),
)
def weekly_sales(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "date", "revenue_cents", "units")
    return rows.groupBy("date").agg(
        F.sum("revenue_cents").alias("revenue_cents"), F.sum("units").alias("units")
    )


@query(
    "entities_per_period",
    """
    SELECT cast(year(o_orderdate) AS integer) AS year, count(*) AS row_count,
      count(DISTINCT o_custkey) AS entity_count FROM orders GROUP BY 1
    """,
)
def entities_per_period(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey")
    return R.group_sizes(rows, "year", "o_custkey")


@query(
    "entities_describe",
    """
    WITH s AS (SELECT year(o_orderdate) AS y, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1)
    SELECT min(n) AS min_value, max(n) AS max_value, round(avg(n), 4) AS mean_value,
      round(stddev_samp(n), 4) AS std_value, round(quantile_cont(n, 0.25), 4) AS q1,
      round(quantile_cont(n, 0.5), 4) AS median, round(quantile_cont(n, 0.75), 4) AS q3 FROM s
    """,
)
def entities_describe(spark: SparkSession, sf: str) -> DataFrame:
    """Distribution of the yearly sizes; the percentiles run over one value per year."""
    sizes = entities_per_period(spark, sf)
    n = F.col("entity_count")
    return sizes.agg(
        F.min(n).alias("min_value"),
        F.max(n).alias("max_value"),
        F.round(F.avg(n), 4).alias("mean_value"),
        F.round(F.stddev_samp(n), 4).alias("std_value"),
        F.round(F.percentile(n, F.lit(0.25)), 4).alias("q1"),
        F.round(F.percentile(n, F.lit(0.5)), 4).alias("median"),
        F.round(F.percentile(n, F.lit(0.75)), 4).alias("q3"),
    )


@query(
    "period_success",
    sql(
        """SELECT target_year, count(*) AS entity_count,
          cast(sum(target) AS double) / count(*)::double AS success_rate
        FROM pairs GROUP BY 1""",
        "pairs",
    ),
)
def period_success(spark: SparkSession, sf: str) -> DataFrame:
    return P.period_success(P.label_next_period(B.panel(spark, sf)))


@query(
    "period_halves",
    sql(
        """
        WITH y AS (SELECT target_year, cast(sum(target) AS double) / count(*)::double AS r
          FROM pairs GROUP BY 1),
        m AS (SELECT (min(target_year) + max(target_year)) // 2 AS mid FROM y)
        SELECT CASE WHEN target_year <= mid THEN 'early' ELSE 'late' END AS half,
          min(target_year) AS first_year, max(target_year) AS last_year,
          round(avg(r), 6) AS mean_success_rate FROM y, m GROUP BY 1
        """,
        "pairs",
    ),
)
def period_halves(spark: SparkSession, sf: str) -> DataFrame:
    halves = P.early_late(P.label_next_period(B.panel(spark, sf)))
    return halves.withColumn("mean_success_rate", F.round("mean_success_rate", 6))


@query(
    "group_median",
    sql(
        """SELECT year, round(quantile_cont(win_rate, 0.5), 6) AS median FROM panel GROUP BY 1""",
        "panel",
    ),
)
def group_median(spark: SparkSession, sf: str) -> DataFrame:
    medians = exact_quantiles(B.panel(spark, sf), "win_rate", {"median": 0.5}, ["year"])
    return medians.select("year", F.round("median", 6).alias("median"))


@query(
    "group_median_rows",
    sql(
        """SELECT product_category, count(*) AS n,
          round(quantile_cont(revenue, 0.5), 4) AS median,
          round(quantile_cont(revenue, 0.9), 4) AS p90 FROM sales GROUP BY 1""",
        "sales",
    ),
)
def group_median_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles over all sales rows of a few large groups."""
    rows = B.sales(spark, sf, "product_category", "revenue")
    out = exact_quantiles(rows, "revenue", {"median": 0.5, "p90": 0.9}, ["product_category"])
    return out.withColumns({c: F.round(c, 4) for c in ("median", "p90")})


@query(
    "mode",
    """
    SELECT l_quantity, count(*) AS row_count FROM lineitem GROUP BY 1
    ORDER BY row_count DESC, l_quantity LIMIT 1
    """,
)
def mode(spark: SparkSession, sf: str) -> DataFrame:
    return R.most_common(B.table(spark, sf, "lineitem"), "l_quantity")


@query("value_counts", "SELECT p_brand, count(*) AS row_count FROM part GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.value_counts(B.table(spark, sf, "part"), "p_brand")


# -- duplicates and ranks ----------------------------------------------------------------------


@query(
    "dup_flag",
    sql(
        """
        SELECT row_key, row_number() OVER (PARTITION BY date, region, product_category, sku,
          channel, customer_type ORDER BY row_key) > 1 AS is_duplicate FROM sales
        """,
        "sales",
    ),
)
def dup_flag(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "row_key", *B.DUPLICATE_KEY)
    return D.flag_duplicates(rows, B.DUPLICATE_KEY, ["row_key"]).select("row_key", "is_duplicate")


@query(
    "dup_all",
    sql(
        """
        SELECT row_key, n AS group_size FROM (SELECT row_key, count(*) OVER (PARTITION BY date,
          region, product_category, sku, channel, customer_type) AS n FROM sales) WHERE n > 1
        """,
        "sales",
    ),
)
def dup_all(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "row_key", *B.DUPLICATE_KEY)
    return D.all_duplicates(rows, B.DUPLICATE_KEY, ["row_key"]).select("row_key", "group_size")


@query(
    "dup_exact",
    """
    SELECT cast(sum(n - 1) AS bigint) AS duplicate_rows FROM (
      SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity,
        l_discount, l_tax, l_shipdate)
    """,
)
def dup_exact(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_shipdate"
    )
    return D.exact_duplicates(rows)


@query(
    "broadcast_group_stat",
    sql(
        """SELECT team, year, round(median(win_rate) OVER (PARTITION BY year), 6) AS period_median,
          win_rate > median(win_rate) OVER (PARTITION BY year) AS above FROM panel""",
        "panel",
    ),
)
def broadcast_group_stat(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.with_period_median(B.panel(spark, sf), "win_rate")
    above = F.col("win_rate") > F.col("period_median")
    return rows.select(
        "team", "year", F.round("period_median", 6).alias("period_median"), above.alias("above")
    )


@query(
    "lead_label",
    sql(
        """
        SELECT team, year, win_rate, next_win_rate FROM (
          SELECT team, year, win_rate, lead(win_rate) OVER w AS next_win_rate,
            lead(year) OVER w AS next_year FROM panel_gap
          WINDOW w AS (PARTITION BY team ORDER BY year)) WHERE next_year = year + 1
        """,
        "panel_gap",
    ),
)
def lead_label(spark: SparkSession, sf: str) -> DataFrame:
    pairs = P.lead_pairs(B.panel_with_gap(spark, sf), "win_rate", "next_win_rate")
    return pairs.select("team", "year", "win_rate", "next_win_rate")


@query(
    "rank_avg",
    """
    WITH c AS (SELECT l_extendedprice AS price, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT price, n, cast(sum(n) OVER (ORDER BY price) AS double) - (n - 1) / 2.0::double
      AS avg_rank FROM c
    """,
)
def rank_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Average rank of every distinct price over all rows."""
    counts = (
        B.table(spark, sf, "lineitem")
        .groupBy(F.col("l_extendedprice").alias("price"))
        .agg(count_all().alias("n"))
    )
    return average_ranks(counts, "price").select("price", "n", "avg_rank")


# -- ordering ----------------------------------------------------------------------------------


@query(
    "sort_by_date",
    sql(
        """SELECT transaction_date, count(*) AS row_count, true AS sorted FROM clean
        GROUP BY 1""",
        "clean",
    ),
)
def sort_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written in date order per file, read back file by file: inside a file no date is
    smaller than the one before it."""
    from pyspark.sql import Window

    from ..functions.rules import required
    from ..workspace import fresh_dir

    rules = [*B.landing_rules(), *[required(c) for c in ("date", "units", "unit_price")]]
    clean = star.transform_transactions(B.landing_layer(spark, sf), rules)
    path = fresh_dir(spark, "sorted")
    star.sorted_for_write(clean.select("transaction_date")).write.parquet(path)
    back = spark.read.parquet(path).select(
        "transaction_date",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    before = F.lag("transaction_date").over(Window.partitionBy("file").orderBy("place"))
    checked = back.withColumn(
        "in_order", F.coalesce(before <= F.col("transaction_date"), F.lit(True))
    )
    return checked.groupBy("transaction_date").agg(
        count_all().alias("row_count"), F.every("in_order").alias("sorted")
    )


@query(
    "head_tail",
    sql(
        """
        SELECT 'head' AS part, * FROM (SELECT row_key, units FROM sales ORDER BY row_key LIMIT 5)
        UNION ALL
        SELECT 'tail', * FROM (SELECT row_key, units FROM sales ORDER BY row_key DESC LIMIT 3)
        """,
        "sales",
    ),
)
def head_tail(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "row_key", "units")
    first = R.head(rows, ["row_key"], 5).select(F.lit("head").alias("part"), "*")
    return first.unionByName(R.tail(rows, ["row_key"], 3).select(F.lit("tail").alias("part"), "*"))


@query(
    "entity_history",
    sql(
        """SELECT team, year, win_rate FROM panel WHERE team = 'NATION_7' ORDER BY year LIMIT 4""",
        "panel",
    ),
)
def entity_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.entity_history(B.panel(spark, sf), "NATION_7", n=4)
    return rows.select("team", "year", "win_rate")


# -- sets --------------------------------------------------------------------------------------


@query(
    "coverage_gap",
    sql(
        """
        WITH d AS (SELECT DISTINCT date FROM sales)
        SELECT date, (SELECT count(*) FROM d) AS sales_weeks, (SELECT count(*) FROM macro_w)
          AS macro_weeks
        FROM (SELECT date FROM d EXCEPT SELECT week FROM macro_w)
        """,
        "sales",
        "macro_w",
    ),
)
def coverage_gap(spark: SparkSession, sf: str) -> DataFrame:
    days, macro = B.sales(spark, sf, "date"), B.macro(spark, sf)
    sizes = [days.distinct().agg(count_all()).scalar(), macro.agg(count_all()).scalar()]
    return R.coverage_gap(days, "date", macro, "week").select(
        "date", sizes[0].alias("sales_weeks"), sizes[1].alias("macro_weeks")
    )


@query(
    "missing_years",
    sql(
        """SELECT DISTINCT year FROM panel_gap EXCEPT
        SELECT a.year FROM panel_gap a JOIN panel_gap b ON a.team = b.team AND b.year = a.year + 1""",
        "panel_gap",
    ),
)
def missing_years(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.panel_with_gap(spark, sf)
    paired = P.next_period_join(rows, "win_rate", "next_win_rate")
    return rows.select("year").distinct().subtract(paired.select("year"))


@query(
    "distinct_pairs",
    """
    SELECT count(DISTINCT (l_partkey, l_suppkey)) AS distinct_pairs,
      count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS duplicate_rows FROM lineitem
    """,
)
def distinct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = B.table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(count_all().alias("n"))
    return pairs.agg(
        count_all().alias("distinct_pairs"), (F.sum("n") - count_all()).alias("duplicate_rows")
    )


@query(
    "prefix_consistency",
    sql(
        """
        SELECT split_part(sku, '-', 1) AS sku_prefix, any_value(e) AS expected_category,
          count(*) AS row_count, count(DISTINCT product_category) AS category_count,
          count(*) FILTER (product_category IS DISTINCT FROM e) AS mismatch_rows
        FROM (SELECT sku, product_category, CASE split_part(sku, '-', 1)
            WHEN 'ECO' THEN 'ECONOMY' WHEN 'LAR' THEN 'LARGE' WHEN 'MED' THEN 'MEDIUM'
            WHEN 'PRO' THEN 'PROMO' WHEN 'SMA' THEN 'SMALL' WHEN 'STA' THEN 'STANDARD' END AS e
          FROM sales) GROUP BY 1
        """,
        "sales",
    ),
)
def prefix_consistency(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.columns import sku_prefix

    rows = B.sales(spark, sf, "sku", "product_category")
    return R.prefix_consistency(rows, sku_prefix(F.col("sku")), "product_category", B.PREFIXES)
