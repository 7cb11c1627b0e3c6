"""The test tables seen as weekly sales, weekly macro drivers and a yearly panel.

Callers name the columns they need and only the tables behind those columns are joined. Every
lineitem has its order, customer, nation, region and part, so a join left out loses no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import rules as R
from .plans.mart import MartConfig
from .workspace import stored_once

# Domains of the test tables.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
CHANNELS = ["big_box_diy", "pro_dealer"]
CUSTOMERS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PREFIXES = {
    "ECO": "ECONOMY",
    "LAR": "LARGE",
    "MED": "MEDIUM",
    "PRO": "PROMO",
    "SMA": "SMALL",
    "STA": "STANDARD",
}

REGION_SEEDS = [(i, n, n) for i, n in enumerate(REGIONS, start=1)]
CHANNEL_SEEDS = [(i, n, n, n[:3].upper()) for i, n in enumerate(CHANNELS, start=1)]
CUSTOMER_SEEDS = [(i, n, n) for i, n in enumerate(CUSTOMERS, start=1)]

# Bounds that a few rows in a hundred break; unknown members are planted in ``landing``.
BOUNDS = R.Bounds(
    units=(1, 49),
    lumber_price_index=(400.0, 620.0),
    housing_starts_index=(90.0, 110.0),
    mortgage_rate=(0.25, 0.40),
    season_factor=(0.0, 1.5),
)

# Discount and tax of the rows in which ``landing`` plants a defect, by what it spoils.
DEFECTS = {
    "date": (0.1, 0.08),
    "region": (0.01, 0.0),
    "product_category": (0.02, 0.0),
    "customer_type": (0.03, 0.0),
    "units": (0.0, 0.08),
    "no_units": (0.0, 0.0),
    "unit_price": (0.1, 0.0),
}

STAR_KEY = ["date", "region", "sku", "channel", "customer_type"]
DUPLICATE_KEY = ["date", "region", "product_category", "sku", "channel", "customer_type"]

_PART = ["product_category", "sku"]
_CUSTOMER = ["customer_type"]
_REGION = ["region"]
_ORDER = ["channel"]
_MACRO = ["housing_starts_index", "lumber_price_index", "mortgage_rate"]
_MACRO_TEXT = {
    "housing_starts_index": "decimal(6,2)",
    "lumber_price_index": "decimal(8,2)",
    "mortgage_rate": "decimal(5,3)",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sales(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Weekly sales rows with the asked columns. Money is kept in whole cents beside the doubles
    so that sums are exact. What one table alone decides is worked out before the joins, so that they
    move a date, a flag and the number of a defect in place of times, texts and rates."""
    need = set(columns)
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    price = F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
    day = F.date_trunc("week", "l_shipdate").cast("date")
    exprs = {
        "row_key": F.concat_ws(
            "|",
            *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber")],
            *[F.col(c).cast("string") for c in ("l_partkey", "l_suppkey")],
            F.col("l_shipdate").cast("date").cast("string"),
            cents.cast("string"),
        ),
        "date": day,
        "year": F.year(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
        "region": F.col("r_name"),
        "product_category": F.col("p_type"),
        "sku": F.concat(
            F.upper(F.substring("p_type", 1, 3)), F.lit("-"), F.col("l_partkey").cast("string")
        ),
        "channel": F.when(F.col("_pro"), "pro_dealer").otherwise("big_box_diy"),
        "customer_type": F.col("c_mktsegment"),
        "units": F.col("l_quantity").cast("int"),
        "price_cents": price,
        "revenue_cents": cents,
        "unit_price": price.cast("double") / 100,
        "revenue": cents.cast("double") / 100,
        "discount": F.col("l_discount"),
        "tax": F.col("l_tax"),
        "defect": F.col("_defect"),
        "brand": F.col("p_brand"),
        "joined_sku": F.col("_joined"),
        "returned": F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
        **{c: F.col(c) for c in _MACRO},
        **{f"{c}_text": F.col(f"{c}_text") for c in _MACRO},
    }
    out = table(spark, sf, "lineitem").drop("l_linestatus")
    out = out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    if "defect" in need:
        defect = F.lit(None).cast("int")
        for i, (discount, tax) in enumerate(DEFECTS.values()):
            defect = F.when((F.col("l_discount") == discount) & (F.col("l_tax") == tax), i).otherwise(defect)
        out = out.withColumn("_defect", defect)
    # The largest table meets parts first, while its rows are narrow; buyers meet orders before it does, so it is
    # shuffled once for the order side and not again by buyer, and their texts are moved with orders alone.
    if need & {*_PART, "brand", "joined_sku"}:
        part = table(spark, sf, "part").withColumn("_joined", F.col("p_brand") == "Brand#13")
        out = out.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if need & {*_ORDER, *_CUSTOMER, *_REGION}:
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("_pro")
        orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", urgent)
        if need & {*_CUSTOMER, *_REGION}:
            buyers = table(spark, sf, "customer")
            if need & set(_REGION):
                nations = table(spark, sf, "nation").join(
                    table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
                )
                buyers = buyers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            orders = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        out = out.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if need & {*_MACRO, *(f"{c}_text" for c in _MACRO)}:
        weeks = macro(spark, sf).drop("season_factor")
        # Written as text once per week, not once per sale.
        weeks = weeks.withColumns({f"{c}_text": F.col(c).cast(t).cast("string") for c, t in _MACRO_TEXT.items()})
        out = out.join(weeks, day == F.col("week"), "left")
    return out.select(*[exprs[c].alias(c) for c in columns])


def macro(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly drivers from orders. Each value is an exact whole number of its last digit."""
    week = F.date_trunc("week", "o_orderdate").cast("date")
    weekly = (
        table(spark, sf, "orders")
        .groupBy(week.alias("week"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("o_orderstatus") == "O").alias("open"),
            F.count_if(F.col("o_orderstatus") == "F").alias("filled"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        )
    )
    n = F.col("n").cast("double")

    def digits(x, scale):
        return F.round(x).cast("bigint").cast("double") / scale

    month = F.month("week")
    return weekly.select(
        "week",
        digits(F.col("open") * 30000.0 / n, 100).alias("housing_starts_index"),
        digits(F.col("cents").cast("double") / (n * 500.0), 100).alias("lumber_price_index"),
        digits(F.col("filled") * 1000.0 / n, 1000).alias("mortgage_rate"),
        F.when(month != 7, digits(month * 1000.0 / 6.5, 1000)).alias("season_factor"),
    )


LANDING_COLUMNS = [
    "date", "year", "month", "week_of_year", "region", "product_category", "sku", "channel",
    "customer_type", "units", "unit_price", "revenue", "housing_starts_index",
    "lumber_price_index", "mortgage_rate",
]


def landing(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Sales as an all-text landing table with defects that follow from the data: other date
    formats, non-numeric units and prices, missing units, codes without a hyphen, members that no
    dimension knows."""
    columns = columns or ("row_key", *LANDING_COLUMNS)
    need = set(columns)
    base = set(columns) - {"units", "unit_price", "revenue", *_MACRO}
    base |= {f"{c}_text" for c in need & set(_MACRO)}
    base |= {"joined_sku"} if "sku" in need else set()
    planted = {"date", "units", "unit_price", "region", "product_category", "customer_type"}
    base |= {"defect"} if need & planted else set()
    base |= {"units"} if "units" in need else set()
    base |= {"price_cents"} if "unit_price" in need else set()
    base |= {"revenue_cents"} if "revenue" in need else set()
    rows = sales(spark, sf, *sorted(base))

    def money(c: str):
        whole = F.expr(f"{c} div 100").cast("string")
        return F.concat(whole, F.lit("."), F.lpad((F.col(c) % 100).cast("string"), 2, "0"))

    def has(defect: str):
        return F.col("defect") == list(DEFECTS).index(defect)

    exprs = {
        "date": lambda: F.when(
            has("date"), F.date_format("date", "yyyy/MM/dd")
        ).otherwise(F.date_format("date", "yyyy-MM-dd")),
        "region": lambda: F.when(has("region"), "ATLANTIS").otherwise(F.col("region")),
        "product_category": lambda: F.when(has("product_category"), "OTHER").otherwise(
            F.col("product_category")
        ),
        "customer_type": lambda: F.when(has("customer_type"), "PIRATES").otherwise(
            F.col("customer_type")
        ),
        "sku": lambda: F.when(
            F.col("joined_sku"), F.replace(F.col("sku"), F.lit("-"), F.lit(""))
        ).otherwise(F.col("sku")),
        "units": lambda: F.when(has("units"), "twelve")
        .when(has("no_units"), F.lit(None))
        .otherwise(F.col("units").cast("string")),
        "unit_price": lambda: F.when(has("unit_price"), "free").otherwise(money("price_cents")),
        "revenue": lambda: money("revenue_cents"),
        **{c: lambda c=c: F.col(f"{c}_text") for c in _MACRO},
    }
    return rows.select(
        *[(exprs[c]() if c in exprs else F.col(c).cast("string")).alias(c) for c in columns]
    )


def landing_layer(spark: SparkSession, sf: str) -> DataFrame:
    """The landing table as it arrives for validation: written once a session, all text, by date inside each partition,
    so that dates and weekly values are runs that take next to no bytes, also in the layers that loads write of it.
    Validating the stored layer also keeps a dozen rules from being pushed through the joins that made it, where
    constraint inference on them costs more than the run itself."""
    return stored_once(spark, ("landing", sf), lambda: landing(spark, sf).sortWithinPartitions("date"))


def landing_rules() -> list[R.Rule]:
    return R.sales_rules(REGIONS, CATEGORIES, CHANNELS, CUSTOMERS, BOUNDS)


def mart_config(rules: list[R.Rule] | None = None) -> MartConfig:
    return MartConfig(
        rules=landing_rules() if rules is None else rules,
        regions=REGION_SEEDS,
        channels=CHANNEL_SEEDS,
        customers=CUSTOMER_SEEDS,
        prefixes=PREFIXES,
        row_no="row_key",
        row_type="string",
    )


# The year that is taken out of the panel for the queries about gaps, and for those only.
GAP_YEAR = 1998


def panel_with_gap(spark: SparkSession, sf: str) -> DataFrame:
    """The panel without one year, whose neighbours then are no pair."""
    return panel(spark, sf).filter(F.col("year") != GAP_YEAR)


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Nation by order year: shares of order states as results, buyers and low-priority orders
    as goals."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year")
    )
    placed = orders.join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )

    def state(s: str):
        return F.count_if(F.col("o_orderstatus") == s)

    # Per buyer first: the distinct buyers of a nation become a count of rows.
    buyers = placed.groupBy("c_nationkey", "year", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        state("F").alias("f"),
        state("O").alias("o"),
        state("P").alias("p"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"),
    )
    yearly = buyers.groupBy("c_nationkey", "year").agg(
        *[F.sum(c).alias(c) for c in ("n", "f", "o", "p", "low")],
        F.count("o_custkey").alias("buyers"),
    )
    named = yearly.join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return named.select(
        F.col("n_name").alias("team"),
        "year",
        F.col("f").alias("wins"),
        F.col("o").alias("losses"),
        F.when(F.col("year") >= 1998, F.col("p")).alias("ot_losses"),
        (F.col("f").cast("double") / F.col("n").cast("double")).alias("win_rate"),
        F.col("buyers").alias("goals_for"),
        F.col("low").alias("goals_against"),
        (F.col("buyers") - F.col("low")).alias("goal_diff"),
    )

