"""Sources and sinks on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..functions.rules import annotate
from ..operators import merge as M
from ..operators import quality as Q
from ..plans.control import BatchLog, DeadLetters, MarkStore
from ..sources import files as S
from ..operators.ordered import dense_numbers
from ..sources.html import PANEL_CELLS, html_fragments, pages_until_empty, table_rows
from ..workspace import fresh_dir, stage
from .registry import query
from .sqltext import sql

LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'


@query(
    "scan_transactions",
    sql(
        """SELECT date, year, month, week_of_year, region, product_category, sku, channel,
          customer_type, units, unit_price, revenue, housing_starts_index, lumber_price_index,
          mortgage_rate FROM landing""",
        "landing",
    ),
)
def scan_transactions(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "transactions")
    S.write_csv(B.landing(spark, sf, *B.LANDING_COLUMNS), path)
    return S.scan_transactions(spark, path)


@query("scan_macro", sql("SELECT * FROM macro_w", "macro_w"))
def scan_macro(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "macro")
    S.write_csv(B.macro(spark, sf), path)
    return S.scan_macro(spark, path)


@query(
    "scan_dictionary",
    sql(
        """
        SELECT 'date' AS "column", 'date' AS type,
          concat(min(date), ' .. ', max(date)) AS description FROM landing
        UNION ALL SELECT 'region', 'string', concat(min(region), ' .. ', max(region)) FROM landing
        UNION ALL SELECT 'units', 'int', concat(min(units), ' .. ', max(units)) FROM landing
        UNION ALL SELECT 'unit_price', 'float',
          concat(min(unit_price), ' .. ', max(unit_price)) FROM landing
        """,
        "landing",
    ),
)
def scan_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary describing the landing columns by their text range, written and read back."""
    kinds = {"date": "date", "region": "string", "units": "int", "unit_price": "float"}
    row = B.landing(spark, sf, *kinds).agg(
        *[F.concat(F.min(c), F.lit(" .. "), F.max(c)).alias(c) for c in kinds]
    )
    lines = row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"), F.lit(k).alias("type"), F.col(c).alias("description")
                    )
                    for c, k in kinds.items()
                ]
            )
        )
    )
    path = fresh_dir(spark, "dictionary")
    S.write_csv(lines, path)
    return S.scan_dictionary(spark, path)


@query(
    "extract_summary",
    sql(
        """
        SELECT 'transactions' AS source, count(*) AS row_count, 4 AS column_count,
          min(date) AS min_date, max(date) AS max_date FROM sales
        UNION ALL SELECT 'macro', count(*), 5, min(week), max(week) FROM macro_w
        """,
        "sales",
        "macro_w",
    ),
)
def extract_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "date", "units", "unit_price", "revenue")
    return S.summarise(rows, "transactions", "date").unionByName(
        S.summarise(B.macro(spark, sf), "macro", "week")
    )


@query(
    "html_links",
    f"""
    SELECT page_id, cast(unnest(range(len(h))) AS integer) AS pos, unnest(h) AS href,
      nullif(trim(unnest(t)), '') AS label
    FROM (SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS h,
            regexp_extract_all(html, '{LINK}', 2) AS t FROM pages)
    """,
)
def html_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = B.table(spark, sf, "pages").select("page_id", "html")
    rows = html_fragments(pages, "html", LINK, {"href": 1, "label": 2})
    text = F.trim("label")
    return rows.withColumn("label", F.when(text != "", text))


# Rows of a page, and the page that is left empty.
PAGE_ROWS, EMPTY_PAGE = 25, 4
PAGED_SQL = f"""
  SELECT *, CASE WHEN p < {EMPTY_PAGE} THEN p ELSE p + 1 END AS page FROM (
    SELECT *, (row_number() OVER (ORDER BY team, year) - 1) // {PAGE_ROWS} + 1 AS p,
      cast((row_number() OVER (ORDER BY team, year) - 1) % {PAGE_ROWS} + 1 AS integer) AS pos FROM panel)
"""


def panel_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The panel as web pages: a data table with a header row each, one page without any row."""
    rows = B.panel(spark, sf)
    key = F.concat_ws("|", "team", F.col("year").cast("string"))
    keyed = rows.withColumn("key", key)
    numbers = dense_numbers(keyed.select("team", "year", "key"), ["team", "year"], "n").select("key", "n")
    page = F.floor((F.col("n") - 1) / PAGE_ROWS) + 1
    cells = [F.concat(F.lit("<td> "), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(" </td>")) for c in PANEL_CELLS]
    lines = keyed.join(numbers, "key").select(
        F.when(page < EMPTY_PAGE, page).otherwise(page + 1).alias("page"),
        F.struct("n", F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("tr")).alias("line"),
    )
    head = f"<html><body><table class='data table'><tr>{''.join(f'<th>{c}</th>' for c in PANEL_CELLS)}</tr>"
    body = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["tr"]), "\n")
    full = lines.groupBy("page").agg(F.concat(F.lit(head), body, F.lit("</table></body></html>")).alias("html"))
    empty = spark.range(EMPTY_PAGE, EMPTY_PAGE + 1).select(
        F.col("id").alias("page"), F.lit(f"{head}</table></body></html>").alias("html")
    )
    return full.unionByName(empty)


@query("html_rows", sql(f"SELECT page, pos, {', '.join(PANEL_CELLS)} FROM ({PAGED_SQL})", "panel"))
def html_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the pages' data tables, typed; they are the panel's own."""
    rows = table_rows(panel_pages(spark, sf), "html")
    counts = [c for c, t in PANEL_CELLS.items() if t == "int" and c != "year"]
    return rows.withColumns({c: F.col(c).cast("long") for c in counts})


@query(
    "page_union",
    sql(
        f"""SELECT count(DISTINCT page) AS page_count, count(*) AS row_count FROM ({PAGED_SQL})
        WHERE page < {EMPTY_PAGE}""",
        "panel",
    ),
)
def page_union(spark: SparkSession, sf: str) -> DataFrame:
    """Pages in order up to the first one without a row."""
    pages = panel_pages(spark, sf)
    found = table_rows(pages, "html").groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    counts = pages.select("page").join(found, "page", "left").fillna(0, ["n"])
    return pages_until_empty(counts, "page", "n").agg(
        F.count(F.lit(1)).alias("page_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
    )


@query(
    "csv_roundtrip",
    sql(
        """SELECT count(*) AS rows_written, count(*) AS rows_read, true AS same_columns,
        cast(sum(revenue_cents) AS bigint) AS cents_read FROM sales""",
        "sales",
    ),
)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "date", "channel", "units", "revenue_cents")
    path = fresh_dir(spark, "csv")
    S.write_csv(rows, path)
    back = S.scan_csv(spark, path, rows.schema)
    written = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return back.agg(
        written.alias("rows_written"),
        F.count(F.lit(1)).alias("rows_read"),
        F.lit(back.columns == rows.columns).alias("same_columns"),
        F.sum("revenue_cents").alias("cents_read"),
    )


@query("scan_dimension", "SELECT p_partkey, p_name FROM part")
def scan_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return S.scan_dimension(spark, f"{sf}/part.parquet", "p_partkey", "p_name")


# -- sinks -------------------------------------------------------------------------------------


def landing_errors(spark: SparkSession, sf: str) -> DataFrame:
    annotated = annotate(B.landing_layer(spark, sf), B.landing_rules())
    return Q.error_rows(Q.invalid_rows(annotated), B.landing_rules(), "row_key")


@query(
    "dlq_read",
    sql('SELECT row_key AS row_index, "column", value, error_type FROM errors', "errors"),
)
def dlq_read(spark: SparkSession, sf: str) -> DataFrame:
    letters = DeadLetters(spark, fresh_dir(spark, "letters"))
    letters.write(landing_errors(spark, sf), "first")
    return letters.read().select("row_index", "column", "value", "error_type")


@query(
    "dlq_write",
    sql(
        """
        SELECT CASE WHEN error_type = 'INVALID_CATEGORY' THEN 'members' ELSE 'other' END AS batch_id,
          error_type, count(*) AS error_count, true AS stamped
        FROM errors GROUP BY ALL
        """,
        "errors",
    ),
)
def dlq_write(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of letters; the second one is delivered twice and still counts once."""
    letters = DeadLetters(spark, fresh_dir(spark, "letters"))
    errors = landing_errors(spark, sf)
    members = F.col("error_type") == "INVALID_CATEGORY"
    letters.write(errors.filter(members), "members", "landing")
    for _ in range(2):
        letters.write(errors.filter(~members), "other", "landing")
    return letters.read().groupBy("batch_id", "error_type").agg(
        F.count(F.lit(1)).alias("error_count"),
        F.every(F.col("timestamp").isNotNull()).alias("stamped"),
    )


@query(
    "dlq_clear",
    sql(
        "SELECT count(*) AS letters_before, cast(0 AS bigint) AS letters_after FROM errors",
        "errors",
    ),
)
def dlq_clear(spark: SparkSession, sf: str) -> DataFrame:
    letters = DeadLetters(spark, fresh_dir(spark, "letters"))
    letters.write(landing_errors(spark, sf), "first")
    before = letters.read().count()
    letters.clear()
    return letters.read().agg(
        F.lit(before).cast("long").alias("letters_before"),
        F.count(F.lit(1)).alias("letters_after"),
    )


@query(
    "insert_ignore",
    """
    WITH target AS (SELECT cast(o_orderdate AS date) AS day, min(o_orderkey) AS first_order
      FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    batch AS (SELECT cast(o_orderdate AS date) AS day, min(o_orderkey) AS first_order
      FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT * FROM target
    UNION ALL SELECT * FROM batch WHERE day NOT IN (SELECT day FROM target)
    """,
)
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """Days of filled orders, then the days of other orders that are not there yet."""
    orders = B.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").alias("first_order"),
        (F.col("o_orderstatus") == "F").alias("filled"),
    )
    target = orders.filter("filled").groupBy("day").agg(F.min("first_order").alias("first_order"))
    batch = orders.filter("not filled").drop("filled")
    return M.insert_ignore(target, batch, ["day"], ["first_order"])


@query(
    "upsert_overwrite",
    """
    WITH target AS (SELECT o_custkey AS custkey, max(o_orderkey) AS orderkey,
        arg_max(cast(round(o_totalprice * 100) AS bigint), o_orderkey) AS cents
      FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    batch AS (SELECT o_custkey AS custkey, max(o_orderkey) AS orderkey,
        arg_max(cast(round(o_totalprice * 100) AS bigint), o_orderkey) AS cents
      FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
    SELECT coalesce(b.custkey, t.custkey) AS custkey,
      CASE WHEN b.custkey IS NOT NULL THEN b.orderkey ELSE t.orderkey END AS orderkey,
      CASE WHEN b.custkey IS NOT NULL THEN b.cents ELSE t.cents END AS cents
    FROM target t FULL JOIN batch b ON t.custkey = b.custkey
    """,
)
def upsert_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Last filled order per buyer, overwritten by the last open one."""
    orders = B.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderkey").alias("orderkey"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        "o_orderstatus",
    )
    filled = orders.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    target = M.last_per_key(filled, ["custkey"], ["orderkey"])
    batch = orders.filter("o_orderstatus = 'O'").drop("o_orderstatus")
    return M.upsert_overwrite(target, batch, ["custkey"], ["orderkey"])


@query(
    "upsert_additive",
    sql(
        """
        SELECT date, region, product_category, channel, cast(sum(units) AS bigint) AS units,
          cast(sum(revenue_cents) AS bigint) AS revenue_cents,
          arg_min(price_cents, concat(cast(1 - returned AS varchar), row_key)) AS price_cents
        FROM sales GROUP BY ALL
        """,
        "sales",
    ),
)
def upsert_additive(spark: SparkSession, sf: str) -> DataFrame:
    """Returned rows as the target, all others merged into it."""
    keys = ["date", "region", "product_category", "channel"]
    rows = B.sales(
        spark, sf, *keys, "units", "revenue_cents", "price_cents", "returned", "row_key"
    ).withColumns({"units": F.col("units").cast("long"), "batch_seq": 1 - F.col("returned")})
    sums, firsts, order = ["units", "revenue_cents"], ["price_cents"], ["batch_seq", "row_key"]
    parts = [rows.filter(F.col("returned") == r).drop("returned") for r in (1, 0)]
    target, batch = (M.additive(p, keys, sums, firsts, order) for p in parts)
    merged = M.additive(target.unionByName(batch), keys, sums, firsts, order)
    return merged.drop(*order)


@query(
    "merge_counts",
    sql(
        """
        WITH t AS (SELECT DISTINCT date, region, sku, channel FROM sales WHERE returned = 1),
        b AS (SELECT date, region, sku, channel, count(*) AS n FROM sales WHERE returned = 0
          GROUP BY ALL),
        j AS (SELECT b.n, t.date IS NULL AS fresh FROM b LEFT JOIN t
          ON t.date = b.date AND t.region = b.region AND t.sku = b.sku AND t.channel = b.channel)
        SELECT count(*) FILTER (fresh) AS inserted,
          cast(sum(n) AS bigint) - count(*) FILTER (fresh) AS updated FROM j
        """,
        "sales",
    ),
)
def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["date", "region", "sku", "channel"]
    rows = B.sales(spark, sf, *keys, "returned")
    target = rows.filter("returned = 1").select(*keys).distinct()
    return M.merge_counts(target, rows.filter("returned = 0"), keys)


@query(
    "watermark_store",
    sql(
        """
        SELECT 'transactions' AS source_name, cast(max(date) AS varchar) AS last_processed_value
        FROM sales
        UNION ALL SELECT 'macro', NULL
        """,
        "sales",
    ),
)
def watermark_store(spark: SparkSession, sf: str) -> DataFrame:
    """Marks set, moved and reset; the latest state per source."""
    store = MarkStore(spark, fresh_dir(spark, "marks"))
    top = B.sales(spark, sf, "date").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    store.set("transactions", top["lo"])
    store.set("macro", top["hi"])
    store.set("transactions", top["hi"], "b2")
    store.reset("macro")
    return store.table().select("source_name", "last_processed_value")


@query(
    "batch_log",
    sql(
        """
        SELECT 'nightly' AS batch_id, 'success' AS status, count(*) AS rows_processed,
          count(*) FILTER (returned = 1) AS rows_rejected FROM sales
        """,
        "sales",
    ),
)
def batch_log(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the written rows in one appended log row."""
    rows = stage(B.sales(spark, sf, "units", "returned"), "rows")
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("returned") == 1).alias("rejected")
    ).first()
    log = BatchLog(spark, fresh_dir(spark, "log"))
    log.append(
        batch_id="nightly",
        status="success",
        rows_processed=seen["n"],
        rows_rejected=seen["rejected"],
    )
    return log.table().select("batch_id", "status", "rows_processed", "rows_rejected")
