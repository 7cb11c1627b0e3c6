"""Incremental, full and streaming loads on the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..operators.ordered import dense_numbers
from ..plans import mart as T
from ..plans import star as S
from ..streaming.ingest import file_stream, ingest_stream
from ..streaming.rollup import Rollup, rollup_stream, weekly_rollup
from ..workspace import CODEC, fresh_dir
from .registry import query
from .sqltext import sql

# Date between the two loads of the incremental queries.
CUT = date(1998, 6, 1)

FACT_SQL = """
  SELECT transaction_date AS date, region AS region_name, sku, channel AS channel_name,
    customer_type, cast(sum(units) AS bigint) AS units,
    cast(sum(cast(revenue AS decimal(15,2))) AS double) AS revenue,
    arg_min(unit_price, row_key) AS unit_price
  FROM clean GROUP BY ALL
"""


def new_mart(spark: SparkSession, label: str) -> T.Mart:
    return T.Mart(spark, fresh_dir(spark, label), B.mart_config())


def named_fact(mart: T.Mart, fact: DataFrame) -> DataFrame:
    joined = S.star_join(fact, mart.dims())
    return joined.select(
        "date",
        "region_name",
        "sku",
        "channel_name",
        "customer_type",
        "units",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("unit_price").cast("double").alias("unit_price"),
    )


def early(landing: DataFrame) -> DataFrame:
    """Rows up to the cut, by the text of the date."""
    return landing.filter(F.replace("date", F.lit("/"), F.lit("-")) <= CUT.isoformat())


@query("new_rows", sql(f"SELECT row_key, date FROM sales WHERE date > DATE '{CUT}'", "sales"))
def new_rows(spark: SparkSession, sf: str) -> DataFrame:
    return T.new_rows(B.sales(spark, sf, "row_key", "date"), CUT, "date")


@query("late_rows", sql(f"SELECT row_key, date FROM sales WHERE date <= DATE '{CUT}'", "sales"))
def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    return T.late_rows(B.sales(spark, sf, "row_key", "date"), CUT, "date")


@query("advance_mark", sql("SELECT max(date) AS mark, true AS kept FROM sales", "sales"))
def advance_mark(spark: SparkSession, sf: str) -> DataFrame:
    """The mark after a load, and after a load without rows."""
    rows = B.sales(spark, sf, "date")
    mark = T.high_mark(rows, CUT, "date")
    kept = T.high_mark(rows.filter(F.lit(False)), mark, "date") == mark
    return spark.range(1).select(F.lit(mark).alias("mark"), F.lit(kept).alias("kept"))


@query("incremental_load", sql(FACT_SQL, "clean"))
def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """History up to the cut, then the whole table: the second load takes what is newer."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    mart.load(early(landing), B.macro(spark, sf))
    mart.load(landing)
    return named_fact(mart, mart.snapshot())


@query(
    "incremental_counts",
    sql(
        f"""
        WITH k AS (SELECT transaction_date AS d, region, sku, channel, customer_type, count(*) AS n
          FROM clean GROUP BY ALL)
        SELECT 'early' AS batch, cast(sum(n) AS bigint) AS loaded_rows, count(*) AS inserted,
          cast(sum(n) AS bigint) - count(*) AS updated, cast(0 AS bigint) AS late_rows,
          max(d) AS mark FROM k WHERE d <= DATE '{CUT}'
        UNION ALL
        SELECT 'all', cast(sum(n) AS bigint), count(*), cast(sum(n) AS bigint) - count(*),
          (SELECT count(*) FROM clean WHERE transaction_date <= DATE '{CUT}'), max(d)
        FROM k WHERE d > DATE '{CUT}'
        """,
        "clean",
    ),
)
def incremental_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What each of the two loads reports."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    runs = {"early": mart.load(early(landing), B.macro(spark, sf)), "all": mart.load(landing)}
    fields = ["loaded_rows", "inserted", "updated", "late_rows", "mark"]
    return spark.createDataFrame(
        [(name, *[run[f] for f in fields]) for name, run in runs.items()],
        "batch string, loaded_rows long, inserted long, updated long, late_rows long, mark date",
    )


@query("full_load", sql(FACT_SQL, "clean"))
def full_load(spark: SparkSession, sf: str) -> DataFrame:
    """A full load after an incremental one rebuilds the fact instead of adding to it."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    mart.load(early(landing), B.macro(spark, sf))
    mart.load(landing, mode="full")
    return named_fact(mart, mart.snapshot())


@query("idempotent_rerun", sql(FACT_SQL, "clean"))
def idempotent_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch delivered twice."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    for _ in range(2):
        mart.load(landing, B.macro(spark, sf), mode="batch", batch_id="first")
    return named_fact(mart, mart.fact())


@query(
    "atomic_load",
    sql(
        """SELECT count(*) AS fact_rows, 'rolled_back' AS failed_status, true AS mark_kept
        FROM (SELECT transaction_date, region, sku, channel, customer_type FROM clean
          WHERE channel = 'pro_dealer' GROUP BY ALL)""",
        "clean",
    ),
)
def atomic_load(spark: SparkSession, sf: str) -> DataFrame:
    """A good batch, then one that its check rejects: nothing of the second is visible."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    mart.load(landing.filter("channel = 'pro_dealer'"), B.macro(spark, sf), batch_id="good")
    before = mart.marks.get("transactions")

    def refuse(contribution: DataFrame) -> None:
        raise ValueError("rejected")

    try:
        mart.load(landing, mode="batch", batch_id="bad", check=refuse)
    except ValueError:
        pass
    status = mart.log.table().filter("batch_id = 'bad'").select("status").scalar()
    kept = mart.marks.get("transactions") == before
    return mart.fact().agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.max(status).alias("failed_status"),
        F.lit(kept).alias("mark_kept"),
    )


@query(
    "failed_retry",
    sql(
        """
        SELECT count(DISTINCT (row_key, error_type)) AS letters,
          (SELECT count(*) FROM macro_w) AS macro_weeks,
          (SELECT count(DISTINCT sku) FROM clean WHERE channel = 'pro_dealer') AS products
        FROM (SELECT row_key, error_type FROM errors
          UNION ALL SELECT row_key, 'REQUIRED' FROM landing WHERE units IS NULL)
        JOIN landing USING (row_key) WHERE channel = 'pro_dealer'
        """,
        "errors",
        "clean",
    ),
)
def failed_retry(spark: SparkSession, sf: str) -> DataFrame:
    """A batch, then a retry of it with other rows that is refused: its dead letters, macro weeks
    and products are those of the published attempt."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    mart.load(landing.filter("channel = 'pro_dealer'"), B.macro(spark, sf), mode="batch", batch_id="b")

    def refuse(contribution: DataFrame) -> None:
        raise ValueError("rejected")

    other = B.macro(spark, sf).withColumn("week", F.date_add("week", 1))
    try:
        mart.load(landing.filter("channel <> 'pro_dealer'"), other, mode="batch", batch_id="b", check=refuse)
    except ValueError:
        pass
    dims, letters = mart.dims(), mart.dead_letters.read()
    return letters.select("row_index", "error_type").distinct().agg(
        F.count(F.lit(1)).alias("letters"),
        F.max(dims["macro"].agg(F.count(F.lit(1))).scalar()).alias("macro_weeks"),
        F.max(dims["product"].filter("product_id > 0").agg(F.count(F.lit(1))).scalar()).alias("products"),
    )


@query("failed_refresh", sql(FACT_SQL, "clean"))
def failed_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads whose snapshot was never refreshed, as if that had failed, then one without rows
    of its own: the snapshot catches up with all of them."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    mart.load(early(landing), B.macro(spark, sf), update_snapshot=False)
    mart.load(landing, update_snapshot=False)
    mart.load(landing.limit(0))
    return named_fact(mart, mart.snapshot())


SUMS_SQL = """
  SELECT transaction_date AS date, region AS region_name, sku, channel AS channel_name,
    customer_type, cast(sum(units) AS bigint) AS units,
    cast(sum(cast(revenue AS decimal(15,2))) AS double) AS revenue
  FROM clean GROUP BY ALL
"""


def half(landing: DataFrame, part: int) -> DataFrame:
    return landing.filter(F.length("row_key") % 2 == part)


@query("racing_refresh", sql(SUMS_SQL, "clean"))
def racing_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of the same months is published while the snapshot is refreshed: the next look at what is
    pending finds it, since the refresh covers no more than the log it read."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    how = {"mode": "batch", "update_snapshot": False}
    mart.load(half(landing, 0), B.macro(spark, sf), batch_id="a", **how)
    mart.refresh_snapshot(check=lambda: mart.load(half(landing, 1), batch_id="b", **how))
    mart.catch_up()
    return named_fact(mart, mart.snapshot()).drop("unit_price")


@query(
    "racing_loads",
    sql(
        """
        SELECT sku, cast(sum(units) AS bigint) AS units, CAST(1 AS BIGINT) AS product_ids,
          3 AS log_rows FROM clean GROUP BY sku
        """,
        "clean",
    ),
)
def racing_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads number new products at once: the one that publishes second does its work again, so
    every SKU has one id and every id one SKU."""
    mart, landing, macro = new_mart(spark, "mart"), B.landing_layer(spark, sf), B.macro(spark, sf)
    how = {"mode": "batch", "update_snapshot": False}

    def other(contribution: DataFrame) -> None:
        if not mart.log.position():
            mart.load(half(landing, 1), macro, batch_id="b", **how)

    mart.load(half(landing, 0), macro, batch_id="a", check=other, **how)
    products = mart.dims()["product"].select("product_id", "sku")
    per_sku = mart.fact().join(products, "product_id").groupBy("sku")
    return per_sku.agg(
        F.sum("units").alias("units"),
        F.count_distinct("product_id").alias("product_ids"),
        F.lit(mart.log.position()).alias("log_rows"),
    )


@query("vacuumed", sql(SUMS_SQL, "clean"))
def vacuumed(spark: SparkSession, sf: str) -> DataFrame:
    """A batch loaded twice, one that is withdrawn, one that is refused: what can't be reached is removed and nothing
    else changes."""
    mart, landing, macro = new_mart(spark, "mart"), B.landing_layer(spark, sf), B.macro(spark, sf)
    how = {"mode": "batch", "update_snapshot": False}
    mart.load(half(landing, 0), macro, batch_id="a", **how)
    mart.load(landing, macro, mode="batch", batch_id="a")
    mart.load(half(landing, 1), batch_id="b", **how)
    mart.withdraw("b")

    def refuse(contribution: DataFrame) -> None:
        raise ValueError("rejected")

    try:
        mart.load(half(landing, 0), batch_id="c", check=refuse, **how)
    except ValueError:
        pass
    mart.catch_up()
    mart.vacuum()
    return named_fact(mart, mart.snapshot()).drop("unit_price")


@query(
    "dlq_replay",
    sql(
        """WITH told AS (
          SELECT row_key, CASE WHEN count(*) FILTER ("column" <> 'region') OVER (PARTITION BY row_key) = 0
            THEN 'replayed' ELSE 'pending' END AS status
          FROM (SELECT row_key, "column" FROM errors UNION ALL SELECT row_key, 'units' FROM landing WHERE units IS NULL)
        )
        SELECT status, count(*) AS letters, count(DISTINCT row_key) AS letter_rows,
          (SELECT cast(sum(units) AS bigint) FROM clean) + (SELECT cast(sum(trunc(cast(units AS double))) AS bigint)
            FROM landing JOIN (SELECT DISTINCT row_key FROM told WHERE status = 'replayed') USING (row_key)) AS fact_units
        FROM told GROUP BY status
        """,
        "errors",
        "clean",
    ),
)
def dlq_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Letters of a load whose region rule is lifted afterwards, replayed twice: rows with no other fault
    enter the fact once."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    mart.load(landing, B.macro(spark, sf), mode="batch", batch_id="a", update_snapshot=False)
    mart.config.rules = [r for r in B.landing_rules() if r.column != "region"]
    for _ in range(2):
        mart.replay(landing.schema, update_snapshot=False)
    units = mart.fact().agg(F.sum("units")).scalar()
    return mart.letters().groupBy("status").agg(
        F.count(F.lit(1)).alias("letters"),
        F.count_distinct("row_index").alias("letter_rows"),
        F.max(units).alias("fact_units"),
    )


@query(
    "fact_calendar",
    sql(
        """
        SELECT fiscal_year, quarter, count(*) AS fact_rows, cast(sum(units) AS bigint) AS units,
          count(*) FILTER (n > 1) AS updated_rows
        FROM (SELECT cast(year(transaction_date) AS integer) AS fiscal_year,
            cast(quarter(transaction_date) AS integer) AS quarter, sum(units) AS units,
            count(DISTINCT channel_part) AS n
          FROM (SELECT *, length(row_key) % 2 AS channel_part FROM clean)
          GROUP BY transaction_date, region, sku, channel, customer_type)
        GROUP BY ALL
        """,
        "clean",
    ),
)
def fact_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, units and later updated rows of the fact by fiscal year and quarter, after two batches."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    for part in (0, 1):
        rows = landing.filter(F.length("row_key") % 2 == part)
        mart.load(rows, B.macro(spark, sf), mode="batch", batch_id=f"part-{part}", update_snapshot=False)
    return mart.fact().groupBy("fiscal_year", "quarter").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("units").alias("units"),
        F.count_if(F.col("updated_at") > F.col("created_at")).alias("updated_rows"),
    )


@query(
    "two_streams",
    sql(
        """SELECT count(*) AS batches, (SELECT cast(sum(units) AS bigint) FROM clean) AS units
        FROM (SELECT DISTINCT channel FROM landing)""",
        "clean",
    ),
)
def two_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Two folders with checkpoints of their own into one mart: their first epochs add up."""
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    for channel in B.CHANNELS:
        source = fresh_dir(spark, "incoming")
        landing.filter(F.col("channel") == channel).write.parquet(source, compression=CODEC)
        stream = file_stream(spark, source, landing.schema, "parquet")
        ingest_stream(mart, stream, fresh_dir(spark, "stream"), B.macro(spark, sf))
    batches = mart.log.published().agg(F.count(F.lit(1))).scalar()
    return mart.fact().agg(F.max(batches).alias("batches"), F.sum("units").alias("units"))


@query(
    "numeric_row_order",
    sql(
        """
        SELECT transaction_date AS date, region AS region_name, sku, channel AS channel_name,
          customer_type, arg_min(unit_price, n) AS unit_price
        FROM (SELECT c.*, row_number() OVER (ORDER BY row_key DESC) AS n FROM clean c)
        GROUP BY ALL
        """,
        "clean",
    ),
)
def numeric_row_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows numbered against the order of their text: a key keeps the price of its lowest number."""
    landing = B.landing_layer(spark, sf)
    numbered = dense_numbers(landing.select("row_key").distinct(), ["row_key"], "n")
    top = numbered.agg(F.max("n")).scalar()
    rows = landing.join(numbered, "row_key").withColumn("row_no", (top - F.col("n") + 1).cast("string")).drop("n")
    config = B.mart_config()
    config.row_no, config.row_type = "row_no", "long"
    mart = T.Mart(spark, fresh_dir(spark, "mart"), config)
    mart.load(rows, B.macro(spark, sf))
    return named_fact(mart, mart.fact()).drop("units", "revenue")


RUN_SQL = """
  WITH broken AS (SELECT row_key, count(*) AS n FROM (SELECT row_key FROM errors
    UNION ALL SELECT row_key FROM landing WHERE units IS NULL) GROUP BY 1)
  SELECT (SELECT count(*) FROM landing) AS raw_rows,
    (SELECT count(*) FROM landing) - count(*) AS clean_rows,
    cast(sum(n) AS bigint) AS error_count, 'STATUS' AS status, MARK AS mark FROM broken
"""


@query(
    "etl_run",
    sql(RUN_SQL.replace("STATUS", "dry").replace("MARK", "cast(NULL AS date)"), "errors"),
)
def etl_run(spark: SparkSession, sf: str) -> DataFrame:
    """A dry run: extract and transform with their counts, nothing published."""
    mart = new_mart(spark, "mart")
    run = mart.load(B.landing_layer(spark, sf), mode="dry")
    return spark.createDataFrame(
        [(run["raw_rows"], run["valid_rows"], run["error_count"], run["status"], run["mark"])],
        "raw_rows long, clean_rows long, error_count long, status string, mark date",
    )


@query(
    "etl_summary",
    sql(
        RUN_SQL.replace("STATUS", "success").replace(
            "MARK", "(SELECT max(transaction_date) FROM clean)"
        ),
        "errors",
        "clean",
    ),
)
def etl_summary(spark: SparkSession, sf: str) -> DataFrame:
    mart = new_mart(spark, "mart")
    mart.load(B.landing_layer(spark, sf), B.macro(spark, sf))
    return mart.summary_table().drop("batch_id")


@query(
    "layered_tables",
    sql(
        """
        SELECT 'landing' AS layer, count(*) AS row_count FROM landing
        UNION ALL SELECT 'valid', count(*) FROM clean
        UNION ALL SELECT 'rejected', (SELECT count(*) FROM landing) - (SELECT count(*) FROM clean)
        UNION ALL SELECT 'fact', count(*) FROM (SELECT transaction_date, region, sku, channel,
          customer_type FROM clean GROUP BY ALL)
        """,
        "clean",
    ),
)
def layered_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the persisted layers after a load."""
    mart = new_mart(spark, "mart")
    mart.load(B.landing_layer(spark, sf), B.macro(spark, sf), batch_id="only")
    layers = f"{mart.root}/layers/batch_id=only"
    validated = spark.read.parquet(f"{layers}/*/validated")
    tables = {
        "landing": spark.read.parquet(f"{layers}/*/landing"),
        "valid": validated.filter(F.col("is_valid").cast("boolean")),
        "rejected": validated.filter(~F.col("is_valid").cast("boolean")),
        "fact": mart.snapshot(),
    }
    out = None
    for name, table in tables.items():
        row = table.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count"))
        out = row if out is None else out.unionByName(row)
    return out


# -- streaming ---------------------------------------------------------------------------------


def streamed_mart(spark: SparkSession, sf: str) -> T.Mart:
    """Landing files of two channels arrive one after the other; each drain sees the new ones,
    and a last drain finds nothing."""
    source, checkpoint = fresh_dir(spark, "incoming"), fresh_dir(spark, "stream")
    mart, landing = new_mart(spark, "mart"), B.landing_layer(spark, sf)
    macro = B.macro(spark, sf)
    for channel in (*B.CHANNELS, None):
        if channel is not None:
            landing.filter(F.col("channel") == channel).write.mode("append").parquet(source, compression=CODEC)
        stream = file_stream(spark, source, landing.schema, "parquet")
        ingest_stream(mart, stream, checkpoint, macro)
    return mart


@query("stream_ingest", sql(FACT_SQL, "clean"))
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    mart = streamed_mart(spark, sf)
    return named_fact(mart, mart.snapshot())


@query(
    "stream_dlq",
    sql(
        """
        SELECT channel, error_type, count(*) AS error_count FROM (
          SELECT row_key, error_type FROM errors
          UNION ALL SELECT row_key, 'REQUIRED' FROM landing WHERE units IS NULL)
        JOIN landing USING (row_key) GROUP BY ALL
        """,
        "errors",
    ),
)
def stream_dlq(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters of the drained stream, with the channel read back from the kept original."""
    letters = streamed_mart(spark, sf).dead_letters.read()
    channel = F.get_json_object("original_data", "$.channel").alias("channel")
    return letters.groupBy(channel, "error_type").agg(F.count(F.lit(1)).alias("error_count"))


@query(
    "stream_weekly_rollup",
    """
    SELECT cast(date_trunc('week', ts) AS date) AS week, event_type, count(*) AS event_count,
      cast(sum(cast(round(value * 100) AS bigint)) AS bigint) AS value_cents
    FROM events GROUP BY 1, 2
    """,
)
def stream_weekly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Events in four files out of time order, one epoch each; late ones count as well."""
    return streamed_rollup(spark, sf)[0]


@query(
    "stream_late_events",
    """
    WITH e AS (SELECT event_id, ts, event_id % 4 AS part FROM events),
    m AS (SELECT part, max(ts) AS top FROM e GROUP BY 1)
    SELECT event_id, ts, part AS epoch FROM e
    WHERE ts < (SELECT max(top) FROM m WHERE m.part < e.part) - INTERVAL 7 DAY
    """,
)
def stream_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events more than a week behind the newest event of an earlier epoch."""
    return streamed_rollup(spark, sf)[1].select("event_id", "ts", "epoch")


def streamed_rollup(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    source, checkpoint, path = (fresh_dir(spark, x) for x in ("events", "stream", "rollup"))
    cents = with_cents(B.table(spark, sf, "events"))
    out = None
    for part in range(4):
        cents.filter(F.col("event_id") % 4 == part).write.mode("append").parquet(source)
        stream = file_stream(spark, source, cents.schema, "parquet")
        out = rollup_stream(stream, path, checkpoint, "ts", "event_type", {"value_cents": "cents"})
    return out


@query(
    "stream_rollup_by_stream",
    """
    SELECT cast(date_trunc('week', ts) AS date) AS week, event_type, count(DISTINCT event_id % 2) AS streams,
      count(*) AS event_count, cast(sum(cast(round(value * 100) AS bigint)) AS bigint) AS value_cents
    FROM events GROUP BY 1, 2
    """,
)
def stream_rollup_by_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams into one rollup, each stopped after its first epoch and started again from its checkpoint;
    the newest events come first, so later epochs bring late ones."""
    cents = with_cents(B.table(spark, sf, "events"))
    rollup = Rollup(fresh_dir(spark, "rollup"), cents.schema, "ts", "event_type", {"value_cents": "cents"})
    middle = cents.agg(F.timestamp_seconds(F.avg(F.unix_seconds(F.col("ts").cast("timestamp"))))).scalar()
    folders = [(fresh_dir(spark, "events"), fresh_dir(spark, "stream")) for _ in range(2)]
    for newer in (True, False):
        for part, (source, checkpoint) in enumerate(folders):
            rows = cents.filter((F.col("event_id") % 2 == part) & ((F.col("ts") >= middle) == newer))
            rows.write.mode("append").parquet(source)
            rollup.run(file_stream(spark, source, cents.schema, "parquet"), checkpoint)
    return rollup.by_stream(spark).groupBy("week", "event_type").agg(
        F.count_distinct("stream").alias("streams"),
        F.sum("event_count").alias("event_count"),
        F.sum("value_cents").alias("value_cents"),
    )


def with_cents(events: DataFrame) -> DataFrame:
    return events.withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


@query(
    "weekly_rollup",
    """
    SELECT cast(date_trunc('week', ts) AS date) AS week, event_type, count(*) AS event_count,
      cast(sum(cast(round(value * 100) AS bigint)) AS bigint) AS value_cents
    FROM events GROUP BY 1, 2
    """,
)
def batch_weekly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The same rollup on the table."""
    cents = with_cents(B.table(spark, sf, "events"))
    return weekly_rollup(cents, "ts", "event_type", {"value_cents": "cents"})
