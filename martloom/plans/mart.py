"""The sales mart: layered tables, contribution ledger, incremental and full loads.

Every batch writes what it adds to the fact as its own *contribution*, under a new attempt
folder; so are the macro weeks, dates and products that it brings. An attempt becomes visible
through its ``success`` row in the batch log and in no other way. From that follow: a failed batch
leaves nothing but its dead letters and its row in the log, a retried batch replaces itself
instead of adding twice, and a batch can be withdrawn or rewritten. The fact is the sum of all
published contributions; ``snapshot`` keeps it compacted by month. A contribution has one row per business key, so a
month of one batch needs no merging. The log says which months a batch
touched and as of which position a refresh covered them, so that a refresh that failed, or that a
batch overtook, is made up for by the next.

Loads are optimistic. A load remembers the position of the log that it read; when it publishes, it looks
at what was committed since, and if that changes what it did (another load moved the mark that it took rows
by, or both brought new products and numbered them alike) it does its work again from the log as it is then. A
refresh writes files of its own and names them in its row; of several refreshes of a month the one that read the log at the
latest position is the one that is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions.rules import LATE_ROW, Rule, required
from ..operators import quality as Q
from ..operators.merge import last_per_key, merge_counts
from ..sources.files import struct_of
from ..workspace import CODEC, discard, stage, tidy
from . import star as S
from .commits import Conflict, Store
from .control import ALL_MONTHS, BatchLog, DeadLetters, MarkStore, read_or_empty

ORDER = ["batch_seq", "sale_date", "row_no"]
DIMENSIONS = ("dim_date", "dim_product", "dim_macro_log")
REPLAYED = "origin_batch string, row_index string"
TRIES = 5  # of a load whose commits meet others
CONTRIB_TYPES = {
    "date_id": "int",
    "region_id": "int",
    "product_id": "long",
    "channel_id": "int",
    "customer_id": "int",
    "units": "long",
    "revenue": "decimal(25,2)",
    "unit_price": "decimal(12,4)",
    "macro_id": "int",
    "housing_starts_index": "decimal(6,2)",
    "lumber_price_index": "decimal(8,2)",
    "mortgage_rate": "decimal(5,3)",
    "batch_seq": "long",
    "sale_date": "date",
}
# Columns that the fact has beside those of the contributions.
FACT_TYPES = {
    "fiscal_year": "int",
    "quarter": "int",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}
MACRO_LOG = (
    "macro_id int, week date, housing_starts_index decimal(6,2), lumber_price_index decimal(8,2), "
    "mortgage_rate decimal(5,3), season_factor decimal(5,3), seq long"
)
DATE_SCHEMA = (
    "date_id int, date date, year int, month int, quarter int, week_of_year int, "
    "day_of_week int, day_name string, month_name string, is_weekend boolean, fiscal_year int"
)


class TooManyErrors(RuntimeError):
    pass


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.floor(F.col("date_id") / 100).cast("int"))


@dataclass
class MartConfig:
    """Closed dimensions, rules and ordering of one mart.

    ``row_no`` orders rows inside a date and must be unique; it decides which price a merged key
    keeps. Its order is that of ``row_type``: numbers by default, "string" for text keys.
    ``max_error_rows`` aborts a load with more invalid rows, whose letters are kept; None accepts
    any number. A dead letter that ``give_up_after`` replays didn't bring in is given up.
    """

    rules: Sequence[Rule]
    regions: Sequence[tuple] = field(default_factory=lambda: S.REGION_SEEDS)
    channels: Sequence[tuple] = field(default_factory=lambda: S.CHANNEL_SEEDS)
    customers: Sequence[tuple] = field(default_factory=lambda: S.CUSTOMER_SEEDS)
    prefixes: dict[str, str] = field(default_factory=lambda: S.PREFIX_CATEGORIES)
    row_no: str = "row_no"
    row_type: str = "long"
    unknown_id: int = -1
    source: str = "transactions"
    max_error_rows: int | None = None
    give_up_after: int = 3


def new_rows(df: DataFrame, mark: date | None, day: str = "transaction_date") -> DataFrame:
    """Rows strictly after the mark; everything without a mark."""
    return df if mark is None else df.filter(F.col(day) > F.lit(mark))


def late_rows(df: DataFrame, mark: date | None, day: str = "transaction_date") -> DataFrame:
    """Rows at or before the mark, which an incremental load does not take in."""
    return df.limit(0) if mark is None else df.filter(F.col(day) <= F.lit(mark))


def high_mark(df: DataFrame, mark: date | None, day: str = "transaction_date") -> date | None:
    """The mark after loading ``df``: its latest date, the old mark when there is none."""
    top = df.agg(F.max(F.col(day).cast("date")).alias("d")).first()["d"]
    return mark if top is None else top if mark is None else max(top, mark)


class Mart:
    def __init__(self, spark: SparkSession, root: str, config: MartConfig):
        self.spark, self.root, self.config = spark, root.rstrip("/"), config
        self.log = BatchLog(spark, f"{self.root}/batch_log")
        self.marks = MarkStore(spark, f"{self.root}/marks", self.log)
        self.dead_letters = DeadLetters(spark, f"{self.root}/dead_letters", self.log)
        self.contrib_types = {**CONTRIB_TYPES, "row_no": config.row_type}

    # -- tables --------------------------------------------------------------------------------

    def _brought(self, name: str, schema: str, attempt: str | None) -> DataFrame:
        """Rows that successful attempts brought to a table, and those of ``attempt``."""
        keys = "batch_id string, attempt string"
        rows = read_or_empty(self.spark, f"{self.root}/{name}", f"{schema}, {keys}")
        seen = self.log.succeeded().select("batch_id", "attempt")
        if attempt is not None:
            own = rows.filter(F.col("attempt") == attempt).select("batch_id", "attempt").distinct()
            seen = seen.unionByName(own)
        return rows.join(seen, ["batch_id", "attempt"], "left_semi").drop("batch_id", "attempt")

    def dims(self, attempt: str | None = None) -> dict[str, DataFrame]:
        """The dimensions; ``attempt`` sees its own additions before they are published."""
        c = self.config
        products = self._brought("dim_product", S.PRODUCT_SCHEMA, attempt)
        return {
            "region": S.seed_regions(self.spark, c.regions, c.unknown_id),
            "channel": S.seed_channels(self.spark, c.channels, c.unknown_id),
            "customer": S.seed_customers(self.spark, c.customers, c.unknown_id),
            "category": S.seed_categories(self.spark, c.prefixes, c.unknown_id),
            "date": self._brought("dim_date", DATE_SCHEMA, attempt),
            "product": S.with_unknown_product(products, c.unknown_id),
            "macro": self._macro(attempt),
        }

    def _macro(self, attempt: str | None = None) -> DataFrame:
        log = self._brought("dim_macro_log", MACRO_LOG, attempt)
        return last_per_key(log, ["macro_id"], ["seq"]).drop("seq")

    def contributions(self, as_of: int | None = None) -> DataFrame:
        """Contributions of published attempts, or of those published up to a position of the log. The log is one
        row per batch; joined on the partition columns it prunes the folders of every other attempt."""
        types = {**self.contrib_types, "month": "int", "batch_id": "string", "attempt": "string"}
        path, schema = f"{self.root}/contrib", struct_of(types)
        rows = read_or_empty(self.spark, path, schema)
        return rows.join(self.log.published(as_of), ["batch_id", "attempt"], "left_semi")

    def fact(self) -> DataFrame:
        as_of = self.log.position()
        alone, merged = self._merged(self.contributions(as_of), self.log.shared_months(as_of))
        return alone.unionByName(merged)

    def _merged(self, contrib: DataFrame, shared: Sequence[int] | None) -> tuple[DataFrame, DataFrame]:
        """The fact of some contributions, with its calendar and when its rows were first and last
        loaded (a batch's sequence number is its time in microseconds): months of one batch as they were
        written, and months that several ``shared`` (None: any), whose rows are merged."""
        several = F.lit(True) if shared is None else F.col("month").isin(list(shared)) if shared else F.lit(False)
        day = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
        fields = {**C.calendar(day), **C.calendar_ext(day)}
        merged = S.merge_contributions(contrib.filter(several), ORDER, {"_last": F.max("batch_seq")})
        alone = contrib.filter(~several).withColumn("_last", F.col("batch_seq")).select(*merged.columns)
        added = {
            "fiscal_year": fields["fiscal_year"].cast("int"),
            "quarter": fields["quarter"].cast("int"),
            "created_at": F.timestamp_micros("batch_seq"),
            "updated_at": F.timestamp_micros("_last"),
        }
        return tuple(rows.withColumns(added).drop(*ORDER, "_last") for rows in (alone, merged))

    def snapshot(self) -> DataFrame:
        """The compacted fact; each month is read from the files of one refresh alone."""
        types = {k: v for k, v in self.contrib_types.items() if k not in ORDER}
        schema = struct_of({**types, **FACT_TYPES, "attempt": "string", "month": "int"})
        rows = read_or_empty(self.spark, f"{self.root}/fact_sales", schema)
        whole, parts = self.log.snapshot_parts()
        kept = F.col("attempt") == F.lit(whole)
        if parts:
            kept &= ~F.col("month").isin(list(parts))
        for attempt in set(parts.values()):
            kept |= (F.col("attempt") == attempt) & F.col("month").isin([m for m, a in parts.items() if a == attempt])
        return rows.filter(kept).drop("attempt")

    # -- steps ---------------------------------------------------------------------------------

    def _bring(self, rows: DataFrame, name: str, batch_id: str, attempt: str) -> None:
        path = f"{self.root}/{name}/batch_id={batch_id}/attempt={attempt}"
        rows.write.mode("overwrite").parquet(path, compression=CODEC)

    def load_macro(self, macro: DataFrame, seq: int, batch_id: str, attempt: str) -> None:
        """Macro weeks replace earlier values of the same week."""
        rows = S.macro_rows(S.transform_macro(macro)).withColumn("seq", F.lit(seq).cast("long"))
        self._bring(rows, "dim_macro_log", batch_id, attempt)

    def extend_dims(self, clean: DataFrame, days: DataFrame, batch_id: str, attempt: str) -> int:
        """Dates and products the dimensions lack; existing members stay as they are, so a
        repeated call appends nothing. ``days`` has the dates of ``clean``. Returns the number of products."""
        dims = self.dims()
        dates = S.date_rows(days, "transaction_date")
        fresh = dates.join(dims["date"].select("date_id"), "date_id", "left_anti")
        self._bring(fresh, "dim_date", batch_id, attempt)
        products = S.new_products(clean, dims["product"], dims["category"], self.config.prefixes)
        self._bring(products, "dim_product", batch_id, attempt)
        path = f"{self.root}/dim_product/batch_id={batch_id}/attempt={attempt}"
        return self.spark.read.schema(S.PRODUCT_SCHEMA).parquet(path).count()

    def refresh_snapshot(
        self, months: Sequence[int] | None = None, check: Callable[[], None] | None = None
    ) -> None:
        """Rebuild the compacted fact, for the given months only when there are any, and log it.

        The rebalance hint lets adaptive execution cut a month that holds most of the rows into
        several files and put small ones together; months of one batch follow the files of its contribution, which
        were cut like that. ``check`` is called before the refresh is logged.
        """
        as_of, attempt = self.log.position(), uuid.uuid4().hex
        contrib = self.contributions(as_of)
        if months is not None:
            contrib = contrib.filter(F.col("month").isin(list(months)))
        shared = self.log.shared_months(as_of)
        alone, merged = map(with_month, self._merged(contrib, shared))
        # Written, so that the shuffles of merging and of the layout by month don't lie on disk together.
        staged = stage(merged, "merged") if shared is None or shared else None
        rows = alone if staged is None else alone.unionByName(staged.hint("rebalance", "month"))
        with tidy(self.spark):
            (
                rows.sortWithinPartitions("month", "date_id")
                .write.mode("overwrite")
                .partitionBy("month")
                .parquet(f"{self.root}/fact_sales/attempt={attempt}", compression=CODEC)
            )
        if staged is not None:
            discard(staged)
        if check is not None:
            check()
        covered = ALL_MONTHS if months is None else ",".join(map(str, months))
        fields = {"status": "snapshot", "months": covered, "attempt": attempt, "as_of": as_of}
        self.log.append(source_name=self.config.source, **fields)

    # -- loads ---------------------------------------------------------------------------------

    def load(
        self,
        transactions: DataFrame | Callable[[], DataFrame],
        macro: DataFrame | None = None,
        mode: str = "incremental",
        batch_id: str | None = None,
        source_file: str | None = None,
        check: Callable[[DataFrame], None] | None = None,
        update_snapshot: bool = True,
    ) -> dict:
        """Validate, type, resolve and merge one batch.

        ``incremental`` takes rows after the mark and advances it; ``batch`` takes all rows and
        ignores the mark (streams, corrections of history); ``full`` rebuilds the fact from this
        input alone; ``dry`` writes the validated layer and publishes nothing; ``replay`` is for ``replay``. ``check`` may
        inspect the contribution and raise to reject the batch. A function in place of rows is asked again if the load has
        to do its work again.
        """
        c = self.config
        seq = int(datetime.now(timezone.utc).timestamp() * 1_000_000)
        named, batch_id = batch_id is not None, batch_id or f"{c.source}-{seq}"
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        # A batch id that was loaded before keeps its place in the order of batches.
        earlier = self._first_seq(batch_id) if named else None
        place = seq if earlier is None else earlier
        for left in reversed(range(TRIES)):
            attempt, as_of = uuid.uuid4().hex, self.log.position()
            summary = {"batch_id": batch_id, "mode": mode, "status": "failed", "place": place}
            try:
                rows = transactions() if callable(transactions) else transactions
                # A stream's rows come with a session of their own.
                with tidy(self.spark), tidy(rows.sparkSession):
                    self._load(summary, rows, macro, mode, batch_id, attempt, seq, place, source_file, check)
                if mode == "dry":
                    self._finish(summary, attempt, started, status="dry")
                    return summary
                # What is to be refreshed is part of the row that publishes the batch. A corrected batch also
                # touches the months that its earlier attempts had filled.
                months = sorted({*summary["months"], *(self.log.months_of(batch_id) if earlier is not None else ())})
                touched = ALL_MONTHS if mode == "full" else ",".join(map(str, months))
                unchanged = lambda: self._look_again(summary, as_of)  # noqa: B023, E731
                self._finish(summary, attempt, started, status="success", months=touched, check=unchanged)
                break
            except Conflict as e:
                self._finish(summary, attempt, started, status="conflict", error=str(e))
                if not left:
                    raise
            except Exception as e:
                self._finish(summary, attempt, started, status="rolled_back", error=str(e))
                raise
        if update_snapshot:
            self.catch_up()
        return summary

    def _look_again(self, summary: dict, as_of: int) -> None:
        """Raises if a batch published since ``as_of`` changes what a load did."""
        others = (F.col("seq") > as_of) & (F.col("status") == "success") & (F.col("batch_id") != summary["batch_id"])
        found = self.log.table().filter(others).agg(
            F.count_if(F.col("mark").isNotNull() & (F.col("source_name") == self.config.source)).alias("marks"),
            F.count_if(F.col("new_products") > 0).alias("products"),
            F.count_if(F.col("mode") == "replay").alias("replays"),
        ).first()
        if summary["mode"] == "incremental" and found["marks"]:
            raise Conflict("the mark has moved")
        if summary["mode"] == "replay" and found["replays"]:
            raise Conflict("other letters were replayed")
        if summary["new_products"] and found["products"]:
            raise Conflict("other products were numbered")

    def letters(self) -> DataFrame:
        """Dead letters with ``status`` and ``processed_at``.

        A letter is replayed once its row is in a published replay, given up after ``give_up_after`` replays of its
        batch's letters that left it out, and pending until then. Both follow from what is published, so no write but a
        replay's own moves a letter on.
        """
        rows = read_or_empty(self.spark, f"{self.root}/replayed", f"{REPLAYED}, batch_id string, attempt string")
        times = self.log.table().select("batch_id", "attempt", F.col("end_time").alias("entered"))
        entered = rows.join(self.log.published(), ["batch_id", "attempt"], "left_semi").join(times, ["batch_id", "attempt"])
        entered = entered.select(F.col("origin_batch").alias("batch_id"), "row_index", "entered")
        tried = [F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(at).alias("at")) for seq, at in self.log.replays()]
        empty = F.array().cast("array<struct<seq:bigint,at:timestamp>>")
        since = F.filter(F.array(*tried) if tried else empty, lambda x: x["seq"] > F.coalesce("seq", F.lit(0)))
        limit = F.lit(self.config.give_up_after)
        known = self.dead_letters.read().join(self.log.places().select("batch_id", "seq"), "batch_id", "left")
        marked = known.join(entered, ["batch_id", "row_index"], "left").withColumn("since", since)
        status = F.when(F.col("entered").isNotNull(), "replayed").when(F.size("since") >= limit, "given_up").otherwise("pending")
        last = F.when(F.size("since") >= limit, F.element_at("since", limit)["at"])
        return marked.withColumns({"status": status, "processed_at": F.coalesce("entered", last)}).drop("since", "entered", "seq")

    def replay(self, schema: T.StructType, **how) -> dict:
        """Takes in the rows of pending letters that the rules of today accept.

        A row enters the fact under the place of its own batch, so a key keeps the price of its first row as if
        the row had been accepted then. The replay is a load like others: its one row in the log publishes
        the rows and marks their letters as replayed, so none enters twice, whenever it fails. ``schema`` is that of raw rows.
        Letters of unpublished batches and of late rows aren't replayed.
        """

        def rows() -> DataFrame:
            pending = self.letters().filter("status = 'pending'")
            late = F.max(F.col("error_type") == LATE_ROW).alias("late")
            per_row = pending.groupBy("batch_id", "row_index").agg(F.min("original_data").alias("data"), late)
            placed = per_row.filter("NOT late").join(self.log.places(), "batch_id")
            row = F.from_json("data", schema).alias("row")
            return placed.select(row, "batch_id", "place").select(
                "row.*", F.col("batch_id").alias("origin_batch"), F.col("place").alias("batch_place")
            )

        return self.load(rows, mode="replay", **how)

    def catch_up(self) -> None:
        """Refresh the snapshot by all months that published batches have touched since."""
        months = self.log.pending_months()
        if months is None or months:
            self.refresh_snapshot(months)

    def _load(
        self, summary, transactions, macro, mode, batch_id, attempt, seq, place, source_file, check
    ) -> None:
        c = self.config
        base = f"{self.root}/layers/batch_id={batch_id}/attempt={attempt}"
        transactions.write.mode("overwrite").parquet(f"{base}/landing", compression=CODEC)
        landing = self.spark.read.schema(transactions.schema).parquet(f"{base}/landing")
        rules = [*c.rules, *[required(x) for x in ("date", "units", "unit_price")]]
        good, bad, seen = Q.fork(landing, rules, f"{base}/validated")
        clean = S.typed_transactions(good)

        mark = self.marks.get(c.source) if mode == "incremental" else None
        taken, late = new_rows(clean, mark), late_rows(clean, mark)
        errors = Q.error_rows(bad, rules, c.row_no)
        late_errors = late.select(
            F.col(c.row_no).cast("string").alias("row_index"),
            F.lit("transaction_date").alias("column"),
            F.col("transaction_date").cast("string").alias("value"),
            F.lit(LATE_ROW).alias("error_type"),
            F.lit("row is not newer than the high-water mark").alias("error_message"),
            F.to_json(F.struct(*late.columns)).alias("original_data"),
        )
        summary.update(seen, valid_rows=seen["raw_rows"] - seen["invalid_rows"])
        if mode == "dry":
            summary.update(loaded_rows=0, inserted=0, updated=0, mark=None)
            return
        letters = errors.withColumn("row_index", F.col("row_index").cast("string"))
        letters = letters.unionByName(late_errors, allowMissingColumns=True)
        if mode == "replay":
            # Rows that still break a rule have their letters already.
            entered = taken.select("origin_batch", F.col(c.row_no).cast("string").alias("row_index"))
            self._bring(entered, "replayed", batch_id, attempt)
        else:
            self.dead_letters.write(letters, batch_id, source_file, attempt)
        if mode != "replay" and c.max_error_rows is not None and seen["invalid_rows"] > c.max_error_rows:
            raise TooManyErrors(f"{seen['invalid_rows']} invalid rows")
        if macro is not None:
            self.load_macro(macro, seq, batch_id, attempt)
        # One pass for the dates and the counts: a row per day, of which the mark takes some.
        days = stage(clean.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n")), "days")
        summary["new_products"] = self.extend_dims(taken, new_rows(days, mark), batch_id, attempt)

        # A missing SKU and one of the unknown member's name are one product, and so one key of the contribution.
        placed = taken.withColumns(
            {
                "sku": F.coalesce("sku", F.lit(S.UNKNOWN)),
                "batch_seq": (F.col("batch_place") if mode == "replay" else F.lit(place)).cast("long"),
                "sale_date": F.col("transaction_date"),
                "row_no": F.col(c.row_no).cast(c.row_type),
            }
        )
        path = f"{self.root}/contrib/batch_id={batch_id}/attempt={attempt}"
        types, dims = self.contrib_types, self.dims(attempt)
        # Merging, the product lookup and the layout by month each shuffle all rows; written in between, only one of the
        # three shuffles lies on disk at a time.
        merged = stage(S.natural_contributions(placed, dims, ORDER, c.unknown_id), "merged")
        contrib = S.keyed_contributions(merged, dims, ORDER, c.unknown_id)
        keyed = stage(contrib.select(*[F.col(n).cast(t).alias(n) for n, t in types.items()]), "keyed")
        discard(merged)
        by_month = with_month(keyed).hint("rebalance", "month").sortWithinPartitions("month", "date_id")
        by_month.write.mode("overwrite").partitionBy("month").parquet(path, compression=CODEC)
        discard(keyed)
        written = read_or_empty(self.spark, path, struct_of({**types, "month": "int"}))
        if check is not None:
            check(written)

        # Keys are unique in a contribution and those of other months cannot meet them, so only months that
        # other batches touched are compared.
        counts = {r["month"]: r["count"] for r in written.groupBy("month").count().collect()}
        as_of, months = self.log.position(), list(counts)
        others = set() if mode == "full" else self.log.others_months(batch_id, as_of)
        met = [m for m in months if others is None or m in others]
        inserted = sum(n for m, n in counts.items() if m not in met)
        if met:
            theirs = self.contributions(as_of).filter(F.col("month").isin(met) & (F.col("batch_id") != batch_id))
            target = theirs.select(*S.BUSINESS_KEY).distinct()
            ours = written.filter(F.col("month").isin(met))
            inserted += merge_counts(target, ours, S.BUSINESS_KEY).first()["inserted"]
        newer = F.lit(True) if mark is None else F.col("transaction_date") > F.lit(mark)
        rows = days.agg(
            F.coalesce(F.sum(F.when(newer, F.col("n"))), F.lit(0)).alias("loaded"),
            F.coalesce(F.sum(F.when(~newer, F.col("n"))), F.lit(0)).alias("late"),
            F.max(F.when(newer, F.col("transaction_date"))).alias("top"),
        ).first()
        summary.update(
            months=months,
            loaded_rows=rows["loaded"],
            inserted=inserted,
            updated=rows["loaded"] - inserted,
            late_rows=rows["late"],
            mark=None if mode in ("batch", "replay") else rows["top"] or mark,
        )

    def _first_seq(self, batch_id: str) -> int | None:
        earlier = self.contributions().filter(F.col("batch_id") == batch_id)
        return earlier.agg(F.min("batch_seq").alias("s")).first()["s"]

    def withdraw(self, batch_id: str) -> None:
        """Take a batch out of the fact; its files stay until ``vacuum`` removes them."""
        touched = ",".join(map(str, sorted(self.log.months_of(batch_id))))
        self.log.append(batch_id=batch_id, attempt="withdrawn", status="success", months=touched)

    def vacuum(self) -> int:
        """Removes files that no read can reach any more, and returns how many attempts went: those of attempts that
        failed, were replaced or withdrawn, or lie before a full load, and the files of refreshes that
        newer ones have taken the place of. Attempts that the log doesn't know may still run and stay; what published
        attempts brought to the dimensions stays as well."""
        rows = self.log.table().filter(F.col("attempt").isNotNull() & F.col("batch_id").isNotNull())
        ended = {(r["batch_id"], r["attempt"]) for r in rows.filter("status <> 'dry'").select("batch_id", "attempt").collect()}
        live = {tuple(r) for r in self.log.published().collect()}
        judged = {tuple(r) for r in self.log.judged().collect()}
        brought = {tuple(r) for r in self.log.succeeded().collect()}
        gone = set()
        for table, kept in (("contrib", live), ("layers", live), ("replayed", live), ("dead_letters", judged), *[(d, brought) for d in DIMENSIONS]):
            for batch_id, attempt in ended - kept:
                store = Store(self.spark, f"{self.root}/{table}/batch_id={batch_id}")
                if f"attempt={attempt}" in store.names():
                    store.delete(f"attempt={attempt}")
                    gone.add(attempt)
        whole, parts = self.log.snapshot_parts()
        made = {r["attempt"] for r in self.log.table().filter("status = 'snapshot'").select("attempt").collect()}
        store = Store(self.spark, f"{self.root}/fact_sales")
        for attempt in made - {whole, *parts.values()}:
            if f"attempt={attempt}" in store.names():
                store.delete(f"attempt={attempt}")
                gone.add(attempt)
        return len(gone)

    def _finish(self, summary, attempt, started, status, error=None, months=None, check=None) -> None:
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        if error:
            summary["error"] = error
        self.log.append(
            check,
            batch_id=summary["batch_id"],
            attempt=attempt,
            source_name=self.config.source,
            mode=summary["mode"],
            status=status,
            mark=summary["mark"].isoformat() if summary.get("mark") else None,
            start_time=started,
            end_time=ended,
            duration_seconds=(ended - started).total_seconds(),
            rows_processed=summary.get("raw_rows"),
            rows_inserted=summary.get("inserted"),
            rows_updated=summary.get("updated"),
            rows_rejected=summary.get("invalid_rows"),
            error_count=summary.get("error_count"),
            months=months,
            new_products=summary.get("new_products"),
            place=summary.get("place"),
        )
        summary["status"] = status

    def summary_table(self) -> DataFrame:
        """Counts per layer of the last finished batch, and the mark."""
        log = self.log.table().filter(F.col("rows_processed").isNotNull())
        last = log.orderBy(F.desc("seq")).limit(1)
        mark = self.marks.get(self.config.source)
        return last.select(
            "batch_id",
            "status",
            F.col("rows_processed").alias("raw_rows"),
            (F.col("rows_processed") - F.col("rows_rejected")).alias("clean_rows"),
            "error_count",
            F.lit(mark).cast("date").alias("mark"),
        )
