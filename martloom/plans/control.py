"""Control tables: high-water marks, batch log, dead letters.

Marks and batches are rows of one commit log; the current state is the latest row per key, so a
crashed writer leaves either the old or the new state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import last_per_key
from ..sources.files import struct_of
from .commits import CommitLog

LOG_SCHEMA = (
    "batch_id string, attempt string, source_name string, mode string, status string, "
    "mark string, start_time timestamp, "
    "end_time timestamp, duration_seconds double, rows_processed long, rows_inserted long, "
    "rows_updated long, rows_rejected long, error_count long, months string, "
    "new_products long, as_of long, place long"
)
# A packed file is read by one task, so letters go to files of at most so many.
LETTERS_PER_FILE = 500_000
# In ``months``: every month there is.
ALL_MONTHS = "all"
DEAD_LETTER_TYPES = {
    "row_index": "string",
    "column": "string",
    "value": "string",
    "error_type": "string",
    "error_message": "string",
    "original_data": "string",
    "source_file": "string",
    "timestamp": "timestamp",
}


def read_or_empty(spark: SparkSession, path: str, schema: str, form: str = "parquet") -> DataFrame:
    """Table at ``path``, or an empty one when nothing has been written yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


class BatchLog:
    """One row per attempt of a batch, and one per refresh of the snapshot, in the order of their commits."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.commits = spark, CommitLog(spark, path, LOG_SCHEMA)

    def position(self) -> int:
        return self.commits.position()

    def table(self, as_of: int | None = None) -> DataFrame:
        return self.commits.table(as_of)

    def append(self, check: Callable[[], None] | None = None, **fields) -> int:
        return self.commits.append(fields, check)

    def published(self, as_of: int | None = None) -> DataFrame:
        """The successful attempt of each batch that counts: its last one. A full load hides
        every batch before it."""
        done = self.table(as_of).filter(F.col("status") == "success")
        rebuilt = done.filter(F.col("mode") == "full").agg(F.max("seq")).scalar()
        live = done.filter(F.col("seq") >= F.coalesce(rebuilt, F.lit(0)))
        return last_per_key(live, ["batch_id"], ["seq"]).select("batch_id", "attempt")

    def succeeded(self) -> DataFrame:
        """Attempts that were published at any time, also those replaced since."""
        return self.table().filter(F.col("status") == "success").select("batch_id", "attempt").distinct()

    def judged(self) -> DataFrame:
        """The attempt of each batch whose letters count: the last successful one, else the last."""
        tries = self.table().filter(F.col("attempt").isNotNull() & F.col("batch_id").isNotNull())
        good = (F.col("status") == "success").cast("int")
        rank = tries.withColumn("good", good)
        return last_per_key(rank, ["batch_id"], ["good", "seq"]).select("batch_id", "attempt")

    def places(self) -> DataFrame:
        """Per published batch its place in the order of batches and the position that published it."""
        done = self.table().select("batch_id", "attempt", "place", "seq")
        return done.join(self.published(), ["batch_id", "attempt"], "left_semi").filter("place IS NOT NULL")

    def replays(self) -> list[tuple[int, datetime]]:
        """Position and time of every replay of dead letters, one row each."""
        rows = self.table().filter("status = 'success' AND mode = 'replay'").select("seq", "end_time")
        return sorted((r["seq"], r["end_time"]) for r in rows.collect())

    def months_of(self, batch_id: str) -> set[int]:
        """Months that published attempts of a batch have touched."""
        rows = self.table().filter((F.col("batch_id") == batch_id) & (F.col("status") == "success"))
        listed = rows.filter(F.coalesce("months", F.lit("")) != "").select(F.explode(F.split("months", ",")).alias("m"))
        return {int(r["m"]) for r in listed.distinct().collect() if r["m"] != ALL_MONTHS}

    def pending_months(self) -> list[int] | None:
        """Months that published batches have touched since the position as of which a refresh last
        covered them, a handful; None for all months."""
        rows = self.table().filter(F.col("months").isNotNull() & (F.col("months") != ""))
        each = rows.select("status", "seq", "as_of", F.explode(F.split("months", ",")).alias("month"))
        touched = F.max(F.when(F.col("status") == "success", F.col("seq"))).alias("touched")
        covered = F.max(F.when(F.col("status") == "snapshot", F.col("as_of"))).alias("covered")
        found = {r["month"]: (r["touched"] or 0, r["covered"] or 0) for r in each.groupBy("month").agg(touched, covered).collect()}
        touched_all, covered_all = found.pop(ALL_MONTHS, (0, 0))
        if touched_all > covered_all:
            return None
        return sorted(int(m) for m, (t, c) in found.items() if t > max(c, covered_all))

    def _touched(self, as_of: int | None) -> DataFrame:
        """The months that each published batch touched, one row each; a batch without a list may touch any."""
        done = self.table(as_of).filter("status = 'success' AND attempt <> 'withdrawn'").select("batch_id", "attempt", "months")
        live = done.join(self.published(as_of), ["batch_id", "attempt"], "left_semi")
        listed = F.explode(F.split(F.coalesce("months", F.lit(ALL_MONTHS)), ","))
        return live.select("batch_id", listed.alias("month")).filter("month <> ''")

    def shared_months(self, as_of: int | None = None) -> list[int] | None:
        """Months that more than one published batch may hold rows of; None for all months."""
        batches = {r["month"]: r["count"] for r in self._touched(as_of).groupBy("month").count().collect()}
        whole = batches.pop(ALL_MONTHS, 0)
        return None if whole > 1 else sorted(int(m) for m, n in batches.items() if n + whole > 1)

    def others_months(self, batch_id: str, as_of: int | None = None) -> set[int] | None:
        """Months that published batches but ``batch_id`` may hold rows of; None for all months."""
        rows = self._touched(as_of).filter(F.col("batch_id") != batch_id).select("month").distinct().collect()
        months = {r["month"] for r in rows}
        return None if ALL_MONTHS in months else {int(m) for m in months}

    def snapshot_parts(self) -> tuple[str | None, dict[int, str]]:
        """Which attempt of the snapshot holds which month: the one made as of the latest position. The first
        value holds every month that the second doesn't name."""
        rows = self.table().filter(F.col("status") == "snapshot").select("months", "attempt", "as_of", "seq").collect()
        whole, parts = (0, 0, None), {}
        for r in rows:
            made = (r["as_of"], r["seq"], r["attempt"])
            if r["months"] == ALL_MONTHS:
                whole = max(whole, made, key=lambda x: x[:2])
            else:
                for month in r["months"].split(","):
                    parts[int(month)] = max(parts.get(int(month), made), made, key=lambda x: x[:2])
        return whole[2], {m: made[2] for m, made in parts.items() if made[:2] > whole[:2]}

    def marks(self) -> DataFrame:
        """Marks reached by successful batches, which are part of the row that publishes them, and marks
        set by hand."""
        reached = (F.col("status") == "success") & F.col("mark").isNotNull()
        return self.table().filter(reached | (F.col("status") == "mark")).select(
            "source_name", F.col("mark").alias("last_processed_value"), "batch_id", "seq"
        )


class MarkStore:
    """High-water mark per source: the latest of those in ``log``, or in a log of its own."""

    def __init__(self, spark: SparkSession, path: str, log: BatchLog | None = None):
        self.log = log or BatchLog(spark, path)

    def table(self) -> DataFrame:
        return last_per_key(self.log.marks(), ["source_name"], ["seq"])

    def get(self, source: str) -> date | None:
        row = self.table().filter(F.col("source_name") == source).first()
        value = row["last_processed_value"] if row else None
        return date.fromisoformat(value) if value else None

    def set(self, source: str, value: date | None, batch_id: str | None = None) -> None:
        text = value.isoformat() if value else None
        self.log.append(source_name=source, status="mark", mark=text, batch_id=batch_id)

    def reset(self, source: str) -> None:
        self.set(source, None)


class DeadLetters:
    """Rejected rows as packed JSON lines, one folder per attempt of a batch.

    With a batch log, a batch's letters are those of its last successful attempt, or of its last
    attempt if none succeeded: a failed retry leaves the letters of the published attempt alone,
    and a load that only failed still shows why. Without a log all letters are read.
    """

    def __init__(self, spark: SparkSession, path: str, log: BatchLog | None = None):
        self.spark, self.path, self.log = spark, path, log

    def write(
        self, errors: DataFrame, batch_id: str, source_file: str | None = None, attempt: str = "0"
    ) -> None:
        origin = F.col("source_file") if "source_file" in errors.columns else F.lit(source_file)
        out = errors.withColumns(
            {"source_file": origin.cast("string"), "timestamp": F.current_timestamp()}
        ).select(*[F.col(c).cast(t).alias(c) for c, t in DEAD_LETTER_TYPES.items()])
        packed = out.write.mode("overwrite").option("maxRecordsPerFile", LETTERS_PER_FILE)
        packed.json(f"{self.path}/batch_id={batch_id}/attempt={attempt}", compression="gzip")

    def read(self, limit: int | None = None) -> DataFrame:
        """Readable letters; malformed lines are skipped."""
        schema = struct_of({**DEAD_LETTER_TYPES, "batch_id": "string", "attempt": "string"})
        from pyspark.errors import AnalysisException

        try:
            rows = (
                self.spark.read.schema(schema).option("mode", "DROPMALFORMED").json(self.path)
            )
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise
        rows = rows.filter(F.col("error_type").isNotNull())
        if self.log is not None:
            rows = rows.join(self.log.judged(), ["batch_id", "attempt"], "left_semi")
        return rows if limit is None else rows.limit(limit)

    def summary(self) -> DataFrame:
        """Letters and latest time per error type, with the overall total on every row."""
        per_type = self.read().groupBy("error_type").agg(
            F.count(F.lit(1)).alias("error_count"), F.max("timestamp").alias("latest")
        )
        total = per_type.agg(F.sum("error_count")).scalar()
        return per_type.withColumn("total_errors", total).orderBy(
            F.desc("error_count"), "error_type"
        )

    def clear(self) -> None:
        empty = self.spark.createDataFrame([], struct_of(DEAD_LETTER_TYPES))
        empty.write.mode("overwrite").json(self.path)
