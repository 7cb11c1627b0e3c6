"""Event-time rollups: weekly sums of a table, and of streams by state under a watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans.control import read_or_empty
from .ingest import run_available, stream_id

WEEK, MONDAY = 7 * 86400, 4 * 86400  # seconds; the epoch is a Thursday
# Kinds of rows: sums of open and of closed weeks, late events, and a bucket without open weeks.
OPEN, CLOSED, LATE, NONE = "open", "closed", "late", "none"
# With event-time timers Spark drops late rows before the function sees them; with these it doesn't.
TIMER = GroupStateTimeout.ProcessingTimeTimeout
# A late event is kept as JSON; the formats lose no digit of its times.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def weekly_rollup(events: DataFrame, ts: str, key: str, measures: dict[str, str]) -> DataFrame:
    """Monday-aligned weekly sums per key; ``measures`` maps result names to columns.

    The epoch is a Thursday, hence the four-day offset; weeks start at midnight UTC.
    """
    source = events.withColumn(ts, F.col(ts).cast("timestamp"))
    window = F.window(ts, "7 days", "7 days", "4 days")
    sums = [F.sum(c).alias(name) for name, c in measures.items()]
    grouped = source.groupBy(window, key).agg(F.count(F.lit(1)).alias("event_count"), *sums)
    return grouped.select(
        F.col("window.start").cast("date").alias("week"),
        key,
        "event_count",
        *measures,
    )


def _pack(table: pd.DataFrame) -> bytes:
    whole = pa.Table.from_pandas(table, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, whole.schema) as out:
        out.write_table(whole)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def _keeper(sums: list[str], names: list[str]):
    """What a bucket does with the events of an epoch, and when its oldest week closes.

    State: one table of (week, key) with sums, of the weeks that are still open.
    """
    keys = ["week", "key"]

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby(keys, dropna=False, as_index=False, sort=False)[sums].sum()

    def run(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        parts = [_unpack(state.get[0])] if state.exists else []
        if not state.hasTimedOut:
            for batch in batches:
                late = batch["us"] < mark * 1000 if mark > 0 else pd.Series(False, batch.index)
                if late.any():
                    yield batch[late].assign(kind=LATE, bucket=bucket[0])[names]
                parts.append(added(batch[~late]))
        held = added(pd.concat(parts, ignore_index=True)) if parts else pd.DataFrame(columns=[*keys, *sums])
        done = (held["week"] + WEEK) * 1000 <= mark
        closed, still = held[done], held[~done]
        if len(still):
            state.update((_pack(still),))
            state.setTimeoutDuration(1)  # asks to be called in the next epoch, with events or without
        elif state.exists:
            state.remove()
        none = pd.DataFrame([{"week": 0, "key": "", **dict.fromkeys(sums, 0)}] if still.empty else [])
        for kind, rows in ((CLOSED, closed), (OPEN, still), (NONE, none)):
            if len(rows):
                yield rows.assign(kind=kind, bucket=bucket[0], event="", us=0)[names]

    return run


class Rollup:
    """The weekly rollup of all streams that write to one folder.

    Each stream keeps its own state and watermark in its checkpoint and writes under its own id, so any
    number of streams add up. State holds the sums of open weeks alone: a week closes, and leaves
    the state, once the watermark (the newest event of earlier epochs less ``lateness``) has passed its end. An event
    behind the watermark is late: it is written to a side table as it came, and counts in the rollup through that
    table, so no event is lost in whatever order events arrive.

    Events are dealt by a hash of the whole event into ``buckets`` (per shuffle partition, ``SPREAD``), not by key
    or week: a key with most events is as many rows in every bucket, and a bucket's state has a row per key and
    open week. An epoch is written by one job into a folder of its own, which a repeated epoch overwrites.
    Null times belong to no week and are left out, as in ``weekly_rollup``.
    """

    SPREAD = 4

    def __init__(self, path: str, schema: T.StructType, ts: str, key: str, measures: dict[str, str], lateness: str = "7 days"):
        self.path, self.schema, self.ts, self.key = path.rstrip("/"), schema, ts, key
        self.measures, self.lateness = measures, lateness
        self.kept = [f"sum{i}" for i in range(len(measures))] + [f"count{i}" for i in range(len(measures))]

    def _fields(self, events: DataFrame) -> DataFrame:
        """Time, week, key, measures with their number of values, and the event itself."""
        at = F.col(self.ts).cast("timestamp")
        start = F.floor((F.unix_seconds(at) - MONDAY) / WEEK) * WEEK + MONDAY
        columns = list(self.measures.values())
        return events.filter(F.col(self.ts).isNotNull()).select(
            at.alias("at"),
            F.unix_micros(at).alias("us"),
            start.cast("long").alias("week"),
            F.col(self.key).cast("string").alias("key"),
            F.lit(1).cast("long").alias("event_count"),
            *[F.coalesce(F.col(c), F.lit(0)).cast(self.schema[c].dataType).alias(f"sum{i}") for i, c in enumerate(columns)],
            *[F.col(c).isNotNull().cast("long").alias(f"count{i}") for i, c in enumerate(columns)],
            F.to_json(F.struct(*events.columns), JSON_TIMES).alias("event"),
        )

    def _output(self, summed: DataFrame) -> T.StructType:
        kinds = {f.name: f.dataType for f in summed.schema}
        sums = [(s, T.LongType() if s.startswith("count") else _total(kinds[s])) for s in self.kept]
        fixed = [("kind", T.StringType()), ("bucket", T.IntegerType()), ("week", T.LongType()), ("key", T.StringType())]
        rest = [("event_count", T.LongType()), *sums, ("us", T.LongType()), ("event", T.StringType())]
        return T.StructType([T.StructField(n, t) for n, t in fixed + rest])

    def run(self, events: DataFrame, checkpoint: str) -> None:
        """Takes in what the stream has; a second run goes on where the first ended."""
        spark = events.sparkSession
        fields = self._fields(events).withWatermark("at", self.lateness)
        schema = self._output(fields)
        buckets = self.SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = fields.withColumn("bucket", F.pmod(F.xxhash64("event"), F.lit(buckets)).cast("int"))
        keeper = _keeper(["event_count", *self.kept], schema.names)
        rolled = dealt.groupBy("bucket").applyInPandasWithState(keeper, schema, "held binary", "update", TIMER)

        def write(batch: DataFrame, epoch: int) -> None:
            out = f"{self.path}/stream={stream_id(spark, checkpoint)}/epoch={epoch}"
            batch.write.mode("overwrite").partitionBy("kind").parquet(out)

        # Weeks close with the next events; epochs without events would only close them sooner.
        run_available(rolled, write, checkpoint, "update", {"spark.sql.streaming.noDataMicroBatches.enabled": "false"})

    def table(self, spark) -> DataFrame:
        """All rows that streams have written."""
        empty = spark.createDataFrame([], self.schema)
        keys = [T.StructField("stream", T.StringType()), T.StructField("epoch", T.LongType())]
        schema = self._output(self._fields(empty))
        return read_or_empty(spark, self.path, T.StructType([*schema.fields, *keys]))

    def late(self, spark) -> DataFrame:
        """Late events, with stream and epoch."""
        rows = self.table(spark).filter(F.col("kind") == LATE)
        event = F.from_json("event", self.schema, JSON_TIMES).alias("event")
        return rows.select(event, "stream", "epoch").select("event.*", "stream", "epoch")

    def by_stream(self, spark) -> DataFrame:
        """Weekly sums per key and stream: closed weeks, late events, and the open weeks as each bucket
        showed them last."""
        rows = self.table(spark)
        last = rows.filter(F.col("kind").isin(OPEN, NONE)).groupBy("stream", "bucket").agg(F.max("epoch").alias("epoch"))
        shown = rows.filter(F.col("kind") == OPEN).join(last, ["stream", "bucket", "epoch"], "left_semi")
        counted = rows.filter(F.col("kind").isin(CLOSED, LATE)).unionByName(shown.select(*rows.columns))
        totals = counted.groupBy("week", "key", "stream").agg(*[F.sum(c).alias(c) for c in ("event_count", *self.kept)])
        return self._named(totals, ["stream"])

    def sums(self, spark) -> DataFrame:
        """The rollup of everything all streams have delivered: equal to that of the whole table."""
        totals = self.by_stream(spark).groupBy("week", self.key)
        return totals.agg(*[F.sum(c).alias(c) for c in ("event_count", *self.measures)])

    def _named(self, totals: DataFrame, more: list[str]) -> DataFrame:
        values = [F.when(F.col(f"count{i}") > 0, F.col(f"sum{i}")).alias(name) for i, name in enumerate(self.measures)]
        week = F.timestamp_seconds("week").cast("date").alias("week")
        return totals.select(week, F.col("key").cast(self.schema[self.key].dataType).alias(self.key), "event_count", *values, *more)


def _total(kind: T.DataType) -> T.DataType:
    """Type of a sum, as Spark's own."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    return T.DoubleType() if isinstance(kind, (T.DoubleType, T.FloatType)) else T.LongType()


def rollup_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    ts: str,
    key: str,
    measures: dict[str, str],
    lateness: str = "7 days",
) -> tuple[DataFrame, DataFrame]:
    """Drains a stream into the rollup at ``path``; returns the sums of all its streams and their late events."""
    rollup = Rollup(path, events.schema, ts, key, measures, lateness)
    rollup.run(events, checkpoint)
    spark = events.sparkSession
    return rollup.sums(spark), rollup.late(spark)
