"""Stateful weekly rollups against the rollup of the whole table."""

from pyspark.sql import functions as F

from martloom.streaming.rollup import CLOSED, LATE, OPEN, Rollup, weekly_rollup

SCHEMA = "ts timestamp, k string, v long, note string"


def events(spark, *rows):
    frame = spark.createDataFrame([(*r, None)[:4] for r in rows], "ts string, k string, v long, note string")
    return frame.withColumn("ts", F.col("ts").cast("timestamp"))


def rollup_at(spark, path):
    return Rollup(str(path), spark.createDataFrame([], SCHEMA).schema, "ts", "k", {"s": "v"})


def drain(spark, rollup, source, checkpoint, rows=None):
    if rows is not None:
        rows.write.mode("append").parquet(str(source))
    rollup.run(spark.readStream.schema(SCHEMA).parquet(str(source)), str(checkpoint))


def same(spark, rollup, *sources):
    table = spark.read.schema(SCHEMA).parquet(*[str(s) for s in sources])
    want = sorted(map(str, weekly_rollup(table, "ts", "k", {"s": "v"}).collect()))
    assert sorted(map(str, rollup.sums(spark).collect())) == want


def test_streams_with_checkpoints_of_their_own_add_up(spark, tmp_path):
    rollup = rollup_at(spark, tmp_path / "out")
    sources = [tmp_path / "a", tmp_path / "b"]
    drain(spark, rollup, sources[0], tmp_path / "ca", events(spark, ("2024-03-01", "x", 1), ("2024-03-01", "x", 2)))
    drain(spark, rollup, sources[1], tmp_path / "cb", events(spark, ("2024-03-01", "x", 4)))
    assert [(r["event_count"], r["s"]) for r in rollup.sums(spark).collect()] == [(3, 7)]
    assert rollup.by_stream(spark).count() == 2
    # Started again from its checkpoint, without and with new events.
    drain(spark, rollup, sources[1], tmp_path / "cb")
    drain(spark, rollup, sources[0], tmp_path / "ca", events(spark, ("2024-03-02", "x", 8), ("2024-03-09", "y", 16)))
    same(spark, rollup, *sources)


def test_weeks_close_and_late_events_count(spark, tmp_path):
    rollup, source, check = rollup_at(spark, tmp_path / "out"), tmp_path / "in", tmp_path / "check"
    steps = [
        [("2024-01-02", "x", 1), ("2024-01-02 10:00:00.123456", None, None), (None, "x", 9)],
        [("2024-02-20", "x", 2)],  # moves the watermark past the first weeks
        [("2024-02-21", "y", 4), ("2024-01-03 01:02:03.000001", "x", 8, "läte \"one\"")],
        [("2024-02-15 00:00:01", "x", 16)],  # older than the newest, but not late
    ]
    for rows in steps:
        drain(spark, rollup, source, check, events(spark, *rows))
        same(spark, rollup, source)
    late = rollup.late(spark).collect()
    assert [(str(r["ts"]), r["k"], r["v"], r["note"], r["epoch"]) for r in late] == [
        ("2024-01-03 01:02:03.000001", "x", 8, 'läte "one"', 2)
    ]
    rows = rollup.table(spark)
    assert {r["epoch"] for r in rows.filter(F.col("kind") == CLOSED).collect()} == {2}
    assert rows.filter(F.col("kind") == LATE).count() == 1
    # The closed week is in no bucket's open sums any more.
    last = rows.filter((F.col("kind") == OPEN) & (F.col("epoch") >= 2))
    assert last.agg(F.min("week")).first()[0] == 1707696000


def test_rollup_of_nothing(spark, tmp_path):
    rollup = rollup_at(spark, tmp_path / "out")
    assert rollup.sums(spark).collect() == rollup.late(spark).collect() == []
