from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom.functions.rules import sales_rules
from martloom.operators.lookup import lookup
from martloom.plans import mart as T
from martloom.plans import star as S
from martloom.plans.control import DeadLetters, MarkStore
from martloom.streaming.ingest import file_stream, ingest_stream
from martloom.streaming.rollup import rollup_stream, weekly_rollup

SCHEMA = (
    "row_no string, date string, region string, product_category string, sku string, "
    "channel string, customer_type string, units string, unit_price string, "
    "housing_starts_index string, lumber_price_index string, mortgage_rate string"
)
RULES = sales_rules(
    [s[1] for s in S.REGION_SEEDS],
    list(S.PREFIX_CATEGORIES.values()),
    [s[1] for s in S.CHANNEL_SEEDS],
    [s[1] for s in S.CUSTOMER_SEEDS],
)


def sale(no, day, units="2", price="10", sku="LUM-1", region="Pacific"):
    head = (no, day, region, "lumber", sku, "pro_dealer", "homebuilder", units, price)
    return (*head, "100", "500", "4")


def rows(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


def macro(spark):
    one = [(date(2024, 1, 1), 100.0, 500.0, 4.0, None), (date(2024, 3, 4), 90.0, 400.0, 5.0, 0.5)]
    return spark.createDataFrame(
        one,
        "week date, housing_starts_index double, lumber_price_index double, "
        "mortgage_rate double, season_factor double",
    )


@pytest.fixture
def mart(spark, tmp_path):
    return T.Mart(spark, str(tmp_path / "mart"), T.MartConfig(rules=RULES))


def facts(df):
    return sorted((r["date_id"], r["units"], float(r["revenue"]), float(r["unit_price"])) for r in df.collect())


def test_incremental_marks_and_merge(spark, mart):
    first = mart.load(rows(spark, sale("1", "2024-01-01"), sale("2", "2024-01-01", "3", "12")), macro(spark))
    assert (first["inserted"], first["updated"], first["mark"]) == (1, 1, date(2024, 1, 1))
    assert facts(mart.fact()) == [(20240101, 5, 56.0, 10.0)]
    both = rows(spark, sale("1", "2024-01-01"), sale("3", "2024-01-08"), sale("4", "2024-01-08", "-1"))
    second = mart.load(both)
    assert (second["loaded_rows"], second["late_rows"], second["invalid_rows"]) == (1, 1, 1)
    assert mart.marks.get("transactions") == date(2024, 1, 8)
    assert facts(mart.snapshot()) == facts(mart.fact()) == [(20240101, 5, 56.0, 10.0), (20240108, 2, 20.0, 10.0)]
    third = mart.load(both)
    assert third["loaded_rows"] == 0 and third["mark"] == date(2024, 1, 8)
    kinds = {r["error_type"] for r in mart.dead_letters.read().collect()}
    assert kinds == {"OUT_OF_RANGE", "LATE_ROW"}
    dims = mart.dims()
    ids = {r["customer_type"]: r["customer_id"] for r in dims["customer"].collect()}
    assert (ids["homebuilder"], ids["contractor"]) == (4, 2)
    assert sorted(r["product_id"] for r in dims["product"].collect()) == [-1, 1]


def test_rerun_correction_and_emptied_month(spark, mart):
    batch = rows(spark, sale("1", "2024-01-01"), sale("2", "2024-02-05"))
    for _ in range(2):
        mart.load(batch, macro(spark), mode="batch", batch_id="b")
    assert len(facts(mart.fact())) == 2
    mart.load(rows(spark, sale("1", "2024-01-01", "7")), mode="batch", batch_id="b")
    assert facts(mart.snapshot()) == facts(mart.fact()) == [(20240101, 7, 70.0, 10.0)]


def test_failed_batch_leaves_nothing(spark, mart):
    mart.load(rows(spark, sale("1", "2024-01-01")), macro(spark), batch_id="a")

    def refuse(contribution):
        raise ValueError("no")

    with pytest.raises(ValueError):
        mart.load(rows(spark, sale("2", "2024-01-08")), batch_id="b", check=refuse)
    assert len(facts(mart.fact())) == 1 and mart.marks.get("transactions") == date(2024, 1, 1)
    status = {r["batch_id"]: r["status"] for r in mart.log.table().where("batch_id IS NOT NULL").collect()}
    assert status == {"a": "success", "b": "rolled_back"}


def test_full_load_rebuilds_and_limit_aborts(spark, mart):
    mart.load(rows(spark, sale("1", "2024-01-01")), macro(spark))
    mart.load(rows(spark, sale("9", "2024-05-06", "4")), mode="full")
    assert facts(mart.fact()) == facts(mart.snapshot()) == [(20240506, 4, 40.0, 10.0)]
    mart.config.max_error_rows = 0
    with pytest.raises(T.TooManyErrors):
        mart.load(rows(spark, sale("5", "2024-06-03", "x")))
    assert [r["row_index"] for r in mart.dead_letters.read().collect()] == ["5"]


def test_dry_run_publishes_nothing(spark, mart):
    run = mart.load(rows(spark, sale("1", "2024-01-01"), sale("2", "x")), mode="dry")
    assert (run["status"], run["raw_rows"], run["valid_rows"]) == ("dry", 2, 1)
    assert mart.fact().count() == 0 and mart.marks.get("transactions") is None


def test_missing_values_go_to_the_dead_letters(spark, mart):
    mart.load(rows(spark, sale("1", None), sale("2", "2024-01-01", None)), macro(spark))
    assert mart.fact().count() == 0
    assert {(r["column"], r["error_type"]) for r in mart.dead_letters.read().collect()} == {
        ("date", "REQUIRED"),
        ("units", "REQUIRED"),
    }


def test_macro_week_without_sales_and_missing_week(spark, mart):
    mart.load(rows(spark, sale("1", "2024-01-01"), sale("2", "2024-01-08")), macro(spark))
    view = {str(r["week"]): r["weekly_units"] for r in S.macro_view(mart.fact(), mart.dims()).collect()}
    assert view == {"2024-01-01": 2, "2024-03-04": None}
    assert {r["date_id"]: r["macro_id"] for r in mart.fact().collect()} == {
        20240101: 20240101,
        20240108: None,
    }
    weekly = S.weekly_sales_view(mart.fact(), mart.dims())
    assert weekly.count() == 2 and weekly.filter("season_factor = 1.0").count() == 1
    assert S.category_view(mart.fact(), mart.dims()).first()["is_lumber_sensitive"]


def test_new_and_late_rows(spark):
    days = ["2024-01-01", "2024-01-08", "2024-01-15"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("transaction_date"))
    assert T.new_rows(df, None).count() == 3 and T.late_rows(df, None).count() == 0
    assert T.new_rows(df, date(2024, 1, 7)).count() == 2
    assert T.high_mark(df, None) == date(2024, 1, 15)
    assert T.high_mark(df.limit(0), date(2024, 1, 2)) == date(2024, 1, 2)


def test_mark_store(spark, tmp_path):
    marks = MarkStore(spark, str(tmp_path / "marks"))
    assert marks.get("s") is None
    marks.set("s", date(2024, 1, 15))
    assert marks.get("s") == date(2024, 1, 15)
    marks.reset("s")
    assert marks.get("s") is None


def test_dead_letter_summary_limit_and_malformed(spark, tmp_path):
    path = tmp_path / "dlq"
    letters = DeadLetters(spark, str(path))
    assert letters.read().count() == 0
    items = [(str(i), "c", "v", "OUT_OF_RANGE" if i < 3 else "INVALID_CATEGORY", "m", "{}") for i in range(5)]
    schema = "row_index string, column string, value string, error_type string, error_message string, original_data string"
    letters.write(spark.createDataFrame(items, schema), "b1")
    (path / "batch_id=b1" / "attempt=0" / "bad.json").write_text("{not json\n")
    assert letters.read().count() == 5 and letters.read(limit=2).count() == 2
    got = [(r["error_type"], r["error_count"], r["total_errors"]) for r in letters.summary().collect()]
    assert got == [("OUT_OF_RANGE", 3, 5), ("INVALID_CATEGORY", 2, 5)]
    letters.clear()
    assert letters.read().count() == 0


def test_stream_equals_batch(spark, mart, tmp_path):
    source = str(tmp_path / "in")
    one = rows(spark, sale("1", "2024-01-01"), sale("2", "2024-01-01", "3", "12"))
    two = rows(spark, sale("3", "2024-01-01", "1"), sale("4", "2024-01-08", "-1"))
    for part in (one, two, None):
        if part is not None:
            part.write.mode("append").parquet(source)
        stream = file_stream(spark, source, one.schema, "parquet")
        ingest_stream(mart, stream, str(tmp_path / "check"), macro(spark))
    assert facts(mart.fact()) == facts(mart.snapshot()) == [(20240101, 6, 66.0, 10.0)]
    assert mart.dead_letters.read().count() == 1
    assert mart.log.published().count() == 2


def test_failed_retry_keeps_the_published_attempt(spark, mart):
    mart.load(rows(spark, sale("1", "2024-01-01"), sale("2", "x")), macro(spark), mode="batch", batch_id="c")

    def refuse(contribution):
        raise ValueError("no")

    later = macro(spark).limit(1).withColumn("week", F.date_add("week", 700))
    with pytest.raises(ValueError):
        mart.load(rows(spark, sale("3", "2024-01-08", sku="LUM-9"), sale("4", "y")), later, mode="batch", batch_id="c", check=refuse)
    assert [r["row_index"] for r in mart.dead_letters.read().collect()] == ["2"]
    dims = mart.dims()
    assert {r["sku"] for r in dims["product"].collect()} == {"unknown", "LUM-1"}
    assert dims["macro"].count() == 2 and dims["date"].count() == 1
    mart.load(rows(spark, sale("5", "2024-01-08", sku="LUM-3")), batch_id="d")
    assert {r["sku"]: r["product_id"] for r in mart.dims()["product"].collect()} == {"unknown": -1, "LUM-1": 1, "LUM-3": 2}


def test_snapshot_catches_up_after_a_failed_refresh(spark, mart, monkeypatch):
    def fail(months=None, check=None):
        raise OSError("disk")

    monkeypatch.setattr(mart, "refresh_snapshot", fail)
    with pytest.raises(OSError):
        mart.load(rows(spark, sale("1", "2024-01-01")), macro(spark))
    monkeypatch.undo()
    assert mart.snapshot().count() == 0 and mart.log.pending_months() == [202401]
    assert mart.load(rows(spark, sale("1", "2024-01-01")))["loaded_rows"] == 0
    assert facts(mart.snapshot()) == facts(mart.fact()) == [(20240101, 2, 20.0, 10.0)]
    assert mart.log.pending_months() == []
    mart.withdraw(mart.log.published().first()["batch_id"])
    mart.catch_up()
    assert mart.snapshot().count() == 0


def test_fact_has_calendar_and_load_times(spark, mart):
    first = mart.load(rows(spark, sale("1", "2024-11-04")), macro(spark), mode="batch", batch_id="a")
    mart.load(rows(spark, sale("2", "2024-11-04"), sale("3", "2024-01-01")), mode="batch", batch_id="b")
    assert first["status"] == "success"
    for table in (mart.fact(), mart.snapshot()):
        found = {r["date_id"]: r for r in table.collect()}
        old, new = found[20241104], found[20240101]
        assert (old["quarter"], new["quarter"]) == (4, 1)
        assert old["created_at"] < old["updated_at"] == new["created_at"] == new["updated_at"]


def test_rows_are_ordered_as_numbers(spark, mart):
    mart.load(rows(spark, sale("10", "2024-01-01", "1", "77"), sale("9", "2024-01-01", "1", "10")), macro(spark))
    assert facts(mart.fact()) == [(20240101, 2, 87.0, 10.0)]


def test_two_streams_add_up(spark, mart, tmp_path):
    for name, no in (("a", "1"), ("b", "2")):
        batch = rows(spark, sale(no, "2024-01-01"), sale(no, "x"))
        batch.write.parquet(str(tmp_path / name))
        stream = file_stream(spark, str(tmp_path / name), batch.schema, "parquet")
        ingest_stream(mart, stream, str(tmp_path / f"check-{name}"), macro(spark))
    assert facts(mart.fact()) == [(20240101, 4, 40.0, 10.0)]
    assert mart.dead_letters.read().count() == 2


def test_unknown_members_stay_in_the_views(spark, mart):
    mart.config.rules = []
    mart.load(rows(spark, sale("1", "2024-01-01"), sale("2", "2024-01-01", sku="XXX-1"), sale("3", "2024-01-01", region="Nowhere")), macro(spark))
    dims = mart.dims()
    assert all(d.filter(f"{c} = -1").count() == 1 for d, c in ((dims["region"], "region_id"), (dims["product"], "product_id"), (dims["category"], "category_id")))
    weekly = S.weekly_sales_view(mart.fact(), dims).collect()
    assert sum(r["total_units"] for r in weekly) == 6
    assert {r["category_name"] for r in weekly} == {"lumber", "unknown"} and "unknown" in {r["region_name"] for r in weekly}
    assert sum(r["total_units"] for r in S.category_view(mart.fact(), dims).collect()) == 6


def test_closed_dimensions_move_no_rows(spark, mart, tmp_path):
    """The planner knows the size of closed dimensions: looking them up shuffles nothing."""
    S.typed_transactions(rows(spark, sale("1", "2024-01-01"))).write.parquet(str(tmp_path / "clean"))
    dims = mart.dims()
    clean = spark.read.parquet(str(tmp_path / "clean"))
    for name, column, key, found in (("region", "region", "region_name", "region_id"), ("channel", "channel", "channel_name", "channel_id"), ("customer", "customer_type", "customer_type", "customer_id")):
        plan = lookup(clean, dims[name], column, key, found)._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_weekly_rollup_starts_on_monday(spark, tmp_path):
    items = [("2024-01-07 23:59:59", "a", 1), ("2024-01-08 00:00:00", "a", 2), ("2024-01-14 12:00:00", "a", 4)]
    df = spark.createDataFrame(items, "ts string, k string, v long").withColumn("ts", F.col("ts").cast("timestamp"))
    want = {"2024-01-01": 1, "2024-01-08": 6}
    assert {str(r["week"]): r["s"] for r in weekly_rollup(df, "ts", "k", {"s": "v"}).collect()} == want


def test_streamed_rollup_loses_no_late_event(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "ts timestamp, k string, v long"
    for day, value in (("2024-03-01", 1), ("2024-03-20", 2), ("2024-01-01", 4)):
        one = spark.createDataFrame([(day, "a", value)], "ts string, k string, v long")
        one.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        sums, late = rollup_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck"), "ts", "k", {"s": "v"})
    table = weekly_rollup(spark.read.schema(schema).parquet(source), "ts", "k", {"s": "v"})
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, table.collect())) and sums.count() == 3
    assert [(r["v"], r["epoch"]) for r in late.collect()] == [(4, 2)]


def shuffles(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [date_id")


def test_months_of_one_batch_are_not_merged_again(spark, mart):
    """F5 to F10, F13, F19, F21: the fact and every refresh merged all rows once more."""
    how = {"mode": "batch", "update_snapshot": False}
    mart.load(rows(spark, sale("1", "2024-01-01"), sale("2", "2024-02-05")), macro(spark), batch_id="a", **how)
    assert mart.log.shared_months() == []
    assert shuffles(mart._merged(mart.contributions(), None)[1]) == 1 and shuffles(mart.fact()) == 0
    second = rows(spark, sale("3", "2024-02-05", "3", "12"), sale("4", "2024-02-05", sku="LUM-2"), sale("5", "2024-03-04"))
    run = mart.load(second, batch_id="b", **how)
    assert mart.log.shared_months() == [202402] and mart.log.others_months("b") == {202401, 202402}
    assert (run["loaded_rows"], run["inserted"], run["updated"]) == (3, 2, 1)
    expected = [(20240101, 2, 20.0, 10.0), (20240205, 2, 20.0, 10.0), (20240205, 5, 56.0, 10.0), (20240304, 2, 20.0, 10.0)]
    mart.catch_up()
    assert facts(mart.fact()) == facts(mart.snapshot()) == expected
    # Columns that only the second batch's time changes.
    newer = mart.fact().filter("updated_at > created_at").select("date_id", "units").collect()
    assert [tuple(r) for r in newer] == [(20240205, 5)]
    mart.withdraw("b")
    assert mart.log.shared_months() == []
    mart.catch_up()
    assert facts(mart.fact()) == facts(mart.snapshot()) == [(20240101, 2, 20.0, 10.0), (20240205, 2, 20.0, 10.0)]
    mart.load(second, mode="full", update_snapshot=False)
    assert mart.log.shared_months() == []
    mart.load(rows(spark, sale("6", "2024-03-04")), batch_id="c", **how)
    assert mart.log.shared_months() == [202403] and mart.log.others_months("c") is None
    mart.catch_up()
    assert facts(mart.fact()) == facts(mart.snapshot())
    assert [f for f in facts(mart.fact()) if f[0] == 20240304] == [(20240304, 4, 40.0, 10.0)]


def test_missing_and_unknown_sku_are_one_key(spark, tmp_path):
    """A contribution has one row per business key, also of the unknown product."""
    free = T.Mart(spark, str(tmp_path / "mart"), T.MartConfig(rules=[]))
    run = free.load(rows(spark, sale("1", "2024-01-01", sku=None), sale("2", "2024-01-01", sku="unknown")), macro(spark))
    assert (run["loaded_rows"], run["inserted"], run["updated"]) == (2, 1, 1)
    assert facts(free.fact()) == facts(free.snapshot()) == [(20240101, 4, 40.0, 10.0)]
