"""What jobs of many steps hold on disk, and steps that queries name."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom import bindings as B
from martloom.catalog import load_queries as L
from martloom.plans import star as S
from martloom.workspace import TIDY, discard, scratch_root, stage, tidy


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p for d in folders for p in Path(d).rglob("shuffle_*")}


def landed(spark, n=12):
    i = F.col("id")
    month = i % 3 + 1
    day = F.format_string("1998-0%d-05", month)
    values = {
        "row_key": F.concat(F.when(i % 2 == 0, "k").otherwise("kk"), i.cast("string")), "date": day, "year": F.lit("1998"), "month": month.cast("string"),
        "week_of_year": F.lit("2"), "region": F.lit("ASIA"), "product_category": F.lit("PROMO"), "sku": F.concat(F.lit("PRO-"), (i % 4).cast("string")),
        "channel": F.lit("pro_dealer"), "customer_type": F.lit("BUILDING"), "units": F.lit("5"), "unit_price": F.lit("10.00"), "revenue": F.lit("50.00"),
        "housing_starts_index": F.lit("100.00"), "lumber_price_index": F.lit("500.00"), "mortgage_rate": F.lit("0.300"),
    }
    return spark.range(n).select(*[v.alias(k) for k, v in values.items()])


def weeks(spark):
    return spark.sql("SELECT date'1998-01-05' AS week, 100D AS housing_starts_index, 500D AS lumber_price_index, 0.3D AS mortgage_rate, 1D AS season_factor")


@pytest.fixture
def tables(spark, monkeypatch):
    marts = []
    monkeypatch.setattr(B, "landing_layer", lambda spark, sf: landed(spark))
    monkeypatch.setattr(B, "macro", lambda spark, sf: weeks(spark))
    new = L.new_mart
    monkeypatch.setattr(L, "new_mart", lambda *a: marts.append(new(*a)) or marts[-1])
    return marts


def test_vacuumed_has_a_refused_load(spark, tables):
    """the query named a refused batch and made none."""
    found = L.vacuumed(spark, "").agg(F.count(F.lit(1)), F.sum("units")).first()
    assert tuple(found) == (12, 60)
    log = {(r["batch_id"], r["status"]) for r in tables[0].log.table().collect()}
    assert ("c", "rolled_back") in log
    assert not list(Path(tables[0].root).glob("contrib/batch_id=c/attempt=*"))


@pytest.fixture
def plain(spark):
    """Without settings that another test may have left."""
    assert spark.conf.get(TIDY) == "false"
    yield
    assert spark.conf.get(TIDY) == "false"


def test_written_steps_leave_no_shuffle(spark, plain):
    """F1 to F21: shuffle files stayed until the driver collected its garbage."""
    before = shuffle_files(spark)
    stage(spark.range(1000).groupBy((F.col("id") % 50).alias("k")).count(), "counts")
    assert shuffle_files(spark) <= before
    spark.range(1000).groupBy((F.col("id") % 50).alias("k")).count().collect()
    assert not shuffle_files(spark) <= before  # the session's own queries are as they were


def test_a_load_leaves_no_shuffle(spark, plain, tables):
    """F3 to F21"""
    mart = L.new_mart(spark, "mart")
    before = shuffle_files(spark)
    run = mart.load(landed(spark), weeks(spark), mode="batch", update_snapshot=False)
    made = [p for p in shuffle_files(spark) - before if p.suffix == ".data"]
    assert run["inserted"] == 12
    # What is left is the log's: a row a batch.
    assert sum(p.stat().st_size for p in made) < 10_000
    steps = [p for name in ("merged", "keyed") for p in Path(scratch_root(spark)).glob(f"{name}-*/*.parquet")]
    assert not [p for p in steps if p.stat().st_mtime > Path(mart.root).stat().st_ctime]


def test_discarded_tables_are_gone(spark):
    kept, gone = stage(spark.range(3), "kept"), stage(spark.range(3), "gone")
    path = Path(gone.inputFiles()[0].removeprefix("file:").replace("//", "")).parent
    discard(gone)
    assert not path.exists() and kept.count() == 3


def test_tidy_ends_with_its_block(spark, plain):
    with pytest.raises(ValueError), tidy(spark):
        assert spark.conf.get(TIDY) == "true"
        raise ValueError


def test_contributions_merge_and_look_up_in_two_steps(spark):
    """both shuffles lay on disk together."""
    clean = S.typed_transactions(landed(spark, 24))
    dims = {
        "region": S.seed_regions(spark, B.REGION_SEEDS), "channel": S.seed_channels(spark, B.CHANNEL_SEEDS), "customer": S.seed_customers(spark, B.CUSTOMER_SEEDS),
        "product": spark.sql("SELECT 'PRO-1' AS sku, 7L AS product_id"), "macro": S.macro_rows(S.transform_macro(weeks(spark))),
    }
    found = S.contributions(clean, dims, ["row_key"])
    assert found.groupBy("product_id").agg(F.sum("units").alias("u")).orderBy("product_id").collect() == [(-1, 90), (7, 30)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_landing_is_written_by_date(spark, monkeypatch):
    """F3 to F21: weekly values in no order took half as many bytes again."""
    rows = landed(spark, 300).coalesce(1)
    monkeypatch.setattr(B, "landing", lambda spark, sf: rows)
    days = [r["date"] for r in B.landing_layer(spark, "by date").select("date").collect()]
    assert days == sorted(days) and len(days) == 300
