"""What written and moved tables cost."""

import contextlib
import io
import re
from pathlib import Path

from pyspark.sql import functions as F

from martloom import bindings as B
from martloom.functions import columns as C
from martloom.operators import evaluate as E
from martloom.operators import merge as M
from martloom.operators.ordered import dense_numbers, range_blocks
from martloom.plans import star as S
from martloom.plans.control import DEAD_LETTER_TYPES, DeadLetters
from martloom.workspace import stage

NUMBERS = ["12", "12.", ".5", "1/", "12d", "0x1p3", "0X1P3", "Infinity", "NaN", "", "  7 ", "7\t", "7\n", "-1e3", "1e3x", "é1", None]


def test_letters_are_packed_and_read_back(spark, tmp_path):
    """F1, F2"""
    kept = F.concat(F.lit('{"sku":"LUM-'), F.col("id").cast("string"), F.lit('","units":"twelve","region":"Pacific"}'))
    texts = {c: F.lit(None).cast("string") for c, t in DEAD_LETTER_TYPES.items() if t == "string"}
    errors = spark.range(5000).select(kept.alias("kept")).withColumns(
        {**texts, "original_data": F.col("kept"), "error_type": F.lit("LATE_ROW")}
    )
    letters = DeadLetters(spark, str(tmp_path / "letters"))
    letters.write(errors.drop("kept"), "b")
    size = sum(p.stat().st_size for p in Path(letters.path).rglob("part-*"))
    assert size < 5000 * 30
    back = letters.read().select("original_data")
    assert back.exceptAll(errors.select("original_data")).isEmpty() and back.count() == 5000


def test_staged_tables_are_packed(spark):
    """F1, F2"""
    path = stage(spark.range(10), "packed").inputFiles()[0]
    assert path.endswith(".zstd.parquet")


def test_transform_is_compiled(spark):
    """the JVM compiles no method of over 8,000 bytes of code."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        raw = stage(spark.createDataFrame([], ", ".join(f"{c} string" for c in ("row_key", *B.LANDING_COLUMNS))), "raw")
        rules = [*B.landing_rules(), *[S.Rule(c, "R", lambda x: x.isNull(), "", on_null=True) for c in ("date", "units", "unit_price")]]
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            S.transform_transactions(raw, rules).explain("codegen")
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_numbers_are_read_as_before(spark):
    rows = spark.createDataFrame([(x,) for x in NUMBERS], "x string")
    last = F.substring(F.rtrim("x"), -1, 1).between(".", "9") & ~F.col("x").contains("x") & ~F.col("x").contains("X")
    plain = F.when(last, F.rtrim("x").try_cast("double"))
    found = rows.select("x", C.as_number(F.col("x")).alias("got"), plain.alias("was")).collect()
    assert [r for r in found if r["got"] != r["was"]] == []
    assert [r["got"] for r in found][:4] == [12.0, 12.0, 0.5, None]


def test_first_row_moves_its_order_once(spark):
    """F7, F12 to F16, F18"""
    rows = spark.createDataFrame([("a", 1, 2.0, 5), ("a", 1, 1.0, 6), ("a", 2, 0.0, 4), ("b", None, 3.0, None)], "k string, n int, price double, o int")
    merged = M.additive(rows, ["k"], ["n"], ["price"], ["o"])
    assert merged.columns == ["k", "n", "price", "o"]
    assert sorted(map(tuple, merged.collect())) == [("a", 4, 0.0, 4), ("b", None, 3.0, None)]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan


def test_bootstrap_blocks_follow_rows(spark, monkeypatch):
    """adaptive execution put all of these rows into one block."""
    rows = spark.range(400).select((F.col("id") % 100 / 10).alias("score"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    whole = sorted(map(tuple, E.bootstrap_auc(rows, replicates=10).collect()))
    made = []
    monkeypatch.setattr(E, "CELLS_PER_BLOCK", 50)
    monkeypatch.setattr(E, "range_blocks", lambda *a: made.append(range_blocks(*a)) or made[-1])
    assert sorted(map(tuple, E.bootstrap_auc(rows, replicates=10).collect())) == whole
    assert made[0].select("_block").distinct().count() == 4


def test_numbered_blocks_are_not_shuffled_again(spark):
    """all rows moved to their blocks once more to be numbered there."""
    rows = spark.range(1000).select(F.hex(F.col("id") * 7919 % 1000).alias("k"))
    numbered = dense_numbers(rows, ["k"], "n", start=5)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_block") <= 1
    found = [tuple(r) for r in numbered.collect()]
    assert sorted(found) == list(zip(sorted(k for k, _ in found), range(5, 1005)))


def test_weekly_values_become_text_before_the_join(spark, tmp_path):
    """F5 to F10, F13, F19, F21: they were written as text once per sale."""
    orders = "1L o_orderkey, 'F' o_orderstatus, 12.5D o_totalprice, timestamp'2024-01-02' o_orderdate"
    lines = "1 l_linenumber, 1L l_partkey, 1L l_suppkey, 2D l_quantity, 9D l_extendedprice, 0D l_discount, 0D l_tax, 'N' l_returnflag, 'O' l_linestatus"
    spark.sql(f"SELECT {orders}").write.parquet(str(tmp_path / "orders.parquet"))
    days = "VALUES (1L, timestamp'2024-01-03'), (1L, timestamp'2024-02-01') AS t(l_orderkey, l_shipdate)"
    spark.sql(f"SELECT *, {lines} FROM {days}").write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = B.landing(spark, str(tmp_path), "date", "lumber_price_index", "mortgage_rate")
    assert sorted(map(tuple, rows.collect()), key=str) == [("2024-01-01", "0.03", "1.000"), ("2024-01-29", None, None)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(5,3)" in plan and plan.index("Join") < plan.index("decimal(5,3)")
