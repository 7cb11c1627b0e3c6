import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators import moments as M
from martloom.operators import stats as S
from martloom.plans.commits import Store
from martloom.workspace import fresh_dir

COLUMNS = ["a", "b", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    """Values far from zero, of which sums of squares would lose all digits; nulls on either side."""
    rng = np.random.default_rng(4)
    a = 1e9 + rng.normal(size=600)
    b = 3 * a + rng.normal(size=600)
    data = [(i, None if i % 7 == 0 else float(x), None if i % 11 == 0 else float(y), 5.0) for i, (x, y) in enumerate(zip(a, b))]
    return spark.createDataFrame(data, "i int, a double, b double, flat double").cache()


def same(found, wanted, key):
    found, wanted = ({tuple(r[k] for k in key): r.asDict() for r in d.collect()} for d in (found, wanted))
    assert found.keys() == wanted.keys()
    for k, r in wanted.items():
        for name, v in r.items():
            undefined = isinstance(v, float) and v != v
            assert found[k][name] == (None if undefined else pytest.approx(v, rel=1e-7) if isinstance(v, float) else v), (k, name)


def test_batches_equal_the_full_pass(spark, rows):
    store = M.MomentStore(spark, fresh_dir(spark, "m"), COLUMNS)
    store.add("1", rows.filter("i < 100"))
    store.add("2", rows.filter("i = 150"))
    store.add("none", rows.limit(0))
    store.add("3", rows.filter("i >= 350"))
    store.add("2", rows.filter("i >= 100 and i < 350"))
    assert store.records().count() == 4
    found = store.combined()
    same(M.describe(found, COLUMNS), S.describe(rows, COLUMNS), ["column_name"])
    same(M.correlation_matrix(found, COLUMNS), S.correlation_matrix(rows, COLUMNS), ["x", "y"])
    for x, y in (("a", "b"), ("b", "a")):
        (line,) = M.linear_trend(found, x, y).collect()
        (wanted,) = S.linear_trend(rows, x, y).collect()
        assert line["pair_count"] == wanted["pair_count"]
        assert (line["slope"], line["r2"]) == pytest.approx((wanted["slope"], wanted["r2"]), rel=1e-6)


def test_withdrawn_batches_and_positions(spark, rows):
    store = M.MomentStore(spark, fresh_dir(spark, "m"), ["a"])
    store.add("1", rows.filter("i < 300"))
    at = store.add("2", rows.filter("i >= 300"))
    store.withdraw("2")
    same(M.describe(store.combined(), ["a"]), S.describe(rows.filter("i < 300"), ["a"]), ["column_name"])
    same(M.describe(store.combined(at), ["a"]), S.describe(rows, ["a"]), ["column_name"])


def test_a_store_without_values(spark, rows):
    store = M.MomentStore(spark, fresh_dir(spark, "m"), ["a", "b"])
    for _ in range(2):
        (r,) = M.describe(store.combined(), ["a"]).collect()
        assert (r["value_count"], r["mean_value"], r["std_value"]) == (0, None, None)
        assert M.linear_trend(store.combined(), "a", "b").count() == 0
        store.add("empty", rows.limit(0))


def test_many_batches_read_few_files(spark, rows):
    path = fresh_dir(spark, "m")
    store = M.MomentStore(spark, path, ["flat"])
    record = M.moments(rows.limit(3), ["flat"]).first().asDict(recursive=True)["pairs"]
    for i in range(70):
        store.log.append({"batch_id": str(i), "pairs": record})
    assert len(Store(spark, path).names()) < 70
    (r,) = M.describe(store.combined(), ["flat"]).collect()
    assert (r["value_count"], r["min_value"], r["mean_value"], r["std_value"]) == (210, 5.0, 5.0, 0.0)
