import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators import duplicates as D
from martloom.operators import quality as Q
from martloom.operators import selection as S

PROBS = {"low": 0.0, "q1": 0.25, "med": 0.5, "p9": 0.9, "high": 1.0}


def brute(values, p):
    x = np.sort(np.asarray(values, float))
    at = p * (len(x) - 1)
    lo, hi = x[int(np.floor(at))], x[int(np.ceil(at))]
    return lo + (hi - lo) * (at - np.floor(at))


@pytest.fixture(scope="module")
def rows():
    """A group of ordinary values, one over all magnitudes and signs, one of ties, single rows, a null group."""
    rng = np.random.default_rng(11)
    wide = np.sign(rng.random(700) - 0.4) * 10.0 ** rng.uniform(-320, 300, 700)
    near = 1.0 + np.arange(300) * 2.0**-52
    parts = {
        "plain": rng.normal(100, 15, 900).round(2),
        "wide": wide,
        "near": near,
        "ties": rng.choice([0.0, -0.0, 3.5], 400),
        "one": [7.25],
        "two": [-1e300, 1e300],
        None: rng.random(50),
    }
    return [(g, float(x)) for g, xs in parts.items() for x in xs]


@pytest.mark.parametrize("direct", [0, 20, 50_000])
def test_quantiles_equal_sorting(spark, rows, direct):
    extra = [("plain", None), ("plain", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows + extra, "g string, v double")
    found = {r["g"]: r for r in S.exact_quantiles(df, "v", PROBS, ["g"], direct=direct).collect()}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    assert set(found) == set(groups)
    for g, xs in groups.items():
        assert found[g]["n"] == len(xs)
        for name, p in PROBS.items():
            assert found[g][name] == pytest.approx(brute(xs, p), rel=1e-15, abs=0), (g, name)


@pytest.mark.parametrize("direct", [0, 100])
def test_quantiles_of_the_whole_table(spark, rows, direct):
    df = spark.createDataFrame(rows, "g string, v double")
    (found,) = S.exact_quantiles(df, "v", PROBS, direct=direct).collect()
    for name, p in PROBS.items():
        assert found[name] == pytest.approx(brute([x for _, x in rows], p), rel=1e-15, abs=0)
    (none,) = S.exact_quantiles(df.filter("v is null"), "v", PROBS).collect()
    assert none["n"] is None and none["med"] is None
    assert S.exact_quantiles(df.filter("v is null"), "v", PROBS, ["g"]).count() == 0


def test_infinite_values_are_ends(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (-inf, -inf, -1e308, 1e308, inf, 0.0, inf)], "v double")
    (found,) = S.exact_quantiles(df, "v", {"low": 0.0, "med": 0.5, "high": 1.0}, direct=0).collect()
    assert (found["low"], found["med"], found["high"]) == (-inf, 0.0, inf)


def test_passes_are_few_and_move_bins_only(spark, monkeypatch):
    """40,000 distinct values between two floats: passes of bins, none of which orders rows."""
    passes = []
    narrow = S._narrow
    monkeypatch.setattr(S, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    monkeypatch.setattr(S, "_finish", lambda *a: pytest.fail("nothing may be ordered"))
    df = spark.range(40_000).select((F.lit(1.0) + F.col("id") * F.lit(2.0**-52)).alias("v"))
    (found,) = S.exact_quantiles(df, "v", {"med": 0.5}, direct=0).collect()
    assert found["med"] == pytest.approx(1.0 + 19_999.5 * 2.0**-52, abs=2.0**-52)
    assert 1 <= len(passes) <= 5


def test_flags_of_a_numeric_order_are_hash_aggregates(spark):
    df = spark.range(100).select("id", (F.col("id") % 40).cast("string").alias("k"))
    plan = D.flag_duplicates(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    later = {r["id"] for r in D.flag_duplicates(df, ["k"], ["id"]).filter("is_duplicate").collect()}
    assert later == set(range(40, 100))


def test_error_types_are_counted_without_records(spark):
    from martloom.functions.rules import required

    df = spark.createDataFrame([("a", None), (None, "5"), ("x", "-1"), (None, None)], "k string, v string")
    rules = [required("k"), required("v")]
    counted = {tuple(r) for r in Q.error_type_counts(df, rules).collect()}
    parsed, flags = Q.flag_columns(df, rules)
    assert sum(n for _, n in counted) == sum(parsed.select(F.sum(f.cast("int"))).first()[0] for f in flags) == 4
    assert "Generate" not in Q.error_type_counts(df, rules)._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[-1]
