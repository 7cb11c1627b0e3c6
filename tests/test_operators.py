import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from martloom.operators import duplicates as D
from martloom.operators import evaluate as E
from martloom.operators import lookup as L
from martloom.operators import merge as M
from martloom.operators import ordered as O
from martloom.operators import selection as Sel
from martloom.operators import profile as R
from martloom.operators import stats as S


@pytest.fixture(scope="module", autouse=True)
def several_blocks(spark):
    """Keep small ranges apart, so that groups spread over blocks."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def hot(spark):
    """1,200 rows, one group of which holds more than a third, with ties and nulls."""
    rng = np.random.default_rng(3)
    group = np.where(rng.random(1200) < 0.4, "hot", rng.choice(list("abc"), 1200))
    value = np.round(rng.normal(size=1200), 1)
    pdf = pd.DataFrame({"g": group, "v": value, "y": (rng.random(1200) < 0.4).astype(int)})
    rows = [(i, *r) for i, r in enumerate(pdf.itertuples(index=False, name=None))]
    rows += [(1200, "hot", None, 1), (1201, None, 0.5, 1), (1202, None, 1.5, 0)]
    return spark.createDataFrame(rows, "id int, g string, v double, y int")


def brute(df):
    return df.toPandas()


def test_exact_quantiles(hot):
    got = {
        r["g"]: r for r in Sel.exact_quantiles(hot, "v", {"q1": 0.25, "med": 0.5, "p9": 0.9}, ["g"]).collect()
    }
    for g, part in brute(hot).groupby("g", dropna=False):
        key = None if pd.isna(g) else g
        want = part["v"].quantile([0.25, 0.5, 0.9]).tolist()
        assert [got[key][c] for c in ("q1", "med", "p9")] == pytest.approx(want)
        assert got[key]["n"] == part["v"].notna().sum()


def test_a_group_spreads_over_blocks(hot):
    blocks = O.range_blocks(hot.filter("v is not null").select("g", "v", "id"), ["g", "v", "id"])
    per_group = blocks.groupBy("g").agg(F.count_distinct(O.BLOCK).alias("n")).toPandas()
    assert per_group["n"].max() > 1


def test_running_total_and_numbers(spark):
    rows = [(g, i, i % 7) for g in "ab" for i in range(200)]
    df = spark.createDataFrame(rows, "g string, i int, x int")
    pdf = O.running_total(df, "x", ["i"], ["g"]).toPandas().sort_values(["g", "i"])
    assert (pdf.groupby("g")["x"].cumsum() == pdf["running"]).all()
    assert set(pdf["total"]) == {sum(i % 7 for i in range(200))}
    names = spark.createDataFrame([(f"k{i:03d}",) for i in range(300)], "k string")
    out = O.dense_numbers(names, ["k"], "n", start=11).toPandas().sort_values("k")
    assert out["n"].tolist() == list(range(11, 311))


def pair_auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_against_all_pairs(hot):
    got = {r["g"]: r["auc"] for r in E.roc_auc(hot, "v", "y", ["g"]).collect()}
    for g, part in brute(hot).dropna(subset=["v"]).groupby("g"):
        assert got[g] == pytest.approx(pair_auc(part["v"].to_numpy(), part["y"].to_numpy()))


def test_auc_ties_and_single_class(spark):
    df = spark.createDataFrame([(0.5, 0), (0.5, 1), (0.9, 1)], "score double, label int")
    assert E.roc_auc(df).first()["auc"] == 0.75
    assert E.roc_auc(df.filter("label = 1")).first()["auc"] is None


def test_bootstrap_centres_on_the_auc(hot):
    rows = hot.filter("v is not null")
    aucs = E.bootstrap_auc(rows, "v", "y", 300).toPandas()["auc"]
    exact = E.roc_auc(rows, "v", "y").first()["auc"]
    assert len(aucs) == 300 and abs(aucs.mean() - exact) < 0.005
    assert 0.008 < aucs.std() < 0.03
    again = E.bootstrap_auc(rows.repartition(3), "v", "y", 300).toPandas()["auc"]
    assert np.allclose(np.sort(aucs), np.sort(again))


def test_poisson_draws_have_the_right_moments():
    u = (np.arange(20000) + 0.5) / 20000
    for n in (1, 7, 400):
        draws = E.poisson_draws(np.array([n]), u[None, :])[0]
        assert draws.mean() == pytest.approx(n, rel=0.01)
        assert draws.var() == pytest.approx(n, rel=0.03)


def test_duplicates(hot):
    flagged = D.flag_duplicates(hot, ["g", "v"], ["id"]).toPandas().sort_values("id")
    want = brute(hot).sort_values("id").duplicated(["g", "v"])
    assert flagged["is_duplicate"].tolist() == want.tolist()
    members = D.all_duplicates(hot, ["g", "v"], ["id"]).toPandas()
    assert set(members["id"]) == set(brute(hot)[brute(hot).duplicated(["g", "v"], keep=False)]["id"])


def test_additive_merge_and_counts(spark):
    cols = "k string, units long, revenue double, price double, seq int, no int"
    target = spark.createDataFrame([("k", 5, 50.0, 10.0, 0, 0)], cols)
    batch = spark.createDataFrame(
        [("k", 2, 24.0, 12.0, 1, 0), ("k2", 1, 9.0, 9.0, 1, 1), ("k2", 3, 30.0, 10.0, 1, 2)], cols
    )
    args = (["k"], ["units", "revenue"], ["price"], ["seq", "no"])
    merged = M.additive(target.unionByName(M.additive(batch, *args)), *args)
    got = {r["k"]: (r["units"], r["revenue"], r["price"]) for r in merged.collect()}
    assert got == {"k": (7, 74.0, 10.0), "k2": (4, 39.0, 9.0)}
    assert tuple(M.merge_counts(target, batch, ["k"]).first()) == (1, 2)


def test_merge_does_not_depend_on_how_rows_are_batched(hot):
    rows = hot.filter("v is not null").withColumn("n", F.lit(1).cast("long"))
    args = (["g"], ["n"], ["v"], ["id"])
    whole = M.additive(rows.select("g", "n", "v", "id"), *args)
    halves = [M.additive(rows.filter(F.col("y") == y).select("g", "n", "v", "id"), *args) for y in (0, 1)]
    merged = M.additive(halves[0].unionByName(halves[1]), *args)
    assert set(map(tuple, whole.collect())) == set(map(tuple, merged.collect()))


def test_insert_ignore_and_overwrite(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    s = spark.createDataFrame([("b", 9), ("c", 8), ("c", 7)], "k string, v int")
    assert set(map(tuple, M.insert_ignore(t, s, ["k"], ["v"]).collect())) == {("a", 1), ("b", 2), ("c", 7)}
    assert set(map(tuple, M.upsert_overwrite(t, s, ["k"], ["v"]).collect())) == {("a", 1), ("b", 9), ("c", 8)}


def test_lookup_unknown_member(spark):
    df = spark.createDataFrame([("x",), ("zz",), (None,)], "r string")
    dim = spark.createDataFrame([(4, "x")], "id int, name string")
    assert sorted(r["id"] for r in L.lookup(df, dim, "r", "name", "id").collect()) == [-1, -1, 4]
    ids = df.select(L.map_lookup(F.col("r"), {"x": 4}, 1).alias("id")).collect()
    assert sorted(r["id"] for r in ids) == [1, 1, 4]
    assert [r["name"] for r in L.new_members(df, "r", dim, "name").collect()] == ["zz"]


def test_cardinality_ignores_null(hot):
    got = {r["column_name"]: r["distinct_values"] for r in R.cardinality(hot, ["g", "v"]).collect()}
    assert got == {"g": 4, "v": brute(hot)["v"].nunique()}


def test_boxplot(hot):
    got = {r["g"]: r for r in S.boxplot_stats(hot, "g", "v").collect()}
    part = brute(hot).query("g == 'hot'")["v"].dropna()
    q1, q3 = part.quantile([0.25, 0.75])
    inside = part[(part >= q1 - 1.5 * (q3 - q1)) & (part <= q3 + 1.5 * (q3 - q1))]
    assert got["hot"]["whisker_low"] == inside.min() and got["hot"]["whisker_high"] == inside.max()
    assert got["hot"]["outlier_count"] == len(part) - len(inside)


def test_histogram_covers_every_value(hot):
    bins = S.histogram(hot, "v", 10).toPandas()
    assert bins["row_count"].sum() == brute(hot)["v"].notna().sum()
    assert bins["bin"].between(1, 10).all()


@pytest.mark.parametrize("t, df, p", [(2.0, 10, 0.0734), (2.5, 200, 0.01322), (0.0, 5, 1.0)])
def test_t_distribution(t, df, p):
    assert S.t_p_value(t, df) == pytest.approx(p, abs=2e-4)


def test_mutual_information_of_a_copy_is_the_entropy(spark):
    rows = [(i % 2, i % 2, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "y int, same double, flat double".replace("same double", "same int"))
    got = {r["feature"]: r["mutual_info"] for r in S.mutual_information(df, ["same", "flat"], "y", 2).collect()}
    assert got["flat"] == pytest.approx(0.0)
    assert got["same"] == pytest.approx(np.log(2))
