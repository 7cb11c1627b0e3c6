import pytest

from martloom.operators import evaluate as E
from martloom.operators import models as M
from martloom.operators import panel as P

SCHEMA = "team string, year int, win_rate double, ot_losses int"


@pytest.fixture(scope="module")
def panel(spark):
    rows = [
        ("A", 2001, 0.50, None),
        ("A", 2002, 0.60, 1),
        ("A", 2003, 0.40, 1),
        ("A", 2005, 0.90, 1),
        ("B", 2001, 0.40, None),
        ("B", 2002, 0.40, 2),
        ("C", 2002, 0.50, 3),
        ("C", 2003, 0.70, 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_label_uses_the_median_of_all_entities(panel):
    got = {(r["team"], r["year"]): r for r in P.label_next_period(panel).collect()}
    assert set(got) == {("A", 2001), ("A", 2002), ("B", 2001), ("C", 2002)}
    assert got["A", 2001]["median_next_win_rate"] == 0.50
    assert [got[k]["target"] for k in (("A", 2001), ("B", 2001), ("C", 2002))] == [1, 0, 1]
    assert got["A", 2001]["ot_losses"] == 0


def test_value_equal_to_the_median_is_zero(spark):
    rows = [("A", 1, 0.1, 0), ("A", 2, 0.5, 0), ("B", 2, 0.4, 0), ("C", 2, 0.6, 0)]
    out = P.label_next_period(spark.createDataFrame(rows, SCHEMA))
    assert out.first()["target"] == 0 and P.median_ties(out).first()["median_ties"] == 1


def test_join_and_window_give_the_same_pairs(panel):
    cols = ["team", "year", "next"]
    joined = P.next_period_join(panel, "win_rate", "next").select(*cols)
    led = P.lead_pairs(panel, "win_rate", "next").select(*cols)
    assert set(map(tuple, joined.collect())) == set(map(tuple, led.collect()))


def test_unpaired(panel):
    got = {r["year"]: r["unpaired_rows"] for r in P.unpaired_by_period(panel).collect()}
    assert got == {2002: 1, 2003: 2, 2005: 1}


def test_split_and_guard(panel):
    split = P.with_split(P.label_next_period(panel), 2002, 2003)
    assert {r["split"]: r["row_count"] for r in P.split_summary(split).collect()} == {
        "train": 2,
        "validation": 2,
    }
    with pytest.raises(P.FutureLeak):
        P.guard_features(["wins", "next_win_rate"])


def test_outcomes(spark):
    df = spark.createDataFrame([(0.9, 0), (0.1, 1), (0.6, 1), (0.5, 0)], "s double, y int")
    judged = E.with_outcome(df, "s", "y")
    assert {r["outcome"]: r["row_count"] for r in E.outcome_profile(judged, ["s"]).collect()} == {
        "False Positive": 2,
        "False Negative": 1,
        "Correct": 1,
    }
    assert E.confident_errors(judged, ["s"], 1).first()["s"] in (0.1, 0.9)
    assert E.union_outcomes(judged).count() == 4
    m = E.threshold_metrics(df, "s", "y").first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (1, 2, 1, 0) and m["accuracy"] == 0.25
    assert E.brier(df, "s", "y").first()["brier"] == pytest.approx((0.81 + 0.81 + 0.16 + 0.25) / 4)


def test_model_learns_a_separable_label(spark):
    rows = [("t", i, float(i), float(i % 3), int(i > 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "team string, year int, a double, b double, target int")
    model = M.fit(df, M.logistic(rows=60, c=10), ["a", "b"], scale=True)
    scored = M.predict(model, df, ["a", "b"])
    assert E.roc_auc(scored, "score", "target").first()["auc"] > 0.99
    top = M.weights(model, ["a", "b"], spark).first()
    assert top["feature"] == "a" and top["weight"] > 0
