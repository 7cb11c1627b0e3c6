"""Dead letters that are worked off."""

from pyspark.sql import functions as F
from test_mart import RULES, facts, macro, mart, rows, sale  # noqa: F401


def states(m):
    found = m.letters().collect()
    assert all((r["processed_at"] is None) == (r["status"] == "pending") for r in found)
    return sorted((r["batch_id"], r["row_index"], r["status"]) for r in found)


def widened(m):
    m.config.rules = [r for r in RULES if r.column != "region"]


def test_letters_of_a_widened_rule_enter_once(spark, mart):  # noqa: F811
    # Row 1 is older than row 2 and lost to the region rule; row 3 breaks two rules, row 4 the widened one and another.
    first = rows(spark, sale("1", "2024-01-01", "1", "77", region="Nowhere"), sale("2", "2024-01-01", "2", "10"), sale("3", "x", "y"))
    mart.load(first, macro(spark), mode="batch", batch_id="a")
    mart.load(rows(spark, sale("4", "2024-01-08", "-5", region="Nowhere"), sale("5", "2024-01-01", "4", "20", region="Nowhere")), mode="batch", batch_id="b")
    assert {s for _, _, s in states(mart)} == {"pending"} and facts(mart.fact()) == [(20240101, 2, 20.0, 10.0)]
    before = mart.fact().select("region_id").first()[0]
    assert mart.replay(first.schema)["loaded_rows"] == 0  # nothing has changed yet
    widened(mart)
    for loaded in (2, 0):
        assert mart.replay(first.schema)["loaded_rows"] == loaded
        found = {r["region_id"]: (r["units"], float(r["unit_price"])) for r in mart.fact().collect()}
        # Under the place of its own batch row 1 comes before row 5 and gives the price.
        assert found == {before: (2, 10.0), -1: (5, 77.0)}
        assert sorted(map(str, mart.snapshot().collect())) == sorted(map(str, mart.fact().select(*mart.snapshot().columns[:-1]).withColumn("month", F.lit(202401)).collect()))
    assert states(mart) == [
        ("a", "1", "replayed"), ("a", "3", "given_up"), ("a", "3", "given_up"),
        ("b", "4", "given_up"), ("b", "4", "given_up"), ("b", "5", "replayed"),
    ]
    assert mart.vacuum() >= 0 and {s for _, _, s in states(mart)} == {"given_up", "replayed"}


def test_replays_that_meet_take_a_letter_once(spark, mart):  # noqa: F811
    batch = rows(spark, sale("1", "2024-01-01", region="Nowhere"), sale("2", "2024-01-01"))
    mart.load(batch, macro(spark), mode="batch", batch_id="a")
    widened(mart)
    met = []

    def other(contribution):
        if not met:
            met.append(mart.replay(batch.schema)["loaded_rows"])

    assert mart.replay(batch.schema, check=other)["loaded_rows"] == 0 and met == [1]
    assert sorted(r["units"] for r in mart.fact().collect()) == [2, 2]
