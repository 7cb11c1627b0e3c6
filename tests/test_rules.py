import pytest

from martloom.functions import columns as C
from martloom.functions import rules as R
from martloom.operators import quality as Q
from martloom.plans import star as S
from pyspark.sql import functions as F

COLUMNS = ["date", "units", "unit_price", "region", "product_category", "channel"]
COLUMNS += ["customer_type", "lumber_price_index", "sku"]
GOOD = ("2024-01-01", "100", "10.50", "Pacific", "lumber", "pro_dealer")
GOOD += ("homebuilder", "500", "LUM-1234")
RULES = R.sales_rules(
    [s[1] for s in S.REGION_SEEDS],
    list(S.PREFIX_CATEGORIES.values()),
    [s[1] for s in S.CHANNEL_SEEDS],
    [s[1] for s in S.CUSTOMER_SEEDS],
)


def frame(spark, *rows):
    schema = "row_no int, " + ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def row(**changes):
    return tuple(changes.get(c, v) for c, v in zip(COLUMNS, GOOD))


def broken(spark, **changes):
    invalid = Q.invalid_rows(R.annotate(frame(spark, row(**changes)), RULES))
    errors = Q.error_rows(invalid, RULES, "row_no").collect()
    return [(e["column"], e["error_type"]) for e in errors]


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"units": "-5"}, [("units", "OUT_OF_RANGE")]),
        ({"units": "0"}, []),
        ({"units": "100000"}, []),
        ({"units": "100001"}, [("units", "OUT_OF_RANGE")]),
        ({"units": "ten"}, [("units", "INVALID_TYPE")]),
        ({"units": "12d"}, [("units", "INVALID_TYPE")]),
        ({"units": "0x1p3"}, [("units", "INVALID_TYPE")]),
        ({"unit_price": "0.01"}, [("unit_price", "OUT_OF_RANGE")]),
        ({"unit_price": "100000"}, []),
        ({"unit_price": "1e3"}, []),
        ({"region": "InvalidRegion"}, [("region", "INVALID_CATEGORY")]),
        ({"product_category": "food"}, [("product_category", "INVALID_CATEGORY")]),
        ({"channel": "web"}, [("channel", "INVALID_CATEGORY")]),
        ({"customer_type": "other"}, [("customer_type", "INVALID_CATEGORY")]),
        ({"lumber_price_index": "99.9"}, [("lumber_price_index", "OUT_OF_RANGE")]),
        ({"lumber_price_index": "high"}, [("lumber_price_index", "INVALID_TYPE")]),
        ({"sku": "LUM1234"}, [("sku", "INVALID_FORMAT")]),
        ({"date": "2024-02-30"}, [("date", "INVALID_DATE_FORMAT")]),
        ({"date": "2024-1-5"}, [("date", "INVALID_DATE_FORMAT")]),
        ({"date": "01.02.2024"}, [("date", "INVALID_DATE_FORMAT")]),
        ({c: None for c in COLUMNS}, []),
        (
            {"units": "-5", "sku": "LUM1234"},
            [("units", "OUT_OF_RANGE"), ("sku", "INVALID_FORMAT")],
        ),
    ],
)
def test_rule(spark, changes, expected):
    assert broken(spark, **changes) == expected


def test_metrics_count_rows_and_errors_apart(spark):
    df = frame(spark, row(), row(units="-5", sku="LUM1"), row(region="x"))
    m = Q.metrics(df, RULES).first()
    assert (m["total_rows"], m["valid_rows"], m["invalid_rows"], m["error_count"]) == (3, 1, 2, 3)
    assert m["error_rate_pct"] == pytest.approx(200 / 3)
    assert Q.metrics(df.limit(0), RULES).first()["error_rate_pct"] == 0.0


def test_valid_and_invalid_make_up_the_input(spark):
    df = frame(spark, row(), row(units="-5"), row(sku=None), row(date="x"))
    good, bad = Q.split(df, RULES)
    assert good.count() + bad.count() == df.count() == 4


def test_error_keeps_value_reason_and_original(spark):
    df = frame(spark, row(units="-5"))
    e = Q.error_rows(Q.split(df, RULES)[1], RULES, "row_no").first()
    assert e["value"] == "-5" and e["error_message"].endswith("-5")
    assert '"sku":"LUM-1234"' in e["original_data"]


def test_required_rule_fires_on_null_only(spark):
    df = frame(spark, row(units=None), row())
    errors = Q.error_rows(Q.split(df, [R.required("units")])[1], [R.required("units")], "row_no")
    assert [(e["row_index"], e["error_type"]) for e in errors.collect()] == [(0, "REQUIRED")]


def test_typed_row(spark):
    t = S.typed_transactions(frame(spark, row(sku="LUM-1234-AB", units="12.7"))).first()
    assert (t["units"], t["unit_price"], t["sku_prefix"]) == (12, 10.5, "LUM")
    assert t["revenue"] == 126.0 and str(t["transaction_date"]) == "2024-01-01"


@pytest.mark.parametrize("units, price, revenue", [(10, 100, 1000), (20, 50, 1000), (15, 75, 1125)])
def test_revenue_identity(spark, units, price, revenue):
    df = spark.createDataFrame([(units, float(price), float(revenue))], "units int, unit_price double, revenue double")
    assert Q.revenue_mismatch(df).first()["mismatch_rows"] == 0


def test_calendar_and_ids(spark):
    df = spark.sql("SELECT DATE'2024-12-30' AS d")
    c = df.select(*[v.alias(k) for k, v in C.calendar(F.col("d")).items()]).first()
    assert (c["week_of_year"], c["quarter"], c["day_of_week"], c["day_name"]) == (1, 4, 0, "Monday")
    assert df.select(C.date_id(F.col("d"))).first()[0] == 20241230
    ext = df.select(*[v.alias(k) for k, v in C.calendar_ext(F.col("d"), 10).items()]).first()
    assert (ext["fiscal_year"], ext["fiscal_quarter"], ext["is_weekend"]) == (2025, 1, False)


def test_null_tokens(spark):
    df = spark.createDataFrame([("NaN", float("nan")), ("x", 1.0)], "s string, d double")
    assert [tuple(r) for r in C.clean_nulls(df).collect()] == [(None, None), ("x", 1.0)]


def test_constraints_ignore_null(spark):
    df = spark.createDataFrame([(13,), (None,), (5,)], "month int")
    out = Q.constraint_counts(df, {"month_range": F.col("month").between(1, 12)}).first()
    assert out["violations"] == 1
