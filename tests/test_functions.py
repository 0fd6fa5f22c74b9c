from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.functions import aggregates as agg
from tallymark.functions import conditional as cond
from tallymark.functions import formulas, privacy


def one(spark, expr, schema="x double", row=(None,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, op, expected",
    [
        (700.0, ">=", "mid"), (699.9, ">=", "low"), (750.0, ">=", "high"), (None, ">=", "low"),
        (700.0, ">", "low"), (700.1, ">", "mid"), (750.0, ">", "mid"),
    ],
)
def test_band_descending(spark, value, op, expected):
    assert one(spark, cond.band("x", [(750, "high"), (700, "mid")], "low", op), row=(value,)) == expected


@pytest.mark.parametrize("value, expected", [(0.2, 4), (0.19, 5), (0.4, 0), (None, 0)])
def test_band_ascending(spark, value, expected):
    assert one(spark, cond.band("x", [(0.2, 5), (0.4, 4)], 0, "<"), row=(value,)) == expected


def test_band_null_value(spark):
    assert one(spark, cond.band("x", [(1, "a")], "b", null_value="unset")) == "unset"


def test_rules_take_the_first_match_in_order(spark):
    x = F.col("x")
    rules = cond.rules([(x > 10, "ten"), (x > 5, "five"), (x > 20, "twenty")], "none")
    assert one(spark, rules, row=(25.0,)) == "ten"
    assert one(spark, rules, row=(None,)) == "none"
    with pytest.raises(ValueError):
        cond.rules([], 0)


def test_rule_table_is_rules_written_as_data(spark):
    table = [({"a": (">", 1), "b": ("==", "x")}, 2), ({"a": (">=", 0)}, 1)]
    df = spark.createDataFrame([(2, "x"), (2, "y"), (1, "x"), (-1, "x"), (None, "x")], "a int, b string")
    assert [r[0] for r in df.select(cond.rule_table(table, 0)).collect()] == [2, 1, 1, 0, 0]


def test_band_where_equals_a_filter_on_the_band(spark):
    steps = [(30, 0.95), (20, 0.75), (12, 0.5)]
    df = spark.createDataFrame([(v,) for v in (None, 12.0, 12.1, 20.0, 20.1, 30.0, 30.1)], "x double")
    banded = df.withColumn("p", cond.band("x", steps, 0.05, ">"))
    for limit in (0.5, 0.7, 0.9):
        direct = df.filter(cond.band_where("x", steps, lambda p: p > limit, ">"))
        assert direct.collect() == banded.filter(F.col("p") > limit).select("x").collect()
    for passes in (lambda p: p == 0.75, lambda p: p > 1):
        with pytest.raises(ValueError):
            cond.band_where("x", steps, passes, ">")


def test_indicator_sum_and_weighted_score(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    scored = df.select(
        cond.indicator_sum([(F.col("a") > 0, 2.5), (F.col("b") > 2, 1.5)]).alias("points"),
        cond.weighted_score({"a": 2.0, "b": -1.0}, 10).alias("score"),
    )
    assert [tuple(r) for r in scored.collect()] == [(2.5, None), (4.0, 11.0)]


@pytest.mark.parametrize(
    "n, d, policy, expected",
    [
        (1.0, 0.0, "positive", None), (1.0, -2.0, "positive", None), (1.0, 2.0, "positive", 0.5),
        (1.0, 0.0, "nonzero", None), (1.0, -2.0, "nonzero", -0.5), (1.0, 0.0, "eps", 100.0), (None, 1.0, "eps", None),
    ],
)
def test_ratio(spark, n, d, policy, expected):
    assert one(spark, cond.ratio("n", "d", policy), "n double, d double", (n, d)) == expected


def test_ratio_rejects_unknown_policy():
    with pytest.raises(ValueError):
        cond.ratio(F.lit(1), F.lit(1), "other")


def test_formulas(spark):
    schema = "p double, r double, w double, h double, birth date, v double"
    df = spark.createDataFrame(
        [(100000.0, 6.0, 80.0, 200.0, date(2000, 3, 1), 228.0), (1000.0, 0.0, 80.0, 0.0, None, None)], schema
    )
    row, empty = df.select(
        F.round(formulas.annuity_payment("p", "r"), 2).alias("payment"),
        formulas.bmi("w", "h").alias("bmi"),
        formulas.age_years("birth", F.lit(date(2020, 2, 28))).alias("age"),
        formulas.adjusted_dosage("w").alias("dosage"),
        formulas.deviation("v", 240.0).alias("deviation"),
    ).collect()
    assert tuple(row) == (599.55, 20.0, 19, 80.5, 0.05)
    assert tuple(empty) == (None, None, None, 80.5, None)


@pytest.mark.parametrize(
    "text, raw, clean, phone, identity",
    [
        (" Ann@Example.com", " ***@Example.com", "a***@example.com", "******.com", "XXXXXXXX.com"),
        ("no-at", None, None, "******o-at", "XXXXXXXXo-at"),
        ("12", None, None, "******12", "XXXXXXXX12"),
        ("@x.org", "@***@x.org", "***@x.org", "******.org", "XXXXXXXX.org"),
        (None, None, None, None, None),
    ],
)
def test_masks(spark, text, raw, clean, phone, identity):
    df = spark.createDataFrame([(text,)], "c string")
    got = df.select(
        privacy.mask_email("c"), privacy.mask_email_normalised("c"), privacy.mask_phone("c"), privacy.mask_id("c")
    ).first()
    assert tuple(got) == (raw, clean, phone, identity)


def test_hash_ignores_outer_blanks(spark):
    df = spark.createDataFrame([(" a ",), ("a",), (None,)], "c string").select(privacy.hash_pii("c").alias("h"))
    first, second, third = [r["h"] for r in df.collect()]
    assert first == second and len(first) == 64 and third is None


def test_aggregate_builders(spark):
    df = spark.createDataFrame(
        [("S", Decimal("10.00"), 1), ("R", Decimal("4.00"), 2), ("X", Decimal("9.00"), 2), (None, None, 3)],
        "kind string, amount decimal(10,2), id int",
    )
    sale = F.col("kind") == "S"
    row = df.agg(
        agg.count_where(sale), agg.sum_if(sale, "amount"), agg.signed_sum("kind", "amount", "S", "R"),
        agg.count_distinct_if(F.col("kind").isin("R", "X"), "id"), agg.avg_round("amount", 2),
        agg.rate(sale, 4), agg.rate(sale, 2, 100.0),
    ).first()
    assert tuple(row) == (1, Decimal("10.00"), Decimal("6.00"), 1, Decimal("7.67"), 0.25, 25.0)
