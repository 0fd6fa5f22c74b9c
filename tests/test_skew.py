"""Hot keys found in one pass, spread full outer joins, and distinct counts without copies of the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.operators import joins, kpi
from tallymark.plans import banking_gold


@pytest.fixture
def shuffled(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_all_keys_are_read_in_one_pass(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    df = spark.range(0, 4000, 1, 5).select("id", (F.col("id") % 2).alias("a"), F.when(F.col("id") % 3 > 0, F.lit("s")).alias("b"), F.lit(1.5).alias("c"))
    hot = joins.hot_values(df.mapInArrow(count, df.schema), ["a", "b", "c", "id"])
    assert calls.value == 4000
    assert set(hot["a"]) == {0, 1} and set(hot["b"]) == {None, "s"} and set(hot["c"]) == {1.5} and hot["id"] == {}
    # 4000 rows on 8 partitions: pieces of at most half of 500.
    assert hot["a"][0] == 8 and hot["c"][1.5] == 16


def test_sketches_of_many_tasks_and_values(spark):
    """Forty hot values in 400,000 distinct ones, over many tasks: all are found, and nothing that is far from hot."""
    df = spark.range(0, 800_000, 1, 40).select(F.when(F.col("id") % 2 == 0, F.col("id") % 80).otherwise(F.col("id") + 1000).alias("k"))
    total, found = joins.frequent_values(df, ["k"], 2048)
    assert total == 800_000 and {v for v, n in found["k"].items() if n > 5000} == set(range(0, 80, 2))
    assert all(abs(found["k"][v] - 10_000) <= 3.5 * total / 2048 for v in range(0, 80, 2))
    assert set(joins.hot_values(df, ["k"], limit=8000)["k"]) == set(range(0, 80, 2))


def test_values_a_sketch_cannot_track(spark):
    """Binary keys are counted on a sample, next to others that are sketched."""
    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.lit(b"x")).otherwise(F.col("id").cast("string").cast("binary")).alias("k"), "id")
    hot = joins.hot_values(df, ["k", "id"])
    assert set(hot["k"]) == {b"x"} and hot["id"] == {}
    assert joins.hot_values(df.filter("id < 0"), ["id"]) == {"id": {}}


def plain(left, right):
    """By brute force."""
    out, used = Counter(), set()
    for k, s, v in left:
        match = [i for i, (kk, ss, _) in enumerate(right) if (kk, ss) == (k, s)]
        used |= set(match)
        for i in match:
            out[k, s, v, right[i][2]] += 1
        if not match:
            out[k, s, v, None] += 1
    for i, (kk, ss, w) in enumerate(right):
        if i not in used:
            out[kk, ss, None, w] += 1
    return out


@pytest.mark.parametrize("limit", [None, 1, 40, 10**6])
def test_full_outer_with_hot_keys_on_both_sides(spark, shuffled, limit):
    left = [(None, None, i) for i in range(60)] + [(1, "a", i) for i in range(50)] + [(i, "b", i) for i in range(40)] + [(None, "a", 1)] * 3
    right = [(None, None, 7), (1, "a", 8), (1, "a", 9), (None, "b", 1), (5, None, 2)] + [(99, "z", i) for i in range(70)] + [(i, "b", i) for i in range(20, 60)]
    a = spark.createDataFrame(left, "k int, s string, v int")
    b = spark.createDataFrame(right, "kk int, s string, w int")
    got = joins.full_outer_nullsafe(a, b, ["k", "s"], ["kk", "s"], limit=limit)
    assert sorted(got.columns) == ["k", "s", "v", "w"]
    assert Counter(map(tuple, got.select("k", "s", "v", "w").collect())) == plain(left, right)


def test_no_task_of_a_full_outer_join_holds_a_hot_key(spark, shuffled):
    """A third of the rows of each side on one key: no task gets more than twice the rows per partition."""
    n, width = 96_000, 32
    a = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    b = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, -2).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))
    got = joins.full_outer_nullsafe(a, b, ["k"])
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    matched = n // 3 * 2
    assert sum(sizes) == matched + 2 * (n - matched)
    assert max(sizes) <= 2 * n / width
    hot = joins.full_outer_nullsafe(a, b, ["k"], aggregated=True)
    assert max(r["count"] for r in hot.groupBy(F.spark_partition_id().alias("p")).count().collect()) > 10 * n / width


def test_distinct_counts_by_marks(spark, rows):
    data = [(i % 3, None if i % 4 == 0 else i % 5, i % 7 if i % 6 else None, i % 11) for i in range(200)] + [(9, None, None, 1), (None, 1, 2, 3)]
    df = spark.createDataFrame(data, "g int, a int, b int, v int")
    got = kpi.kpis_with_distinct(df, {"na": "a", "nb": "b"}, {"n": F.count(F.lit(1)), "total": F.sum("v")}, {"top": F.max("v")}, ["g"])
    want = df.groupBy("g").agg(F.countDistinct("a").alias("na"), F.countDistinct("b").alias("nb"), F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.max("v").alias("top"))
    columns = ["g", "na", "nb", "n", "total", "top"]
    assert rows(got, *columns) == rows(want, *columns)


def test_daily_transactions_copy_no_rows(spark):
    schema = """transaction_date date, transaction_type string, transaction_channel string, transaction_currency string, account_id string,
        customer_id string, is_successful boolean, transaction_status string, debit_credit_indicator string,
        transaction_amount decimal(18, 2), high_value_txn_flag boolean"""
    summary = banking_gold.daily_transaction_summary(spark.createDataFrame([], schema), "2024-01-01")
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Window" in plan
