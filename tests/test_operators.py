from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.operators import joins, kpi, registry, textscan, windows
from tallymark.operators import quality as dq


def versions(spark):
    return spark.createDataFrame(
        [
            (1, 10, "ACTIVE", "PASS"), (1, 20, "DELETED", "PASS"),
            (2, 10, "ACTIVE", None), (2, 10, "ACTIVE", "FAIL"),
            (3, None, "ACTIVE", "WARN"), (3, 5, None, "WARN"),
            (4, 1, "ACTIVE", "FAIL"), (None, 1, "ACTIVE", "PASS"),
        ],
        "id int, data_load_ts int, record_status string, data_quality_flag string",
    )


def test_gates(spark, rows):
    df = versions(spark)
    assert dq.drop_deleted(df).count() == 6
    assert rows(dq.dq_gate(df), "id", "data_load_ts") == [(None, 1), (1, 10), (2, 10), (3, None)]


def test_order_of_gate_and_dedupe_matters(spark, rows):
    df = versions(spark)

    def latest(frame):
        return windows.dedupe_latest(frame, ["id"], tie_breakers=["data_quality_flag"])

    after = rows(latest(dq.drop_deleted(df)), "id", "data_load_ts", "data_quality_flag")
    assert after == [(None, 1, "PASS"), (1, 10, "PASS"), (2, 10, "FAIL"), (3, None, "WARN"), (4, 1, "FAIL")]
    before = rows(dq.dq_gate(latest(df)), "id")
    assert before == [(None,)]


def test_dedupe_needs_keys_and_trims_before_the_shuffle(spark):
    with pytest.raises(ValueError):
        windows.dedupe_latest(versions(spark), [])
    plan = windows.dedupe_latest(versions(spark), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_quarantine_splits_without_loss(spark):
    df = versions(spark)
    good, bad = dq.split_quarantine(df, ["id", "data_load_ts"], "2024-01-01")
    assert (good.count(), bad.count()) == (6, 2)
    row = bad.select("quarantine_reason", "quarantine_ts").distinct().collect()
    assert [tuple(r) for r in row] == [("failed_not_null_dq_check", datetime(2024, 1, 1))]
    assert dq.split_quarantine(df, [])[1].isEmpty()


def test_conforming(spark):
    df = spark.createDataFrame(
        [(" a ", -1.0, "", "x@y.z"), ("Q", 0.0, "  ", "x y@z.w"), (None, 100.0, " n", None), ("A", 101.0, None, "x@y")],
        "kind string, score double, note string, email string",
    )
    got = df.select(
        dq.conform_enum("kind", ["A"], dq.UNKNOWN), dq.null_out_of_range("score"), dq.blank_to_null("note"),
        dq.valid_email("email"), dq.positive("score"), dq.set_and_not_zero("score"),
    )
    assert [tuple(r) for r in got.collect()] == [
        ("A", None, None, True, False, True), ("UNKNOWN", 0.0, "", False, False, False),
        ("UNKNOWN", 100.0, "N", None, True, True), ("A", None, None, False, True, True),
    ]


def test_key_violations_row_filter_and_guard(spark, rows):
    df = spark.createDataFrame([(1, "N"), (1, "N"), (2, "S"), (None, None)], "k int, region string")
    assert rows(dq.key_violations(df, ["k"]), "k", "row_count") == [(None, 1), (1, 2)]
    assert dq.row_filter(df, "region", ["S"]).count() == 1
    assert dq.row_filter(df, "region", [], is_global=True).count() == 4
    with pytest.raises(ValueError, match="orders"):
        dq.assert_non_empty(df.filter("k > 5"), "orders")


def expected_ranks(values):
    order = sorted({v for v in values if v is not None}, reverse=True)
    ranks = {v: i + 1 for i, v in enumerate(order)}
    ranks[None] = len(order) + 1
    return sorted(((v, ranks[v]) for v in values), key=lambda r: (r[0] is not None, r))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 40)), max_size=60), st.booleans())
def test_dense_rank_equals_brute_force(spark, rows, shuffled, values, salted):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    ranked = windows.dense_rank_by(df, "v", "r", buckets=4, limit=3 if salted else 10**6)
    assert rows(ranked, "v", "r") == expected_ranks(values)
    assert ranked.columns == ["id", "v", "r"]


def test_ranges_are_cut_over_distinct_values(spark, rows, shuffled):
    """99.5 % of the rows share one value, and still no range holds more than twice its share of the values."""
    df = spark.range(400_000).select(F.when(F.col("id") < 398_000, 7).otherwise(F.col("id")).cast("long").alias("v"))
    values = sorted(r["v"] for r in df.select("v").distinct().collect())
    cuts = windows.range_cuts(df.select("v").distinct(), "v", 16)
    sizes = [sum(a < v <= b for v in values) for a, b in zip([-1, *cuts], [*cuts, 10**9])]
    assert len(sizes) == 16 and max(sizes) <= 2 * len(values) / 16
    ranked = windows.dense_rank_by(df, "v", "r", buckets=16).groupBy("v", "r").count().collect()
    assert sorted((r["v"], r["r"]) for r in ranked) == [(v, len(values) - i) for i, v in enumerate(values)]


def test_rolling_by_rows_and_by_days(spark, rows):
    days = [(1, date(2024, 1, d), v) for d, v in [(1, 1), (1, 2), (2, 4), (9, 8)]] + [(2, date(2024, 1, 1), 5)]
    df = spark.createDataFrame(days, "store int, day date, v int")
    by_rows = windows.rolling_rows(df, ["store"], "day", F.sum("v"), 2, "r")
    assert [r[2] for r in rows(by_rows, "store", "day", "r")] == [3, 7, 12, 5]
    by_days = windows.rolling_days(df, ["store"], "day", F.sum("v"), 7, "r")
    assert [r[2] for r in rows(by_days, "store", "day", "r")] == [3, 7, 8, 5]


def facts(spark):
    data = [(i, 7 if i % 3 else None if i % 2 else i, i % 5) for i in range(300)]
    return spark.createDataFrame(data, "id int, a int, b int")


def sides(spark):
    a = spark.createDataFrame([(i, f"a{i}") for i in range(0, 300, 2)] + [(7, "x"), (7, "y"), (None, "n")], "a int, va string")
    b = spark.createDataFrame([(i, f"b{i}") for i in range(4)], "b int, vb string")
    more = spark.createDataFrame([(i, -i) for i in range(300)], "a int, w int")
    return a, b, more


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, whatever the size of the sides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(params=["shuffled", "broadcast"])
def either(request):
    return request.getfixturevalue("shuffled") if request.param == "shuffled" else None


@pytest.mark.parametrize("hot", [None, {"a": {7: 4, None: 3}, "b": {1: 2}}, {}])
def test_enrich_gives_the_plain_left_join(spark, rows, either, hot):
    df, (a, b, more) = facts(spark), sides(spark)
    plain = df.join(a, "a", "left").join(b, "b", "left").join(more, "a", "left")
    dims = [joins.Dim(a, "a"), joins.Dim(b, "b"), joins.Dim(more, "a", ["w"])]
    got = joins.enrich(df, dims, hot=hot, limit=40)
    columns = ["id", "a", "b", "va", "vb", "w"]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got, *columns) == rows(plain, *columns)


def test_enrich_by_a_key_of_a_side_table(spark, rows, shuffled):
    df, (_, b, more) = facts(spark), sides(spark)
    names = spark.createDataFrame([(i, f"n{i % 3}") for i in range(4)] + [(1, "again")], "code int, label string")
    more = more.withColumn("code", F.col("a") % 5)
    plain = df.join(more, "a", "left").join(names, "code", "left")
    got = joins.enrich(df, [joins.Dim(more, "a"), joins.Dim(names, "code")], limit=40)
    assert rows(got, "id", "w", "code", "label") == rows(plain, "id", "w", "code", "label")


def test_hot_values_are_measured(spark):
    hot = joins.hot_values(facts(spark), ["a", "b"], limit=50)
    assert hot["a"] == {7: 8, None: 2} and set(hot["b"]) == {0, 1, 2, 3, 4}
    assert joins.hot_values(facts(spark), ["a"], limit=1000) == {"a": {}}
    # By default the limit is the rows per shuffle partition, here 300 / 8.
    assert joins.hot_values(facts(spark), ["a"])["a"][7] == 11


def test_every_hot_key_is_found(spark):
    """A thousand keys of the same size, and a hundred among many that occur once."""
    same = spark.range(2_000_000).select((F.col("id") % 1000).alias("k"))
    assert len(joins.hot_values(same, ["k"], limit=1500)["k"]) == 1000
    single = spark.range(2_000_000).select(F.when(F.col("id") < 1_000_000, F.col("id") % 100).otherwise(F.col("id")).alias("k"))
    found = joins.hot_values(single, ["k"], limit=5000)["k"]
    assert set(found) == set(range(100)) and min(found.values()) >= 2


def test_spread_keeps_every_row_and_uses_all_pieces(spark):
    spreaded = joins.spread(facts(spark), "a", {7: 4}, "s")
    pieces = {r["s"]: r["count"] for r in spreaded.filter("a = 7").groupBy("s").count().collect()}
    assert set(pieces) == {0, 1, 2, 3} and sum(pieces.values()) == 200
    assert spreaded.filter("a is null or a <> 7").select("s").distinct().count() == 1


@pytest.mark.parametrize("hot", [None, {"f.a": {7: 4, None: 3}, "m.w": {-7: 2, None: 2}}])
def test_left_chain_gives_the_plain_joins(spark, rows, either, hot):
    df, (a, b, more) = facts(spark), sides(spark)
    # Several matches per key at both levels, and keys without a match or without a value.
    more = more.unionByName(spark.createDataFrame([(7, 2), (7, None), (None, 3), (9, 2)], "a int, w int"))
    b = b.unionByName(spark.createDataFrame([(2, "two"), (-7, "x"), (-7, "y"), (None, "z")], "b int, vb string"))
    steps = [
        joins.Step(a.alias("s"), "f.a", "s.a"),
        joins.Step(more.alias("m"), "f.a", "m.a"),
        joins.Step(b.alias("t"), "m.w", "t.b"),
    ]
    got = joins.left_chain(df, "f", steps, hot=hot, limit=40).select("f.id", "s.va", "m.w", "t.vb")
    plain = df.alias("f").join(a.alias("s"), F.col("f.a") == F.col("s.a"), "left")
    plain = plain.join(more.alias("m"), F.col("f.a") == F.col("m.a"), "left")
    plain = plain.join(b.alias("t"), F.col("m.w") == F.col("t.b"), "left").select("f.id", "s.va", "m.w", "t.vb")
    assert rows(got, "id", "va", "w", "vb") == rows(plain, "id", "va", "w", "vb")


def test_left_chain_carries_little_through_its_shuffles(spark, rows):
    """Small sides come last, and of the others the key that adds the widest rows."""
    df = spark.createDataFrame([(1, 1, 1, 1), (2, None, 2, 3)], "id int, a int, b int, c int")
    little = spark.createDataFrame([(1, "x")], "a int, va string")
    wide = spark.createDataFrame([(1, "y", "z", "w"), (1, "p", "q", "r")], "b int, vb string, wb string, xb string")
    narrow = spark.createDataFrame([(1, 7), (3, 8)], "c int, vc int")
    steps = [
        joins.Step(little.alias("s"), "f.a", "s.a"),
        joins.Step(wide.alias("w"), "f.b", "w.b"),
        joins.Step(narrow.alias("n"), "f.c", "n.c"),
    ]
    got = joins.left_chain(df, "f", steps, hot={}, small=lambda side: "va" in side.columns)
    plan = got._jdf.queryExecution().analyzed().toString()
    order = sorted(("s", "w", "n"), key=lambda name: plan.index(f"SubqueryAlias {name}\n"))
    assert order == ["n", "w", "s"]
    assert rows(got.select("f.id", "s.va", "w.vb", "n.vc"), "id", "va", "vb", "vc") == [
        (1, "x", "p", 7), (1, "x", "y", 7), (2, None, None, 8),
    ]


def test_broadcast_is_decided_by_bytes(spark):
    side = spark.range(100)
    assert joins.is_small(side) and joins.plan_bytes(side) > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(joins.plan_bytes(side) - 1))
    try:
        assert not joins.is_small(side)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_full_outer_matches_null_keys(spark, rows):
    left = spark.createDataFrame([(1, "a", 1), (None, "a", 2), (None, None, 3)], "k int, s string, l int")
    right = spark.createDataFrame([(1, "a", 10), (None, "a", 20), (5, "b", 30), (None, None, 40)], "kk int, s string, r int")
    got = joins.full_outer_nullsafe(left, right, ["k", "s"], ["kk", "s"])
    assert rows(got, "k", "s", "l", "r") == [(None, None, 3, 40), (None, "a", 2, 20), (1, "a", 1, 10), (5, "b", None, 30)]


def test_join_aggregates_fills_defaults(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    totals = spark.createDataFrame([(1, 5, 7)], "k int, n int, m int")
    assert rows(joins.join_aggregates(df, "k", [totals], {"n": 0}), "k", "n", "m") == [(1, 5, 7), (2, 0, None)]


def test_kpi_row_counts_share_and_samples(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "a", None)], "k int, s string, v int")
    row = kpi.kpi_row({"n": df.agg(F.count(F.lit(1))), "total": df.agg(F.sum("v"))}).first()
    assert tuple(row) == (3, 12)
    counts = kpi.flag_counts(df, {"a": F.col("s") == "a", "set": F.col("v").isNotNull()}, {"v": F.sum("v")})
    assert tuple(counts.first()) == (2, 2, 12)
    assert kpi.share(df, F.col("s") == "a").first()[0] == pytest.approx(2 / 3.001)
    assert rows(kpi.min_sample(df, ["k"], 2, {"v": F.sum("v")}), "k", "cnt", "v") == [(2, 1, None)]
    assert kpi.share(df.limit(0), F.col("s") == "a").first()[0] == 0


def test_alert_rollups(spark, rows):
    df = spark.createDataFrame(
        [("d1", "x", 6), ("d1", "y", 5), ("d1", "z", 1), ("d2", "x", 5), (None, "x", 99)], "d string, c string, v int"
    )
    nested = kpi.nested_alert(
        df, "d", "c", ["x", "z", "q"], {"part": F.sum("v")}, {"total": F.sum("part")}, F.col("total") > 10
    )
    assert rows(nested, "d", "c", "total") == [("d1", "x", 12), ("d1", "z", 12)]
    segment = kpi.segment_alert(df, ["d", "c"], {"v": F.sum("v")}, F.col("v") > 4, only={"c": ["x"]})
    assert rows(segment, "d", "c", "v") == [("d1", "x", 6), ("d2", "x", 5)]


def test_top_n_keeps_candidates_per_task(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(20)], "id int, v int")
    best = kpi.top_n(df, [F.desc("v")], 3, ["id"])
    assert [r["id"] for r in best.collect()] == [2, 5, 8]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


def test_scan_patterns_finds_each_kind(spark, rows):
    text = "\n".join(
        [
            "key AK" + "IA" + "X" * 16, "api_key = '" + "k" * 20 + "'", "post" + "gres://user@host/db",
            "ey" + "Jabc.def.ghi", "pass" + "word: hunter", "Bea" + "rer " + "t" * 24, "mail ann@example.com now",
            "+1 555-000-1234", "000-00-0000", "4000 0000 0000 0000", "Server=nowhere;",
        ]
    )
    df = spark.createDataFrame([(1, text), (2, "nothing here"), (3, None), (4, "a@b.co " * 3)], "id int, text string")
    found = textscan.scan_patterns(df, "text", ["id"])
    assert {r[1] for r in rows(found, "id", "pattern", "hits") if r[0] == 1} == set(textscan.PATTERNS)
    assert rows(found.filter("id > 1"), "id", "pattern", "hits") == [(4, "email", 3)]
    matrix = textscan.pattern_matrix(found.withColumn("g", F.when(F.col("id") == 4, "x").otherwise("y")), "g", ["x", "z"])
    assert rows(matrix.filter("pattern = 'email'"), "x", "z") == [(3, 0)]


def test_needed_text_is_part_of_every_match():
    """The plain search may only skip texts that cannot match."""
    import re

    samples = {
        "aws_key": "AKIA" + "A" * 16, "db_url": "mysql://h", "jwt": "eyJa.b.c", "email": "a@b.c",
        "phone": "+15550001234", "ssn": "000-00-0000", "connection_string": "Host = h;",
    }
    assert set(samples) == set(textscan.NEEDED)
    for name, needed in textscan.NEEDED.items():
        assert needed in samples[name] and re.search(textscan.PATTERNS[name], samples[name])
        assert not re.search(textscan.PATTERNS[name], samples[name].replace(needed, ""))


def test_scan_patterns_reads_whole_long_texts(spark):
    df = spark.createDataFrame([(1, "a" * 300_000 + " ann@example.com " + "b" * 300_000)], "id int, text string")
    assert [tuple(r) for r in textscan.scan_patterns(df, "text", ["id"]).collect()] == [(1, "email", 1)]


def test_registry_coverage(spark, rows):
    df = spark.createDataFrame([("r", [1, 2]), ("r", [2]), ("e", []), ("e", None)], "d string, rules array<int>")
    assert rows(registry.coverage(df, "d", "rules", "rule"), "d", "rule", "jobs") == [("r", 1, 1), ("r", 2, 2)]


def test_failing_versions_are_blanked_but_still_win(spark, rows):
    """A failed newest version hides the older one, and its values need not be shuffled."""
    data = [("a", "ACTIVE", "PASS", 1, "x"), ("a", "DELETED", None, 2, "y"), ("b", "ACTIVE", None, 1, "z"), ("c", None, "PASS", 1, "u"), ("d", "ACTIVE", "FAIL", 1, "v")]
    df = spark.createDataFrame(data, "k string, record_status string, data_quality_flag string, t int, `v.1` string")
    blank = dq.blank_failing(df, ["k", "t"])
    assert blank.columns == df.columns
    assert rows(blank, "k", "t", "`v.1`") == [("a", 1, "x"), ("a", 2, None), ("b", 1, "z"), ("c", 1, None), ("d", 1, None)]
    assert rows(dq.dq_gate(windows.dedupe_latest(blank, ["k"], "t")), "k", "`v.1`") == [("b", "z")]
    assert rows(dq.dq_gate(blank), "k", "t", "`v.1`") == rows(dq.dq_gate(df), "k", "t", "`v.1`")
