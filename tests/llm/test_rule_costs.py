"""Costs of rules are those of the rules, not of the session's start or of starting a job."""

from pyspark.sql import functions as F

from tallymark.llm import quality_rules as q


def test_costs_do_not_depend_on_which_rule_is_first(spark):
    """The one rule that sorts windows is the dearest in each run, wherever it stands; useless rules come last."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    rules = q.rules(F.col("text"))
    for names in (list(rules), list(rules)[::-1]):
        measured = q.measure(docs, {n: rules[n] for n in names})
        assert max(measured, key=lambda n: measured[n][0]) == "repeated_words"
        order = q.cascade_order(measured)
        useless = {n for n in names if measured[n][1] == 0}
        assert set(order[len(order) - len(useless) :]) == useless


def test_cost_follows_the_work(spark, documents):
    """One and sixteen times the same work, the cheap rule last and first."""
    df = documents(*((i, f"some words of a text {i} " * 40) for i in range(200)))
    rounds = lambda n: sum((F.length(F.regexp_replace("text", f"[aeiou]{i}", "")) for i in range(n)), F.lit(0)) < 0
    for names in (("once", "often"), ("often", "once")):
        rules = {name: rounds({"once": 1, "often": 16}[name]) for name in names}
        cost = {name: c for name, (c, _) in q.measure(df, rules).items()}
        assert 5 * cost["once"] < cost["often"]


def test_shares_are_of_the_sample(spark, documents):
    df = documents(*((i, "x" * (i % 4)) for i in range(40)), (99, None))
    measured = q.measure(df, {"none": F.lit(False), "empty": F.length("text") == 0, "all": F.lit(True)})
    assert [round(measured[n][1] * 41) for n in ("none", "empty", "all")] == [0, 11, 41]
    assert all(c > 0 for c, _ in measured.values())
