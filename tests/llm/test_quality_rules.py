import random
import re

import pytest
from pyspark.sql import functions as F

from tallymark.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force(spark, documents):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a ", "b ", "é\n", "##", "| ", "\t", "w\x0b"]) for _ in range(rng.randrange(0, 80))) for _ in range(150)]
    texts += [None, "", " \n", " ", "a b c d e a b c d e", "same " * 2000]
    rows = q.report(documents(*enumerate(texts))).orderBy("doc_id").collect()
    for text, row in zip(texts, rows, strict=True):
        want = brute(text) if text != "same " * 2000 else (2000, 8000, 0, 0, 2000)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        assert row["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (row["base_failed"] and row["kept"])


def test_order_does_not_change_the_verdict(spark, documents):
    good = "The committee met on Tuesday and agreed that the bridge should be repaired before the winter sets in."
    texts = [good, "too short", "### $$$ ||| *** " * 9, good + "\nx" * 30, "1 2 3 4 5 6 7 8 9 10 11", good.upper(), None]
    df = documents(*enumerate(texts)).withColumn("words", F.lit("w")).withColumn("_rejected_by", F.lit(0))
    rules = q.rules(F.col("text"))
    kept = {r["doc_id"] for r in q.keep_good(df).collect()}
    assert kept == {0}
    assert q.keep_good(df).columns == df.columns
    for order in (list(rules), list(rules)[::-1]):
        found = df.withColumn("v", q.cascade(rules, order)).filter("v is null").collect()
        assert {r["doc_id"] for r in found} == kept
    assert q.cascade_order({"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (9.0, 0.0)}) == ["b", "a", "c"]


def test_short_circuit(spark, documents):
    """A later rule is not evaluated for a text that an earlier one rejects."""
    df = documents((1, "boom"))
    fails = {"first": F.col("text") == "boom", "second": F.raise_error(F.lit("evaluated")).cast("boolean")}
    assert df.select(q.cascade(fails, ["first", "second"]).alias("v")).first()["v"] == "first"
    with pytest.raises(Exception, match="evaluated"):
        df.select(q.cascade(fails, ["second", "first"]).alias("v")).collect()


def test_empty_table(spark, documents):
    assert q.report(documents()).count() == 0
    assert q.keep_good(documents()).count() == 0
