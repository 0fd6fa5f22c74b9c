import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallymark.llm import decontaminate as d


def brute(docs, items, n):
    items = [("null" if i is None else str(i), d.words_of(t)) for i, t in items]
    grams = [(i, tuple(w[k : k + min(n, len(w))])) for i, w in items if w for k in range(max(1, len(w) - n + 1))]
    for doc_id, text in docs:
        words = d.words_of(text)
        hit, found = set(), set()
        for item, gram in grams:
            for k in range(len(words) - len(gram) + 1):
                if tuple(words[k : k + len(gram)]) == gram:
                    hit |= set(range(k, k + len(gram)))
                    found.add(item)
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield (doc_id, len(words), len(hit), len(found), ids, len(hit) > 0 and 20 * len(hit) >= len(words))


@pytest.mark.parametrize("limit", [d.SHARD_WORDS, 6])
@pytest.mark.parametrize("window", [3, 5])
def test_equals_brute_force(spark, documents, window, limit):
    rng = random.Random(window)
    text = lambda n: "".join(rng.choice(["a", "B", "b", "cd", "é", "ç", "7"]) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(80)] + [(100, None), (101, ""), (None, "a b"), (7, "a b cd")]
    items = [(i, text(rng.randrange(0, 12))) for i in range(12)] + [(3, "a"), (None, "cd a b é"), (20, None), (21, "")]
    items = [x for x in items if x[1] != "a" or window > 3]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = d.report(documents(*docs), bench, window, limit).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(docs, items, window), key=str)


def test_clean_cuts_spans_and_drops_documents(spark, documents):
    item = " ".join(f"w{i}" for i in range(20))
    long = " ".join(f"x{i}" for i in range(900))
    df = documents((1, item), (2, long + ". " + item.upper() + "! " + long), (3, long), (4, None), (4, None), (5, ""))
    df = df.withColumn("mask", F.lit("m")).withColumn("Items", F.lit(1))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = d.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted([(r["doc_id"], r["text"], r["mask"]) for r in kept.collect()], key=str) == sorted(
        [(2, long + ". ! " + long, "m"), (3, long, "m"), (4, None, "m"), (4, None, "m"), (5, "", "m")], key=str
    )


def test_clean_keeps_one_worker_for_each_core(spark, documents):
    """Calls to Python one after the other in a stage run in two workers at once, which stay for later steps."""
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = d.clean(documents((1, "a b"), (2, "a b c")), bench)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.report(documents(), bench).count() == 0
    assert d.report(documents((1, "a b")), bench).collect()[0]["contaminated"] is False
    assert d.clean(documents((1, "a b")), bench).count() == 1
