import random

import pytest
from pyspark.sql import functions as F

from tallymark.llm import near_dedup as nd
from tallymark.llm.components import components


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute(docs):
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    for i, (doc_id, _) in enumerate(docs):
        c = least.get(find(i))
        yield doc_id, len(sets[i]), c, c is None or doc_id == c


def family(rng, n, size, edits):
    base = [f"b{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(size), rng.randrange(edits + 1)):
            words[at] = f"e{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("limits", [(nd.CELL_MEMBERS, nd.CELL_SHINGLES), (6, 10**6), (10**6, 900)])
def test_equals_brute_force(spark, documents, limits):
    rng = random.Random(8)
    texts = [t for n, size, edits in [(40, 120, 14), (5, 60, 5), (3, 30, 2), (25, 80, 6)] for t in family(rng, n, size, edits)]
    texts += [" ".join(f"r{rng.randrange(500)}" for _ in range(rng.randrange(0, 50))) for _ in range(40)]
    texts += ["One", "one", "two words", "two  WORDS\n", None, "", "\t"] + texts[:3]
    rng.shuffle(texts)
    docs = list(enumerate(texts)) + [(None, texts[0]), (None, "alone without id"), (3, texts[5]), (3, texts[5])]
    # Many collections, so that the candidates of this small test are complete beyond doubt.
    got = nd.report(documents(*docs), limits=limits, rows=2, n=40).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(docs), key=str)


def test_keep_one(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    df = documents((5, text), (3, text + " more"), (3, text + " more"), (None, text), (9, ""), (9, ""), (8, None), (2, "other text here"))
    df = df.withColumn("key", F.lit("k")).withColumn("component", F.lit(1))
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    assert sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=str) == sorted(
        [(3, text + " more"), (9, ""), (9, ""), (8, None), (2, "other text here")], key=str
    )


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 100)] + [(200, 200 + i) for i in range(30)]
    rng.shuffle(chain)
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100} | {200 + i: 200 for i in range(30)}
    assert got == want


def test_empty(spark, documents):
    assert nd.report(documents()).count() == 0
    assert nd.keep_one(documents()).count() == 0
    assert nd.report(documents((1, None))).collect()[0]["kept"]
