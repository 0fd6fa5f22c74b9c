import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import importance_resampling as resampling
from tallymark.llm import word_features

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def runs(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, items, buckets=10_000, min_words=20, percent=5):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in runs(t)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = count(x for _, x in docs), count(items)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        n, features = runs(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(features), weight, score, n >= min_words))
    can = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = percent * len(can) // 100
    drawn = [(*r[:4], i) for i, r in enumerate(can[:k], 1)]
    return sorted(drawn + [(*r[:4], None) for r in can[k:]] + [(*r[:4], None) for r in rows if not r[4]], key=str)


def got(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert all(f.dataType == T.LongType() for f in df.schema)
    return sorted(map(tuple, df.collect()), key=str)


def corpus(n=500, seed=4):
    rng = random.Random(seed)
    word = lambda: rng.choice(["The", "of", "é", "math", "proof", "lemma", "x1", "中文", "q" * 70, "_", "Z"])
    docs = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 19, 20, 21, 60])))) for i in range(n)]
    docs += [(None, docs[3][1] * 9), (7, docs[7][1]), (7, docs[7][1]), (7, "other " * 25), (9999, None)]
    return docs, ["math proof lemma " * 5, "Lemma, proof!", None, ""]


@pytest.mark.parametrize("settings", [{}, {"group": 7, "few": 1}, {"group": 64, "few": 30, "copies": 2}])
def test_equals_brute_force(spark, documents, settings):
    """Also when the cutoff is found in many rounds of small groups."""
    docs, items = corpus()
    df = documents(*docs).repartition(6).withColumn("score", F.lit(1)).withColumn("n_words", F.lit(2)).withColumn("rank", F.lit(3))
    target = spark.createDataFrame(list(enumerate(items)), ITEMS)
    assert got(resampling.resample(df, target, percent=30, **settings)) == brute(docs, items, percent=30)


def test_repeated_rows_and_ties(spark, documents):
    """A third of the rows is one document; equal rows at the cutoff take what is left of the ranks."""
    same = (5, "lemma " * 30)
    docs = [same] * 300 + [(i, "lemma " * 30) for i in range(1000, 1600)]
    target = spark.createDataFrame([(1, "lemma")], ITEMS)
    for percent in (1, 20, 70, 100):
        found = resampling.resample(documents(*docs), target, percent=percent, group=32, few=4, copies=7)
        assert got(found) == brute(docs, ["lemma"], percent=percent)


def test_every_round_discards_a_quarter():
    rng = random.Random(1)
    for _ in range(50):
        groups = [[resampling.Key(rng.randrange(50), 0, rng.randrange(9), 0) for _ in range(rng.randrange(1, 40))] for _ in range(rng.randrange(1, 20))]
        medians = [(sorted(g)[len(g) // 2], len(g)) for g in groups]
        pivot, rows = resampling.weighted_median(medians), [k for g in groups for k in g]
        assert 4 * sum(k <= pivot for k in rows) >= len(rows) - 4 * len(groups)
        assert 4 * sum(k >= pivot for k in rows) >= len(rows)


def test_features_by_column():
    """Words at the edges of texts, long words, and blocks of any length."""
    rng = random.Random(1)
    texts = ["", "a", "Ab cD", "é x y z", "w" * 200 + " " + "q" * 70 + " b " + "z" * 65, "x" * 100_000 + " y", "  ", "1_2-3 ABC"]
    texts += ["".join(rng.choice("aB1 é-\n中") for _ in range(rng.randrange(60))) for _ in range(200)]
    want = sorted(zlib.crc32(f.encode()) for t in texts for f in runs(t)[1])
    column = pa.array([b"not read", *[t.encode() for t in texts]], pa.binary()).slice(1)
    for block in (1, 2, 3, 7, 1 << 18):
        found = []
        for f in word_features.features_of(word_features.words_of(column), block):
            found += [*f.one.tolist(), *f.two[f.has_two].tolist(), *f.three[f.has_three].tolist()]
        assert sorted(found) == want


def test_edges(spark, documents):
    target = spark.createDataFrame([(1, "some words of a target")], ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert got(resampling.resample(documents(), target)) == []
    docs = [(1, None), (2, ""), (None, "a b"), (3, "word " * 40_000), (4, "x" * 300_000)] + [(i, "some words of " * 10) for i in range(10, 40)]
    assert got(resampling.resample(documents(*docs), target)) == brute(docs, ["some words of a target"])
    assert got(resampling.resample(documents(*docs), none, percent=50)) == brute(docs, [], percent=50)
