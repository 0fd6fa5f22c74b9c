import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import filter_audit
from tallymark.llm.text_trie import TextTrie

LABELS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "quality", "toxic")])
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType())])
SPACE = " \t\n\x0b\f\r"


def fails(text):
    words = [w for w in "".join(" " if c in SPACE else c for c in text).split(" ") if w]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def brute(docs, labels):
    """Every document goes through every order."""
    out = {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, source, text in docs:
        text = text or ""
        failed = fails(text)
        failed["E"] = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, _, t in docs)
        rows.append((doc_id, source or "", {x for x, bad in failed.items() if bad}))
    for part in {p for _, p, _ in rows}:
        mine = [(i, f) for i, p, f in rows if p == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for _, failed in mine:
                first = next((x for x in order if x in failed), None)
                shapley[first] += 1
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                before = set(order[: step - 1])
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(x in f and bool(f & before) for _, f in mine), sum(f == {x} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), shapley[x],
                )
    return out


def got(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def table(spark, docs):
    return spark.createDataFrame(docs, DOCS)


def some(n, seed=3):
    rng = random.Random(seed)
    pool = [None, "", " ", "x", "A b", "#", "wörd " * 250, "same " * 300, " ".join(f"w{i}" for i in range(230)),
            " ".join(f"w{i}" for i in range(230)) + "\x0b", " ".join(f"W{i}" for i in range(230)), "é" * 40 + "A", "\x1fa" * 9]
    return [(rng.choice([None, *range(40), 7, 7]), rng.choice([None, "", "a", "b"]), rng.choice(pool)) for _ in range(n)]


@pytest.mark.parametrize("settings", [{}, {"held_bytes": 0}, {"held_bytes": 500, "limit": 2}, {"limit": 1}])
def test_equals_brute_force(spark, settings):
    """Also with tries emptied at once, every prefix extended and every text dealt to pieces."""
    docs = some(160)
    labels = [(i, i % 2, i % 3 // 2) for i in range(30)] + [(7, 0, 1), (7, None, None), (None, 1, 1)]
    df = table(spark, docs).repartition(5).withColumn("part", F.lit(1)).withColumn("mask", F.lit(2)).withColumn("n", F.lit(3))
    found = got(filter_audit.audit(df, spark.createDataFrame(labels, LABELS), **settings))
    assert found == brute(docs, labels)


def test_order_and_layout_do_not_matter(spark):
    """A text that half of the rows have, and long ones that differ at the end only."""
    long = "the same beginning " * 3000
    docs = [(i, "s", "hot") for i in range(400)] + [(1000 + i, "s", long + str(i % 5)) for i in range(200)] + [(2, "t", long + "0")]
    flags = lambda df, **kw: sorted(map(tuple, filter_audit.failed_filters(df, **kw).collect()))
    want = sorted(
        (i, p, (1 if len(t.split()) < 200 else 0) | (2 if len(t) > 99 else 0) | (16 if any(j < i and u == t for j, _, u in docs) else 0), 1)
        for i, p, t in docs
    )
    df = table(spark, docs)
    assert flags(df) == want
    assert flags(df.repartition(40), limit=8) == want
    assert flags(df.orderBy(F.desc("doc_id")), held_bytes=10, limit=3) == want


def test_hot_text_is_pre_aggregated_and_dealt(spark):
    """One candidate per text and task leaves the first step; a text hot even so goes to several pieces."""
    df = table(spark, [(i, "s", "hot") for i in range(3000)] + [(5000 + i, "s", f"text {i}") for i in range(50)]).repartition(30)
    rows = filter_audit.candidates(df)
    assert rows.filter("text = 'hot'").count() <= 30
    heads = {f"head_{n}": F.substring("text", 1, n) for n in filter_audit.LADDER}
    placed = filter_audit.with_prefixes(rows.withColumns(heads | {"digest": F.xxhash64("text")}), 4)
    assert placed.filter("text = 'hot'").select("piece").distinct().count() > 3
    assert placed.filter("text <> 'hot' AND pieces > 1").isEmpty()


def test_prefixes_grow_where_they_must(spark):
    beginning = "b" * 70
    df = table(spark, [(i, "s", beginning + str(i)) for i in range(100)] + [(500 + i, "s", f"{i:03} other") for i in range(100)])
    rows = filter_audit.candidates(df).withColumns({f"head_{n}": F.substring("text", 1, n) for n in filter_audit.LADDER})
    placed = filter_audit.with_prefixes(rows.withColumn("digest", F.xxhash64("text")), 20)
    lengths = {r["text"][:1] == "b": r["n"] for r in placed.select("text", F.length("prefix").alias("n")).collect()}
    assert lengths[False] == 9 and lengths[True] > 70


def test_trie():
    trie = TextTrie()
    texts = [b"", b"abc", b"abd", b"ab", b"abcdef", b"abc", b"x" * 5000, b"x" * 4999 + b"y"]
    moved = [row for i, t in enumerate(texts) for row in trie.add(t, 100 - i, "p")]
    assert moved == [(99, "p", 1)]
    assert trie.add(b"abc", 200, "q", 3) == [(200, "q", 3)]
    assert trie.add(b"abc", 95, "p") == []
    assert [(t, last.least, last.rows) for t, last in trie.walk()] == sorted(
        [(b"", 100, {"p": 1}), (b"abc", 95, {"p": 2}), (b"abd", 98, {"p": 1}), (b"ab", 97, {"p": 1}), (b"abcdef", 96, {"p": 1}),
         (b"x" * 5000, 94, {"p": 1}), (b"x" * 4999 + b"y", 93, {"p": 1})]
    )
    # Common beginnings are held once.
    assert trie.held == len(b"abc") + len(b"d") + len(b"def") + 5000 + 1


def test_empty_tables(spark):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(table(spark, []), labels).count() == 0
    assert got(filter_audit.audit(table(spark, [(None, None, None)]), labels)) == brute([(None, None, None)], [])
