import math
import random

import pytest
from pyspark.sql import functions as F

from tallymark.llm import quality_classifier as q

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(tables):
    """The fit sees at most 3000 of the labelled documents; the others are judged."""
    docs, labels = tables
    seen = {r["doc_id"] for r in q.labelled_sample(labels, 3000).collect()}
    assert len(seen) == 3000
    known = {r["doc_id"]: r for r in labels.collect() if r["doc_id"] not in seen}
    rows = [r for r in q.report(docs, labels, 3000).collect() if r["doc_id"] in known]
    right = lambda t: sum((r[t] > 0.5) == bool(known[r["doc_id"]][t]) for r in rows) / len(rows)
    assert right("quality") > 0.97
    assert right("toxic") > 0.95
    clean = [r for r in rows if known[r["doc_id"]]["quality"] and not known[r["doc_id"]]["toxic"]]
    assert sum(r["kept"] for r in clean) / len(clean) > 0.98


def brute(rows):
    """The posteriors by plain loops."""
    out = {}
    clip = lambda p: min(max(p, 1e-4), 1 - 1e-4)

    def strength(sites):
        n, n2 = sum(s[1] for s in sites), sum(s[1] ** 2 for s in sites)
        if n * n <= n2:
            return q.STRENGTH[1]
        spread = sum(s[1] * (s[0] / s[1] - s[2]) ** 2 for s in sites) - sum(s[2] * (1 - s[2]) for s in sites)
        between = spread / (n - n2 / n)
        each = sum(s[2] * (1 - s[2]) for s in sites) / len(sites)
        return q.STRENGTH[1] if between <= 0 else min(max(each / between - 1, q.STRENGTH[0]), q.STRENGTH[1])

    for t in q.TARGETS:
        path, host = {}, {}
        for r in rows:
            for key, table in (((r["host"], r["section"]), path), (r["host"], host)):
                y, n = table.get(key, (0.0, 0))
                table[key] = (y + r[f"{t}_yes"], n + 1)
        rate = clip(sum(y for y, _ in host.values()) / sum(n for _, n in host.values()))
        hs = strength([(y, n, rate) for y, n in host.values()])
        ps = strength([(y, n, clip(host[k[0]][0] / host[k[0]][1])) for k, (y, n) in path.items()])
        for r in rows:
            y, n = host[r["host"]]
            of_host = (y - r[f"{t}_yes"] + hs * rate) / (n - 1 + hs)
            y, n = path[r["host"], r["section"]]
            p = clip((y - r[f"{t}_yes"] + ps * of_host) / (n - 1 + ps))
            out.setdefault(r["doc_id"], {})[t] = 1 / (1 + math.exp(-(math.log(p / (1 - p)) + r[f"{t}_evidence"])))
    return out


def test_site_posteriors_equal_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        h = rng.randrange(6)
        yes = {t: float(rng.random() < (0.1 + 0.15 * h)) for t in q.TARGETS}
        rows.append({"doc_id": i, "host": f"h{h}", "section": f"s{rng.randrange(4) if h else i}", **{f"{t}_yes": yes[t] for t in q.TARGETS}, **{f"{t}_evidence": rng.uniform(-3, 3) for t in q.TARGETS}})
    want = brute(rows)
    for r in q.with_sites(spark.createDataFrame(rows)).collect():
        for t in q.TARGETS:
            assert r[t] == pytest.approx(want[r["doc_id"]][t], abs=1e-9)


def test_sparse_sites_shrink(spark):
    """One bad document of a lone site says less about the site than many bad ones of a large site."""
    row = lambda i, host, yes: {"doc_id": i, "host": host, "section": host, **{f"{t}_yes": yes for t in q.TARGETS}, **{f"{t}_evidence": 0.0 for t in q.TARGETS}}
    rows = [row(i, "good", 1.0) for i in range(200)] + [row(300 + i, "bad", 0.0) for i in range(200)]
    rows += [row(600, "lone", 0.0), row(601, "lone", 0.0)]
    got = {r["doc_id"]: r["quality"] for r in q.with_sites(spark.createDataFrame(rows)).collect()}
    assert got[0] > 0.9 and got[300] < 0.1 and got[300] < got[600] < 0.5


def test_edges(spark, documents):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = documents((1, None), (1, ""), (None, "a b"), (2, "c")).withColumn("lang", F.lit(None).cast("string")).withColumn("host", F.lit(1))
    rows = q.report(df, empty).collect()
    assert len(rows) == 4 and all(r["kept"] and r["quality"] == r["toxic"] == 0.5 for r in rows)
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 0), (None, 1, 1), (7, None, 1)], "doc_id long, quality int, toxic int")
    assert q.report(df, labels).count() == 4
    assert q.report(df.limit(0), labels).count() == 0


@pytest.mark.parametrize("scale", [1, 100])
def test_rare_telling_words_count_at_any_size(spark, scale):
    """Eight toxic documents and no other one with a word tell as much in 10,000 fitted labels as in 100."""
    sides = [f"{t}_{side}" for t in q.TARGETS for side in ("yes", "no")]
    rows = [(-1, 89.0 * scale, 11.0 * scale, 11.0 * scale, 89.0 * scale), (5, 0.0, 0.0, 8.0, 0.0), (6, 0.0, 0.0, 1.0, 0.0)]
    counts = spark.createDataFrame(rows, ["feature", *sides])
    assert set(q.weights(counts, "toxic")) == {5} and q.weights(counts, "quality") == {}


def test_copies_fit_as_one(spark):
    """Copies and near copies share one count, on one side of the split; other texts count in full."""
    rng = random.Random(3)
    words = lambda: [f"w{rng.randrange(10**6)}" for _ in range(200)]
    base = words()
    texts = [" ".join(base)] * 30 + [" ".join([*base[:199], f"z{i}"]) for i in range(10)] + [" ".join(words()) for _ in range(20)]
    texts += ["", "One two", "one two"]
    sample = spark.createDataFrame([(i, t, 1.0, 0.0) for i, t in enumerate(texts)], "doc_id long, text string, quality double, toxic double")
    rows = q.with_copies_once(sample).collect()
    assert len(rows) == len(texts)
    copies = [r for r in rows if base[0] in r["text"]]
    assert sum(r["share"] for r in copies) == pytest.approx(1, abs=1e-4) and len({r["fits"] for r in copies}) == 1
    others = [r["share"] for r in rows if base[0] not in r["text"] and r["text"].lower() != "one two"]
    assert others == [1.0] * 21 and [r["share"] for r in rows if r["text"].lower() == "one two"] == [0.5, 0.5]
