import random

from pyspark.sql import functions as F

from tallymark.llm import line_dedup
from tallymark.llm.common import SPACE


def brute(docs, t=line_dedup.MIN_RUN):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        raw = text.split("\n")
        seq = [(i, x.strip(SPACE)) for i, x in enumerate(raw) if x.strip(SPACE)]
        gone = set()
        for k in range(len(seq) - t + 1):
            window = tuple(x for _, x in seq[k : k + t])
            if window in seen:
                gone |= {i for i, _ in seq[k : k + t]}
            seen.add(window)
        out[doc_id] = ("\n".join(x for i, x in enumerate(raw) if i not in gone), len(gone))
    return out


def test_equals_brute_force(spark, documents):
    rng = random.Random(5)
    docs = [(i, "\n".join(rng.choice(["a", "b", " a ", "", "c c", "\t"]) for _ in range(rng.randrange(0, 14)))) for i in range(120)]
    docs.append((500, "a\n" * 3000 + "long"))
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup(documents(*docs)).collect()}
    assert got == brute(docs)


def test_edges(spark, documents):
    run = "x\ny\nz"
    df = documents((None, run), (1, run), (1, run), (2, None), (3, ""), (4, "x\ny"), (5, "q\n" + run + "\n\nr"), (5, run + "\n!"))
    df = df.withColumn("lines", F.lit(1)).withColumn("_key", F.lit(2)).withColumn("window", F.lit(3))
    done = line_dedup.dedup(df)
    assert done.columns[: len(df.columns)] == df.columns
    got = sorted([(r["doc_id"], r["text"]) for r in done.collect()], key=str)
    assert got == sorted([(None, run), (1, ""), (1, ""), (2, None), (3, ""), (4, "x\ny"), (5, "q\n\nr"), (5, "!")], key=str)
    assert line_dedup.report(documents()).count() == 0


def test_hot_lines_and_runs_are_spread(spark, documents):
    """Half of all texts share one run, and one line stands everywhere: the result is that of brute force."""
    rng = random.Random(9)
    common = "license\nof many\ntexts"
    docs = [(i, f"{common}\nown {i}" if i % 2 else f"start {i}\nlicense\nend {rng.randrange(4)}\nlicense") for i in range(400)]
    df = documents(*docs).repartition(7)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup(df).collect()}
    assert got == brute(docs)
    hot = line_dedup.hot_values(line_dedup.windows(df), ["fingerprint", "window"])
    assert hot["fingerprint"] and hot["window"]
