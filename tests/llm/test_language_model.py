import math
import random
from collections import Counter

import numpy as np
import pytest

from tallymark.llm import language_model as lm


def brute(docs):
    tokens = lambda t: [*(t or "").encode().lower().split(), lm.END]
    train = [tokens(t) for i, t in docs if not lm.is_held_out(i)]
    c = Counter(w for ws in train for w in ws)
    pairs = Counter(p for ws in train for p in zip([lm.BEGIN, *ws], ws))
    n, v = sum(c.values()), len(c)
    context = c + Counter({lm.BEGIN: len(train)})
    arcs = {p: k for p, k in pairs.items() if k >= lm.MIN_COUNT}
    mass = Counter()
    for (h, _), k in arcs.items():
        mass[h] += k - lm.DISCOUNT
    unigram = lambda w: (c[w] + 1) / (n + v + 1)
    back = lambda h: (context[h] - mass[h]) / context[h] if context[h] else 1.0
    p = lambda h, w: ((arcs[h, w] - lm.DISCOUNT) / context[h] if (h, w) in arcs else 0) + back(h) * unigram(w)
    known = [w for w in c]
    for h in [lm.BEGIN, *known[:5], b"never"]:
        assert sum(p(h, w) for w in known) + back(h) * unigram(b"unknown") == pytest.approx(1)
    for i, t in docs:
        ws = tokens(t)
        yield (
            i, lm.is_held_out(i), len(ws), sum(c[w] > 0 for w in ws), n,
            sum(math.log10(unigram(w)) for w in ws), sum(math.log10(p(h, w)) for h, w in zip([lm.BEGIN, *ws], ws)),
        )


@pytest.mark.parametrize("block_bytes", [lm.BLOCK_BYTES, 1_200])
def test_equals_brute_force(spark, documents, block_bytes):
    rng = random.Random(6)
    text = lambda: " ".join(rng.choice(["the", "The", "cat", "sat", "é", "on", "a", f"w{rng.randrange(60)}", "\n"]) for _ in range(rng.randrange(0, 40)))
    docs = [(i, text()) for i in range(140)] + [(None, "the cat"), (500, None), (501, ""), (7, "again"), (7, "again"), (502, "the " * 4000)]
    got = sorted(lm.scores(documents(*docs), block_bytes).collect(), key=str)
    want = sorted(brute(docs), key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: str(tuple(r)[:5])), sorted(want, key=lambda r: str(r[:5]))):
        assert tuple(g)[:5] == w[:5]
    key = lambda r: (str(tuple(r)[:5]), round(r[5], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g)[5:] == pytest.approx(w[5:], abs=1e-6)


def test_empty_and_untrained(spark, documents):
    assert lm.scores(documents()).count() == 0
    held = next(i for i in range(100) if lm.is_held_out(i))
    row = lm.scores(documents((held, "a b"))).collect()[0]
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert row["score"] == row["base_score"] == 0.0


def test_held_out_text_is_better_predicted_than_by_words_alone(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.scores(df).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_bigrams_are_told_apart_by_all_bits():
    docs = [lm.Document(True, 1, 0, " ".join(f"w{i}" for i in range(100)), 1)]
    keys = lm.bigram_table(lm.read(docs)).keys
    assert len(keys) == 101 and (keys & np.uint64(0xFFF)).any()


def test_no_score_is_nan_if_two_bigrams_share_a_hash():
    """Two bigrams seen once with one hash credit 1.25 to a context seen once."""
    one, none = np.array([1.0]), np.array([0])
    machine = lm.automaton(one, np.array([1.25]), 5, 3, np.array([2.0]), none, none)
    assert np.isfinite([machine.empty[0], machine.failure[0], machine.arcs[0]]).all()
