import hashlib
import random

import numpy as np
import pytest

from tallymark.llm import substring_dedup as s
from tallymark.llm import windows


def brute(docs, width):
    seen = set()
    for doc_id, text in sorted(docs):
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone |= set(range(i, i + width))
            seen.add(window)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        yield doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("block_bytes", [s.BLOCK_BYTES, 1_500])
def test_equals_brute_force(spark, documents, block_bytes):
    rng = random.Random(4)
    passages = [" ".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(6)]
    text = lambda: " ".join(rng.choice([*passages, "x y", "\n", "é Z", "q"]) for _ in range(rng.randrange(0, 14)))
    docs = [(i, text()) for i in range(150)] + [(900, "a " * 3000), (901, None), (902, "")]
    got = s.report(documents(*docs), 5, block_bytes).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, 5))


def test_edges(spark, documents):
    run = " ".join(f"w{i}" for i in range(25))
    df = documents((None, run), (1, run), (1, run), (2, "short"), (3, run + " tail"))
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in s.report(df).collect()}
    assert got == {(None, 25, 0), (1, 25, 25), (2, 1, 0), (3, 26, 25)}
    assert s.report(df).count() == 5
    assert s.report(documents()).count() == 0


def test_factors_name_their_reference(spark, documents):
    a, b = (" ".join(f"{c}{i}" for i in range(22)) for c in "ab")
    rows = {r["doc_id"]: r["factors"] for r in s.factors(documents((1, a), (2, b), (3, f"{a} x {b}"))).collect()}
    assert rows == {1: "", 2: "", 3: "0:22:0,23:22:0"}
    parsed = list(s.parse(np.array([0, 1, 2, 3, 9]), np.array([4, 4, 1, 1, 1]), 5))
    assert parsed == [s.Factor(0, 6, 4), s.Factor(2, 6, 1), s.Factor(9, 5, 1)]


def test_window_hashes():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    values = np.concatenate((values, values))
    hashes = windows.window_hashes(values, 7)
    assert len(hashes) == 94 and (hashes[:44] == hashes[50:]).all() and len(set(hashes.tolist())) == 50
    ordered = np.unique(hashes)
    assert (windows.expand(windows.squeeze(ordered)) == ordered).all()
