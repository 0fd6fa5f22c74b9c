import hashlib

import numpy as np
import pytest

from tallymark.llm import bpe
from tallymark.llm.queries import tokenizer_file
from tests.llm.test_token_counts import strange_texts

PATH = tokenizer_file("byte_bpe_50k.json")


def library(text):
    t = bpe.tokenizer(PATH)
    ids = t.encode(text, add_special_tokens=False).ids
    decoded = t.decode(ids, skip_special_tokens=False)
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [bpe.BLOCK_BYTES, 2_000])
def test_equals_library(spark, documents, block_bytes):
    texts = strange_texts() + ["a  b", "x    y", "end  ", "<|endoftext|>", "a  <|endoftext|> b<|endoftext|>", "it's we'll 12ab", "\n\n x"]
    rows = bpe.report(documents(*enumerate(texts)), PATH, block_bytes).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == {i: library(t) for i, t in enumerate(texts)}


def test_edges(spark, documents):
    rows = bpe.report(documents((1, None), (None, "a b"), (2, "c"), (2, "c"), (2, "d")), PATH, 100).collect()
    assert sorted(tuple(r) for r in rows if r["doc_id"]) == sorted([(1, *library("")), (2, *library("c")), (2, *library("c")), (2, *library("d"))])
    assert len(rows) == 5
    assert bpe.report(documents(), PATH).count() == 0


def test_ids_come_from_blocks_of_half_the_size(spark, documents, monkeypatch):
    seen, whole = [], bpe.into_blocks
    monkeypatch.setattr(bpe, "into_blocks", lambda docs, size, ordered: seen.append(size) or whole(docs, size, ordered=ordered))
    rows = bpe.token_ids(documents((1, "a b  c"), (2, "it's")), PATH).collect()
    assert seen == [bpe.BLOCK_BYTES // 2]
    assert {r["doc_id"]: tuple(r)[1:4] for r in rows} == {1: library("a b  c"), 2: library("it's")}
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
