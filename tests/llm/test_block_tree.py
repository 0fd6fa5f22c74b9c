"""The tree of merges between blocks and shards: results as with one level, and packs in proportion to the blocks."""

import random

import numpy as np
import pytest

from tallymark.llm import blocks, bpe, language_model, substring_dedup
from tallymark.llm.blocks import ANSWER_SCHEMA, ASK_SCHEMA
from tests.llm import test_bpe, test_language_model, test_substring_dedup

FAN = 3


def corpus(n=160):
    rng = random.Random(12)
    passages = [" ".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(6)]
    word = lambda: rng.choice([*passages, "x y", "\n", "é Z", "the", f"w{rng.randrange(900)}"])
    return [(i, " ".join(word() for _ in range(rng.randrange(0, 14)))) for i in range(n)]


EDGES = [(900, "a " * 2000), (901, None), (902, "")]


@pytest.mark.parametrize(
    "n, want", [(1, [1]), (3, [3]), (4, [3, 6]), (9, [3, 9]), (10, [3, 9, 18]), (27, [3, 9, 27]), (28, [3, 9, 27, 54])]
)
def test_levels(n, want):
    assert blocks.ranges_by_level(n, FAN) == want


def test_levels_of_large_corpora():
    assert [len(blocks.ranges_by_level(n)) for n in (256, 257, 65_536, 65_537, 1 << 24)] == [1, 2, 2, 3, 3]
    for n in (257, 3_840, 12_500_000):
        ranges = blocks.ranges_by_level(n)
        assert all(b % a == 0 and b // a <= blocks.FAN for a, b in zip([1, *ranges], ranges))
        assert n <= ranges[-1] < 2 * n


def test_substring_dedup_equals_brute_force(spark, documents):
    docs = corpus() + EDGES
    df = documents(*docs)
    assert blocks.into_blocks(df, 600).count > FAN**3
    got = substring_dedup.report(df, 5, 600, FAN).collect()
    assert sorted(map(tuple, got)) == sorted(test_substring_dedup.brute(docs, 5))


def test_language_model_equals_brute_force(spark, documents):
    docs = corpus() + EDGES + [(None, "the cat"), (7, "again"), (7, "again")]
    got = language_model.scores(documents(*docs), 1_500, FAN).collect()
    want = list(test_language_model.brute(docs))
    key = lambda r: (str(tuple(r)[:5]), round(r[5], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g)[:5] == w[:5]
        assert tuple(g)[5:] == pytest.approx(w[5:], abs=1e-6)


def test_bpe_equals_library(spark, documents):
    docs = corpus(120) + EDGES
    rows = bpe.report(documents(*docs), test_bpe.PATH, 1_000, FAN).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == {i: test_bpe.library(t or "") for i, t in docs}


def test_packs_grow_with_the_blocks_not_their_square(spark, documents, monkeypatch):
    """Every pack between two steps is counted: those that blocks ask with, of all levels, and those of the answers."""
    small = blocks.into_blocks(documents(*corpus(300)), 800)
    large = blocks.into_blocks(documents(*corpus(1_200)), 800)

    def packs(made):
        written = []
        stage = blocks.stage
        monkeypatch.setattr(blocks, "stage", lambda df, label: written.append(stage(df, label)) or written[-1])
        asked = blocks.ask(made, substring_dedup.questions(blocks.shards_of_block(made.count, FAN), 5))
        answers = blocks.exchange(asked, made.count, substring_dedup.EARLIEST, FAN).count()
        monkeypatch.undo()
        return answers, [w.count() for w in written]

    assert large.count > 3 * small.count
    for made in (small, large):
        answers, asked = packs(made)
        assert len(asked) == len(blocks.ranges_by_level(made.count, FAN)) - 1
        # Nodes of a level are at most twice the blocks, and each sends at most FAN packs.
        assert all(n <= 2 * FAN * made.count for n in (answers, *asked))


def test_common_keys_reach_a_node_once_per_child(spark):
    """500 blocks with the same keys: no node of any level joins more than FAN values, each with its keys once."""
    seen = spark.sparkContext.accumulator(0)

    def union(values):
        seen.add(len(values) > FAN)
        return np.unique(np.concatenate(values))

    def split(value, n):
        from tallymark.llm.windows import stretches

        return [(s, value[p]) for s, p in stretches(value, n)]

    def tell(values, value, answer):
        return [(answer[0][np.searchsorted(value, v)],) for v in values]

    def tell_blocks(shard, at, values, value, answer):
        return [(b, shard, a) for b, (a,) in zip(at, tell(values, value, answer))]

    keys = blocks.Keys(union, split, lambda value: (value % np.uint64(1_000),), tell, tell_blocks)
    hashes = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 40, np.uint64))
    first = blocks.shards_of_block(500, FAN)
    rows = [(s, b, blocks.pack(v)) for b in range(500) for s, v in split(hashes, first)]
    answers = blocks.exchange(spark.createDataFrame(rows, ASK_SCHEMA), 500, keys, FAN)
    assert answers.schema.simpleString() == spark.createDataFrame([], ANSWER_SCHEMA).schema.simpleString()
    told = {}
    for r in sorted(answers.collect(), key=lambda r: r["shard"]):
        told.setdefault(r["block"], []).append(blocks.unpack(r["payload"]))
    assert sorted(told) == list(range(500))
    assert all((np.concatenate(v) == hashes % np.uint64(1_000)).all() for v in told.values())
    assert seen.value == 0
