"""Language-model scores by a weighted backoff automaton.

The model is a smoothed bigram model of the training documents. As an automaton it has one state per word that was
seen as a context, one for the begin of a text, and the empty state. A state has an arc for each bigram kept in the
model and a failure arc to the empty state; the empty state has an arc for each word:

    arc (h, w):     log10((c(h,w) - D) / c(h) + b(h) * p(w))      for bigrams with c(h,w) >= MIN_COUNT
    failure arc h:  log10(b(h)),  b(h) = (c(h) - sum of the (c(h,w) - D) of its arcs) / c(h)
    empty state:    log10 p(w),   p(w) = (c(w) + 1) / (N + V + 1)

so the weights of a state sum to one with one unknown word. A text is traversed once from left to right: the state
is the last word (the empty state if that was never a context), and the weights on the way add up to the score. The
positions of a block are traversed side by side, since the state only depends on the word before.

The model grows with the corpus, so it is never in one place. Blocks send their distinct bigrams, with training
counts, to the shards of the bigram; a shard adds up the counts, answers each block for the bigrams it asked for, and
credits the mass of each arc to one block that has its context. The distinct words of each block then go with counts
and credits to the shards of the word, which answer with c(w) and the arcs' mass. Each block so receives the part of
the automaton that its documents can reach. A word or bigram that fills a third of the corpus is one entry per block.

Edge cases: a null or empty text is the end token alone; a null doc_id counts as the empty string in the split, so it
trains; repeated rows train and are scored each; without training documents all words are unknown; an empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.blocks import (
    ASK_SCHEMA,
    BLOCK_BYTES,
    FAN,
    Document,
    Keys,
    ask,
    exchange,
    finish,
    into_blocks,
    pack,
    packed,
    shards_of_block,
    unpack,
)
from tallymark.llm.common import drop_finished_shuffles, stage
from tallymark.llm.windows import Words, distinct, expand, joined, mix, planes, read_words, squeeze, stretches

# Marks that no word can be, since words hold no white space.
BEGIN, END = b" begin", b" end"
BEGIN_HASH = np.uint64(xxhash.xxh64_intdigest(BEGIN))
# Bigrams seen less often than this are left to the failure arc: none.
MIN_COUNT = 1
DISCOUNT = 0.75
# Every seventh document by checksum is held out.
FOLDS, HELD_OUT = 7, 2


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


class Read(NamedTuple):
    """A block's tokens: each document is its words and the end mark; ``before`` is the token before each."""

    words: Words
    before: np.ndarray
    weight: np.ndarray


def read(docs: list[Document]) -> Read:
    """Weights are the number of training copies of each token's document."""
    words = read_words([[BEGIN]] + [[*d.text.encode().lower().split(), END] for d in docs])
    # The first document only numbers the begin mark.
    codes, bounds = words.codes[1:], words.bounds[1:] - 1
    before = np.concatenate((np.zeros(1, np.int32), codes))[: len(codes)]
    before[bounds[:-1]] = 0
    copies = np.array([0 if is_held_out(d.id) else d.copies for d in docs], np.int64)
    return Read(words._replace(codes=codes, bounds=bounds), before, np.repeat(copies, np.diff(bounds)))


class Table(NamedTuple):
    """Distinct keys in order, the entry of each position, the training count of each key, and one of its positions."""

    keys: np.ndarray
    of: np.ndarray
    counts: np.ndarray
    first: np.ndarray


def word_table(tokens: Read) -> Table:
    """The words of a block in order of their hashes, by code; the begin mark counts training documents."""
    hashes = tokens.words.hashes
    order = np.argsort(hashes)
    of = np.empty(len(order), np.int64)
    of[order] = np.arange(len(order))
    counts = np.bincount(tokens.words.codes, tokens.weight, len(hashes)).astype(np.int64)
    starts = tokens.words.bounds[:-1]
    counts[0] = tokens.weight[starts].sum() if len(starts) else 0
    return Table(hashes[order], of, counts[order], order)


def bigram_table(tokens: Read) -> Table:
    """Bigrams by 64-bit hashes."""
    hashes = tokens.words.hashes
    mixed = mix(hashes[tokens.before] * np.uint64(0x9FB21C651E98DF25) + hashes[tokens.words.codes])
    found = distinct(mixed)
    counts = np.bincount(found.of, tokens.weight, len(found.keys)).astype(np.int64)
    return Table(found.keys, found.of, counts, found.first)


def bigram_questions(n_shards: int):
    """To each shard its bigrams with their training counts and contexts; and to a place of the block's own its words.

    A context is the rank of its word by number of occurrences in the block, so most of these numbers are small.
    """

    def run(block: int, docs: list[Document]) -> Iterator[tuple[int, Any]]:
        tokens = read(docs)
        words, bigrams = word_table(tokens), bigram_table(tokens)
        by_use = np.argsort(-np.bincount(tokens.before, minlength=len(words.keys)), kind="stable")
        rank = np.empty(len(by_use), np.int64)
        rank[by_use] = np.arange(len(by_use))
        yield own_place(block), (squeeze(words.keys), words.counts, words.of[by_use].astype(np.uint32))
        context = rank[tokens.before[bigrams.first]]
        for shard, part in stretches(bigrams.keys, n_shards):
            yield shard, (squeeze(bigrams.keys[part]), planes(bigrams.counts[part]), planes(context[part]))

    return run


def own_place(block: int) -> int:
    """A shard number that only this block writes to; what it sends there comes back as it is."""
    return -1 - block


def credit_place(shard: int) -> int:
    """Where a block gets the credits from a shard, apart from the counts."""
    return -1_000_000_000 - shard


def owners(asked: list[tuple], keys: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each value, the entry of each of its keys, and whether it stands for that entry: the first value that has an
    entry does, if the node does."""
    free = own.astype(bool)
    for mine in asked:
        entry = np.searchsorted(keys, expand(mine[0]))
        first = free[entry]
        free[entry] = False
        yield entry, first


def union_bigrams(asked: list[tuple]) -> tuple:
    found = distinct(np.concatenate([expand(a[0]) for a in asked]))
    counts = np.bincount(found.of, np.concatenate([joined(a[1]) for a in asked]), len(found.keys))
    return squeeze(found.keys), planes(counts)


def split_columns(value: tuple, n: int, columns) -> Iterator[tuple[int, tuple]]:
    keys = expand(value[0])
    for shard, part in stretches(keys, n):
        yield shard, (squeeze(keys[part]), *columns(value, part))


def split_bigrams(value: tuple, n: int) -> Iterator[tuple[int, tuple]]:
    return split_columns(value, n, lambda v, part: (planes(joined(v[1])[part]),))


def count_bigrams(value: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The corpus count of each bigram (0 if not kept), and that the node stands for all of them."""
    counts = joined(value[1]).astype(np.int64)
    return np.where(counts >= MIN_COUNT, counts, 0), np.ones(len(counts), bool)


def tell_bigrams(asked: list[tuple], value: tuple, answer: tuple) -> Iterator[tuple]:
    counts, own = answer
    for entry, first in owners(asked, expand(value[0]), own):
        yield counts[entry], first


def tell_blocks_bigrams(shard: int, blocks: list[int], asked: list[tuple], value: tuple, answer: tuple) -> Iterator[tuple[int, int, Any]]:
    """To each block: the corpus count of each bigram asked for, and the credits of its contexts."""
    for block, (_, _, context), (counts, first) in zip(blocks, asked, tell_bigrams(asked, value, answer)):
        own = first & (counts > 0)
        contexts, place = np.unique(joined(context)[own], return_inverse=True)
        credit = np.bincount(place, counts[own] - DISCOUNT, len(contexts))
        yield block, shard, planes(counts)
        yield block, credit_place(shard), (planes(contexts), credit)


BIGRAMS = Keys(union_bigrams, split_bigrams, count_bigrams, tell_bigrams, tell_blocks_bigrams)


def word_questions(answers: DataFrame, n_shards: int) -> DataFrame:
    """Rows for the word shards: each block's words, counts and credited mass, from what came back to the block."""

    def run(key, table):
        block = key[0].as_py()
        values = {s.as_py(): unpack(p.as_py()) for s, p in zip(table.column("shard"), table.column("payload"))}
        keys, counts, of_rank = values.pop(own_place(block))
        keys, mass = expand(keys), np.zeros(len(counts))
        for contexts, credit in values.values():
            mass[of_rank[joined(contexts)]] += credit
        parts = stretches(keys, n_shards)
        return packed([(s, block, pack((squeeze(keys[p]), counts[p], mass[p]))) for s, p in parts], ("shard", "block"))

    return answers.filter("shard < 0").groupBy("block").applyInArrow(run, ASK_SCHEMA)


# The block number under which a word shard reports its totals.
TOTALS = -1


def union_words(asked: list[tuple]) -> tuple:
    found = distinct(np.concatenate([expand(a[0]) for a in asked]))
    counts, mass = (np.bincount(found.of, np.concatenate([a[i] for a in asked]), len(found.keys)) for i in (1, 2))
    return squeeze(found.keys), counts.astype(np.int64), mass


def split_words(value: tuple, n: int) -> Iterator[tuple[int, tuple]]:
    return split_columns(value, n, lambda v, part: (v[1][part], v[2][part]))


def tell_words(asked: list[tuple], value: tuple, answer: tuple) -> Iterator[tuple]:
    counts, mass, own = answer
    for entry, first in owners(asked, expand(value[0]), own):
        yield counts[entry], mass[entry], first


def tell_blocks_words(shard: int, blocks: list[int], asked: list[tuple], value: tuple, answer: tuple) -> Iterator[tuple[int, int, Any]]:
    """To each block: count and mass of its words; and the tokens and distinct words that the node stands for."""
    counts, _, own = answer
    words = own.astype(bool) & (expand(value[0]) != BEGIN_HASH)
    yield TOTALS, shard, (int(counts[words].sum()), int((counts[words] > 0).sum()))
    for block, (count, mass, _) in zip(blocks, tell_words(asked, value, answer)):
        yield block, shard, (count, mass)


WORDS = Keys(union_words, split_words, lambda v: (v[1], v[2], np.ones(len(v[1]), bool)), tell_words, tell_blocks_words)


class Automaton(NamedTuple):
    """The part of the automaton that a block can reach: weights of the empty state's arcs by word, of the failure
    arcs by state, and of the other arcs by bigram (nan: no such arc)."""

    empty: np.ndarray
    failure: np.ndarray
    arcs: np.ndarray


def automaton(counts: np.ndarray, mass: np.ndarray, n: int, v: int, pairs: np.ndarray, state: np.ndarray, word: np.ndarray) -> Automaton:
    """``pairs`` are the corpus counts of the bigrams (``state``, ``word``); 0 stands for a bigram without an arc."""
    p = (counts + 1) / (n + v + 1)
    # An arc leaves at least its discount; two bigrams with one hash could credit more than their context has.
    share = np.where(counts > 0, np.maximum(counts - mass, DISCOUNT) / np.maximum(counts, 1), 1.0)
    with np.errstate(divide="ignore"):
        failure = np.log10(share)
    inner = (pairs - DISCOUNT) / np.maximum(counts[state], 1) + share[state] * p[word]
    return Automaton(np.log10(p), failure, np.where(pairs > 0, np.log10(np.where(pairs > 0, inner, 1.0)), np.nan))


def traverse(machine: Automaton, state: np.ndarray, word: np.ndarray, bigram: np.ndarray) -> np.ndarray:
    """The weight on the way from each state over its word: its arc, or the failure arc and the empty state's arc."""
    arc = machine.arcs[bigram]
    return np.where(np.isnan(arc), machine.failure[state] + machine.empty[word], arc)


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """Per row: the split, tokens, known tokens, training tokens, and the log10 probabilities of both models."""
    spark = docs.sparkSession
    blocks = into_blocks(docs, block_bytes, ordered=False)
    n_shards = shards_of_block(blocks.count, fan)
    pairs = stage(exchange(ask(blocks, bigram_questions(n_shards)), blocks.count, BIGRAMS, fan), "bigram-answers")
    word_rows = exchange(word_questions(pairs, n_shards), blocks.count, WORDS, fan)
    drop_finished_shuffles(spark)
    words = stage(word_rows, "word-answers")
    n, v = _totals(words)
    drop_finished_shuffles(spark)
    answers = pairs.filter("shard >= 0").withColumn("kind", F.lit(0)).unionByName(
        words.filter(F.col("block") != TOTALS).withColumn("kind", F.lit(1))
    )

    def work(_: int, held: list[Document], told: dict[Any, Any]) -> Iterator[tuple]:
        tokens = read(held)
        vocabulary, bigrams = word_table(tokens), bigram_table(tokens)
        known = [told[1, s] for s in sorted(s for kind, s in told if kind == 1)]
        counts, mass = (np.concatenate(part) for part in zip(*known))
        kept = np.concatenate([joined(told[0, s]) for s in sorted(s for kind, s in told if kind == 0)])
        word, state = vocabulary.of[tokens.words.codes], vocabulary.of[tokens.before]
        machine = automaton(counts, mass, n, v, kept.astype(np.float64), state[bigrams.first], word[bigrams.first])
        weights = traverse(machine, state, word, bigrams.of)
        begins = tokens.words.bounds[:-1]
        sizes = np.diff(tokens.words.bounds)
        columns = (np.add.reduceat(x, begins) for x in ((counts[word] > 0).astype(np.int64), machine.empty[word], weights))
        for doc, size, n_known, base, score in zip(held, sizes.tolist(), *(c.tolist() for c in columns)):
            yield is_held_out(doc.id), size, n_known, n, base, score

    return finish(blocks, answers, work, SCHEMA)


def _totals(words: DataFrame) -> tuple[int, int]:
    """Training tokens and distinct training tokens; one row of two numbers per shard is added up in Spark."""

    def run(batches):
        for batch in batches:
            values = [unpack(p.as_py()) for p in batch.column("payload")]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in values], pa.int64()) for i in (0, 1)], ["n", "v"])

    row = words.filter(F.col("block") == TOTALS).mapInArrow(run, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return row[0] or 0, row[1] or 0
