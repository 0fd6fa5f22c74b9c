"""Substring dedup by relative Lempel-Ziv parsing.

The corpus is its own reference, cut into blocks in document order. The index of a reference block are the hashes of
its windows of ``WIDTH`` words. A document is parsed greedily against all indexed blocks: at each place the index
tells the earliest block that holds the next ``WIDTH`` words; a factor starts there and is extended while the words
keep occurring earlier in the same reference. A factor has at least ``WIDTH`` words. Where one factor ends and the
next begins, the windows across the boundary are looked up as well, so a repeat that is put together from two
references is found too. The words of all factors are the duplicate spans.

Looking up means a round trip of the block's distinct windows through the index, a tree of merges (module ``blocks``), so a
passage that fills a third of the corpus is asked for once per block. Within its own block a window is a repeat from
its second place on. Windows are judged on the input, not on what is left.

Windows are compared by 64-bit hashes of the words' 64-bit hashes (a false match between two given windows has a
chance of about 2**-58).

Edge cases: a null or empty text, or one with fewer words than a window, loses nothing; null ids come first in the
order of documents; texts that share an id are ordered by their hashes; fully equal rows are one document and are
treated alike; an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from tallymark.llm.blocks import (
    BLOCK_BYTES,
    FAN,
    Blocks,
    Document,
    Keys,
    ask,
    exchange,
    finish,
    into_blocks,
    shards_of_block,
)
from tallymark.llm.windows import Words, distinct, expand, inside, read_words, squeeze, stretches, window_hashes

WIDTH = 20


class Index(NamedTuple):
    """Windows of a block: the places where they start, their distinct hashes in order, which of these each place
    has, and the first place of each."""

    starts: np.ndarray
    keys: np.ndarray
    of: np.ndarray
    first: np.ndarray


def index(words: Words, width: int) -> Index:
    starts = np.flatnonzero(inside(words.bounds, width))
    hashes = window_hashes(words.hashes[words.codes], width)[starts]
    return Index(starts, *distinct(hashes))


def block_words(docs: list[Document]) -> Words:
    return read_words(d.text.encode().split() for d in docs)


class Windows(NamedTuple):
    """Distinct window hashes, squeezed, and the earliest block that has each."""

    keys: np.ndarray
    block: np.ndarray


def questions(n_shards: int, width: int):
    def run(block: int, docs: list[Document]) -> Iterator[tuple[int, Windows]]:
        keys = index(block_words(docs), width).keys
        for shard, part in stretches(keys, n_shards):
            yield shard, Windows(squeeze(keys[part]), np.full(part.stop - part.start, block, np.int32))

    return run


def union(asked: list[Windows]) -> Windows:
    hashes, blocks = np.concatenate([expand(w.keys) for w in asked]), np.concatenate([w.block for w in asked])
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return Windows(squeeze(ordered[starts]), np.minimum.reduceat(blocks[order], starts))


def split(windows: Windows, n: int) -> Iterator[tuple[int, Windows]]:
    keys = expand(windows.keys)
    for shard, part in stretches(keys, n):
        yield shard, Windows(squeeze(keys[part]), windows.block[part])


def tell(asked: list[Windows], windows: Windows, answer: tuple[np.ndarray]) -> Iterator[tuple[np.ndarray]]:
    """For each window asked for, the earliest block that has it."""
    keys = expand(windows.keys)
    for mine in asked:
        yield (answer[0][np.searchsorted(keys, expand(mine.keys))],)


def tell_blocks(shard: int, blocks: list[int], asked: list[Windows], windows: Windows, answer: tuple[np.ndarray]):
    for block, (mine,) in zip(blocks, tell(asked, windows, answer)):
        yield block, shard, mine


EARLIEST = Keys(union, split, lambda windows: (windows.block,), tell, tell_blocks)


class Factor(NamedTuple):
    """A duplicate span: its first word, its number of words, and the reference block it was found in."""

    start: int
    n_words: int
    block: int


def parse(starts: np.ndarray, source: np.ndarray, width: int) -> Iterator[Factor]:
    """Greedy factors from the starts (ascending) of repeated windows and the block that holds each."""
    if not len(starts):
        return
    new = np.flatnonzero(np.concatenate(([True], (np.diff(starts) != 1) | (np.diff(source) != 0))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    for a, b in zip(new, last):
        yield Factor(int(starts[a]), int(starts[b] - starts[a]) + width, int(source[a]))


def repeated(found: Index, told: dict[int, Any], block: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that occur earlier, and the earliest block of each."""
    source = np.concatenate([np.zeros(0, np.int32), *(told[s] for s in sorted(told))])[found.of]
    # A window that no earlier block has is new at its first place in this one.
    later = (source < block) | (np.arange(len(found.of)) != found.first[found.of])
    return found.starts[later], source[later]


def factors_of(block: int, docs: list[Document], told: dict[int, Any], width: int) -> tuple[Words, list[list[Factor]]]:
    """The block's words and the factors of each document, starts counted within the document."""
    words = block_words(docs)
    starts, source = repeated(index(words, width), told, block)
    edges = np.searchsorted(starts, words.bounds)
    parsed = [
        list(parse(starts[a:b] - base, source[a:b], width)) for a, b, base in zip(edges, edges[1:], words.bounds)
    ]
    return words, parsed


def lookup(blocks: Blocks, width: int, fan: int = FAN) -> DataFrame:
    asked = ask(blocks, questions(shards_of_block(blocks.count, fan), width))
    return exchange(asked, blocks.count, EARLIEST, fan)


def factors(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row, its factors as ``start:words:block`` joined by commas."""
    blocks = into_blocks(docs, block_bytes)

    def work(block: int, held: list[Document], told: dict[int, Any]) -> Iterator[tuple]:
        for found in factors_of(block, held, told, width)[1]:
            yield (",".join(f"{f.start}:{f.n_words}:{f.block}" for f in found),)

    return finish(blocks, lookup(blocks, width), work, "doc_id long, factors string")


def report(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """Per row: words, words removed, and the digest of the words that stay, joined by one space."""
    blocks = into_blocks(docs, block_bytes)

    def work(block: int, held: list[Document], told: dict[int, Any]) -> Iterator[tuple]:
        words, parsed = factors_of(block, held, told, width)
        for begin, end, found in zip(words.bounds, words.bounds[1:], parsed):
            codes, n_removed = words.codes[begin:end], 0
            if found:
                change = np.zeros(len(codes) + 1, np.int64)
                np.add.at(change, [f.start for f in found], 1)
                np.add.at(change, [f.start + f.n_words for f in found], -1)
                gone = np.cumsum(change[:-1]) > 0
                codes, n_removed = codes[~gone], int(gone.sum())
            kept = b" ".join(map(words.vocabulary.__getitem__, codes.tolist()))
            yield int(end - begin), n_removed, hashlib.sha256(kept).hexdigest()

    return finish(blocks, lookup(blocks, width, fan), work, "doc_id long, n_words long, n_removed long, kept_sha256 string")
