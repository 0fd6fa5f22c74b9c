"""Byte-level BPE through a table of distinct words.

Texts are split into words (a run of non-space characters with the white space before it; the tokenizer never joins
characters across the start of such a run). Every block sends its distinct words to the shard of the word, through
a tree of merges (module ``blocks``); a shard encodes each distinct word of the corpus once and answers with its ids. A block then joins the ids back by position.
Decoding joins ids to the pieces of the vocabulary, which is bounded, and concatenates the bytes.

Edge cases: a null or empty text has no ids and decodes to the empty text; special strings inside a text become their
token as the library does it; texts and words of any length are encoded whole; repeated rows give one row each; an
empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from typing import Any, NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from tallymark.llm.blocks import (
    BLOCK_BYTES,
    FAN,
    Blocks,
    Document,
    Keys,
    ask,
    by_shard,
    exchange,
    finish,
    gather,
    into_blocks,
    shards_of_block,
)
from tallymark.llm.token_counts import tokenizer
from tallymark.llm.windows import Codes, shard_of, stretches

# White space of the tokenizer's split pattern.
_WHITE = "\t-\r \x85\xa0  -     　"
# Blocks whose ids are returned hold half the text: words, ids and rows of a block are in a worker's memory at once.
IDS_BLOCK_BYTES = BLOCK_BYTES // 2
WORD = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")


class Pieces(NamedTuple):
    """Bytes of all pieces one after the other, and the start and length of each id's piece."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray


def byte_of_char() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.cache
def pieces(path: str) -> Pieces:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
    to_byte = byte_of_char()
    raw = [bytes(to_byte[c] for c in tokens.get(i, "")) for i in range(max(tokens) + 1)]
    lengths = np.array([len(r) for r in raw], np.int64)
    return Pieces(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lengths) - lengths, lengths)


def decode(ids: np.ndarray, path: str) -> str:
    table = pieces(path)
    data = table.data[gather(table.starts[ids], table.lengths[ids])]
    return data.tobytes().decode("utf-8", "replace")


def encode_words(words: Sequence[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each word, and all ids."""
    lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for at in range(0, len(words), 4_000):
        part = [e.ids for e in tokenizer(path).encode_batch_fast(words[at : at + 4_000], add_special_tokens=False)]
        lengths.append(np.array([len(p) for p in part], np.int64))
        ids.append(np.array([i for p in part for i in p], np.uint32))
    return np.concatenate(lengths), np.concatenate(ids)


class Split(NamedTuple):
    """The words of a block: codes of each document, the rank of each code in order, and the words in order with
    the positions of each shard's words."""

    parts: list[np.ndarray]
    rank: np.ndarray
    words: list[str]
    shards: list[tuple[int, np.ndarray]]


def hashes_of(words: Sequence[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def split(docs: Sequence[Document], n_shards: int) -> Split:
    codes = Codes()
    parts = []
    for doc in docs:
        words = WORD.findall(doc.text)
        parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
    first_seen = list(codes)
    order = sorted(range(len(first_seen)), key=first_seen.__getitem__)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    words = [first_seen[i] for i in order]
    return Split(parts, rank, words, list(by_shard(shard_of(hashes_of(words), n_shards), n_shards)))


def questions(n_shards: int):
    def run(_: int, docs: list[Document]) -> Iterator[tuple[int, list[str]]]:
        found = split(docs, n_shards)
        for shard, at in found.shards:
            yield shard, [found.words[i] for i in at]

    return run


def union(asked: list[list[str]]) -> list[str]:
    """The distinct words in order of their hashes."""
    return sorted(set().union(*asked), key=lambda w: (xxhash.xxh64_intdigest(w), w))


def split_words(words: list[str], n: int) -> Iterator[tuple[int, list[str]]]:
    for shard, part in stretches(hashes_of(words), n):
        yield shard, words[part]


Answer = tuple[np.ndarray, np.ndarray]


def tell(asked: list[list[str]], words: list[str], answer: Answer) -> Iterator[Answer]:
    """The number of ids of each word asked for, and the ids, in the order of the question."""
    lengths, ids = answer[0].astype(np.int64), answer[1]
    number = dict(zip(words, range(len(words))))
    starts = np.cumsum(lengths) - lengths
    for mine in asked:
        at = np.fromiter(map(number.__getitem__, mine), np.int64, len(mine))
        yield lengths[at].astype(np.uint32), ids[gather(starts[at], lengths[at])]


def word_table(path: str) -> Keys:
    """Every distinct word is encoded once, however many blocks have it."""

    def tell_blocks(shard: int, blocks: list[int], asked: list[list[str]], words: list[str], answer: Answer):
        for block, mine in zip(blocks, tell(asked, words, answer)):
            yield block, shard, mine

    return Keys(union, split_words, lambda words: encode_words(words, path), tell, tell_blocks)


def encoded(docs: list[Document], told: dict[int, Any], n_shards: int) -> Iterator[np.ndarray]:
    """The ids of each document, joined by the position of its words."""
    found = split(docs, n_shards)
    lengths, starts = np.zeros(len(found.words), np.int64), np.zeros(len(found.words), np.int64)
    ids, held = [np.zeros(0, np.uint32)], 0
    for shard, at in found.shards:
        sizes, flat = told[shard]
        lengths[at] = sizes
        starts[at] = held + np.cumsum(sizes, dtype=np.int64) - sizes
        ids.append(flat)
        held += len(flat)
    joined = np.concatenate(ids)
    lengths, starts = lengths[found.rank], starts[found.rank]
    for codes in found.parts:
        yield joined[gather(starts[codes], lengths[codes])]


def round_trip(blocks: Blocks, path: str, row, schema: str, fan: int = FAN) -> DataFrame:
    n_shards = shards_of_block(blocks.count, fan)
    answers = exchange(ask(blocks, questions(n_shards)), blocks.count, word_table(path), fan)

    def work(_: int, docs: list[Document], told: dict[int, Any]) -> Iterator[tuple]:
        for ids in encoded(docs, told, n_shards):
            yield row(ids)

    return finish(blocks, answers, work, schema)


REPORT_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def summary(ids: np.ndarray, path: str) -> tuple[int, str, str]:
    text = decode(ids, path).encode()
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()


def report(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """Per row: the number of ids, their digest, and the digest of the text decoded from them."""
    blocks = into_blocks(docs, block_bytes, ordered=False)
    return round_trip(blocks, path, lambda ids: summary(ids, path), REPORT_SCHEMA, fan)


def token_ids(docs: DataFrame, path: str, block_bytes: int = IDS_BLOCK_BYTES) -> DataFrame:
    """As ``report``, with the ids themselves in a column ``ids``."""
    blocks = into_blocks(docs, block_bytes, ordered=False)
    return round_trip(blocks, path, lambda ids: (*summary(ids, path), ids.astype(np.int32)), f"{REPORT_SCHEMA}, ids array<int>")
