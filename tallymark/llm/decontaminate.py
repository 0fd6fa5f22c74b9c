"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items form one automaton whose states are the sets of places where a word sequence
occurs. Every document is read once from left to right; the automaton gives the length of the longest suffix of the
words read so far that occurs in an item. A word is hit if it lies inside an occurrence of a window: ``window``
consecutive words of an item, or a whole item that is shorter. A document is contaminated if hit words reach the
coverage limit; cleaning drops such documents and cuts the remaining hits of full windows out of the others.

Documents are never shuffled. The items are dealt to shards of at most ``SHARD_WORDS`` words by Spark and written to the
shared folder; the driver and the plan know only the names of the shards, and a task loads one shard at a time by its
path. With more than one shard, a task matches ``HELD_BYTES`` of documents at a time with one after the other, so a
shard's automaton is built once per that many bytes, and no task holds more than one or two of them. An item longer than
a shard is cut into pieces that overlap by a window less one word.

Edge cases: null and empty texts have no words and are clean; an item without words matches nothing; an item with a
null id is reported as "null"; items that repeat an id count once; repeated rows are judged one by one; with an empty
benchmark every document is clean; other columns are carried through untouched, whatever their names.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import in_batches, scratch_path, stage

WINDOW = 13
# Hit words times this reach the number of words: contaminated.
COVERAGE = 20
SHARD_WORDS = 150_000
# Items are dealt to groups of about this many shards, which are filled one after the other.
SHARDS_PER_GROUP = 8
HELD_BYTES = 32 << 20
# After lower-casing A-Z, words are runs of digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

Item = tuple[str, tuple[bytes, ...]]


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


class Automaton:
    """Generalised suffix automaton of word sequences; state 0 is the empty sequence."""

    def __init__(self, items: Sequence[Item], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        n = len(self.next)
        self.items: list[set[str]] = [set() for _ in range(n)]
        # Lengths and ids of the short items that end in a state.
        self.whole: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        for number, (name, words) in enumerate(items):
            self._mark(name, words)
        # The smallest match length that completes a window, by state.
        self.alert = [window if size >= window else 1 << 30 for size in self.length]
        for state in sorted(range(1, n), key=self.length.__getitem__):
            short = min((m for m, _ in self.whole[state]), default=1 << 30)
            up = self.alert[self.link[state]]
            self.alert[state] = min(self.alert[state], short, up)
        self.told: dict[tuple[int, int], tuple[int, frozenset[str]]] = {}

    def _state(self, length: int, arcs: dict[bytes, int], link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes) -> int:
        """The state of exactly one word more than ``p``, cut off from the one its arc leads to."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word)
        return new

    def _mark(self, name: str, words: tuple[bytes, ...]) -> None:
        """Note the item at every state of one of its sequences of ``window`` words, or at the whole item."""
        state = 0
        for word in words:
            state = self.next[state][word]
            if len(words) < self.window:
                continue
            at = state
            while at > 0 and self.length[self.link[at]] >= self.window:
                at = self.link[at]
            if self.length[at] >= self.window:
                self.items[at].add(name)
        if 0 < len(words) < self.window:
            self.whole[state].append((len(words), name))

    def tell(self, state: int, length: int) -> tuple[int, frozenset[str]]:
        """Words covered, and items, of the windows that end with a match of this length in this state."""
        key = (state, min(length, self.window))
        if key not in self.told:
            names: set[str] = set()
            longest, at = 0, state
            while at > 0:
                if length >= self.window and self.length[at] >= self.window > self.length[self.link[at]]:
                    names |= self.items[at]
                    longest = self.window
                for m, name in self.whole[at]:
                    if m <= length:
                        names.add(name)
                        longest = max(longest, m)
                at = self.link[at]
            self.told[key] = longest, frozenset(names)
        return self.told[key]

    def scan(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit ranges (begin, end) in order of their ends, and the items."""
        follow, link, size, alert = self.next, self.link, self.length, self.alert
        ranges: list[tuple[int, int]] = []
        names: set[str] = set()
        state = matched = 0
        for i, word in enumerate(words):
            to = follow[state].get(word)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = follow[state].get(word)
                matched = size[state]
                if to is None:
                    continue
            state = to
            matched += 1
            if matched >= alert[state]:
                longest, found = self.tell(state, matched)
                if longest:
                    ranges.append((i + 1 - longest, i + 1))
                    names |= found
        return ranges, names


class Shards(NamedTuple):
    """A folder that all executors share, and the names of the shards in it."""

    path: str
    names: list[str]


@functools.lru_cache(maxsize=2)
def automaton(path: str, shard: str, window: int) -> Automaton:
    """The automaton of a written shard."""
    files, folder = FileSystem.from_uri(re.sub("^file:/+", "/", path))
    table = pq.read_table(f"{folder}/shard={shard}", columns=["name", "words"], filesystem=files)
    rows = sorted(zip(table.column("name").to_pylist(), table.column("words").to_pylist()))
    return Automaton([(name, tuple(words.split())) for name, words in rows], window)


def pieces(benchmark: DataFrame, window: int, limit: int) -> DataFrame:
    """Distinct rows (name, words, n): the items, long ones in pieces of at most ``limit`` words."""

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1), limit - window + 1):
                    piece = words[at : at + limit]
                    if piece:
                        rows.append((name, b" ".join(piece), len(piece)))
            columns = zip(*rows) if rows else ((), (), ())
            types = (pa.string(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["name", "words", "n"])

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), "text")
    return in_batches(named).mapInArrow(run, "name string, words binary, n long").distinct()


def shards(benchmark: DataFrame, window: int = WINDOW, limit: int = SHARD_WORDS) -> Shards:
    """The items, written in shards of at most ``limit`` words."""
    limit = max(limit, 2 * window)
    spark = benchmark.sparkSession
    found = stage(pieces(benchmark, window, limit), "benchmark-pieces")
    groups = max(1, math.ceil((found.agg(F.sum("n")).first()[0] or 0) / (SHARDS_PER_GROUP * limit)))

    def fill(key, table):
        table = table.sort_by([("name", "ascending"), ("words", "ascending")])
        names, number, held = [], 0, 0
        for n in table.column("n").to_pylist():
            if held + n > limit and held:
                number, held = number + 1, 0
            held += n
            names.append(f"{key[0].as_py()}x{number}")
        return pa.table({"name": table.column("name"), "words": table.column("words"), "shard": pa.array(names, pa.string())})

    group = F.pmod(F.xxhash64("name", "words"), F.lit(groups)).alias("group")
    filled = found.groupBy(group).applyInArrow(fill, "name string, words binary, shard string")
    path = scratch_path(spark, "benchmark-shards")
    filled.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    written = spark.read.schema("name string, words binary, shard string").parquet(path)
    return Shards(path, sorted(r["shard"] for r in written.select("shard").distinct().collect()))


class Names(NamedTuple):
    """Columns that the matcher adds: bit mask of hit words, items found, words, hit words."""

    mask: str = "mask"
    items: str = "items"
    n_words: str = "n_words"
    n_hit: str = "n_hit"


class Found:
    """Bit masks of hit words, items found, words and hit words of each text of a batch."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        self.masks: list[bytes | None] = [None] * len(texts)
        self.items: list[list[str]] = [[]] * len(texts)
        self.n_words, self.n_hit = [0] * len(texts), [0] * len(texts)

    def count(self) -> None:
        self.n_words = [len(words_of(text.as_py())) for text in self.texts]

    def scan(self, machine: Automaton) -> None:
        """Sets the bits of the words that the shard's windows hit, and adds the items found."""
        for i, text in enumerate(self.texts):
            words = words_of(text.as_py())
            self.n_words[i] = len(words)
            ranges, names = machine.scan(words)
            if ranges:
                bits = np.zeros(len(words), np.uint8)
                if self.masks[i]:
                    bits = np.unpackbits(np.frombuffer(self.masks[i], np.uint8), count=len(words))
                for begin, end in ranges:
                    bits[begin:end] = 1
                self.masks[i], self.n_hit[i] = np.packbits(bits).tobytes(), int(bits.sum())
                self.items[i] = sorted({*self.items[i], *names})


def held_together(batches: Iterable[pa.RecordBatch], limit: int = HELD_BYTES) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _matched(items: Shards, window: int, finish: Callable[[pa.RecordBatch, Found], pa.RecordBatch]):
    """What ``finish`` makes of each batch and what all shards found in it."""

    def run(batches: Iterable[pa.RecordBatch]):
        for held in held_together(batches):
            found = [Found(batch.column("text")) for batch in held]
            for shard in items.names:
                machine = automaton(items.path, shard, window)
                for part in found:
                    part.scan(machine)
            for batch, part in zip(held, found):
                if not items.names:
                    part.count()
                yield finish(batch, part)

    return run


def _matcher(items: Shards, window: int, to: Names):
    """The rows with the columns of ``to``, after all shards."""

    def add(batch: pa.RecordBatch, part: Found) -> pa.RecordBatch:
        columns = {n: batch.column(n) for n in batch.schema.names}
        columns |= {to.mask: pa.array(part.masks, pa.binary()), to.items: pa.array(part.items, pa.list_(pa.string()))}
        columns |= {to.n_words: pa.array(part.n_words, pa.int64()), to.n_hit: pa.array(part.n_hit, pa.int64())}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return _matched(items, window, add)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, to: Names = Names(), window: int = WINDOW, limit: int = SHARD_WORDS
) -> DataFrame:
    """All rows and columns, and those of ``to``."""
    zero = F.lit(0).cast("long")
    empty = {to.mask: F.lit(None).cast("binary"), to.items: F.array().cast("array<string>"), to.n_words: zero, to.n_hit: zero}
    out = docs.withColumns(empty)
    return in_batches(docs).mapInArrow(_matcher(shards(benchmark, window, limit), window, to), out.schema)


def is_contaminated(n_hit: str, n_words: str) -> Column:
    return (F.col(n_hit) > 0) & (COVERAGE * F.col(n_hit) >= F.col(n_words))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = SHARD_WORDS) -> DataFrame:
    """Per row: words, words hit, items found with their digest, and the verdict."""
    hits = find_hits(docs.select("doc_id", "text"), benchmark, Names(), window, limit)
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated("n_hit", "n_words").alias("contaminated"),
    )


def cut(text: str, mask: bytes, window: int) -> str:
    """The text without its runs of at least ``window`` hit words and what lies between their words."""
    raw = text.encode()
    spans = [m.span() for m in WORD.finditer(raw.lower())]
    bits = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(spans))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], bits, [0]))))
    kept, at = [], 0
    for begin, end in zip(edges[::2], edges[1::2]):
        if end - begin >= window:
            kept.append(raw[at : spans[begin][0]])
            at = spans[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = SHARD_WORDS) -> DataFrame:
    """The rows that are not contaminated, with their columns; hit spans of at least ``window`` words are cut out.

    All in one call to Python: two in a row would keep two workers for each core, also for the steps that follow.
    """

    def apply(batch: pa.RecordBatch, part: Found) -> pa.RecordBatch:
        columns = {n: batch.column(n) for n in batch.schema.names}
        if any(part.masks):
            pairs = zip(part.texts.to_pylist(), part.masks)
            columns["text"] = pa.array([cut(t, m, window) if m else t for t, m in pairs], pa.string())
        stays = [not (n and COVERAGE * n >= words) for n, words in zip(part.n_hit, part.n_words)]
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns)).filter(pa.array(stays, pa.bool_()))

    return in_batches(docs).mapInArrow(_matched(shards(benchmark, window, limit), window, apply), docs.schema)
