"""Documents in blocks of bounded size, and a round trip from blocks to shards of keys and back.

Some operators need, for each key of a document (a word, an n-gram, a window), something that only the whole corpus
knows. A row for each occurrence would make the shuffle many times the text. Instead

1. documents are put into blocks of about ``BLOCK_BYTES`` of text, by a hash of doc_id and text or, where the order of
   documents counts, as ranges of (doc_id, text hash);
2. every block sends its *distinct* keys to shards by key hash, packed into one row per block and shard, so a key
   that occurs in a third of all documents arrives once per block;
3. a shard settles its keys over all blocks and answers each block, again in one row;
4. every block meets its answers and finishes its documents.

Step 3 is a tree of merges (``exchange``). Its first level has, for each group of ``FAN`` blocks, one node for each of
``FAN`` ranges of key hashes. A node merges the keys of its blocks, each kept once, and passes them on to the nodes of
finer ranges over ``FAN`` times as many blocks, until one group holds all. The last nodes settle their keys, and the answers
go back the same way. Each level has about as many nodes as there are blocks, and a node gets and sends at most ``FAN``
packs, so the packs grow in proportion to the blocks (times the levels: one up to 2 GB of text, two up to 512 GB, three
up to 128 TB). A task holds one block or one node; a node meets a common key once per child, never once per block of
the corpus.

Blocks by hash need nothing but their number; ranges need their cut points in every task, which grow with the corpus, 16
bytes for each ``BLOCK_BYTES`` of text. The block of a row follows from its content, so a repeated task or a second
evaluation sends it to the same place.

Rows with equal doc_id and text are one document with a number of copies, merged before the shuffle.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import in_batches, stage, text_key, texts

BLOCK_BYTES = 8 << 20
FAN = 256

BLOCK_SCHEMA = "block int, payload binary"
ASK_SCHEMA = "shard int, block int, payload binary"
ANSWER_SCHEMA = "block int, shard int, payload binary"


def pack(value: Any, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(value, 5))


def unpack(raw: bytes) -> Any:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(raw))


class Document(NamedTuple):
    """Order of documents: null ids first, then by id, then by text hash."""

    has_id: bool
    doc_id: int
    key: int
    text: str
    copies: int

    @property
    def id(self) -> int | None:
        return self.doc_id if self.has_id else None


class Blocks(NamedTuple):
    rows: DataFrame
    count: int


def order_key(doc_id: int | None, key: int) -> tuple[bool, int, int]:
    return (doc_id is not None, doc_id or 0, key)


def into_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, ordered: bool = True) -> Blocks:
    """Rows (block, payload); a payload holds some documents of the block. ``ordered``: blocks are ranges of documents."""
    narrow = texts(docs).select(F.col("doc_id").cast("long"), "text", text_key(F.col("text")).alias("key"))
    total = narrow.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    # Cut points of ids and hashes; documents without an id come before all others.
    ids, keys = np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = np.zeros(0, bool)
    if n > 1 and ordered:
        ranges = narrow.select("doc_id", "key").repartitionByRange(n, "doc_id", "key")
        lowest = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("doc_id", "key")).alias("low"))
        cuts = sorted(order_key(*row["low"]) for row in lowest.collect())[1:]
        known, ids, keys = (np.array([c[i] for c in cuts], t) for i, t in enumerate((bool, np.int64, np.int64)))
        n = len(cuts) + 1

    def place_of(place: tuple[bool, int, int]) -> int:
        """The number of cut points up to the place."""
        low, high = (int(np.searchsorted(known, place[0], side)) for side in ("left", "right"))
        first = low + int(np.searchsorted(ids[low:high], place[1], "left"))
        last = low + int(np.searchsorted(ids[low:high], place[1], "right"))
        return first + int(np.searchsorted(keys[first:last], place[2], "right"))

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            held: dict[int, dict[tuple, list]] = defaultdict(dict)
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "text", "block")))
            for doc_id, key, text, block in rows:
                place = order_key(doc_id, key)
                held[place_of(place) if ordered else block].setdefault(place, [text, 0])[1] += 1
            packed = {b: pack([(*place, *rest) for place, rest in d.items()]) for b, d in held.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed.keys(), pa.int32()), pa.array(packed.values(), pa.binary())], ["block", "payload"]
            )

    numbered = narrow.withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), F.lit(n)).cast("int"))
    return Blocks(in_batches(numbered).mapInArrow(run, BLOCK_SCHEMA), n)


def documents_of(table: pa.Table) -> list[Document]:
    """The documents of a block in order."""
    merged: dict[tuple, list] = {}
    for raw in table.column("payload"):
        for has_id, doc_id, key, text, copies in unpack(raw.as_py()):
            merged.setdefault((has_id, doc_id, key), [text, 0])[1] += copies
    return [Document(*place, *merged[place]) for place in sorted(merged)]


def ask(blocks: Blocks, questions: Callable[[int, list[Document]], Iterable[tuple[int, Any]]]) -> DataFrame:
    """Each block's packs for the shards: ``questions`` gets the block's number and yields (shard, value)."""

    def run(key, table):
        block = key[0].as_py()
        asked = [(shard, block, pack(value)) for shard, value in questions(block, documents_of(table))]
        return packed(asked, ("shard", "block"))

    return blocks.rows.groupBy("block").applyInArrow(run, ASK_SCHEMA)


def packed(rows: list[tuple[int, int, bytes]], names: tuple[str, str]) -> pa.Table:
    first, second, payload = zip(*rows) if rows else ((), (), ())
    return pa.table(
        {names[0]: pa.array(first, pa.int32()), names[1]: pa.array(second, pa.int32()), "payload": pa.array(payload, pa.binary())}
    )


class Keys(NamedTuple):
    """What an operator does with the keys of a node. A value holds distinct keys, ordered by hash from the second
    level on, with what is known of each; an answer is a tuple of arrays in the order of the keys.

    ``union(values)``: one value with the keys of all.
    ``split(value, n)``: (range, value) for each of ``n`` ranges of hashes that has keys, ascending.
    ``settle(value)``: the answer, once the keys have come from all blocks.
    ``tell(values, value, answer)``: the answer for each of the values that were joined to ``value``.
    ``tell_blocks(shard, blocks, values, value, answer)``: (block, shard, value) rows for the blocks of a node.
    """

    union: Callable[[list[Any]], Any]
    split: Callable[[Any, int], Iterable[tuple[int, Any]]]
    settle: Callable[[Any], tuple[np.ndarray, ...]]
    tell: Callable[[list[Any], Any, tuple[np.ndarray, ...]], Iterable[tuple[np.ndarray, ...]]]
    tell_blocks: Callable[[int, list[int], list[Any], Any, tuple[np.ndarray, ...]], Iterable[tuple[int, int, Any]]]


def ranges_by_level(n_blocks: int, fan: int = FAN) -> list[int]:
    """The number of hash ranges on each level; each divides the next."""
    ranges, groups = [1], n_blocks
    while groups > fan:
        ranges.append(ranges[-1] * fan)
        groups = math.ceil(groups / fan)
    return [*ranges[1:], ranges[-1] * groups]


def shards_of_block(n_blocks: int, fan: int = FAN) -> int:
    """The number of shards that a block sends its keys to."""
    return ranges_by_level(n_blocks, fan)[0]


def children(table: pa.Table) -> tuple[list[int], list[Any]]:
    """The blocks (or groups of the level below) that a node hears from, in order, and their values."""
    table = table.sort_by("block")
    return table.column("block").to_pylist(), [unpack(p.as_py()) for p in table.column("payload")]


def upward(asked: DataFrame, keys: Keys, finer: int, fan: int) -> DataFrame:
    """Each node's keys, merged, for the ``finer`` ranges of the next level; the node's group takes the block's place."""

    def run(key, table):
        value = keys.union(children(table)[1])
        return packed([(s, key[0].as_py(), pack(v)) for s, v in keys.split(value, finer)], ("shard", "block"))

    nodes = asked.filter("shard >= 0").groupBy(F.expr(f"block div {fan}").cast("int").alias("node"), "shard")
    return nodes.applyInArrow(run, ASK_SCHEMA)


def downward(asked: DataFrame, answers: DataFrame, keys: Keys, ratio: int, fan: int, leaves: bool) -> DataFrame:
    """Each node's answers to its children, from the answers of the ``ratio`` finer ranges of the next level."""

    def run(key, left, right):
        shard, (at, values) = key[1].as_py(), children(left)
        if shard < 0:
            return packed([(b, shard, pack(v)) for b, v in zip(at, values)], ("block", "shard"))
        parts = [unpack(p.as_py()) for p in right.sort_by("shard").column("payload")]
        answer = tuple(np.concatenate(columns) for columns in zip(*parts, strict=True))
        return replies(keys, shard, at, values, keys.union(values), answer, leaves)

    down = asked.withColumn("node", F.expr(f"block div {fan}").cast("int")).groupBy("node", F.col("shard").alias("place"))
    above = answers.withColumn("place", F.expr(f"shard div {ratio}").cast("int")).groupBy(F.col("block").alias("node"), "place")
    return down.cogroup(above).applyInArrow(run, ANSWER_SCHEMA)


def replies(keys: Keys, shard: int, at: list[int], values: list[Any], value: Any, answer: tuple, leaves: bool) -> pa.Table:
    if leaves:
        rows = [(b, s, pack(v)) for b, s, v in keys.tell_blocks(shard, at, values, value, answer)]
    else:
        rows = [(b, shard, pack(v)) for b, v in zip(at, keys.tell(values, value, answer), strict=True)]
    return packed(rows, ("block", "shard"))


def exchange(asked: DataFrame, n_blocks: int, keys: Keys, fan: int = FAN) -> DataFrame:
    """The answers to each block. What goes to a shard below zero comes back as it is.

    With more than one level, the rows that go up are written to the shared folder, since they are read again on the
    way back.
    """
    ranges = ranges_by_level(n_blocks, fan)
    single = len(ranges) == 1
    levels = []
    for finer in ranges[1:]:
        levels.append(stage(asked, "asked"))
        asked = upward(levels[-1], keys, finer, fan)

    def top(key, table):
        shard, (at, values) = key[0].as_py(), children(table)
        if shard < 0:
            return packed([(b, shard, pack(v)) for b, v in zip(at, values)], ("block", "shard"))
        value = keys.union(values)
        return replies(keys, shard, at, values, value, keys.settle(value), single)

    answers = asked.groupBy("shard").applyInArrow(top, ANSWER_SCHEMA)
    for level in reversed(range(len(levels))):
        ratio = ranges[level + 1] // ranges[level]
        answers = downward(levels[level], answers, keys, ratio, fan, level == 0)
    return answers


def finish(
    blocks: Blocks, answers: DataFrame, work: Callable[[int, list[Document], dict[int, Any]], Iterator[tuple]], schema: str
) -> DataFrame:
    """Rows of each block from its documents and the answers by shard; a document's row is repeated for its copies.

    ``work`` gets the block's number and yields one tuple per document, in order, without the id; the first column
    is ``doc_id``. Answers with a column ``kind`` come by (kind, shard).
    """
    fields = [f.strip().split()[0] for f in schema.split(",")]

    def run(key, left, right):
        docs = documents_of(left)
        values = [unpack(p.as_py()) for p in right.column("payload")]
        places = right.column("shard").to_pylist()
        if "kind" in right.schema.names:
            places = list(zip(right.column("kind").to_pylist(), places))
        told = dict(zip(places, values))
        rows = [(d.id, *row) for d, row in zip(docs, work(key[0].as_py(), docs, told), strict=True) for _ in range(d.copies)]
        columns = list(zip(*rows)) if rows else [() for _ in fields]
        arrow = {
            "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()),
        }
        types = [arrow[f.strip().split()[1]] for f in schema.split(",")]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(fields, columns, types)})

    return blocks.rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def by_shard(shards: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions) of each shard that occurs, positions ascending."""
    order = np.argsort(shards, kind="stable")
    edges = np.searchsorted(shards[order], np.arange(n + 1))
    for shard in np.flatnonzero(np.diff(edges)):
        yield int(shard), order[edges[shard] : edges[shard + 1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the concatenated ranges [start, start + length)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
