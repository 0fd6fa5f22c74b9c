"""Which filter removes what, alone and in every order, with exact duplicates found in radix tries of whole texts.

1. Every task reads its documents once. It notes as bits which filters a document fails, and puts the texts into a
   compressed trie whose terminals hold the least id. A document with a smaller one before it is settled; one
   candidate per text goes on, so a text that a third of all documents have is one row per task and ``HELD_BYTES``.
2. The candidates are partitioned by ranges of text prefixes. A prefix is as long as it must be: where ``LADDER[0]``
   characters are shared by more rows than a task should get, the next length counts, in the end the text's digest.
   Equal texts have equal prefixes, so they meet in one trie; a text that is hot even so is dealt to pieces, whose
   least ids meet in one more round. A task goes through its prefixes in order and empties its trie between two of
   them whenever it holds more than ``HELD_BYTES``.
3. Traversing a trie gives the last flag. The bits are then reduced to counts by part and set of failed filters, at
   most 32 per part, from which every order, step and share follows by arithmetic.

Edge cases: a null text is the empty text, which fails what an empty text fails; texts of any length are read whole.
A null id is no smaller than any other, so such a document is never a duplicate and makes none; it has no label. Rows
with equal id and text are documents of their own, not duplicates of each other. A null source is the part "". If a
document has several labels, one that says so is enough. An empty table gives no rows. Columns other than doc_id,
text, source and those of the labels are not read.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import in_batches, stage
from tallymark.llm.text_trie import TextTrie
from tallymark.operators.joins import hot_values, shuffle_width, with_pieces

# Bytes of distinct text that a task holds, bytes of candidates per partition, and rows per batch that leaves Python.
HELD_BYTES, PARTITION_BYTES, BATCH_ROWS, BATCH_BYTES = 16 << 20, 32 << 20, 4096, 4 << 20
# Lengths of prefixes in characters.
LADDER = (16, 64, 256)

# The limits of the filters and the characters they count.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2
CAPITALS, SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))


class Text:
    """What filters ask of a text in UTF-8. ``split`` without arguments splits at the six ASCII white spaces."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @property
    def code_points(self) -> int:
        return len(self.raw.translate(None, CONTINUATION))

    def count(self, characters: bytes) -> int:
        return len(self.raw) - len(self.raw.translate(None, characters))


Filter = Callable[[Text], bool]
# Failure conditions by letter; ``DUPLICATE`` is the letter of the filter that the tries settle, after these.
FILTERS: dict[str, Filter] = {
    "A": lambda t: len(t.words) < MIN_WORDS,
    "B": lambda t: 100 * len(set(t.words)) < MIN_DISTINCT * len(t.words),
    "C": lambda t: 100 * t.count(CAPITALS) > MAX_CAPITALS * t.code_points,
    "D": lambda t: t.count(SIGNS) > 0,
}
DUPLICATE = "E"

ROWS_SCHEMA = "doc_id long, part string, mask int, n long, text string"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.string())]
)
Row = tuple[int | None, str, int, int, bytes | None]


def batches_of(rows: Iterable[Row]) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded number and bytes."""
    held: list[Row] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[4] or b"")
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[Row]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def candidates(docs: DataFrame, filters: dict[str, Filter] = FILTERS, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Settled rows (without text), and one row per text and trie of a task whose fate other tasks decide."""
    tests, duplicate = list(filters.values()), 1 << len(filters)

    def settled_and_open(batches: Iterable[pa.RecordBatch]) -> Iterator[Row]:
        trie = TextTrie()
        for batch in batches:
            for doc_id, part, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "text"))):
                text = Text(raw)
                mask = sum(1 << bit for bit, fails in enumerate(tests) if fails(text))
                if doc_id is None:
                    yield None, part, mask, 1, None
                    continue
                for later, row, n in trie.add(raw, doc_id, part, note=mask):
                    yield later, row, mask | duplicate, n, None
                if trie.held > held_bytes:
                    yield from unsettled(trie)
                    trie = TextTrie()
        yield from unsettled(trie)

    def unsettled(trie: TextTrie) -> Iterator[Row]:
        for text, last in trie.walk():
            for part, n in last.rows.items():
                yield last.least, part, last.note, n, text

    narrow = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    return in_batches(narrow).mapInArrow(lambda batches: batches_of(settled_and_open(batches)), ROWS_SCHEMA)


def with_prefixes(rows: DataFrame, limit: int | None) -> DataFrame:
    """Adds ``prefix``, as long as it must be, and for hot texts ``piece`` and ``pieces``.

    Measured on the heads of the candidates. The prefixes with more rows than a task should get are at most two per
    task and length, and only steer where rows go.
    """
    heads = [f"head_{n}" for n in LADDER]
    hot = hot_values(rows.filter("text IS NOT NULL").select(*heads, "digest"), [*heads, "digest"], limit)
    chosen = F.concat(heads[-1], F.lit("\0"), F.hex("digest"))
    for head in reversed(heads):
        if hot[head]:
            rows = with_pieces(rows, head, hot[head]).withColumnRenamed("_hot_pieces", f"hot_{head}")
            chosen = F.when(F.col(f"hot_{head}") == 1, F.col(head)).otherwise(chosen)
        else:
            chosen = F.col(head)
    rows = with_pieces(rows, "digest", hot["digest"]).withColumnRenamed("_hot_pieces", "pieces")
    settled = F.col("text").isNull()
    return rows.select(
        *ROWS_COLUMNS,
        # Settled rows go along to tasks by a hash of their own.
        F.when(settled, F.hex(F.xxhash64("doc_id", "part"))).otherwise(chosen).alias("prefix"),
        F.pmod(F.xxhash64("doc_id", "part"), F.col("pieces")).alias("piece"),
        F.when(settled, 1).otherwise(F.col("pieces")).alias("pieces"),
    )


ROWS_COLUMNS = [f.name for f in _ARROW]


def settle(rows: DataFrame, duplicate: int, held_bytes: int = HELD_BYTES) -> DataFrame:
    """The rows with their last flag. All rows of a text and piece lie in one task, ordered by prefix.

    Rows of a text in several pieces keep the text, since another piece may hold a smaller id.
    """

    def flagged(batches: Iterable[pa.RecordBatch]) -> Iterator[Row]:
        trie, prefix = TextTrie(), None
        for batch in batches:
            columns = ("doc_id", "part", "mask", "n", "text", "prefix", "pieces")
            for doc_id, part, mask, n, raw, now, pieces in zip(*(batch.column(c).to_pylist() for c in columns)):
                if raw is None:
                    yield doc_id, part, mask, n, None
                    continue
                if now != prefix and trie.held > held_bytes:
                    yield from firsts(trie)
                    trie = TextTrie()
                prefix = now
                for later, row, k in trie.add(raw, doc_id, part, n, (mask, pieces > 1)):
                    yield later, row, mask | duplicate, k, None
        yield from firsts(trie)

    def firsts(trie: TextTrie) -> Iterator[Row]:
        for text, last in trie.walk():
            mask, is_open = last.note
            for part, n in last.rows.items():
                yield last.least, part, mask, n, text if is_open else None

    sent = rows.withColumn("text", F.col("text").cast("binary"))
    return in_batches(sent).mapInArrow(lambda batches: batches_of(flagged(batches)), ROWS_SCHEMA)


def failed_filters(
    docs: DataFrame, filters: dict[str, Filter] = FILTERS, held_bytes: int = HELD_BYTES, limit: int | None = None
) -> DataFrame:
    """(doc_id, part, mask, n): documents by the set of filters they fail, duplicates as the highest bit.

    ``limit`` is the number of candidates of one prefix that a task should get, by default those of a shuffle partition.
    """
    duplicate = 1 << len(filters)
    noted = candidates(docs, filters, held_bytes).withColumns(
        {f"head_{n}": F.substring("text", 1, n) for n in LADDER} | {"digest": F.xxhash64("text"), "size": F.octet_length("text")}
    )
    staged = stage(noted, "filter-audit")
    size = staged.agg(F.sum("size")).first()[0] or 0
    tasks = max(shuffle_width(docs.sparkSession), math.ceil(size / PARTITION_BYTES))
    placed = with_prefixes(staged, limit)
    dealt = placed.repartitionByRange(tasks, "prefix", "piece").sortWithinPartitions("prefix", "piece")
    found = settle(dealt, duplicate, held_bytes)
    if not placed.filter("pieces > 1").isEmpty():
        # One row per piece of a hot text is left; all others are settled and only pass.
        own = F.when(F.col("text").isNull(), F.xxhash64("doc_id", "part")).otherwise(F.xxhash64("text"))
        again = found.withColumns({"prefix": F.hex(own), "pieces": F.lit(1)})
        found = settle(again.repartition(tasks, "prefix").sortWithinPartitions("prefix"), duplicate, held_bytes)
    return found.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def orders(letters: str) -> Column:
    """One row per order and step: the letter's bit and the bits of the letters before it."""
    bits = {letter: 1 << i for i, letter in enumerate(letters)}
    steps = [
        {"filter_order": "".join(order), "step": i + 1, "bit": bits[x], "earlier": sum(bits[y] for y in order[:i])}
        for order in itertools.permutations(letters)
        for i, x in enumerate(order)
    ]
    return F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,bit:int,earlier:int>>"))


def audit(
    docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] = FILTERS, held_bytes: int = HELD_BYTES,
    limit: int | None = None,
) -> DataFrame:
    """One row per part, order of the filters and step, with documents kept, removed, redundant, lost and shared out."""
    letters = "".join(filters) + DUPLICATE
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    failed = failed_filters(docs, filters, held_bytes, limit).join(known, "doc_id", "left")
    of = lambda flag: F.sum(F.when(F.col(flag) == 1, F.col("n")).otherwise(0))
    cells = failed.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = parts.select("part", "cells", orders(letters).alias("at")).select("part", "cells", "at.*")

    bit, earlier = F.col("bit"), F.col("earlier")
    fails = lambda c, bits: c["mask"].bitwiseAND(bits) != 0

    def total(take: Callable[[Column], Column], value: str = "n") -> Column:
        add = lambda s, c: s + F.when(take(c), c[value]).otherwise(F.lit(0).cast("long"))
        return F.aggregate("cells", F.lit(0).cast("long"), add)

    removed = lambda c: fails(c, bit) & ~fails(c, earlier)
    # A document that fails k filters is removed by each of them in the same number of orders.
    share = lambda c: F.lit(math.factorial(len(letters))) / F.bit_count(c["mask"])
    shapley = F.aggregate(
        "cells", F.lit(0).cast("long"),
        lambda s, c: s + F.when(fails(c, bit), c["n"] * share(c).cast("long")).otherwise(F.lit(0).cast("long")),
    )
    return rows.select(
        "part", "filter_order", "step",
        total(lambda c: ~fails(c, earlier.bitwiseOR(bit))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda c: fails(c, bit) & fails(c, earlier)).alias("redundant"),
        total(lambda c: c["mask"] == bit).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
