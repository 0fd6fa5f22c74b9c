"""Formats conversations for training with a compiled template, and reads them back from what was written.

``layout`` marks turns with control strings; text that looks like one is written with a backslash inside, which reading
takes away, so the same bytes never stand for a mark and for text. What assistants say is marked as generated, in spans of
code points: the loss mask.

1. The turns are partitioned by ranges of (conversation, turn, digest) and sorted there, so a conversation that holds a
   third of all rows lies in many tasks. Each applies the closures of the template to its turns, one after the other,
   and writes parts of at most about ``PART_CHARS`` characters; a task holds one part.
2. Of the parts at the edges of a task it is not known whether the conversation begins or ends there. At most two
   conversations per task are concerned; the first and last parts of these are looked up and get the template's head and tail.
3. Reading back works part by part. Conversations of one part are done; the others come together by conversation, in
   order, and are digested part after part without being held. A digest has to see its bytes one after the other,
   so that step is sequential within a conversation, and all that is left of it there.

Turns come in order of ``turn``, nulls first; rows with the same turn come in order of the SHA-256 of role, a line feed and
text. Edge cases: a null role or text is empty; a null conversation id is a conversation of its own; repeated rows are turns
of their own; texts of any length are formatted whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import in_batches, stage
from tallymark.llm.template import FILTERS, Sink, Template

# Characters of a part, and what leaves Python at once.
PART_CHARS, BATCH_ROWS, BATCH_CHARS = 1 << 19, 1024, 1 << 20
ASSISTANT = "assistant"


class Controls:
    """Control strings that texts may contain: writing puts a backslash after the first character, reading takes one away.

    A first character may not occur again in any control string, so no text next to a mark can form one with it.
    """

    def __init__(self, strings: Sequence[str]):
        firsts, rests = {s[:1] for s in strings}, [s[1:] for s in strings]
        if not strings or any(len(s) < 2 or "\\" in s for s in strings) or any(f in r for f in firsts for r in rests):
            raise ValueError("control strings need two characters, no backslash, and first characters that do not come again")
        if any(a != b and b.startswith(a) for a in strings for b in strings):
            raise ValueError("no control string may begin with another one")
        of = lambda f: "|".join(re.escape(s[1:]) for s in strings if s[0] == f)
        self.mark = re.compile("|".join(re.escape(s) for s in strings))
        self._write = re.compile("|".join(rf"{re.escape(f)}(?=\\*(?:{of(f)}))" for f in sorted(firsts)))
        self._read = re.compile("|".join(rf"(?<={re.escape(f)})\\(?=\\*(?:{of(f)}))" for f in sorted(firsts)))

    def escape(self, text: str) -> str:
        return self._write.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._read.sub("", text)


class Layout(NamedTuple):
    """Control strings around a conversation's turns: head, then for each turn opening, role, middle, text and closing."""

    head: str = "<s>"
    opening: str = "[INST]"
    middle: str = "[/INST]"
    closing: str = "</s>"

    def template(self) -> str:
        quoted = {k: '"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"' for k, v in self._asdict().items()}
        return (
            "{{{{ {head} }}}}{{% for message in messages %}}{{{{ {opening} ~ (message.role | escape) ~ {middle} }}}}"
            '{{% if message.role == "' + ASSISTANT + '" %}}{{% generation %}}{{{{ message.text | escape }}}}{{% endgeneration %}}'
            "{{% else %}}{{{{ message.text | escape }}}}{{% endif %}}{{{{ {closing} }}}}{{% endfor %}}"
        ).format(**quoted)

    def turns(self, text: str, controls: Controls) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn of a formatted text or of a part of one."""
        marks = list(controls.mark.finditer(text))
        if marks and marks[0][0] == self.head:
            marks = marks[1:]
        for opening, middle, closing in zip(marks[::3], marks[1::3], marks[2::3], strict=True):
            if (opening[0], middle[0], closing[0]) != (self.opening, self.middle, self.closing):
                raise ValueError(f"not a turn: {text[opening.start() : opening.start() + 40]!r}")
            yield controls.unescape(text[opening.end() : middle.start()]), controls.unescape(text[middle.end() : closing.start()])


class Style(NamedTuple):
    """A layout, the template that writes it, and the variables of the template. ``source`` None is the layout's own one."""

    layout: Layout = Layout()
    source: str | None = None
    variables: tuple[tuple[str, str], ...] = ()

    def controls(self) -> Controls:
        return Controls(list(self.layout))

    def compiled(self) -> Template:
        filters = {**FILTERS, "escape": self.controls().escape}
        return Template(self.source or self.layout.template(), filters=filters)


_PARTS = pa.schema(
    [
        ("conv_id", pa.int64()), ("place", pa.int64()), ("starts", pa.bool_()), ("ends", pa.bool_()), ("n_turns", pa.int64()),
        ("text", pa.string()), ("spans", pa.list_(pa.list_(pa.int64()))),
    ]
)
PARTS_SCHEMA = "conv_id long, place long, starts boolean, ends boolean, n_turns long, text string, spans array<array<long>>"


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    n = 0
    for row in rows:
        held.append(row)
        n += size(row)
        if len(held) >= BATCH_ROWS or n >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _bodies(turns: DataFrame, style: Style, part_chars: int) -> DataFrame:
    """The formatted turns in parts, in order of ``place``; head and tail are left out.

    ``starts`` and ``ends`` are null where the task cannot tell whether the conversation begins or ends with the part.
    """
    digest = F.sha2(F.concat_ws("\n", "role", "text"), 256)
    narrow = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("digest", digest)
    order = ["conv_id", "turn", "digest"]
    # Equal rows are dealt by where they come from, so that no number of them has to lie in one task.
    dealt = narrow.withColumn("source", F.monotonically_increasing_id()).repartitionByRange(*order, "source")
    dealt = dealt.sortWithinPartitions(*order).select("conv_id", "role", "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        _, turn, _ = style.compiled().parts(dict(style.variables))
        place = TaskContext.get().partitionId() << 33
        # What the first part of a task continues and what continues its last one, only its neighbours know.
        sink, n, now, starts = Sink(), 0, None, None
        for conv_id, role, text in _rows(batches, "conv_id", "role", "text"):
            if n and (conv_id != now or sink.length >= part_chars):
                ends = conv_id != now
                yield now, place, starts, ends, n, sink.text(), sink.spans
                place, sink, n, starts = place + 1, Sink(), 0, ends
            turn({"role": role, "text": text}, sink)
            now, n = conv_id, n + 1
        if n:
            yield now, place, starts, None, n, sink.text(), sink.spans

    return in_batches(dealt).mapInArrow(lambda b: _batches(write(b), _PARTS, lambda row: len(row[5])), PARTS_SCHEMA)


def formatted(turns: DataFrame, style: Style = Style(), part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted conversations: (conv_id, place, starts, ends, n_turns, text, spans), written once.

    The texts of a conversation's parts, in order of ``place``, are the formatted conversation; ``spans`` are what the model
    is to write, as (start, end) in code points of the part. Nearly all conversations are one part.
    """
    head, _, tail = style.compiled().parts(dict(style.variables))
    bodies = stage(_bodies(turns, style, part_chars), "chat-bodies")
    # At most two conversations per task have parts at its edges. If the task before also holds some of one, it has a part
    # with an open end and a lower place; in the same way one goes on in the task behind.
    place_if = lambda flag: F.when(F.col(flag).isNull(), F.col("place"))
    edges = bodies.filter("starts IS NULL OR ends IS NULL").groupBy(F.col("conv_id").alias("edge")).agg(
        F.min(place_if("starts")).alias("first_start"), F.max(place_if("starts")).alias("last_start"),
        F.min(place_if("ends")).alias("first_end"), F.max(place_if("ends")).alias("last_end"),
    )
    place = F.col("place")
    open_start = (place == F.col("first_start")) & (place <= F.coalesce("first_end", place))
    open_end = (place == F.col("last_end")) & (place >= F.coalesce("last_start", place))
    rows = bodies.join(F.broadcast(edges), F.col("conv_id").eqNullSafe(F.col("edge")), "left").select(
        "conv_id", "place",
        F.coalesce("starts", open_start, F.lit(False)).alias("starts"),
        F.coalesce("ends", open_end, F.lit(False)).alias("ends"),
        "n_turns", "text", "spans", F.char_length("text").cast("long").alias("chars"),
    )
    before = F.when(F.col("starts"), F.lit(head.length)).otherwise(0).cast("long")
    after = before + F.col("chars")
    moved = F.transform("spans", lambda s: F.transform(s, lambda at: at + before))
    literal = lambda spans: F.array(*[F.array(*[F.lit(v).cast("long") for v in s]) for s in spans]).cast("array<array<long>>")
    ends = F.transform(literal(tail.spans), lambda s: F.transform(s, lambda at: at + after))
    none = literal([])
    # In two steps: the spans of the tail follow from the text without head and tail.
    placed = rows.withColumn(
        "spans",
        F.concat(F.when(F.col("starts"), literal(head.spans)).otherwise(none), moved, F.when(F.col("ends"), ends).otherwise(none)),
    )
    whole = F.concat(
        F.when(F.col("starts"), F.lit(head.text())).otherwise(""), "text", F.when(F.col("ends"), F.lit(tail.text())).otherwise("")
    )
    return placed.withColumn("text", whole).drop("chars")


class Reading:
    """What a formatted conversation says, read part after part."""

    def __init__(self) -> None:
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, spans: Iterable[Sequence[int]], layout: Layout, controls: Controls) -> None:
        for role, said in layout.turns(text, controls):
            self.n_turns += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        for start, end in spans:
            said = controls.unescape(text[start:end])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.formatted_chars += len(text)

    def row(self, conv_id: int | None) -> tuple[Any, ...]:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


REPORT_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_REPORT = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string()}[f.split()[1]]) for f in REPORT_SCHEMA.split(", ")])


def read_back(parts: DataFrame, style: Style = Style()) -> DataFrame:
    """Turns, loss text and length of each conversation, from its formatted parts alone."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        controls, reading, now = style.controls(), None, None
        for conv_id, text, spans in _rows(batches, "conv_id", "text", "spans"):
            if reading is None or conv_id != now:
                if reading is not None:
                    yield reading.row(now)
                reading, now = Reading(), conv_id
            reading.add(text, spans, style.layout, controls)
        if reading is not None:
            yield reading.row(now)

    run = lambda batches: _batches(read(batches), _REPORT, lambda row: 200)
    columns, whole = ["conv_id", "text", "spans"], F.col("starts") & F.col("ends")
    alone = in_batches(parts.filter(whole).select(*columns)).mapInArrow(run, REPORT_SCHEMA)
    several = parts.filter(~whole).repartition("conv_id").sortWithinPartitions("conv_id", "place").select(*columns)
    return alone.unionByName(in_batches(several).mapInArrow(run, REPORT_SCHEMA))


def report(turns: DataFrame, style: Style = Style(), part_chars: int = PART_CHARS) -> DataFrame:
    return read_back(formatted(turns, style, part_chars), style)
