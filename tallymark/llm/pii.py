"""Personal data behind disguises, found by offset-preserving rewriting.

Two transducers normalise a text and remember where every piece came from: the first maps look-alike characters to
their plain form and drops invisible ones, the second rewrites spelled digits and the at/dot disguises of addresses.
The detectors run on the source and on the normalised text; what they find there is mapped back to source
characters. Findings of the source itself always stay, the normalised text only adds.

Row-local: no shuffle. Every pattern is linear in the text, so very long texts cost no more per character.

Edge cases: a null or empty text has no findings; numbers of any length are handled; repeated rows are judged one by
one; an empty table gives an empty result; ``redact`` carries other columns through whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tallymark.llm.common import in_batches

KINDS = ("email", "ip", "card", "phone")

# The detectors' patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Every address of numbers lies inside one run of these characters.
NUMBERS = re.compile(r"[+0-9][0-9 ().+-]{6,}")
CARD_DIGITS, PHONE_DIGITS = range(16, 20), range(8, 16)

# Look-alikes of plain characters in other scripts. What Unicode itself calls a form of a plain
# character (full width, mathematical letters, circled digits) and other scripts' digits follow by rule.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "һ": "h", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H",
    "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԁ": "D", "α": "a", "ο": "o",
    "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "χ": "x", "γ": "y", "τ": "t", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z",
    "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g",
    "ɑ": "a", "օ": "o", "ո": "n", "ս": "u", "。": ".", "۔": ".", "‐": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "⁃": "-",
}
INVISIBLE = "­​‌‍⁠﻿"
# Digits in words, by language.
DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
AT_WORDS, DOT_WORDS = "at|arroba|arobase", "dot|punto|point|punkt"

DIGIT_OF = {w: str(i) for words in DIGIT_WORDS.values() for i, w in enumerate(words.split())} | {"oh": "0"}


def _plain_forms() -> dict[int, str]:
    forms = {}
    for c in range(0x80, 0x1FBFA):
        plain = unicodedata.normalize("NFKC", chr(c))
        digit = unicodedata.decimal(chr(c), None)
        if digit is not None:
            forms[c] = str(digit)
        elif len(plain) == 1 and " " <= plain <= "~":
            forms[c] = plain
    return forms | {ord(c): plain for c, plain in LOOKALIKES.items()}


PLAIN = _plain_forms()


ODD = frozenset([*map(chr, PLAIN), *INVISIBLE])
DROPPED = re.compile(f"[{INVISIBLE}]+")
_DIGIT = "(?:" + "|".join(sorted(DIGIT_OF, key=lambda w: (-len(w), w))) + ")"
_GAP = r"[ \t]{0,3}"
_DOT = rf"(?:{_GAP}[\[({{<]{_GAP}(?:{DOT_WORDS}|\.){_GAP}[\])}}>]{_GAP}|[ \t]{{1,3}}(?:{DOT_WORDS})[ \t]{{1,3}})"
_LABEL = r"[A-Za-z0-9-]{1,63}"
DISGUISE = re.compile(
    rf"(?P<at>{_GAP}[\[({{<]{_GAP}(?:{AT_WORDS}|@){_GAP}[\])}}>]{_GAP}"
    rf"|[ \t]{{1,3}}(?:{AT_WORDS})[ \t]{{1,3}}(?={_LABEL}(?:{_DOT}{_LABEL})+))"
    rf"|(?P<weak>[ \t]{{1,3}}(?:{AT_WORDS})[ \t]{{1,3}}(?={_LABEL}(?:\.{_LABEL})+))"
    rf"|(?P<dot>{_DOT})"
    rf"|(?P<plus>\bplus[ \t-]{{1,2}}(?={_DIGIT}\b|[0-9]))"
    # Each digit word ends for itself, so a run ends before a longer word and is never tried again from its middle.
    rf"|(?P<digits>\b{_DIGIT}\b(?:[ -]{_DIGIT}\b)*+)"
    r"|(?P<alike>\b(?=[OoIl]*+[0-9])[0-9OoIl]*+\b|(?<=[0-9])[OoIl]++(?=[0-9]))",
    re.I,
)
SPELLED = re.compile(rf"{_DIGIT}\b|[ -]", re.I)
# Letters that stand for digits, in a token of digits and such letters.
ALIKE = re.compile(r"[OoIiLl]")
# What ``hinted`` looks for. All of it is read in lower case; the words come first, since most texts hold none of them.
WORD = re.compile(r"\w+")
_HINT_WORDS = {name: frozenset(words.split("|")) for name, words in (("at", AT_WORDS), ("dot", DOT_WORDS), ("plus", "plus"))}
_HINT_AT = re.compile(rf"[ \t](?:{AT_WORDS})[ \t]{{1,3}}{_LABEL}\.[a-z0-9]")
_HINT_DOT = re.compile(rf"[ \t](?:{DOT_WORDS})[ \t]")
_HINT_PLUS = re.compile(rf"\bplus[ \t-]{{1,2}}(?:{_DIGIT}\b|[0-9])")
_HINT_BRACKET = re.compile(rf"[\[({{<]{_GAP}(?:{AT_WORDS}|{DOT_WORDS}|@|\.){_GAP}[\])}}>]")
_HINT_ALIKE = re.compile(r"[0-9](?:[oil]|(?<=[oil][0-9]))")
_HINT_AFTER = re.compile(rf"[ ().-]*+(?:[0-9+]|{_DIGIT}\b)")


def hinted(text: str) -> bool:
    """Whether the text may hold a disguise that could end in a finding."""
    if not text.isascii():
        # The four letters that equal a plain one when case does not count; one of them would become two characters.
        for letter, plain in ("\u0130", "i"), ("\u0131", "i"), ("\u017f", "s"), ("\u212a", "k"):
            text = text.replace(letter, plain)
    low = text.lower()
    if _HINT_ALIKE.search(low) or _HINT_BRACKET.search(low):
        return True
    words = set(WORD.findall(low))
    for name, pattern in (("at", _HINT_AT), ("dot", _HINT_DOT), ("plus", _HINT_PLUS)):
        if not _HINT_WORDS[name].isdisjoint(words) and pattern.search(low):
            return True
    if words.isdisjoint(DIGIT_OF):
        return False
    for m in WORD.finditer(low):
        if m[0] not in DIGIT_OF:
            continue
        # A digit word counts next to a numeral, a plus sign or another digit word.
        before = m.start() - 1
        while before >= 0 and low[before] in " ().-":
            before -= 1
        if before >= 0 and low[before] in "0123456789+" or _HINT_AFTER.match(low, m.end()):
            return True
    return False


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches: for each at sign, the local part to its left and the domain to its right."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(Span("email", start, domain.end()))
        # What lies before an at sign is no part of a later local part.
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return out


def detect(text: str) -> list[Span]:
    """All findings of a text, by kind and start."""
    found = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    for run in NUMBERS.finditer(text):
        part, at = run.group(), run.start()
        for m in IP.finditer(part) if part.count(".") > 2 else ():
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found["ip"].append(Span("ip", at + m.start(), at + m.end()))
        for m in CARD.finditer(part) if len(part) >= CARD_DIGITS.start else ():
            digits = m.group().replace(" ", "").replace("-", "")
            if len(digits) in CARD_DIGITS and luhn(digits):
                found["card"].append(Span("card", at + m.start(), at + m.end()))
        for m in PHONE.finditer(part) if "+" in part else ():
            if sum(c.isdigit() for c in m.group()) in PHONE_DIGITS:
                found["phone"].append(Span("phone", at + m.start(), at + m.end()))
    return [span for kind in KINDS for span in found[kind]]


class Rewritten:
    """A text made of copied and rewritten pieces of another one, and the way back."""

    def __init__(self, source: str, edits: Iterable[tuple[int, int, str]]):
        # Of each piece: its start here, its start and end in the source, and whether it is a copy.
        self.starts: list[int] = []
        self.pieces: list[tuple[int, int, bool]] = []
        parts, at, size = [], 0, 0

        def put(text: str, begin: int, end: int, copied: bool) -> None:
            nonlocal size
            if text:
                self.starts.append(size)
                self.pieces.append((begin, end, copied))
                parts.append(text)
                size += len(text)

        for begin, end, text in edits:
            put(source[at:begin], at, begin, True)
            put(text, begin, end, False)
            at = end
        put(source[at:], at, len(source), True)
        self.text = "".join(parts)

    def _piece(self, at: int) -> tuple[int, tuple[int, int, bool]]:
        i = bisect_right(self.starts, at) - 1
        return at - self.starts[i], self.pieces[i]

    def source_span(self, start: int, end: int) -> tuple[int, int]:
        into, (begin, _, copied) = self._piece(start)
        first = begin + into if copied else begin
        into, (begin, stop, copied) = self._piece(end - 1)
        return first, begin + into + 1 if copied else stop


# The name before a bare "at" and a plain domain: only one that no word of prose looks like makes it an address.
ACCOUNT = re.compile(r"(?=[^ ]*[A-Za-z])(?=[^ ]*[0-9._+])[A-Za-z0-9._%+-]*[A-Za-z0-9]$")


def is_account(text: str, end: int) -> bool:
    word = text[max(0, end - 64) : end].split()[-1:]
    return bool(word and ACCOUNT.match(word[0]))


def disguises(text: str) -> Iterable[tuple[int, int, str]]:
    for m in DISGUISE.finditer(text):
        if m.lastgroup == "weak":
            if is_account(text, m.start()):
                yield m.start(), m.end(), "@"
        elif m.lastgroup == "digits":
            for part in SPELLED.finditer(text, m.start(), m.end()):
                yield part.start(), part.end(), DIGIT_OF.get(part.group().lower(), "")
        elif m.lastgroup == "alike":
            for part in ALIKE.finditer(text, m.start(), m.end()):
                yield part.start(), part.end(), "0" if part.group() in "Oo" else "1"
        else:
            yield m.start(), m.end(), {"at": "@", "dot": ".", "plus": "+"}[m.lastgroup]


def normalise(text: str) -> list[Rewritten]:
    """The rewritings of the text one after the other; empty if it holds nothing to rewrite."""
    steps = []
    if not text.isascii() and not ODD.isdisjoint(text):
        plain = text.translate(PLAIN)  # one character for one, so offsets stay
        steps.append(Rewritten(plain, ((m.start(), m.end(), "") for m in DROPPED.finditer(plain))))
        text = steps[-1].text
    if hinted(text):
        steps.append(Rewritten(text, disguises(text)))
    return steps


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Findings of the text itself, and those that only its normalised form shows, in source characters."""
    if not text:
        return [], []
    plain = detect(text)
    steps = normalise(text)
    added = []
    known = {kind: [p for p in plain if p.kind == kind] for kind in KINDS} if steps else {}
    starts = {kind: [p.start for p in spans] for kind, spans in known.items()}
    for span in detect(steps[-1].text) if steps else ():
        start, end = span.start, span.end
        for step in reversed(steps):
            start, end = step.source_span(start, end)
        # Spans of a kind come in order and do not overlap, so only the last one that begins before can hold this one.
        before = bisect_right(starts[span.kind], start) - 1
        if before < 0 or known[span.kind][before].end < end:
            added.append(Span(span.kind, start, end))
    return plain, added


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start, s.end))


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in in_order(spans))


def report(docs: DataFrame) -> DataFrame:
    """Per row: the numbers of plain findings, their digest, all spans, and how many the normalised text added."""
    counts = [f"n_{kind}" for kind in KINDS]

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            out: dict[str, list] = {name: [] for name in (*counts, "base_sha256", "spans", "n_added")}
            for text in batch.column("text"):
                plain, added = find(text.as_py())
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s.kind == kind for s in plain))
                out["base_sha256"].append(hashlib.sha256(written(plain).encode()).hexdigest())
                out["spans"].append(written([*plain, *added]))
                out["n_added"].append(len(added))
            strings = {"base_sha256", "spans"}
            arrays = [pa.array(v, pa.string() if k in strings else pa.int64()) for k, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *out])

    columns = ", ".join(f"{c} long" for c in counts)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", "text")).mapInArrow(
        run, f"doc_id {id_type}, {columns}, base_sha256 string, spans string, n_added long"
    )


def masked(text: str | None) -> str | None:
    """The text with every finding replaced by the name of its kind; overlapping findings become one."""
    plain, added = find(text)
    parts, at = [], 0
    for span in sorted([*plain, *added], key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            parts += [text[at : span.start], f"[{span.kind.upper()}]"]
        at = max(at, span.end)
    return text if not parts else "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with the findings in ``text`` masked."""

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            texts = pa.array([masked(t) for t in batch.column("text").to_pylist()], pa.string())
            columns = [texts if n == "text" else batch.column(i) for i, n in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return in_batches(docs).mapInArrow(run, docs.schema)
