"""Hashed runs of one to three words, for whole Arrow columns of texts at once.

A word is a run of ASCII letters, digits and bytes above 0x7F; capitals A-Z count as small. A feature is one to three
consecutive words joined by one space, known by the CRC-32 of its bytes. The checksum of a joined feature follows from
those of its words: moving a checksum past n bytes is a linear map, kept as a table for each short length and, for
longer words, for each power of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Reflected polynomial of CRC-32, and the bytes of words.
POLYNOMIAL = 0xEDB88320
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IS_WORD = np.zeros(256, dtype=bool)
for first, last in (("0", "9"), ("a", "z")):
    IS_WORD[ord(first) : ord(last) + 1] = True
IS_WORD[0x80:] = True

# Words of more bytes are summed one by one; words of a column that are hashed side by side.
SHORT, BLOCK = 64, 1 << 18


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


BYTE = _byte_table()


def _move_by(table: np.ndarray, value: np.ndarray) -> np.ndarray:
    """``value`` moved by what ``table`` (4 x 256) stands for."""
    return (
        table[0][value & 255] ^ table[1][(value >> 8) & 255] ^ table[2][(value >> 16) & 255] ^ table[3][value >> 24]
    )


def _moves() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables for 0 to ``SHORT`` bytes, and for 1, 2, 4 ... 2**39 bytes."""
    still = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    step = lambda v: BYTE[v & 255] ^ (v >> 8)
    short = [still]
    for _ in range(SHORT):
        short.append(step(short[-1]))
    powers = [short[1]]
    for _ in range(39):
        powers.append(_move_by(powers[-1], powers[-1]))
    return np.stack(short), powers


MOVE, POWERS = _moves()


def move(value: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of texts followed by ``length`` more bytes, before those bytes' own checksum is added."""
    n = np.minimum(length, SHORT)
    out = MOVE[n, 0, value & 255] ^ MOVE[n, 1, (value >> 8) & 255] ^ MOVE[n, 2, (value >> 16) & 255] ^ MOVE[n, 3, value >> 24]
    long = np.flatnonzero(length > SHORT)
    if len(long):
        moved, left = value[long], length[long].astype(np.int64)
        for bit, table in enumerate(POWERS[: int(left.max()).bit_length()]):
            moved = np.where((left >> bit) & 1, _move_by(table, moved), moved)
        out[long] = moved
    return out


def sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each word."""
    out = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    at = np.flatnonzero(lengths <= SHORT)
    for k in range(SHORT):
        at = at[lengths[at] > k]
        if not len(at):
            break
        now = out[at]
        out[at] = BYTE[(now ^ data[starts[at] + k]) & 255] ^ (now >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]])
    return out


class Words(NamedTuple):
    """The words of a column: lower-case bytes, where words begin and their lengths, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray


def words_of(column: pa.Array) -> Words:
    """Words of a binary column without nulls."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = LOWER[whole[edges[0] : edges[-1]]]
    edges -= edges[0]
    inside = IS_WORD[low]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    # No word goes on from one text into the next.
    filled = np.diff(edges) > 0
    before[edges[:-1][filled]] = False
    after[edges[1:][filled] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    return Words(low, starts, lengths, np.searchsorted(starts, edges))


class Features(NamedTuple):
    """Features that begin at some words: checksums of one, two and three words, and whether they end in the same text."""

    at: slice
    one: np.ndarray
    two: np.ndarray
    three: np.ndarray
    has_two: np.ndarray
    has_three: np.ndarray


def features_of(words: Words, block: int = BLOCK) -> Iterator[Features]:
    """All features of a column, ``block`` words after the other."""
    total = len(words.starts)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    space = np.array([zlib.crc32(b" ")], dtype=np.uint32)
    for low in range(0, total, block):
        high, ahead = min(low + block, total), min(low + block + 2, total)
        n, lengths = high - low, words.lengths[low:ahead]
        one = sums(words.data, words.starts[low:ahead], lengths)
        # A word behind a space.
        joined = move(np.repeat(space, len(one)), lengths) ^ one
        two = move(one[:-1], lengths[1:] + 1) ^ joined[1:]
        three = move(two[:-1], lengths[2:] + 1) ^ joined[2:]
        same = text[low + 1 : ahead] == text[low : ahead - 1]
        pad = lambda a, fill: np.concatenate([a[:n], np.full(max(0, n - len(a)), fill, a.dtype)])
        yield Features(
            slice(low, high), one[:n], pad(two, 0), pad(three, 0), pad(same, False), pad(same[:-1] & same[1:], False)
        )
