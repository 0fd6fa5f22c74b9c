"""Words of a block as numbers, and hashes of sequences of them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import xxhash

# An odd multiplier for sequences, and the constants of the 64-bit finaliser.
STEP = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Codes(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word: bytes | str) -> int:
        self[word] = code = len(self)
        return code


class Words(NamedTuple):
    """Codes of all words of a block one document after the other, document bounds, the words and their hashes."""

    codes: np.ndarray
    bounds: np.ndarray
    vocabulary: list[bytes]
    hashes: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(MIX[0])
    values ^= values >> np.uint64(27)
    values *= np.uint64(MIX[1])
    return values ^ (values >> np.uint64(31))


def read_words(documents: Iterable[Sequence[bytes]]) -> Words:
    """The words of each document."""
    codes = Codes()
    parts = [np.fromiter(map(codes.__getitem__, words), np.int32, len(words)) for words in documents]
    vocabulary = list(codes)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return Words(np.concatenate([np.zeros(0, np.int32), *parts]), bounds, vocabulary, hashes)


class Distinct(NamedTuple):
    """Distinct keys in order, the entry of each position, and the first position of each entry."""

    keys: np.ndarray
    of: np.ndarray
    first: np.ndarray


def distinct(keys: np.ndarray) -> Distinct:
    if not len(keys):
        return Distinct(keys, np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.argsort(keys)
    ordered = keys[order]
    begins = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    return Distinct(ordered[starts], of, np.minimum.reduceat(order, starts))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` consecutive values, by prefix sums modulo 2**64."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = np.full(len(hashes), STEP, np.uint64)
    factors[0] = 1
    up = np.multiply.accumulate(factors)
    back = np.full(n, pow(STEP, -1, 1 << 64), np.uint64)
    back[0] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)))
    return mix((sums[width:] - sums[:-width]) * np.multiply.accumulate(back))


def inside(bounds: np.ndarray, width: int) -> np.ndarray:
    """For each window start of the concatenated words, whether the window lies in one document."""
    n = int(bounds[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    ends = np.repeat(bounds[1:], np.diff(bounds))[:n]
    return np.arange(n) + width <= ends


def shard_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Shards are ranges of hashes, so the keys of a shard are a stretch of the sorted keys."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def stretches(ordered: np.ndarray, n: int) -> list[tuple[int, slice]]:
    """Each of ``n`` shards that has keys, and the stretch of the ordered keys that it has."""
    if not len(ordered):
        return []
    shards = shard_of(ordered, n)
    starts = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1])))
    ends = [*starts[1:].tolist(), len(ordered)]
    return [(s, slice(a, b)) for s, a, b in zip(shards[starts].tolist(), starts.tolist(), ends)]


def squeeze(ordered: np.ndarray) -> np.ndarray:
    """Sorted values as byte planes of their differences, whose upper planes are nearly empty."""
    return np.diff(ordered, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.copy()


def expand(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers as byte planes, of which the upper ones are nearly empty if most numbers are small."""
    width = 4 if not len(numbers) or numbers.max() < 1 << 32 else 8
    return numbers.astype(f"u{width}").view(np.uint8).reshape(-1, width).T.copy()


def joined(byte_planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(byte_planes.T).view(f"u{len(byte_planes)}").ravel()
