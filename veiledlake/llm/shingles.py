"""Word shingles of whole text columns in numpy, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Text that is hashed at once; a longer text is a part of its own.
PART_BYTES = 1 << 21
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finishing steps of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
ANY_CASE = LETTERS.copy()
ANY_CASE[65:91] = LETTERS[97:123]
_BASE = 0xD1342543DE82EF95
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def sets_of(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of `size` words.

    Words are what white space (space, \\t to \\r) separates, with A-Z in lower case. Fewer words than a shingle are
    one shingle. No words, or null, give an empty array.
    """
    for data, ends in parts(texts):
        yield from _part(data, ends, size)


def parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes of texts, some texts at a time, with the borders of the texts in them."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + PART_BYTES, "right")) - 1)
        yield data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def hashed_words(
    data: np.ndarray, ends: np.ndarray, letters: np.ndarray = ANY_CASE, gap: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a part, and where each starts and stops.

    `letters` holds a number for each byte, `gap` tells which bytes are between words.
    """
    n = len(data)
    word = ~gap[data]
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    before = np.concatenate(([False], word[:-1])) if n else word
    after = np.concatenate((word[1:], [False])) if n else word
    starts = np.flatnonzero(word & (~before | edge[:n]))
    stops = np.flatnonzero(word & (~after | edge[1 : n + 1])) + 1
    powers = _powers(_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[data] * powers[:n], out=sums[1:])
    back = _powers(pow(_BASE, -1, 1 << 64), n + 1)
    hashes = mix((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64) * _STEP)
    return hashes, starts, stops


def rolled(hashes: np.ndarray, more: np.ndarray, size: int, done: int = 1) -> np.ndarray:
    """Hashes of `size` words in a row, from those of `done` words and of the words themselves."""
    for k in range(done, size):
        hashes = mix(hashes[: len(more) - k] * _STEP + more[k:]) if len(more) > k else hashes[:0]
    return hashes


def _part(data: np.ndarray, ends: np.ndarray, size: int) -> Iterator[np.ndarray]:
    hashes, starts, _ = hashed_words(data, ends)
    grams = rolled(hashes, hashes, size)
    bounds = np.searchsorted(starts, ends)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            yield np.unique(grams[a : b - size + 1])
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = mix(np.array([whole], np.uint64) * _STEP + h)[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def set_id(hashes: np.ndarray) -> int:
    """64 bits that stand for a whole set."""
    parts = np.array([hashes.sum(dtype=np.uint64), mix(hashes).sum(dtype=np.uint64), len(hashes)], np.uint64)
    return int(mix(mix(parts) + np.arange(3, dtype=np.uint64) * _STEP).sum(dtype=np.uint64).view(np.int64))
