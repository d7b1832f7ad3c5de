"""Sets of word shingles of whole batches of texts, as sorted 64-bit hashes.

Words are runs of bytes other than white space (0x09-0x0D, 0x20), with A-Z in lower case. A shingle is a run of ``width``
words; a text with fewer words, but at least one, has its whole sequence as its only shingle. A word's hash is a
polynomial over random values of its bytes, from prefix sums over all texts on end; a shingle's hash mixes those of its words.
"""

from __future__ import annotations

from functools import cache

import numpy as np

M = 0xFFFFFFFFFFFFFFFF
#: Odd base of the polynomial, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def byte_values() -> np.ndarray:
    """A fixed random value for each byte; A-Z have those of a-z."""
    low = np.arange(256)
    low[65:91] += 32
    return mixed((low + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power of 0..n-1, modulo 2^64; kept, up to a few million."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        all_ = np.full(max(n, 1 << 16), base, np.uint64)
        all_[0] = 1
        have = np.cumprod(all_, dtype=np.uint64)
        if n <= 1 << 22:
            _powers[base] = have
    return have[:n]


def hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, repeated ones included, and where each text's begin, with the end."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    n = len(data)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([True], white, [True])).astype(np.int8))
    begin, end = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(byte_values()[data] * powers(BASE, n), dtype=np.uint64)))
    word = mixed((sums[end] - sums[begin]) * powers(INVERSE, n)[begin] + (end - begin).astype(np.uint64))
    until = np.searchsorted(begin, first)  # words before each text
    words = np.diff(until)
    shingles = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    borders = np.concatenate(([0], np.cumsum(shingles)))
    at = np.repeat(until[:-1] - borders[:-1], shingles) + np.arange(borders[-1])
    short = np.repeat(np.where(words < width, words, width), shingles)  # words of each shingle
    padded = np.concatenate((word, np.zeros(width, np.uint64)))
    total = short.astype(np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(INVERSE) + np.where(short > k, padded[at + k], np.uint64(0)))
    return total, borders


def sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text."""
    total, borders = hashes(texts, width)
    return [np.unique(total[a:b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
