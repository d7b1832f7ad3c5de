"""Where words of a text begin, for whole batches at once.

Both splitting patterns of the public byte-level vocabularies cut a text by the class of its characters (letter, number,
white space, other), apart from a few English contractions. For characters whose class is the same in every Unicode version
that the libraries use, the cuts are found with array operations over all texts of a batch; texts with any other
character are reported, and callers hand them to the library's own splitter.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, BLANK, SPACE = range(5)  # BLANK: white space other than " "
UNSURE = 9
#: Characters below the first bound and of the general punctuation and currency blocks are looked up.
LATIN, TOP = 0x250, 0x20AD


@cache
def classes() -> np.ndarray:
    """The class of each code point below TOP, UNSURE where a library has to say."""
    out = np.full(TOP + 1, UNSURE, np.uint8)
    for cp in [*range(LATIN), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]:
        kind = unicodedata.category(chr(cp))
        if cp == 0x20:
            out[cp] = SPACE
        elif 0x09 <= cp <= 0x0D:
            out[cp] = BLANK
        elif kind[0] == "L":
            out[cp] = LETTER
        elif kind[0] == "N":
            out[cp] = NUMBER
        elif kind[0] in "PS":
            out[cp] = OTHER
    return out


@cache
def lower_table() -> np.ndarray:
    """Lower case of each code point, 0 where it is not one known character."""
    out = np.zeros(TOP + 1, np.uint32)
    for cp in np.flatnonzero(classes() != UNSURE):
        low = chr(cp).lower()
        if len(low) == 1 and ord(low) < LATIN and classes()[ord(low)] != UNSURE or ord(low[0]) == cp:
            out[cp] = ord(low)
    return out


class Texts:
    """Code points of some texts on end. ``first``: index of each text's first code point, and the end."""

    def __init__(self, texts: list[str]):
        joined = "".join(texts)
        self.cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.first = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)

    def kinds(self) -> np.ndarray:
        return classes()[np.minimum(self.cp, TOP)]

    def unsure(self, bad: np.ndarray) -> np.ndarray:
        """Texts that hold a code point marked in ``bad``."""
        return np.unique(np.searchsorted(self.first, np.flatnonzero(bad), side="right") - 1)


def starts_of_texts(first: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n + 1, bool)
    out[first[first < n]] = True
    return out[:n]


def contractions(cp: np.ndarray, begin: np.ndarray, of_text: np.ndarray) -> None:
    """Cut after 's 't 'm 'd 're 've 'll where a word begins with the apostrophe."""
    at = np.flatnonzero((cp == 39) & begin)
    if not len(at):
        return
    n = len(cp)
    one, two = np.minimum(at + 1, n - 1), np.minimum(at + 2, n - 1)
    has1 = (at + 1 < n) & ~of_text[one]
    has2 = has1 & (at + 2 < n) & ~of_text[two]
    c1, c2 = cp[one], cp[two]
    short = has1 & np.isin(c1, [ord(c) for c in "stmd"])
    long = has2 & (((c1 == 114) & (c2 == 101)) | ((c1 == 118) & (c2 == 101)) | ((c1 == 108) & (c2 == 108)))
    for found, size in ((at[short], 2), (at[long], 3)):
        begin[found + 1] = False
        after = found + size
        begin[after[after < n]] = True


def with_spaces(cp: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word starts where a word may carry one leading space and white space is kept as words of its own."""
    n = len(cp)
    of_text = starts_of_texts(first, n)
    if not n:
        return of_text
    white = kind >= BLANK
    run = np.where(white, np.uint8(BLANK), kind)
    begin = of_text.copy()
    begin[1:] |= run[1:] != run[:-1]
    # A word after white space: the last white character is cut off, and a space goes with the word.
    after = np.flatnonzero(~white[1:] & white[:-1] & ~of_text[1:]) + 1
    begin[after - 1] = True
    begin[after] = kind[after - 1] != SPACE
    contractions(cp, begin, of_text)
    return begin


def without_spaces(cp: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word starts where each number character is a word and white space is dropped."""
    n = len(cp)
    of_text = starts_of_texts(first, n)
    if not n:
        return of_text
    run = np.where(kind >= BLANK, np.uint8(BLANK), kind)
    begin = of_text | (run == NUMBER)
    begin[1:] |= run[1:] != run[:-1]
    contractions(cp, begin, of_text)
    return begin


def byte_offsets(cp: np.ndarray) -> np.ndarray:
    """UTF-8 offset of each code point, and the end."""
    size = np.ones(len(cp), np.int64)
    size += cp >= 0x80
    size += cp >= 0x800
    size += cp >= 0x10000
    return np.concatenate(([0], np.cumsum(size)))


def coded(data: bytes, cuts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """A code for each piece ``data[cuts[i]:cuts[i + 1]]``, and the distinct pieces."""
    offsets = pa.py_buffer(cuts.astype(np.int32).tobytes())
    pieces = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(data)])
    found = pieces.dictionary_encode()
    _, ends, joined = found.dictionary.buffers()
    ends = np.frombuffer(ends, np.int32)[: len(found.dictionary) + 1].tolist()
    joined = joined.to_pybytes()
    return found.indices.to_numpy(), [joined[a:b] for a, b in zip(ends, ends[1:])]


def slices(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Runs of texts of about ``limit`` code points in all; a longer text is a run of its own."""
    out, begin, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            out.append((begin, i))
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        out.append((begin, len(sizes)))
    return out
