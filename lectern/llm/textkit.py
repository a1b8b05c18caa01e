"""Vectorised words and shingles: a batch of texts becomes flat numpy arrays."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

#: Code points from here on count as no word characters.
_TABLE = 0x32000
_PRIME = np.uint64(0x9E3779B97F4A7C15)
SHINGLE_WORDS = 5


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form and kind of each code point; kinds: 0 none, 1 part of a word, 2 a word by itself."""
    lower, kind = np.arange(_TABLE, dtype=np.uint32), np.zeros(_TABLE, dtype=np.uint8)
    for i in range(_TABLE):
        c = chr(i)
        if unicodedata.category(c)[0] in "LNM":
            kind[i] = 1
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    for a, b in ((0x3040, 0x3100), (0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, _TABLE)):
        kind[a:b][kind[a:b] == 1] = 2
    return lower, kind


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts with a line feed after each, and where each text starts."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return codes, np.concatenate(([0], np.cumsum(sizes)))


@dataclass
class Words:
    """Words of some texts. ``doc`` rises; ``start`` and ``end`` count within the text."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i]:bounds[i+1]


def words(texts: list[str]) -> Words:
    """Lower-cased runs of letters, digits and marks; an ideograph is a word by itself."""
    codes, offsets = code_points(texts)
    lower, kinds = _tables()
    codes = np.minimum(codes, np.uint32(_TABLE - 1))
    kind = kinds[codes]
    before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
    begins = (kind == 2) | ((kind == 1) & (before != 1))
    at = np.flatnonzero(kind)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none, np.zeros(len(texts) + 1, np.int64))
    first = np.flatnonzero(begins[at])
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    powers = np.cumprod(np.full(int(length.max()), _PRIME, dtype=np.uint64))
    value = (lower[codes[at]].astype(np.uint64) + np.uint64(1)) * powers[place]
    hashed = mix(np.add.reduceat(value, first))
    start = at[first]
    doc = np.searchsorted(offsets, start, side="right") - 1
    begin = start - offsets[doc]
    return Words(hashed, doc, begin, begin + length, np.searchsorted(doc, np.arange(len(texts) + 1)))


def shingles(w: Words, n_texts: int, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row, their text, and the index of their first word.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    odd = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(w.hash)
    count = np.diff(w.bounds)
    if n >= size:
        whole = n - size + 1
        total = w.hash[:whole] * odd[0]
        for i in range(1, size):
            total = total + w.hash[i:whole + i] * odd[i]
        inside = w.doc[:whole] == w.doc[size - 1:]
        first = np.flatnonzero(inside)
        hashed, doc = mix(total[first]), w.doc[first]
    else:
        first, hashed, doc = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            has = count[short] > i
            own[has] += w.hash[w.bounds[short[has]] + i] * odd[i]
        own = mix(own ^ count[short].astype(np.uint64))
        hashed, doc, first = np.concatenate((hashed, own)), np.concatenate((doc, short)), np.concatenate((first, w.bounds[short]))
        order = np.argsort(doc, kind="stable")
        hashed, doc, first = hashed[order], doc[order], first[order]
    return hashed, doc, first


def chunks(texts: Iterable[str | None], chars: int = 400_000) -> Iterator[tuple[int, list[str]]]:
    """The texts in runs of bounded size (one long text is a run by itself), each with the index of its first; null is empty."""
    run: list[str] = []
    size = at = 0
    for i, t in enumerate(texts):
        t = t if isinstance(t, str) else ""
        if run and size + len(t) > chars:
            yield at, run
            run, size, at = [], 0, i
        run.append(t)
        size += len(t)
    if run:
        yield at, run
