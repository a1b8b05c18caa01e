"""Matching blocks, edits and common subsequences of long texts."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as K

#: Pieces whose lengths multiply to no more than this are matched character by character.
SMALL = 40_000
#: Characters of the pieces by which long runs in common are found.
SEED = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _BASE), dtype=np.uint64)))


class _Runs:
    """Hashes of all runs of a text, each by two lookups: sums of code points times rising powers, brought to one power."""

    def __init__(self, text: str, powers: np.ndarray) -> None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(codes * powers[:len(codes)], dtype=np.uint64)))
        self.powers = powers

    def of(self, start: int, end: int, n: int) -> np.ndarray:
        """Hashes of the runs of ``n`` that lie within a piece."""
        at = np.arange(start, end - n + 1)
        with np.errstate(over="ignore"):
            return (self.sums[at + n] - self.sums[at]) * self.powers[len(self.powers) - 1 - at]


def _longest(a: str, b: str, runs_a: _Runs, runs_b: _Runs, piece: tuple[int, int, int, int]) -> tuple[int, int, int]:
    """The longest run that two pieces have in common, the first in ``a`` and then in ``b``, by halving its length."""
    a0, a1, b0, b1 = piece
    low, high, found = 0, min(a1 - a0, b1 - b0), (a0, b0, 0)
    while low < high:
        n = (low + high + 1) // 2
        have, there = runs_a.of(a0, a1, n), runs_b.of(b0, b1, n)
        common = np.isin(have, there)
        if common.any():
            i = int(common.argmax())
            j = int((there == have[i]).argmax())
            low, found = n, (a0 + i, b0 + j, n)
        else:
            high = n - 1
    i, j, n = found
    if a[i:i + n] != b[j:j + n]:  # two runs of one hash
        m = difflib.SequenceMatcher(None, a, b, autojunk=False).find_longest_match(*piece)
        return m.a, m.b, m.size
    return found


def _clipped(runs: np.ndarray | None, piece: tuple[int, int, int, int]) -> tuple[int, int, int] | None:
    """The longest part of long runs in two pieces, the first in ``a`` and then in ``b``; None where a longer run may be in none of them."""
    if runs is None or not len(runs):
        return None
    a0, a1, b0, b1 = piece
    x, y, n = runs.T
    skip = np.maximum(0, np.maximum(a0 - x, b0 - y))
    size = np.minimum(n, np.minimum(a1 - x, b1 - y)) - skip
    most = int(size.max())
    if most < 2 * SEED - 1:
        return None
    i, j = min(((x + skip)[k], (y + skip)[k]) for k in np.flatnonzero(size == most))
    return int(i), int(j), most


def _long_runs(a: str, b: str, runs_a: _Runs, runs_b: _Runs) -> np.ndarray | None:
    """``(place in a, place in b, length)`` of all the longest runs in common that have ``SEED`` characters of ``a`` from a multiple of ``SEED`` on; None where there are too many.

    Every run of ``2 * SEED - 1`` or more has such characters.
    """
    if min(len(a), len(b)) < SEED:
        return np.zeros((0, 3), np.int64)
    seeds, there = runs_a.of(0, len(a), SEED)[::SEED], runs_b.of(0, len(b), SEED)
    order = np.argsort(there, kind="stable")
    low, high = (np.searchsorted(there, seeds, side, sorter=order) for side in ("left", "right"))
    if (high - low).sum() > len(a) + len(b):
        return None
    starts = np.repeat(np.arange(len(seeds)) * SEED, high - low)
    ends = order[np.concatenate([np.arange(x, y) for x, y in zip(low, high, strict=True)])]
    codes_a, codes_b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in (a, b))
    reached: dict[int, int] = {}
    out = []

    def common(x: np.ndarray, y: np.ndarray) -> int:
        n, step = 0, 64
        most = min(len(x), len(y))
        while n < most:
            differ = np.flatnonzero(x[n:n + step][:most - n] != y[n:n + step][:most - n])
            if len(differ):
                return n + int(differ[0])
            n, step = n + step, step * 4
        return most

    for i, j in zip(starts.tolist(), ends.tolist(), strict=True):
        if i < reached.get(j - i, 0) or a[i:i + SEED] != b[j:j + SEED]:
            continue
        back, ahead = common(codes_a[:i][::-1], codes_b[:j][::-1]), common(codes_a[i:], codes_b[j:])
        reached[j - i] = i + ahead
        out.append((i - back, j - back, back + ahead))
    return np.array(out, np.int64).reshape(-1, 3)


def matching_blocks(a: str, b: str) -> list[tuple[int, int, int]]:
    """Blocks ``(place in a, place in b, length)`` in common: the longest, then the longest on either side of it, and so on.

    The result is that of `difflib` without its rule for popular characters. A
    longest block is found by hashes of runs, in little more than linear time, so
    a long text doesn't cost the product of both lengths.
    """
    if a == b:
        return [(0, 0, len(a))] if a else []
    if len(a) * len(b) <= SMALL:
        return [(m.a, m.b, m.size) for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
    powers = _powers(max(len(a), len(b)) + 1)
    runs_a, runs_b = _Runs(a, powers), _Runs(b, powers)
    runs = _long_runs(a, b, runs_a, runs_b)
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        if (a1 - a0) * (b1 - b0) <= SMALL:
            inner = difflib.SequenceMatcher(None, a[a0:a1], b[b0:b1], autojunk=False)
            found += [(a0 + m.a, b0 + m.b, m.size) for m in inner.get_matching_blocks() if m.size]
            continue
        i, j, n = _clipped(runs, (a0, a1, b0, b1)) or _longest(a, b, runs_a, runs_b, (a0, a1, b0, b1))
        if n:
            found.append((i, j, n))
            todo += [(a0, i, b0, j), (i + n, a1, j + n, b1)]
    out: list[tuple[int, int, int]] = []
    for i, j, n in sorted(found):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (out[-1][0], out[-1][1], out[-1][2] + n)
        else:
            out.append((i, j, n))
    return out


def edits(a: str, b: str) -> list[tuple[str, int, int, int, int]]:
    """What lies between the matching blocks, as ``(tag, a0, a1, b0, b1)``."""
    out, i, j = [], 0, 0
    for x, y, n in [*matching_blocks(a, b), (len(a), len(b), 0)]:
        if i < x or j < y:
            out.append(("replace" if i < x and j < y else "delete" if i < x else "insert", i, x, j, y))
        i, j = x + n, y + n
    return out


def common_subsequence(a: str, b: str, least: int = 0) -> int:
    """Length of the longest common subsequence, a bit for each character of ``a``; 0 if it is under ``least``.

    It stops when more of ``b`` so far is without a partner than ``least``
    allows. As no character's partner is further from its place than the
    unmatched ones before it, only ``a`` up to there is looked at for that.
    """
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    spare_a, spare_b = len(a) - least, len(b) - least
    if least and (spare_a < 0 or spare_b < 0):
        return 0
    full = (1 << len(a)) - 1
    free = full
    for k, c in enumerate(b, 1):
        hit = free & places.get(c, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
        if least and k % 64 == 0:
            reach = min(len(a), k + spare_a)
            matched = reach - (free & ((1 << reach) - 1)).bit_count()
            if k - matched > spare_b:
                return 0
    found = len(a) - free.bit_count()
    return found if found >= least else 0


def ratio_of(a: str, b: str, least: float = 0.0) -> float:
    """Twice the characters in matching blocks by those of both; 0 where it is under ``least``, which bounds show for most texts."""
    total = len(a) + len(b)
    if not total or a == b:
        return 1.0
    if least:
        need = least_matched(len(a), len(b), least)
        if min(len(a), len(b)) < need or common_subsequence(a, b, need) < need:
            return 0.0
    found = 2.0 * sum(n for _, _, n in matching_blocks(a, b)) / total
    return found if found >= least else 0.0


def least_matched(n: int, m: int, ratio: float) -> int:
    """The fewest characters in matching blocks with which texts of such lengths reach a ratio."""
    return int(np.ceil(ratio * (n + m) / 2 - 1e-9))


@F.pandas_udf(K.ArrayType(K.StructType([K.StructField("tag", K.StringType()), *(K.StructField(n, K.IntegerType()) for n in ("a0", "a1", "b0", "b1"))])))
def opcodes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edits that make ``b`` of ``a``, equal parts left out."""
    return pd.Series([[dict(zip(("tag", "a0", "a1", "b0", "b1"), op, strict=True)) for op in edits(x or "", y or "")] for x, y in zip(a, b, strict=True)])


@F.pandas_udf(K.DoubleType())
def ratio(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    return pd.Series([ratio_of(x, y, z) if isinstance(x, str) and isinstance(y, str) else None for x, y, z in zip(a, b, least, strict=True)], dtype="float64")
