"""Verse lines among the clauses of a text, by their metre."""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

# Syllables of a verse line; lines of a passage, at least; how far a line may be from its metre, up to a metre of so many syllables; syllables of a sentence, at most; words of a refrain.
LOW, HIGH, LEAST = 5, 25, 4
DRIFT = ((9, 0), (12, 1))
WIDEST = 2
LONGEST = 200
# Syllables of a line of a verse text, at least; syllables of a run between its lines, at most.
SHORTEST, LONGEST_RUN = 4, 80
REFRAIN = ("ཕྱག", "འཚལ", "བསྟོད", "འདུད")


def drift(metre: int) -> int:
    return next((d for most, d in DRIFT if metre <= most), WIDEST)


def middle(ordered: list[int]) -> int:
    return ordered[(len(ordered) - 1) // 2]


def runs(size: list[int], fits: list[bool]) -> Iterator[tuple[int, int]]:
    """Stretches of clauses that fit and keep to the middle of those before them in the stretch."""
    for good, places in groupby(range(len(size)), key=fits.__getitem__):
        if not good:
            continue
        start, ordered = None, []
        for k in places:
            if ordered and abs(size[k] - middle(ordered)) > drift(middle(ordered)):
                yield start, k
                ordered = []
            start = start if ordered else k
            insort(ordered, size[k])
        yield start, k + 1


def is_passage(size: list[int], final: list[bool], ending: list[str], least: int) -> bool:
    """Lines enough, and where the metre is loose no list of sentences: at most a third end one, unless it is a refrain."""
    if len(size) < least:
        return False
    closing = [e for e, f in zip(ending, final, strict=True) if f]
    if not drift(sorted(size)[len(size) // 2]) or 3 * len(closing) <= len(size):
        return True
    words, times = Counter(closing).most_common(1)[0]
    return 2 * times >= len(closing) and any(w in words for w in REFRAIN)


def verse_lines(size: list[int], closed: list[bool], final: list[bool], ending: list[str], quotes: list[bool], low: int = LOW, high: int = HIGH, least: int = LEAST) -> list[bool]:
    """Which clauses are verse: passages of one metre; a closed line after one that is a syllable off (a contraction) and quotes nothing; a closed line of any size between two."""
    verse = [False] * len(size)
    for a, b in runs(size, [c and low <= n <= high for c, n in zip(closed, size, strict=True)]):
        if is_passage(size[a:b], final[a:b], ending[a:b], least):
            verse[a:b] = [True] * (b - a)
    for k in range(1, len(size)):
        verse[k] = verse[k] or (closed[k] and verse[k - 1] and not quotes[k] and abs(size[k] - size[k - 1]) <= 1)
    between = [k for k in range(1, len(size) - 1) if closed[k] and verse[k - 1] and verse[k + 1]]
    for k in between:
        verse[k] = True
    return verse


def units(size: list[int], verse: list[bool], final: list[bool], cut: list[bool], longest: int = LONGEST) -> list[int]:
    """Numbers of units: each verse line, and sentences, which end with a final clause, a cut, before verse, or when they are long."""
    out, number, total, open_ = [], -1, 0, False
    for n, v, f, c in zip(size, verse, final, cut, strict=True):
        if v or not open_:
            number, total = number + 1, 0
        out.append(number)
        total += n
        open_ = not (v or f or c or total >= longest)
    return out


def padas(size: list[int], closed: list[bool], final: list[bool], rubric: list[bool], cut: list[bool], main: int, longest: int = LONGEST_RUN) -> list[int]:
    """Numbers of the units of a verse text: its lines one by one, and what is no verse (mantras, instructions, lists) in runs.

    A line is closed, of the main metre or a neighbour's, and next to another.
    One that closes a run as its label goes with it. A run ends with a label, a
    rubric, a paragraph, or when it would be too long.
    """
    n = len(size)
    fit = [c and s >= SHORTEST for s, c in zip(size, closed, strict=True)]
    near = lambda k, j: 0 <= j < n and fit[j] and abs(size[k] - size[j]) <= 1
    like = [fit[k] and (abs(size[k] - main) <= 1 or near(k, k - 1) or near(k, k + 1)) for k in range(n)]
    verse = [b and (a or c) for a, b, c in zip([False, *like], like, [*like[1:], False], strict=False)]
    out, number, total, open_ = [], -1, 0, False
    before = True
    for k in range(n):
        label = verse[k] and k > 0 and not before and final[k] and not cut[k - 1]
        line = verse[k] and not label
        if line or not open_ or total + size[k] > longest:
            number, total = number + 1, 0
        out.append(number)
        total += size[k]
        open_ = not (line or label or cut[k] or (closed[k] and rubric[k]))
        before = line
    return out
