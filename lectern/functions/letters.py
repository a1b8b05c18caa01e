"""Places of parts among the letters of a text, and places of one version of a text in another."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np

from lectern.functions.blocks import matching_blocks

#: Letters of an end by which a changed part is found, at least and at most; what may stand between the ends besides the part's own length.
LEAST_END, MOST_END, SLACK = 4, 8, 40
#: Characters in common, at least, that tell a place; fewer may be alike by chance.
ANCHOR = 4


class LetterIndex:
    """The letters of a text, with the places of each run of ``LEAST_END`` letters."""

    def __init__(self, text: str) -> None:
        self.letters = "".join(filter(str.isalpha, text))
        self.places: dict[str, list[int]] = defaultdict(list)
        for i in range(len(self.letters) - LEAST_END + 1):
            self.places[self.letters[i:i + LEAST_END]].append(i)

    def all_of(self, run: str) -> list[int]:
        """Where a run of letters stands, in order: its rarest short run tells where to look."""
        if len(run) < LEAST_END:
            return [i for i in range(len(self.letters) - len(run) + 1) if self.letters.startswith(run, i)]
        shift = min(range(len(run) - LEAST_END + 1), key=lambda i: len(self.places.get(run[i:i + LEAST_END], ())))
        return [p - shift for p in self.places.get(run[shift:shift + LEAST_END], ()) if p >= shift and self.letters.startswith(run, p - shift)]

    def span(self, part: str, hint: int = 0) -> tuple[int, int] | None:
        """Where the letters of ``part`` stand: the first place from ``hint`` on, else the first of all.

        A part that is nowhere as a whole is found by its ends: the first place of
        its head that has its tail after it, with no more between them than twice
        the part and ``SLACK`` letters.
        """
        need = "".join(filter(str.isalpha, part))
        if not need:
            return None
        ahead_first = lambda spots: sorted(spots, key=lambda p: (p < hint, p))
        if whole := self.all_of(need):
            at = ahead_first(whole)[0]
            return at, at + len(need)
        size = min(MOST_END, len(need) // 2)
        if size < LEAST_END:
            return None
        tails = self.all_of(need[-size:])
        for head in ahead_first(self.all_of(need[:size])):
            k = bisect_left(tails, head)
            if k < len(tails) and tails[k] + size - head <= 2 * len(need) + SLACK:
                return head, tails[k] + size
        return None


def letter_span(text: str, part: str, hint: int = 0) -> tuple[int, int] | None:
    return LetterIndex(text).span(part, hint)


def locate_letters(text: str, part: str, hint: int = 0) -> int:
    """The start of `letter_span`; -1 if there is none."""
    found = letter_span(text, part, hint)
    return found[0] if found else -1


def place_map(a: str, b: str) -> np.ndarray:
    """For each character of ``a`` its place in ``b``, -1 where it has none.

    Places rise, and the characters there are equal. A block in common of fewer
    than ``ANCHOR`` characters counts where nothing was changed on one side of it,
    or where it is once in each text between the longer blocks around it; so that
    characters that are gone don't take up others by chance.
    """
    out = np.full(len(a), -1, np.int64)
    found = [(0, 0, 0), *matching_blocks(a, b), (len(a), len(b), 0)]
    firm = [i for i, (_, _, n) in enumerate(found) if n >= ANCHOR or i in (0, len(found) - 1)]
    for before, after in zip(firm, firm[1:], strict=False):
        (x0, y0, n0), (x1, y1, _) = found[before], found[after]
        gap_a, gap_b = a[x0 + n0:x1], b[y0 + n0:y1]
        for k in range(before + 1, after):
            x, y, n = found[k]
            last, following = found[k - 1], found[k + 1]
            beside = (last[0] + last[2] == x or last[1] + last[2] == y) and (following[0] == x + n or following[1] == y + n)
            if beside or (gap_a.count(a[x:x + n]) == 1 and gap_b.count(a[x:x + n]) == 1):
                out[x:x + n] = np.arange(y, y + n)
    for i in firm:
        x, y, n = found[i]
        out[x:x + n] = np.arange(y, y + n)
    return out


def projected(a: str, b: str, spans: list[tuple[int, int]]) -> list[tuple[int, int] | None]:
    """The smallest span of ``b`` that covers what is left of each span of ``a``; None where nothing is."""
    places = place_map(a, b)
    out: list[tuple[int, int] | None] = []
    for start, end in spans:
        kept = places[max(0, start):max(0, end)]
        kept = kept[kept >= 0]
        out.append((int(kept[0]), int(kept[-1]) + 1) if len(kept) else None)
    return out
