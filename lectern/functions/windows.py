"""The run of words in a passage that is most like a line."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from lectern.functions import blocks

#: Buckets in which the characters of words are counted.
BUCKETS = 64


def _counts(words: list[str]) -> np.ndarray:
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4") % BUCKETS
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(owner * BUCKETS + letters, minlength=len(words) * BUCKETS).reshape(len(words), BUCKETS)


class Passage:
    """The words of a passage, with running counts of their letters, which are counted when a line isn't found whole."""

    def __init__(self, text: str) -> None:
        self.words = text.split()
        self.padded = f" {' '.join(self.words)} "

    @cached_property
    def sums(self) -> np.ndarray:
        return np.concatenate((np.zeros((1, BUCKETS), np.int64), np.cumsum(_counts(self.words), axis=0)))

    @cached_property
    def ends(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([len(w) for w in self.words], dtype=np.int64)))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Letters of each run of ``size`` words by bucket, and its length with the spaces between them."""
        n = max(0, len(self.words) - size + 1)
        return self.sums[size:size + n] - self.sums[:n], self.ends[size:size + n] - self.ends[:n] + size - 1

    def best(self, line: str) -> tuple[float, str]:
        """Ratio and text of the run of about a line's number of words that is most like it; the shortest, then the first of several.

        A line that stands there whole is its own best run. Else a run's ratio is at most what its letters have in common with the line's.
        Runs are compared from the highest such bound down, until no bound is over
        the best ratio: first by their longest common subsequence, which bounds it too.
        """
        want = line.split()
        if not want:
            return 0.0, ""
        text = " ".join(want)
        if f" {text} " in self.padded:
            return 1.0, text
        own = _counts(want).sum(axis=0)
        found = []
        for size in range(max(1, len(want) - 1), len(want) + 2):
            letters, lengths = self.windows(size)
            common = np.minimum(letters, own).sum(axis=1) + min(size, len(want)) - 1
            found.append(np.column_stack((2 * common / np.maximum(1, lengths + len(text)), np.full(len(lengths), size), np.arange(len(lengths)))))
        rows = np.concatenate(found) if found else np.zeros((0, 3))
        order = np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))
        best: tuple[float, int, int] = (0.0, 0, 0)
        for bound, size, at in rows[order].tolist():
            if bound + 1e-9 < -best[0]:
                break
            window = " ".join(self.words[int(at):int(at) + int(size)])
            score = blocks.ratio_of(text, window, -best[0]) if best[0] else blocks.ratio_of(text, window)
            if score:
                best = min(best, (-score, int(size), int(at)))
        return -best[0], " ".join(self.words[best[2]:best[2] + best[1]])
