"""Counts of the words of texts, of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SCHEMA = "word string, tf long, acronyms long, capitals long, in_sents long, middle double, kinds_before long, n_before long, kinds_after long, n_after long, most long, mean double, spread double, sents long"
#: Words of the texts that are counted together; a longer text is counted by itself.
WORDS = 250_000


def _kinds(codes: np.ndarray, others: np.ndarray, n: int) -> np.ndarray:
    """How many different values go with each code."""
    base = int(others.max()) + 1 if len(others) else 1
    return np.bincount(np.unique(codes.astype(np.int64) * base + others) // base, minlength=n)


def chunks(sizes: np.ndarray, most: int = WORDS) -> Iterator[tuple[int, int]]:
    """Stretches of texts of ``most`` words together, or of one text."""
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def word_features(words: pa.ListArray, sents: pa.ListArray, marks: pa.ListArray) -> tuple[np.ndarray, list[pa.Array]]:
    """The texts' places and the columns of `SCHEMA`, a row for each content word of a text. Of each text: its words in order, the sentence of each (rising), and its marks (1 acronym, 2 capital, 4 content)."""
    flat = words.flatten().dictionary_encode()
    known, word = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sents, marks = sents.flatten().to_numpy(zero_copy_only=False).astype(np.int64), marks.flatten().to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy(zero_copy_only=False))
    pairs, codes = np.unique(text * len(known) + word, return_inverse=True)  # a text's words, text after text
    n, own = len(pairs), pairs // max(1, len(known))
    times = lambda test: np.bincount(codes[test], minlength=n)
    a_text = lambda values=None: np.bincount(own, values, minlength=len(words))
    tf = np.bincount(codes, minlength=n)
    inner = (sents[1:] == sents[:-1]) & (text[1:] == text[:-1])  # a word and the one before it in a sentence
    first = np.concatenate((np.ones(min(1, len(text)), bool), ~inner))
    order = np.argsort(codes, kind="stable")
    start = np.cumsum(tf) - tf
    middle = (sents[order[start + (tf - 1) // 2]] + sents[order[start + tf // 2]]) / 2
    content = (marks[order[start]] & 4) > 0
    many = np.maximum(1, a_text(content))
    mean = a_text(tf * content) / many
    spread = np.sqrt(a_text((tf - mean[own]) ** 2 * content) / many)
    most = np.zeros(len(words), np.int64)
    np.maximum.at(most, own, tf)
    before, after = codes[:-1][inner], codes[1:][inner]
    columns = [tf, times((marks & 1) > 0), times(((marks & 2) > 0) & ~first), _kinds(codes, sents, n), middle, _kinds(after, before, n), np.bincount(after, minlength=n), _kinds(before, after, n), np.bincount(before, minlength=n), most[own], mean[own], spread[own], np.bincount(text[first], minlength=len(words))[own]]
    return own[content], [known.take(pa.array(pairs[content] % max(1, len(known)))), *(pa.array(c[content]) for c in columns)]
