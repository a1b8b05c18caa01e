"""Many terms looked for in many texts: one pass over each text, by an automaton of all terms."""

from __future__ import annotations

from collections import OrderedDict
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of the terms of one automaton, which is what is sent to the executors; more terms make several passes.
AUTOMATON_CHARS = 2_000_000
_made: OrderedDict[int, object] = OrderedDict()


def automaton(number: int, terms: list[str]):
    """The automaton of some terms, made once a worker; a worker keeps the last two."""
    if number not in _made:
        import ahocorasick

        found = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            found.add_word(t, i)
        found.make_automaton()
        _made[number] = found
        while len(_made) > 2:
            _made.popitem(last=False)
    return _made[number]


def counted(text: str, found, sizes: list[int]) -> dict[int, int]:
    """How often each term is in a text, without overlaps, from the left."""
    ends: dict[int, int] = {}
    times: dict[int, int] = {}
    for end, i in found.iter(text):
        if end - sizes[i] >= ends.get(i, -1):
            ends[i] = end
            times[i] = times.get(i, 0) + 1
    return times


def _pass(rows: DataFrame, key: str, term: str, number: int, terms: list[str]) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        words = sent.value
        sizes = [len(t) for t in words]
        found = automaton(number, words) if words else None
        for pdf in batches:
            out = [(k, words[i], n) for k, t in zip(pdf[key], pdf["_text"], strict=True) if isinstance(t, str) for i, n in (counted(t, found, sizes).items() if found else ())]
            yield pd.DataFrame(out, columns=[key, term, "n"])
    return rows.mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {term} string, n long")


_numbers = iter(range(1 << 62))


def term_hits(texts: DataFrame, terms: DataFrame, key: str, term: str = "term", text: str = "text") -> DataFrame:
    """How often each term is a part of each text, for those where it is; empty terms are in none.

    The terms make one automaton (states for their prefixes, and for each state
    the next shorter one), so that a text is read once however many terms there
    are. Terms of more than ``AUTOMATON_CHARS`` characters in all are dealt by a
    hash to as many automata as that takes, and each makes a pass over the texts.
    """
    known = terms.select(F.col(term).cast("string").alias(term)).where(F.length(term) > 0).distinct()
    chars = known.agg(F.coalesce(F.sum(F.length(term).cast("long")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * chars // AUTOMATON_CHARS)) if chars > AUTOMATON_CHARS else 1
    rows = texts.select(key, F.col(text).alias("_text")).where("_text is not null")
    found = []
    for part in range(parts):
        own = known if parts == 1 else known.where(F.pmod(F.xxhash64(term), F.lit(parts)) == part)
        words = own.toPandas()[term].tolist()
        if words or not found:
            found.append(_pass(rows, key, term, next(_numbers), words))
    return reduce(DataFrame.union, found)
