"""Functional units of a commentary: quoted root lines on their own, prose joined where its words ask for it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as K

from lectern.functions import fixed
from lectern.operators import fuzzy, sequence
from lectern.sources.stage import staged

# What introduces and what closes a quoted line, a homage and other frames, the first of several points, an announcement of a count, a question on the sentence before.
MARK = "[།༎]"
NUMBER = "(?:གཉིས|གསུམ|བཞི|ལྔ|དྲུག|བདུན|བརྒྱད|དགུ|བཅུ(?:་(?:གཅིག|གཉིས|གསུམ|བཞི|ལྔ|དྲུག|བདུན|བརྒྱད|དགུ))?|ཉི་ཤུ)"
INTRODUCES = re.compile(rf"(?:ནི|ན)[\s་]*{MARK}\s*$")
CLOSES = re.compile(r"^\s*(?:ཞེས|ཅེས|ཤེས)[་\s]")
HOMAGE = re.compile("^(?:ན་མོ|ནཱ་མོ|ན་མཿ|ན་མ་)")
FRAME = re.compile(rf"^(?:སྨྲས་པ|སྨྲས་པ་ནི|བརྗོད་པ)[་\s]*{MARK}")
FIRST_POINT = re.compile(r"^\(?དང་པོ[་\s)]")
ANNOUNCES = re.compile(rf"(?:ལ|དང|ལས|སྟེ)[་\s]*{NUMBER}(?:[་\s]*(?:ཡོད[་\s]*(?:དེ|པ)?[་\s]*)?{MARK}|\s)")
ASKS = re.compile(rf"^\(?(?:གང་ལ|གང་གི|གང་དུ|གང་ཞེ|ཅི|ཅིའི|ཇི|སུ|དེ་ཅི|དེ་ཡང་གང)[^།༎]{{0,40}}?(?:ན|ཅེ་ན|ཞེ་ན|སྙམ་ན)[་\s]*{MARK}")
# Likeness and letters of a clause that is a root line, at least; clauses of a stanza that may be none; syllables of a unit.
ALIKE, LETTERS, FEW, LONGEST = 0.8, 8, 2, 300
CLUSTER = r"[།༎](?:[\s་]*[།༎])*+"
_SYLLABLE = re.compile(fixed.TIBETAN_RUN)


def letters(text: Column | str) -> Column:
    """What clauses are compared by: no white space, syllable or closing marks, or brackets."""
    return F.regexp_replace(text, r"[\s་།༎༑༔()\[\]]", "")


def clauses(blocks: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Clauses of blocks, each up to the end of its closing marks, what is left with the last: ``(keys, n, clause)``; joined they are the text."""
    marked = F.split(F.regexp_replace(text, f"({CLUSTER})(?=\\s*\\S)", "$1\u0001"), "\u0001")
    return blocks.select(*keys, F.posexplode(marked).alias("n", "clause"))


def root_lines(root: DataFrame) -> DataFrame:
    """Root lines ``(line, text, alone, first)`` of root blocks ``(pos, text)``: numbered in order, whether they are a block by themselves, whether they begin one. For one root text, a book at most."""
    from pyspark.sql import Window as W

    rows = clauses(root, ["pos"]).withColumn("letters", letters("clause")).where("length(letters) >= 6")
    inside = W.partitionBy("pos")
    rows = rows.withColumns({"alone": F.count("*").over(inside) == 1, "first": F.row_number().over(inside.orderBy("n")) == 1})
    return rows.withColumn("line", F.row_number().over(W.orderBy("pos", "n")) - 1).select("line", F.col("letters").alias("text"), "alone", "first")


def matched_clauses(blocks: DataFrame, root: DataFrame, keys: list[str]) -> DataFrame:
    """Clauses of ``blocks`` with the root line that each is most like (`ALIKE` at least), the first of several; null for none. Each wording is compared once."""
    rows = staged(clauses(blocks, keys).withColumn("letters", letters("clause")))
    words = rows.where(F.length("letters") >= LETTERS).select(F.col("letters").alias("text")).distinct().withColumn("id", F.col("text"))
    found = fuzzy.best_match(words.select("id", "text"), root.select("line", "text"), "id", "line", ALIKE)
    known = root.select("line", "alone")
    return rows.join(found.join(known, "line").select(F.col("id").alias("letters"), "line", "alone"), "letters", "left").select(*keys, "n", "clause", "line", "alone")


@dataclass(frozen=True)
class Clause:
    text: str
    line: int | None
    alone: bool


@dataclass(frozen=True)
class Unit:
    """Clauses of one kind: H heading, V verse, P prose, Q a quotation that stays inline. ``parts`` is how many clauses each of the blocks joined to it has."""

    kind: str
    clauses: tuple[Clause, ...]
    parts: tuple[int, ...] = field(default=())

    @property
    def text(self) -> str:
        return "".join(c.text for c in self.clauses)

    @property
    def syllables(self) -> int:
        return len(_SYLLABLE.findall(self.text))

    def with_(self, other: Unit) -> Unit:
        mine, theirs = self.parts or (len(self.clauses),), other.parts or (len(other.clauses),)
        return replace(self, clauses=self.clauses + other.clauses, parts=mine + theirs)


def stretches(row: tuple[Clause, ...]) -> Iterator[tuple[int, int]]:
    """Where clauses are root lines that follow one another."""
    start = None
    for i, c in enumerate(row):
        follows = start is not None and c.line is not None and c.line == row[i - 1].line + 1
        if start is not None and not follows:
            yield start, i
            start = None
        if start is None and c.line is not None:
            start = i
    if start is not None:
        yield start, len(row)


def cut_quotes(units: list[Unit]) -> list[Unit]:
    """Root lines out of prose: introduced and closed, two in a row or a block by themselves; or the rest of a stanza just before. A homage that opens a block stands alone."""
    out: list[Unit] = []
    for u in units:
        if u.kind != "P":
            out.append(u)
            continue
        row, last = u.clauses, out[-1] if out else None
        spans = [("P", 0, 1)] if HOMAGE.match(row[0].text.lstrip()) and len(row) > 1 else []
        introduced = last is None or last.kind != "P" or bool(INTRODUCES.search(last.text))
        for a, b in stretches(row):
            opens = introduced if a == 0 else bool(INTRODUCES.search(row[a - 1].text))
            closes = b == len(row) or bool(CLOSES.match(row[b].text))
            goes_on = a == 0 and last is not None and last.kind == "V" and last.clauses[-1].line is not None and row[0].line == last.clauses[-1].line + 1
            if goes_on or (opens and closes and (b - a > 1 or row[a].alone)):
                spans.append(("V", a, b))
        at = 0
        for kind, a, b in spans:
            if a >= at:
                out += [Unit("P", row[at:a])] if a > at else []
                out.append(Unit(kind, row[a:b]))
                at = b
        out += [Unit("P", row[at:])] if at < len(row) else []
    return out


def join_verse(units: list[Unit]) -> list[Unit]:
    """A verse of a line or two that goes on with the root where the verse before it ends is the same quotation."""
    out: list[Unit] = []
    for u in units:
        if out and u.kind == out[-1].kind == "V" and len(u.clauses) <= FEW and None not in (out[-1].clauses[-1].line, u.clauses[0].line) and u.clauses[0].line == out[-1].clauses[-1].line + 1:
            out[-1] = replace(out[-1], clauses=out[-1].clauses + u.clauses)
        else:
            out.append(u)
    return out


def demote(units: list[Unit]) -> list[Unit]:
    """A stanza of two lines at most that are none of the root is prose."""
    return [replace(u, kind="P") if u.kind == "V" and len(u.clauses) <= FEW and all(c.line is None for c in u.clauses) else u for u in units]


def inline(units: list[Unit]) -> list[Unit]:
    """Verse that quotes the root is part of the explanation around it."""
    return [replace(u, kind="Q") if u.kind == "V" and any(c.line is not None for c in u.clauses) else u for u in units]


def goes_on(before: Unit, u: Unit) -> bool:
    """Whether prose belongs to the prose before it: the first of points that it announces, a question on it, or the close of what it quotes. Frames begin anew."""
    start = u.text.lstrip()
    if HOMAGE.match(start) or FRAME.match(start) or HOMAGE.match(before.text.lstrip()):
        return False
    tail = "".join(c.text for c in before.clauses[-(before.parts or (len(before.clauses),))[-1]:])
    return bool((FIRST_POINT.match(start) and ANNOUNCES.search(tail)) or ASKS.match(start) or CLOSES.match(start))


def merge(units: list[Unit]) -> list[Unit]:
    out: list[Unit] = []
    after_quote = False
    for u in units:
        prose_before = bool(out) and out[-1].kind == "P"
        start = u.text.lstrip()
        framed = bool(HOMAGE.match(start) or FRAME.match(start))
        joins = prose_before and (u.kind == "Q" or (u.kind == "P" and (goes_on(out[-1], u) or (after_quote and not framed and not FIRST_POINT.match(start)))))
        after_quote = u.kind == "Q"
        u = replace(u, kind="P") if u.kind == "Q" else u
        if joins:
            out[-1] = out[-1].with_(u)
        else:
            out.append(u)
    return out


def within(units: list[Unit], longest: int) -> list[Unit]:
    """Joined prose over so many syllables falls back to the blocks that it was joined of, as many together as fit."""
    out: list[Unit] = []
    for u in units:
        if u.kind != "P" or len(u.parts) < 2 or u.syllables <= longest:
            out.append(u)
            continue
        at, held = 0, None
        for n in u.parts:
            part = Unit("P", u.clauses[at:at + n])
            at += n
            if held is not None and held.syllables + part.syllables <= longest:
                held = held.with_(part)
            else:
                out += [held] if held is not None else []
                held = part
        out.append(held)
    return out


def functional_units(blocks: DataFrame, root: DataFrame, key: str, quotes: str = "separate", longest: int = LONGEST) -> DataFrame:
    """Units ``(key, unit, kind, text)`` of a work's blocks ``(key, pos, kind, text)`` of kinds H, V and P, by a root of `root_lines`.

    In order: root lines are cut out of prose, pieces of one stanza joined, false
    stanzas made prose, quotations put inline (``quotes='inline'``), prose joined
    on what its words say, long units cut back. Clauses are matched with the root
    by a join over all works; what follows runs per work, on its clauses, in one
    scan over works.
    """
    rows = matched_clauses(blocks.where("trim(text) <> ''"), root, [key, "pos", "kind"])

    def lay_out(work: tuple, own: list[tuple]) -> list[tuple]:
        units: list[Unit] = []
        for (_, kind), parts in groupby(own, key=itemgetter(0, 1)):
            units.append(Unit(kind, tuple(Clause(t, line, bool(alone)) for _, _, t, line, alone in parts)))
        steps = [cut_quotes, join_verse, demote, *([inline] if quotes == "inline" else []), merge]
        for step in steps:
            units = step(units)
        units = within(units, longest)
        return [(*work, i, u.kind, "\n".join(c.text.strip() for c in u.clauses) if u.kind == "V" else u.text.strip()) for i, u in enumerate(units)]

    kind = K.StructType([K.StructField(key, blocks.schema[key].dataType), K.StructField("unit", K.IntegerType()), K.StructField("kind", K.StringType()), K.StructField("text", K.StringType())])
    return sequence.by_key(rows, [key], ["pos", "kind", "n"], ["pos", "kind", "clause", "line", "alone"], lay_out, kind)
