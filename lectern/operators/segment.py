"""Cutting, joining and editing texts; what is order-dependent runs per text in Arrow batches."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as K

from lectern.functions import cuts, fixed
from lectern.operators.sequence import with_field

_TIBETAN = re.compile(fixed.TIBETAN_RUN)


def syllable_size(text: str) -> int:
    """Tibetan syllables, or words where there are none."""
    return len(_TIBETAN.findall(text)) or len(text.split())


def rule_cuts(text: str, rules: tuple[cuts.Rule, ...] = cuts.GENERAL) -> list[tuple[int, str]]:
    """Places of cuts with the first rule that makes each; none at the ends, after a syllable mark, or inside brackets."""
    found = cuts.cut(text, rules, in_brackets=False)
    order = [r.name for r in rules]
    named = {at: min((x[at] for x in (found.begins, found.ends) if at in x), key=order.index) for at in found.places}
    return sorted(named.items())


def valid_cut(text: str, at: int) -> bool:
    return cuts.Line(text).may_cut(at)


def named_pieces(docs: DataFrame, key: str, rules: tuple[cuts.Rule, ...] = cuts.TIBETAN, structural: bool = False, text: str = "text") -> DataFrame:
    """Pieces of each text by the ordered rules: ``(key, pos, start, end, begins, ends, piece)``. What a weak rule would cut is a row without a piece, with its place and name."""
    def run(batches):
        for pdf in batches:
            rows = []
            for k, t in zip(pdf[key], pdf[text], strict=True):
                t = t if isinstance(t, str) else ""
                found = cuts.cut(t, rules, structural)
                rows += [(k, i, a, b, begins, ends, t[a:b]) for i, (a, b, begins, ends) in enumerate(cuts.pieces(t, found))]
                rows += [(k, -1, at, at, name, None, None) for at, name in found.candidates]
            yield pd.DataFrame(rows, columns=[key, "pos", "start", "end", "begins", "ends", "piece"])
    return docs.select(key, text).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, pos int, start int, end int, begins string, ends string, piece string")


def clauses(text: Column | str) -> Column:
    """Spans up to and with a closing mark."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"[^།.!?]+[།.!?]*\s*"), F.lit(0)), lambda x: F.trim(x)), lambda x: x != "")


def split_at(text: str, places: list[int]) -> list[str]:
    edges = [0, *places, len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]


_STRONG, _WEAK, _ANY = (re.compile(p) for p in (r"།\s*།\s*|[.!?]+\s+", r"།\s*|[,;:]\s+", r"\s+|་"))


def capped(text: str, most: int) -> list[str]:
    """Pieces of at most ``most`` syllables, cut after the strongest mark that fits, else after a space."""
    unit = _TIBETAN if _TIBETAN.search(text) else re.compile(r"\S+")
    starts = [m.start() for m in unit.finditer(text)]
    marks = [[m.end() for m in p.finditer(text) if m.end() < len(text)] for p in (_STRONG, _WEAK, _ANY)]
    out, at, used = [], 0, 0
    while len(starts) - used > most:
        limit = starts[used + most]  # a piece may reach up to the next syllable
        best = 0
        for ends in marks:
            k = bisect_right(ends, limit) - 1
            if k >= 0 and ends[k] > at:
                best = ends[k]
                break
        if not best:
            break
        out.append(text[at:best])
        at, used = best, bisect_left(starts, best)
    return [*out, text[at:]]


def merged_short(pieces: list[str], least: int, most: int) -> list[str]:
    """Pieces under ``least`` joined to the one before while the two stay within ``most``."""
    out: list[list] = []
    for p in pieces:
        n = syllable_size(p)
        if out and (n < least or out[-1][1] < least) and n + out[-1][1] <= most:
            out[-1][0].append(p)
            out[-1][1] += n
        else:
            out.append([[p], n])
    return ["".join(parts) for parts, _ in out]


# Characters from which a text is cut, and the share of it before a cut, at least and at most.
LONG, EARLIEST, LATEST = 800, 0.2, 0.85


def halved(text: str, least: int = LONG, at: str = r"།\s*།") -> list[str]:
    """A text of ``least`` characters or more cut just after the double mark nearest its middle, and its parts again; white space around a cut goes.

    The marks are looked for once; what is cut further are spans between them.
    """
    marks = [m.end() for m in re.finditer(at, text)]
    todo, out = [(0, len(text))], []
    while todo:
        lo, hi = todo.pop()
        size = hi - lo
        inner = marks[bisect_right(marks, lo + EARLIEST * size):bisect_left(marks, lo + LATEST * size)] if size >= least else []
        k = bisect_left(inner, lo + size / 2)
        near = sorted(inner[max(0, k - 1):k + 1], key=lambda e: abs(e - lo - size / 2))
        left = len(text[lo:near[0]].rstrip()) if near else 0
        right = len(text[near[0]:hi].lstrip()) if near else 0
        if left and right:
            todo += [(hi - right, hi), (lo, lo + left)]
        else:
            out.append(text[lo:hi])
    return out


def at_connectors(text: str, most: int, connectors=("and", "but", "or", "because", "དང་", "ནས", "སྟེ")) -> list[str]:
    """A text over ``most`` syllables cut before connectors, each part as long as it may be."""
    if syllable_size(text) <= most:
        return [text]
    at = [m.start() for m in re.finditer("|".join(rf"(?<=\s){re.escape(c)}(?=\s)" if c.isascii() else re.escape(c) for c in connectors), text) if m.start()]
    out, start, last = [], 0, None
    for a in [*at, len(text)]:
        if syllable_size(text[start:a]) > most and last is not None and last > start:
            out.append(text[start:last])
            start = last
        last = a
    return [*out, text[start:]]


def stanzas(lines: list[str], low: int = 6, high: int = 11) -> list[tuple[int, int]]:
    """Runs of 2 to 4 lines of one length, 6 to 11 syllables each."""
    sizes, out, i = [syllable_size(x) for x in lines], [], 0
    while i < len(lines):
        n = 1
        while n < 4 and i + n < len(lines) and sizes[i + n] == sizes[i]:
            n += 1
        if n >= 2 and low <= sizes[i] <= high:
            out.append((i, i + n))
            i += n
        else:
            i += 1
    return out


def segments(docs: DataFrame, key: str, most: int = 40, least: int = 4, text: str = "text") -> DataFrame:
    """Texts cut by rules, capped, and short pieces joined: ``(key, pos, start, end, segment)``; joined again they are the text."""
    def run(batches):
        for pdf in batches:
            rows = []
            for k, t in zip(pdf[key], pdf[text], strict=True):
                t = t if isinstance(t, str) else ""
                pieces = merged_short([q for p in split_at(t, [c for c, _ in rule_cuts(t)]) for q in capped(p, most)], least, most) if t else []
                at = 0
                for i, p in enumerate(pieces):
                    rows.append((k, i, at, at + len(p), p))
                    at += len(p)
            yield pd.DataFrame(rows, columns=[key, "pos", "start", "end", "segment"])
    return docs.select(key, text).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, pos int, start int, end int, segment string")


def stanza_cut(text: Column | str) -> Column:
    """A stanza's lines: after a closing pair of marks, or a single one inside the line."""
    return F.filter(F.transform(F.split(F.regexp_replace(text, r"(།\s*།|།)\s*(?=[^\s།])", "$1\n"), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def verse_share(clause_rows: DataFrame, keys: list[str], order: str, size: str) -> DataFrame:
    """Share of syllables in clauses as long as a neighbour, and the kind that it makes: verse, mixed or prose."""
    w = W.partitionBy(*keys).orderBy(order)
    like = F.coalesce(F.lag(size).over(w) == F.col(size), F.lit(False)) | F.coalesce(F.lead(size).over(w) == F.col(size), F.lit(False))
    rows = clause_rows.withColumn("_in", F.when(like, F.col(size)).otherwise(0))
    out = rows.groupBy(*keys).agg(F.sum(size).alias("syllables"), F.round(F.sum("_in") / F.greatest(F.sum(size), F.lit(1)), 6).alias("share"))
    return out.withColumn("kind", F.when(F.col("share") >= 0.8, "verse").when(F.col("share") >= 0.3, "mixed").otherwise("prose"))


def spacing_hits(lines: DataFrame, keys: list[str], text: str = "line") -> DataFrame:
    """Spacing defects of a line with their span and the edit that mends each."""
    patterns = (("camel_join", "high", r"(?<=[^\W\d_])(?=[^\W\d_])", "insert"), ("punct_no_space", "high", r"(?<=[,;:!?])(?=[^\W\d_])", "insert"), ("double_space", "high", r"(?<=\S) {2,}(?=\S)", "delete"), ("space_before_punct", "high", r"(?<=\S) +(?=[,;:.!?](?:\s|$))", "delete"), ("edge_space", "review", r"^\s+|\s+$", "delete"), ("odd_space", "review", "[  -​ 　﻿]", "delete"))
    compiled = [(n, c, re.compile(p), op) for n, c, p, op in patterns]

    def run(batches):
        for pdf in batches:
            rows = []
            for i, t in enumerate(pdf[text]):
                t = t if isinstance(t, str) else ""
                for name, conf, p, op in compiled:
                    for m in p.finditer(t):
                        a, b = m.span()
                        if name == "camel_join" and not (t[a - 1].islower() and t[a].isupper()):
                            continue
                        if name == "edge_space" and (a == b or b - a == len(t)):
                            continue
                        rows.append((*(pdf[k].iloc[i] for k in keys), name, conf, op, a + (name == "double_space"), b))
            yield pd.DataFrame(rows, columns=[*keys, "category", "confidence", "op", "start", "end"])

    kinds = dict(lines.dtypes)
    return lines.select(*keys, text).mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", category string, confidence string, op string, start int, end int")


def two_word_splits(words: DataFrame, vocabulary: DataFrame, least: int = 2) -> DataFrame:
    """Unknown words that are two known ones run together; the split whose rarer half is the most frequent, the first on a tie."""
    unknown = words.select("word").distinct().join(vocabulary.select("word"), "word", "left_anti")
    n = F.length("word")
    cut = unknown.where(n >= 2 * least).select("word", F.explode(F.sequence(F.lit(least), n - least)).alias("k"))
    cut = cut.select("word", "k", F.expr("left(word, k)").alias("head"), F.expr("substring(word, k + 1)").alias("tail"))
    both = cut.join(vocabulary.select(F.col("word").alias("head"), F.col("count").alias("_h")), "head").join(vocabulary.select(F.col("word").alias("tail"), F.col("count").alias("_t")), "tail")
    return both.groupBy("word").agg(F.max_by(F.struct("head", "tail"), F.struct(F.least("_h", "_t"), -F.col("k"))).alias("s")).select("word", "s.head", "s.tail")


def adjusted(start: Column, end: Column, ops: Column, continuous: bool) -> Column:
    """A span after edits ``array<struct<type, start, end, text>>``, the last place first and deletions before insertions of a place.

    An insertion at the end of a continuous span is in it, at the end of an annotation it is not. A span of which nothing is left is null.
    """
    order = F.array_sort(F.transform(ops, lambda o: F.struct((-o["start"]).alias("s"), F.when(o["type"] == "delete", 0).otherwise(1).alias("k"), o["end"].alias("end"), F.length(F.coalesce(o["text"], F.lit(""))).alias("n"))))

    def step(acc: Column, o: Column) -> Column:
        p, q, n, a, b = -o["s"], o["end"], o["n"], acc["a"], acc["b"]
        stays = (p > a) | ((p == 0) & (a == 0)) if continuous else p > a
        reach = p <= b if continuous else p < b
        moved = lambda x: x - F.greatest(F.lit(0), F.least(x, q) - p)
        gone = (p <= a) & (q >= b)
        ins_a, ins_b = F.when(stays, a).otherwise(a + n), F.when(stays & ~reach, b).otherwise(b + n)
        del_a = F.when(gone, F.lit(None)).when(p < a, moved(a)).otherwise(a)
        del_b = F.when(gone, F.lit(None)).when(p < b, moved(b)).otherwise(b)
        adds = o["k"] == 1
        return F.struct(F.when(a.isNull(), a).when(adds, ins_a).otherwise(del_a).alias("a"), F.when(a.isNull(), b).when(adds, ins_b).otherwise(del_b).alias("b"))

    done = F.aggregate(order, F.struct(start.cast("int").alias("a"), end.cast("int").alias("b")), step)
    return F.struct(done["a"].alias("start"), done["b"].alias("end"))


def edited_text(text: Column, ops: Column) -> Column:
    """The text after the same edits."""
    order = F.array_sort(F.transform(ops, lambda o: F.struct((-o["start"]).alias("s"), F.when(o["type"] == "delete", 0).otherwise(1).alias("k"), o["end"].alias("end"), F.coalesce(o["text"], F.lit("")).alias("t"))))
    return F.aggregate(order, text, lambda t, o: F.concat(F.substring(t, F.lit(1), -o["s"]), F.when(o["k"] == 1, o["t"]).otherwise(F.lit("")), F.substring(t, F.when(o["k"] == 1, -o["s"]).otherwise(o["end"]) + 1, F.length(t))))


def issue_merge(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Issues of a new scan with the id and decision of the old one; open ones that aren't found any more are gone."""
    a, b = old.select(*key, "issue_id", "status"), new.select(*key).distinct().withColumn("_new", F.lit(True))
    both = a.join(b, key, "full_outer")
    status = F.when(F.col("_new") & F.col("issue_id").isNull(), "open").when(F.col("_new"), F.col("status")).when(F.col("status") == "open", "gone").otherwise(F.col("status"))
    return both.select(*key, F.coalesce("issue_id", F.concat_ws("-", *(F.col(k).cast("string") for k in key))).alias("issue_id"), status.alias("status"))


def applied_groups(blocks: DataFrame, merges: DataFrame, key: str) -> DataFrame:
    """Blocks after merges of runs ``(key, first, last)``: one row a run, the others as they are."""
    hit = blocks.join(merges, key, "left").withColumn("_in", (F.col("pos") >= F.col("first")) & (F.col("pos") <= F.col("last")))
    own = hit.groupBy(key, "pos").agg(F.max(F.when(F.col("_in"), F.col("first"))).alias("_f"), F.first("text").alias("text")).withColumn("_g", F.coalesce("_f", "pos"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), " ")
    return own.groupBy(key, F.col("_g").alias("pos")).agg(joined.alias("text"), F.count("*").alias("n"))


def valid_ops(ops: DataFrame, key: str) -> DataFrame:
    """Merge operations ``(key, op_id, first, last)`` that are rising and whose blocks no valid one before has claimed."""
    def claim(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, ok = set(), []
        pdf = pdf.sort_values("op_id")
        for a, b in zip(pdf["first"], pdf["last"], strict=True):
            span = set(range(a, b + 1))
            good = b > a and not span & taken
            taken |= span if good else set()
            ok.append(good)
        return pdf.assign(valid=ok)
    return ops.groupBy(key).applyInPandas(claim, with_field(ops, "valid", K.BooleanType()))


def with_transclusions(rows: DataFrame, keys: list[str], order: str, link: Column) -> DataFrame:
    """A link and a blank line before each line that asks for one, unless the link stands there already."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("_l", link).withColumn("_there", F.lag("line", 2).over(w))
    parts = F.when(F.col("_l").isNotNull() & ~F.coalesce(F.col("_there") == F.col("_l"), F.lit(False)), F.array("_l", F.lit(""), "line")).otherwise(F.array("line"))
    return rows.select(*keys, F.col(order).alias("src_line"), F.posexplode(parts).alias("sub", "line"))


def without_transclusions(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Lines that are no transclusions, runs of blank ones as one."""
    kept = rows.where(~F.rlike("line", F.lit(r"^\s*!\[\[[^\]]*\]\]\s*$")))
    w = W.partitionBy(*keys).orderBy(order)
    return kept.withColumn("_b", (F.trim("line") == "") & (F.trim(F.lag("line", 1, "x").over(w)) == "")).where("not _b").drop("_b")


def inserted_headings(lines: DataFrame, headings: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Headings ``(keys, at, heading)`` put before the lines that they name."""
    both = lines.select(*keys, F.col(order).cast("double").alias("pos"), "line").union(headings.select(*keys, (F.col("at") - 0.5).alias("pos"), F.col("heading").alias("line")))
    return both.withColumn("new_line", F.row_number().over(W.partitionBy(*keys).orderBy("pos", "line"))).drop("pos")


def shifted_runs(runs: Column, pos: Column | int, removed: Column | int, added: Column | int) -> Column:
    """Formatting runs after an edit at a place."""
    p, r, a = (F.lit(x) if isinstance(x, int) else x for x in (pos, removed, added))
    move = lambda x: F.when(x <= p, x).when(x >= p + r, x - r + a).otherwise(p + a)
    return F.transform(runs, lambda s: F.struct(move(s["start"]).alias("start"), move(s["end"]).alias("end"), s["style"].alias("style")))


def unique_context(lines: DataFrame, contexts: DataFrame, keys: list[str]) -> DataFrame:
    """The line that holds a context, where it is the only one."""
    hit = lines.join(contexts, keys).where(F.contains("line", F.col("context")))
    return hit.groupBy(*keys, "context").agg(F.count("*").alias("n"), F.min("line_no").alias("line_no")).where("n = 1").drop("n")


def announcement_start(lines: DataFrame, titles: DataFrame, keys: list[str], marker: str, ahead: int = 30) -> DataFrame:
    """The first prose line within 30 of a title that has a division mark and a word of the title, else the first prose line."""
    near = titles.withColumn("line_no", F.explode(F.sequence(F.col("title_line") + 1, F.col("title_line") + ahead))).join(lines, [*keys, "line_no"]).where(~F.rlike("line", F.lit(r"^\s*(#.*)?$")))
    rank = F.when(F.rlike("line", F.lit(marker)) & F.exists(F.split("title", r"\s+"), lambda w: F.contains(F.col("line"), w)), 0).otherwise(1)
    return near.groupBy(*keys, "title_line").agg(F.min(F.struct(rank.alias("rank"), "line_no")).alias("s")).select(*keys, "title_line", "s.line_no", (F.col("s.rank") == 0).alias("announced"))


def first_wrap(text: Column, term: str, before: str, after: str) -> Column:
    """The first place of a term in marks."""
    at = F.instr(text, term)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(before + term + after), F.substring(text, at + len(term), F.length(text)))).otherwise(text)


def simulated(spans: DataFrame, ops: DataFrame, key: str) -> DataFrame:
    """Line spans ``(key, start, end)`` of a content after the edits ``(key, ops)``; if they tiled it before they tile it after, which `checks.tiling` can prove."""
    both = spans.join(ops, key, "left")
    none = F.array().cast(dict(ops.dtypes)["ops"])
    return both.withColumn("_s", adjusted(F.col("start"), F.col("end"), F.coalesce("ops", none), True)).select(key, *(c for c in spans.columns if c not in (key, "start", "end")), F.col("_s.start").alias("start"), F.col("_s.end").alias("end"))
