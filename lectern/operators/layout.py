"""Layout of notes: numbering zones, trees, placements, bilingual splits and previews."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as K

from lectern.functions import fold, metre
from lectern.functions import text as T
from lectern.operators import sequence
from lectern.operators.sequence import with_field


def zone_ids(rows: DataFrame, keys: list[str], order: str, colophon: Column) -> DataFrame:
    """Ids in four zones: the title (0), front matter (I-n), verses of numbered chapters (c-v, by the number that they close with), and back matter after the colophon (c-a, c-b, …). A verse number that comes again gets x1."""
    w = W.partitionBy(*keys).orderBy(order)
    chapter = F.last(F.nullif(F.regexp_extract("line", r"^## (\d+)\.", 1), F.lit("")), ignorenulls=True).over(w)
    rows = rows.withColumns({"_ch": F.coalesce(chapter, F.lit("0")), "_head": F.rlike("line", F.lit(r"^#")), "_col": F.max(colophon.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)), "_blank": F.trim("line") == ""})
    rows = rows.withColumn("_v", F.regexp_extract("line", r"\|\|\s*(?:\d+[.,])?(\d+)\s*\|\|\s*$", 1))
    body = ~F.col("_head") & ~F.col("_blank")
    front = F.sum((body & (F.col("_ch") == "0")).cast("int")).over(w)
    back = F.sum((body & (F.col("_col") == 1)).cast("int")).over(W.partitionBy(*keys, "_col").orderBy(order))
    again = F.row_number().over(W.partitionBy(*keys, "_ch", "_v").orderBy(order))
    out = F.when(F.rlike("line", F.lit(r"^# \S")), "0").when(F.rlike("line", F.lit(r"^## 0\.")), "I-0").when(F.rlike("line", F.lit(r"^## \d+\.")), F.concat("_ch", F.lit("-0")))
    out = out.when(body & (F.col("_col") == 1), F.concat("_ch", F.lit("-"), F.char(96 + back))).when(body & (F.col("_ch") == "0"), F.concat(F.lit("I-"), front.cast("string")))
    out = out.when(body & (F.col("_v") != ""), F.concat("_ch", F.lit("-"), "_v", F.when(again > 1, F.concat(F.lit("x"), (again - 1).cast("string"))).otherwise("")))
    return rows.withColumn("assigned_id", out).drop("_ch", "_head", "_col", "_blank", "_v")


def parents(headings: DataFrame, keys: list[str], order: str, level: str) -> DataFrame:
    """``parent`` of each heading: the last before it of the level above; none where that level is skipped or there is none."""
    def nest(last: dict | None, n: int, d: int) -> tuple:
        last = {k: v for k, v in (last or {}).items() if k < d}
        return last | {d: n}, last.get(d - 1)
    return sequence.scanned(headings, keys, order, level, "parent", K.LongType(), nest)


def tree_text(nodes: DataFrame, key: str) -> DataFrame:
    """A tree's nodes ``(key, path, label)`` as indented lines, in the order of their decimal paths."""
    steps = F.transform(F.split("path", r"\."), lambda x: x.cast("int"))
    line = F.concat(F.repeat(F.lit("   "), F.size(F.split("path", r"\.")) - 1), F.lit("└─ "), "label")
    ordered = F.array_sort(F.collect_list(F.struct(steps.alias("s"), line.alias("line"))))
    return nodes.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def reordered(nodes: DataFrame, keys: list[str], renumber: bool = False) -> DataFrame:
    """Children by the place of their text; ids stay unless they are renumbered. Nodes without a place keep theirs."""
    w = W.partitionBy(*keys, "parent_id").orderBy(F.coalesce("place", F.col("pos")), "pos")
    rows = nodes.withColumn("order", F.row_number().over(w))
    return rows.withColumn("node_id", F.concat_ws(".", F.nullif("parent_id", F.lit("")), F.col("order").cast("string"))) if renumber else rows


def row_splits(rows: DataFrame, clauses: DataFrame, key: str) -> DataFrame:
    """Rows cut before clauses ``(key, n, clause)``, each of which must be in the row once and in order; ``ok`` tells."""
    asked = clauses.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "clause"))), lambda s: s["clause"]).alias("_c"))
    joined = rows.join(asked, key)
    at = F.transform("_c", lambda c: F.instr("text", c))
    once = F.forall("_c", lambda c: F.length(F.replace(F.col("text"), c)) == F.length("text") - F.length(c))
    joined = joined.withColumn("_at", at).withColumn("ok", once & F.forall("_at", lambda x: x > 0) & (F.col("_at") == F.array_sort("_at")))
    cut = F.concat(F.array(F.lit(1)), F.filter("_at", lambda x: x > 1), F.array(F.length("text") + 1))
    parts = F.transform(F.sequence(F.lit(1), F.size(cut) - 1), lambda i: F.substring(F.col("text"), F.element_at(cut, i), F.element_at(cut, i + 1) - F.element_at(cut, i)))
    return joined.select(key, "ok", F.posexplode(F.when(F.col("ok"), parts).otherwise(F.array("text"))).alias("part", "text"))


def projected_headings(rows: DataFrame, keys: list[str], order: str, node: str) -> DataFrame:
    """Headings where the rows' node changes, unseen ancestors before it; a row that goes back stays where it is and says so."""
    def emit(pdf: pd.DataFrame) -> pd.DataFrame:
        out, seen, now = [], set(), ()
        for r in pdf.sort_values(order).itertuples():
            path = tuple(int(x) for x in getattr(r, node).split(".")) if isinstance(getattr(r, node), str) else now
            back = path < now
            if path != now and not back:
                out += [(*(getattr(r, k) for k in keys), getattr(r, order), ".".join(map(str, path[:n])), False) for n in range(1, len(path) + 1) if path[:n] not in seen]
                seen |= {path[:n] for n in range(1, len(path) + 1)}
                now = path
            elif back:
                out.append((*(getattr(r, k) for k in keys), getattr(r, order), ".".join(map(str, path)), True))
        return pd.DataFrame(out, columns=[*keys, order, "heading", "backward"])
    kinds = dict(rows.dtypes)
    return rows.groupBy(*keys).applyInPandas(emit, ", ".join(f"{c} {kinds[c]}" for c in [*keys, order]) + ", heading string, backward boolean")


def label_places(labels: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Where labels ``(key, n, label)`` stand in a text, each after the one before; -1 from the first that isn't found on for it alone."""
    def place(batches):
        for pdf in batches:
            rows = []
            for k, text, found in zip(pdf[key], pdf["text"], pdf["labels"], strict=True):
                at = 0
                for i, label in enumerate(found):
                    hit = (text or "").find(label, at)
                    rows.append((k, i, label, hit))
                    at = hit + len(label) if hit >= 0 else at
            yield pd.DataFrame(rows, columns=[key, "n", "label", "place"])
    asked = labels.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "label"))), lambda s: s["label"]).alias("labels"))
    return texts.join(asked, key).select(key, "text", "labels").mapInPandas(place, f"{key} {dict(texts.dtypes)[key]}, n int, label string, place int")


def unique_anchor(text: str, start: int, end: int) -> str:
    """The text from ``start``, from ``end`` on lengthened until it occurs once."""
    while end < len(text) and text.count(text[start:end]) > 1:
        end += 1
    return text[start:end]


def unique_anchors(anchors: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Anchors ``(key, anchor)`` lengthened by what follows their first place, until they are once in the text."""
    @F.pandas_udf(K.StringType())
    def longer(a: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([unique_anchor(y, y.find(x), y.find(x) + len(x)) if x and y and x in y else None for x, y in zip(a, t, strict=True)])
    return anchors.join(texts.select(key, F.col("text").alias("_t")), key).withColumn("unique_anchor", longer("anchor", "_t")).drop("_t")


def fuzzy_place(canon: str, query: str, after: int = 0, least: float = 0.5) -> tuple[int | None, float]:
    """Place and share of the longest run of the query's syllables that the text has from a place on."""
    if not query:
        return None, 0.0
    at = canon.find(query, after)
    if at >= 0:
        return at, 1.0
    parts = [s for s in query.split("་") if s] if "་" in query else query.split()
    joint = "་" if "་" in query else " "
    for size in range(len(parts) - 1, 0, -1):
        for i in range(len(parts) - size + 1):
            at = canon.find(joint.join(parts[i:i + size]), after)
            if at >= 0:
                return (at, size / len(parts)) if size / len(parts) >= least else (None, size / len(parts))
    return None, 0.0


def outline_alignment(outline: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Outline entries ``(key, pos, label)`` with the heading candidates that a global alignment pairs them with."""
    def run(batches):
        for pdf in batches:
            rows = []
            for k, a, b in zip(pdf[key], pdf["a"], pdf["b"], strict=True):
                rows += [(k, i, j) for i, j in fold.align_outline(list(a), list(b))]
            yield pd.DataFrame(rows, columns=[key, "entry", "candidate"])
    gather = lambda df, name: df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda s: s["label"]).alias(name))
    return gather(outline, "a").join(gather(candidates, "b"), key).mapInPandas(run, f"{key} {dict(outline.dtypes)[key]}, entry int, candidate int")


def one_blank_around(lines: DataFrame, keys: list[str], order: str, marked: Column) -> DataFrame:
    """Lines with one blank line around each marked one, and no two blank ones in a row."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = lines.withColumn("_m", marked).where("trim(line) <> '' or not _m")
    rows = rows.withColumns({"_prev": F.lag("line").over(w), "_pm": F.lag("_m", 1, False).over(w), "_blank": F.trim("line") == ""})
    rows = rows.where(~(F.col("_blank") & (F.trim(F.coalesce("_prev", F.lit(""))) == "")))
    before = ((F.col("_m") | F.col("_pm")) & F.col("_prev").isNotNull() & (F.trim("_prev") != "") & ~F.col("_blank"))
    return rows.select(*keys, order, F.posexplode(F.when(before, F.array(F.lit(""), "line")).otherwise(F.array("line"))).alias("sub", "line"))


def bilingual_split(blocks: DataFrame, root: DataFrame, separator: str, key: str = "block_id") -> DataFrame:
    """Blocks of root text, separator and translation as translation blocks; ``problem`` tells of one that has not one separator, or whose root isn't the root's block."""
    joined = blocks.join(root.select(key, F.col("text").alias("_root")), key, "left").withColumn("_p", F.split("text", re.escape(separator)))
    own, other = F.trim(F.get("_p", F.lit(0))), F.trim(F.get("_p", F.lit(1)))
    problem = F.when(F.size("_p") != 2, "separators").when(F.col("_root").isNull(), "no root block").when(T.squeeze(own) != T.squeeze("_root"), "root differs")
    return joined.select(key, F.when(problem.isNull(), other).alias("translation"), problem.alias("problem"))


def tag_spans(blocks: DataFrame, keys: list[str], tag: str = "small") -> DataFrame:
    """Spans of a tag's contents in the text without the tags."""
    parts = F.split("text", f"</?{tag}>")
    at = F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("i"), F.array().cast("array<struct<start:int,end:int>>").alias("out")), lambda a, p: F.struct((a["n"] + F.length(p)).alias("n"), (a["i"] + 1).alias("i"), F.when(a["i"] % 2 == 1, F.concat(a["out"], F.array(F.struct(a["n"].alias("start"), (a["n"] + F.length(p)).alias("end"))))).otherwise(a["out"]).alias("out")), lambda a: a["out"])
    return blocks.select(*keys, F.explode(at).alias("s")).select(*keys, "s.*")


def footnoted(wikitext: Column | str) -> Column:
    """Struct of a wiki text with ``<ref>`` as [n], numbered by first use of a content, and the notes in order."""
    t = F.col(wikitext) if isinstance(wikitext, str) else wikitext
    refs = F.regexp_extract_all(t, F.lit(r"(?s)<ref[^>/]*>(.*?)</ref>"), F.lit(1))
    notes = F.array_distinct(refs)
    body = F.aggregate(F.transform(notes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), F.regexp_replace(t, r"<ref[^>/]*>", "<ref>"), lambda s, n: F.replace(s, F.concat(F.lit("<ref>"), n["x"], F.lit("</ref>")), F.concat(F.lit("["), (n["i"] + 1).cast("string"), F.lit("]"))))
    return F.struct(T.unwrap_wikilinks(body).alias("text"), notes.alias("notes"))


def one_paragraph_each(items: DataFrame, key: str, order: str, title: Column) -> DataFrame:
    """A note of a title and a paragraph an item, and the line of each item in it."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return items.withColumn("line_no", 3 + F.coalesce(F.sum(F.size(F.split("text", "\n")) + 1).over(w), F.lit(0))).withColumn("title", title)


def broken_lines(text: Column | str, pattern: str) -> Column:
    """A line break after each match; a space there becomes the break."""
    return F.regexp_replace(text, f"({pattern}) ?(?!$)", "$1\n")


def anchored(lines: DataFrame, keys: list[str], order: str, heading: str, anchor: Column) -> DataFrame:
    """An anchor line before each heading of a kind that has none."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = lines.withColumn("_a", F.when(F.rlike("line", F.lit(heading)), anchor)).withColumn("_p", F.lag("line").over(w))
    return rows.select(*keys, order, F.posexplode(F.when(F.col("_a").isNotNull() & ~F.coalesce(F.col("_p") == F.col("_a"), F.lit(False)), F.array("_a", "line")).otherwise(F.array("line"))).alias("sub", "line"))


def assembled(sections: DataFrame, key: str, drop: list[str]) -> DataFrame:
    """Sections of a note in order, without some."""
    kept = sections.where(~F.lower("section").isin([d.lower() for d in drop]))
    return kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), "\n\n").alias("text"))


def verse_units(clauses: DataFrame, key: str, low: int = metre.LOW, high: int = metre.HIGH, least: int = metre.LEAST, longest: int = metre.LONGEST) -> DataFrame:
    """Units of a text's clauses ``(key, pos, size, closed, final)``: verse lines by their metre, and sentences between them.

    Where the clauses have them, ``ending`` (their last syllables) tells refrains,
    ``quotes`` lines that close a quotation, and ``cut`` the ends of paragraphs.
    """
    for name, kind in (("ending", "string"), ("quotes", "boolean"), ("cut", "boolean")):
        if name not in clauses.columns:
            clauses = clauses.withColumn(name, F.lit("" if kind == "string" else False).cast(kind))

    names = [c for c in clauses.columns if c != key]
    at = [names.index(c) for c in ("size", "closed", "final", "ending", "quotes", "cut")]

    def lay_out(text: tuple, own: list[tuple]) -> list[tuple]:
        size, closed, final, ending, quotes, cut = ([row[i] for row in own] for i in at)
        verse = metre.verse_lines(size, closed, final, ending, quotes, low, high, least)
        return [(*text, *row, unit, "verse" if v else "prose") for row, unit, v in zip(own, metre.units(size, verse, final, cut, longest), verse, strict=True)]

    clauses = clauses.select(key, *names)
    return sequence.by_key(clauses, [key], ["pos"], names, lay_out, K.StructType([*with_field(clauses, "unit", K.IntegerType()).fields, K.StructField("kind", K.StringType())]))


def moved_up(lines: DataFrame, keys: list[str], order: str, marked: Column) -> DataFrame:
    """Marked lines, such as transclusions, put before the run of lines that they stand in; their order stays."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = lines.withColumns({"_m": marked, "_blank": F.trim("line") == ""})
    rows = rows.withColumn("_run", F.sum((F.col("_blank") != F.lag("_blank", 1, True).over(w)).cast("int")).over(w))
    return rows.withColumn("new_line", F.row_number().over(W.partitionBy(*keys).orderBy("_run", (~F.col("_m")).cast("int"), order))).drop("_m", "_blank", "_run")
