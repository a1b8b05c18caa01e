"""Joins and alignments of texts, blocks and references."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import blocks, letters, windows
from lectern.functions import text as T
from lectern.sources.stage import staged, tasks_for


def full_outer(source: DataFrame, target: DataFrame, key: str = "block_id") -> DataFrame:
    """Blocks of both sides by id. An empty text is a missing one; the note names the side that is missing."""
    a = source.select(key, F.col("text").alias("source_text"))
    b = target.select(key, F.col("text").alias("target_text"))
    both = a.join(b, key, "full_outer").select(key, F.coalesce("source_text", F.lit("")).alias("source_text"), F.coalesce("target_text", F.lit("")).alias("target_text"))
    note = F.when((F.col("source_text") != "") & (F.col("target_text") != ""), "").when(F.col("source_text") != "", "target-only-missing").otherwise("source-only-missing")
    return both.withColumn("notes", note)


def paired_rows(rows: DataFrame, targets: DataFrame, corrections: DataFrame, key: str = "row") -> DataFrame:
    """Row n with row n, unless a correction names another."""
    named = rows.join(corrections.select(key, F.col("target").alias("corrected")), key, "left").withColumn("target", F.coalesce("corrected", key))
    return named.drop("corrected").join(targets.select(F.col(key).alias("target"), F.col("text").alias("target_text")), "target", "left")


def by_transclusion(translation: DataFrame, root: DataFrame) -> DataFrame:
    """Translation blocks with the root block that each names."""
    return translation.where("transcluded_id <> ''").join(root.select(F.col("block_id").alias("transcluded_id"), F.col("text").alias("root_text")), "transcluded_id", "left")


def forward_filled(rows: DataFrame, keys: list[str], order: str, marker: Column, out: str) -> DataFrame:
    """The last marker that is not null at or before each row of its group."""
    return rows.withColumn(out, F.last(marker, ignorenulls=True).over(W.partitionBy(*keys).orderBy(order)))


def scope_pairs(rows: DataFrame, keys: list[str], order: str, is_marker: Column, marker: str, item: str) -> DataFrame:
    """Items with the markers that they stand under; markers that follow each other directly are one group."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("_m", is_marker).withColumn("_g", F.sum((F.col("_m") & ~F.lag("_m", 1, False).over(w)).cast("int")).over(w))
    marks = rows.where("_m").select(*keys, "_g", F.col(item).alias(marker))
    return rows.where("not _m and _g > 0").select(*keys, "_g", item).join(marks, [*keys, "_g"]).select(*keys, marker, item).distinct()


def passages(rows: DataFrame, keys: list[str], order: str, marker: Column, text: str) -> DataFrame:
    """Text after each marker up to the next, as the marker's; what comes again is added."""
    filled = forward_filled(rows.withColumn("_m", marker), keys, order, F.col("_m"), "ref").where("_m is null and ref is not null")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda s: s[text]), "\n")
    return filled.groupBy(*keys, "ref").agg(joined.alias("passage"), F.count("*").alias("n_lines"))


def blocks_under(rows: DataFrame, keys: list[str], order: str, is_marker: Column, marker_value: str, value: str, block: str) -> DataFrame:
    """Blocks under the first group of markers that has a value, up to the next marker."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("_m", is_marker).withColumn("_g", F.sum((F.col("_m") & ~F.lag("_m", 1, False).over(w)).cast("int")).over(w))
    first = rows.where(F.col("_m") & (F.col(marker_value) == value)).groupBy(*keys).agg(F.min("_g").alias("_g"))
    return rows.where("not _m").join(first, [*keys, "_g"]).select(*keys, block).distinct()


def ancestors(node: Column | str) -> Column:
    """The node and all nodes above it: ``1.2.3`` gives 1.2.3, 1.2 and 1."""
    parts = F.split(node, r"\.")
    return F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."))


def under(nodes: DataFrame, targets: DataFrame, node: str = "node", target: str = "target") -> DataFrame:
    """Nodes with every target that is the node or above it: an equi-join on ancestors in place of a prefix comparison of all pairs."""
    spread = nodes.withColumn("_up", F.explode(ancestors(node)))
    return spread.join(targets, spread["_up"] == targets[target]).drop("_up")


def packet(slots: DataFrame, claims: DataFrame) -> DataFrame:
    """``(slot, target)`` with the claims ``(claim_id, node)`` under each target; slots without one are gaps."""
    found = under(claims, slots).select("slot", "claim_id", F.lit("mapped").alias("kind")).distinct()
    gaps = slots.select("slot").distinct().join(found.select("slot").distinct(), "slot", "left_anti").select("slot", F.lit(None).cast("string").alias("claim_id"), F.lit("gap").alias("kind"))
    return found.union(gaps)


def capped(hits: DataFrame, key: str, order: list, most: int) -> DataFrame:
    return hits.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("rank") <= most)


def best_windows(queries: DataFrame, texts: DataFrame, on: str) -> DataFrame:
    """Of the runs of about a line's words in a passage the one most like it: ``(line, passage)`` by ``on``; other columns of the queries stay.

    The lines of a passage go to it together, so it is sent and read once.
    """
    extra = [c for c in queries.columns if c not in (on, "line")]

    def find(batches):
        for pdf in batches:
            rows = []
            for key, asked, text in zip(pdf[on], pdf["asked"], pdf["passage"], strict=True):
                passage = windows.Passage(text or "")
                rows += [(key, *(q[c] for c in extra), q["line"], *passage.best(q["line"] or "")) for q in asked]
            yield pd.DataFrame(rows, columns=[on, *extra, "line", "score", "window"])
    kinds = ", ".join(f"{c} {dict(queries.dtypes)[c]}" for c in (on, *extra))
    asked = queries.groupBy(on).agg(F.collect_list(F.struct("line", *extra)).alias("asked"))
    return asked.hint("merge").join(texts, on).select(on, "asked", "passage").mapInPandas(find, f"{kinds}, line string, score double, window string")


#: Texts of a batch that are Python objects at a time.
CONCORDANCE_ROWS = 64


def concordance(pairs: DataFrame, min_overlap: int = 8) -> DataFrame:
    """Letters of two cuts of a text in common, by row and block: ``(work, a, b)`` are arrays of texts; a pair needs ``min_overlap`` letters or a whole side."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CONCORDANCE_ROWS):
                rows = []
                for work, a, b in zip(*(c.to_pylist() for c in batch.slice(start, CONCORDANCE_ROWS).columns), strict=True):
                    la, lb = (["".join(filter(str.isalpha, t)) for t in x] for x in (a, b))
                    own_a, own_b = (np.repeat(np.arange(len(x)), [len(t) for t in x]) for x in (la, lb))
                    met = [own_a[x:x + n] * len(lb) + own_b[y:y + n] for x, y, n in blocks.matching_blocks("".join(la), "".join(lb))]
                    pairs, letters = np.unique(np.concatenate(met) if met else np.zeros(0, np.int64), return_counts=True)
                    for at, n in zip(pairs.tolist(), letters.tolist(), strict=True):
                        i, j = divmod(at, len(lb))
                        if n >= min_overlap or n in (len(la[i]), len(lb[j])):
                            rows.append((work, i, j, n))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(shape.types)], schema=shape)
    shape = pa.schema([("work", pa.string()), ("row", pa.int32()), ("block", pa.int32()), ("letters", pa.int32())])
    return pairs.select("work", "a", "b").mapInArrow(run, "work string, row int, block int, letters int")


def projected_spans(spans: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Spans of one version of a text on another, the smallest that cover what is left of them: ``(key, start, end)`` and ``(key, a, b)``; null where nothing is."""
    def run(batches):
        for pdf in batches:
            rows = []
            for k, a, b, asked in zip(pdf[key], pdf["a"], pdf["b"], pdf["asked"], strict=True):
                own = [(s["start"], s["end"]) for s in asked]
                rows += [(k, *span, *(to or (None, None))) for span, to in zip(own, letters.projected(a or "", b or "", own), strict=True)]
            yield pd.DataFrame(rows, columns=[key, "start", "end", "to_start", "to_end"]).astype({"to_start": "Int64", "to_end": "Int64"})
    asked = spans.groupBy(key).agg(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))).alias("asked"))
    return asked.hint("merge").join(texts, key).select(key, "a", "b", "asked").mapInPandas(run, f"{key} {dict(spans.dtypes)[key]}, start int, end int, to_start int, to_end int")


#: Levels of the powers of two that a span of longs can need.
LEVELS = 62


def _at(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value.cast("long"), level.cast("int"))


def _cover(start: Column, end: Column) -> Column:
    """The fewest intervals of a power of two that make up the half-open span, two a level at most, as ``(level, place)``; of an empty span the interval of one at its start."""
    last = F.greatest(end, start + 1)
    levels = F.sequence(F.lit(0), F.least(F.lit(LEVELS), F.length(F.bin(F.greatest(last - start, F.lit(1))))))

    def of(level: Column) -> Column:
        # what earlier levels have left of the span, in intervals of this level: from the start rounded up to the end rounded down
        low, high = -_at(-start, level), _at(last, level)
        node = lambda place: F.struct(level.cast("int").alias("level"), place.cast("long").alias("place"))
        left = F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), node(low))
        right = F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), node(high - 1))
        return F.array(left, right)
    return F.array_compact(F.flatten(F.transform(levels, of)))


def _power(start: Column, end: Column) -> Column:
    """The power of two that is a span's length or the next above it."""
    return F.length(F.bin(F.greatest(end - start, F.lit(1)) - 1))


def _met_in_cells(a: DataFrame, b: DataFrame, key: str, power: int) -> DataFrame:
    """`overlap_join` of spans no longer than a power of two: of those over half as long that touch a cell, no part is without overlaps there for long, so few pairs meet in vain."""
    cell = lambda place: _at(place, F.lit(power))
    touched = lambda start, end: F.explode(F.sequence(cell(start), cell(F.greatest(end, start + 1) - 1)))
    left = a.withColumn("_cell", touched(F.col("start"), F.col("end")))
    right = b.select(key, *(F.col(c).alias(f"{c}_b") for c in b.columns if c != key)).withColumn("_cell", touched(F.col("start_b"), F.col("end_b")))
    met = left.hint("merge").join(right, [key, "_cell"]).where("start < end_b and end > start_b")
    return met.where(cell(F.greatest("start", "start_b")) == F.col("_cell")).drop("_cell")


def overlap_join(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Half-open spans of two tables that overlap, by key, however long they are.

    A span is made up of intervals of powers of two, two a level at most, so one
    of length n has no more than 2 log n rows. Of two such intervals that meet,
    one holds the other: each of a span's intervals is also listed by those that
    hold it and that the other table has levels for, and the join is on equal
    intervals. Each pair is kept once, where its first common place lies. The
    intervals of both tables are written once. Spans of about one length (over
    half of a power of two, and no more than it) are listed by the cells of that
    power that they touch, two at most, and nothing is written.
    """
    powers = {r[0] for df in (a, b) for r in df.where("start is not null and `end` is not null").select(_power(F.col("start"), F.col("end"))).distinct().collect()}
    if len(powers) == 1:
        return _met_in_cells(a, b, key, powers.pop())
    left = staged(a.withColumn("_piece", F.explode(_cover(F.col("start"), F.col("end")))))
    right = staged(b.select(key, *(F.col(c).alias(f"{c}_b") for c in b.columns if c != key)).withColumn("_piece", F.explode(_cover(F.col("start_b"), F.col("end_b")))))

    def above(df: DataFrame, levels: list[int]) -> DataFrame:
        higher = F.array(*map(F.lit, levels)).cast("array<int>")
        up = F.transform(F.filter(higher, lambda n: n >= F.col("_piece.level")), lambda n: F.struct(n.alias("level"), _at(F.col("_piece.place"), n - F.col("_piece.level")).alias("place")))
        return df.withColumn("_node", F.explode(up))

    levels = lambda df: sorted(r[0] for r in df.select("_piece.level").distinct().collect())  # noqa: E731  62 at most
    as_b = lambda df: df.withColumnRenamed("_piece", "_piece_b")
    # what the pieces of spans come to can't be told from the tables' sizes, so neither side is broadcast
    one = above(left, levels(right)).hint("merge").join(as_b(right.withColumn("_node", F.col("_piece"))), [key, "_node"])
    two = as_b(above(right, levels(left)).where("_node.level > _piece.level")).hint("merge").join(left.withColumn("_node", F.col("_piece")), [key, "_node"])
    columns = [c for c in one.columns if not c.startswith("_")]
    both = one.select(*columns, "_piece", "_piece_b").unionByName(two.select(*columns, "_piece", "_piece_b"))
    begin = lambda p: F.call_function("shiftleft", F.col(f"{p}.place"), F.col(f"{p}.level"))
    inside = both.where("start < end_b and end > start_b")
    return inside.where(F.greatest("start", "start_b") == F.greatest(begin("_piece"), begin("_piece_b"))).select(*columns)


def as_of(rows: DataFrame, nodes: DataFrame, keys: list[str], at: str, out: str) -> DataFrame:
    """Each row with the last node that starts at or before it; none before the first. One sort of both sides together."""
    names = [c for c in rows.columns if c not in keys]
    left = rows.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*names).alias("_row"), F.lit(None).cast(dict(nodes.dtypes)[out]).alias("_node"))
    right = nodes.select(*keys, F.col(at).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(dict(left.dtypes)["_row"]).alias("_row"), F.col(out).alias("_node"))
    w = W.partitionBy(*keys).orderBy("_at", "_side")
    return left.union(right).withColumn(out, F.last("_node", ignorenulls=True).over(w)).where("_side = 1").select(*keys, "_row.*", out)


def nearest(rows: DataFrame, key: str, line: str, target: str) -> DataFrame:
    """Of the matching lines of a key the one nearest to a target line, the lower on a tie."""
    return rows.groupBy(key).agg(F.min_by(line, F.struct(F.abs(F.col(line) - F.col(target)), F.col(line))).alias(line))


#: Rows of edges that one task sorts.
BACK_ROWS = 500_000


def back_references(edges: DataFrame, order: DataFrame) -> DataFrame:
    """For each target the notes that refer to it, and the first and last of its blocks that they cover; edges are dealt to tasks of a bounded number of rows."""
    at = ["dst_note", "dst_block"]
    tasks = tasks_for(edges, BACK_ROWS)
    own = edges.select(*at, "src_note").repartition(tasks, *at)
    places = order.repartition(tasks, *at).groupBy(*at).agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    return own.distinct().join(places, at).repartition(tasks, "dst_note", "src_note").groupBy("dst_note", "src_note").agg(F.min_by("dst_block", "_lo").alias("first_block"), F.max_by("dst_block", "_hi").alias("last_block"), F.count("*").alias("n_blocks"))


def propagated(notes: DataFrame, sources: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields of a note as its source has them, with a flag for each that changes; an empty source field changes nothing."""
    src = sources.select(key, *(F.col(f).alias(f"_s_{f}") for f in fields))
    out = notes.join(src, key, "left")
    for f in fields:
        new = F.coalesce(F.nullif(F.col(f"_s_{f}"), F.lit("")), F.col(f))
        out = out.withColumn(f"{f}_changed", ~new.eqNullSafe(F.col(f))).withColumn(f, new)
    return out.drop(*(f"_s_{f}" for f in fields))


def witnesses(verses: DataFrame, parts: dict[str, DataFrame], key: str = "verse_id") -> DataFrame:
    """Verses with the text of each witness, and the names of those without one."""
    out = verses
    for name, df in parts.items():
        out = out.join(df.select(key, F.col("text").alias(name)), key, "full_outer")
    return out.withColumn("missing", F.array_join(F.array_compact(F.array(*(F.when(F.coalesce(F.col(n), F.lit("")) == "", F.lit(n)) for n in parts))), ","))


def carried_marks(blocks: DataFrame, marks: DataFrame, key: str = "block_id") -> DataFrame:
    """Blocks with the mark that the root's block has."""
    return blocks.join(marks.select(key, "mark"), key, "left").withColumn("text", F.when(F.col("mark").isNotNull(), F.concat(F.lit("<"), "mark", F.lit(">"), "text", F.lit("</"), "mark", F.lit(">"))).otherwise(F.col("text")))


def repointed(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges to old blocks as edges to their new ones, in order; those without a new block stay and say so."""
    m = mapping.select(F.col("old").alias("dst_block"), "new", F.col("pos").alias("new_pos"))
    return edges.join(m, "dst_block", "left").select(*[c for c in edges.columns if c != "dst_block"], F.coalesce("new", "dst_block").alias("dst_block"), F.coalesce("new_pos", F.lit(0)).alias("new_pos"), F.col("new").isNull().alias("unmapped"))


def verbatim_words(glosses: DataFrame, synonyms: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Reference tokens that stand in the target, themselves or as a synonym, with the word found; the least where several are."""
    spread = glosses.select(key, "pos", "token", F.col("token").alias("form")).union(glosses.join(synonyms, "token").select(key, "pos", "token", "form"))
    words = targets.select(key, F.explode(F.array_distinct(T.english_tokens("text"))).alias("form"))
    hit = spread.join(words, [key, "form"]).groupBy(key, "pos", "token").agg(F.min("form").alias("found"))
    return glosses.join(hit, [key, "pos", "token"], "left").select(key, "pos", "token", "found", F.coalesce("found", F.concat(F.lit("("), "token", F.lit(")"))).alias("gloss"))


def unique_grams(docs: DataFrame, key: str, k: int) -> DataFrame:
    """Runs of k letters that are once in a text, with their place."""
    t = T.letters_only("text")
    spread = docs.select(key, F.posexplode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t) - k + 1)), lambda i: F.substring(t, i, F.lit(k)))).alias("pos", "gram"))
    return spread.groupBy(key, "gram").agg(F.count("*").alias("n"), F.min("pos").alias("pos")).where("n = 1").drop("n")


LABEL = r"\(([A-Za-z]{1,3})\)"


def labelled_parts(blocks: DataFrame, key: str) -> DataFrame:
    """Parts of a block by the labels ``(Ka)`` before them; what stands before the first has none."""
    labels = F.regexp_extract_all("text", F.lit(LABEL), F.lit(1))
    parts = F.split("text", LABEL)
    rows = blocks.select(key, F.posexplode(F.arrays_zip(F.concat(F.array(F.lit("")), labels).alias("label"), parts.alias("part"))).alias("pos", "p"))
    return rows.select(key, "pos", F.lower("p.label").alias("label"), F.trim("p.part").alias("part")).where("part <> ''")


def labelled_pairs(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Parts of both sides of a block by label; a source block without labels goes with the target's part without one, or with its first."""
    a, b = labelled_parts(source, key), labelled_parts(target, key)
    plain = a.groupBy(key).agg(F.max("label").alias("_m"), F.max("part").alias("source_part")).where("_m = ''").select(key, "source_part")
    first = b.groupBy(key).agg(F.coalesce(F.max(F.when(F.col("label") == "", F.col("part"))), F.min_by("part", "pos")).alias("target_part"))
    own = plain.join(first, key).select(key, F.lit("").alias("label"), "source_part", "target_part")
    others = a.join(plain.select(key), key, "left_anti").select(key, "label", F.col("part").alias("source_part"))
    return own.union(others.join(b.select(key, "label", F.col("part").alias("target_part")), [key, "label"]))

