"""Intake of aligned works: rows located by letters, references carried forward, layers laid over blocks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import blocks as matching
from lectern.functions import letters
from lectern.functions import text as T
from lectern.operators.align import overlap_join


def located_rows(rows: DataFrame, contents: DataFrame, key: str) -> DataFrame:
    """Where the letters of each row ``(key, row, text)`` stand among those of the work's content, each from the one before on; -1 if nowhere."""
    def run(batches):
        for pdf in batches:
            out = []
            for k, content, texts in zip(pdf[key], pdf["content"], pdf["texts"], strict=True):
                hint, index = 0, letters.LetterIndex(content or "")
                for i, t in enumerate(texts):
                    at = (index.span(t or "", hint) or (-1,))[0]
                    out.append((k, i, at))
                    hint = max(hint, at)
            yield pd.DataFrame(out, columns=[key, "row", "place"])
    asked = rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda s: s["text"]).alias("texts"))
    return contents.join(asked, key).select(key, "content", "texts").mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, row int, place int")


def parallel_rows(source: DataFrame, target: DataFrame, key: str, block: str) -> DataFrame:
    """Row n with row n; a row without a counterpart stays with the block before it, and is flagged."""
    both = target.join(source.select(key, "row", block), [key, "row"], "left")
    w = W.partitionBy(key).orderBy("row")
    return both.withColumn("flagged", F.col(block).isNull()).withColumn(block, F.last(block, ignorenulls=True).over(w))


def referenced(paragraphs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Commentary paragraphs with the numbers that they begin with; one of numbers alone gives them to the next, one without keeps those before it. Numbers that aren't known are dropped and told.

    A paragraph's numbers are compared in its row with those known of its work, so paragraphs go by their work alone and are never regrouped.
    """
    w = W.partitionBy(key).orderBy("pos")
    rows = paragraphs.withColumn("_r", T.reference_list("text")).withColumn("_only", (F.size("_r") > 0) & F.rlike("text", F.lit(r"^\s*[\d\s,.)–-]+$")))
    rows = rows.withColumn("_own", F.when(F.size("_r") > 0, F.col("_r")))
    rows = rows.withColumn("refs", F.last("_own", ignorenulls=True).over(w)).where("not _only")
    there = known.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_set("ref").alias("_known"))
    refs, own = F.coalesce("refs", F.array().cast(dict(rows.dtypes)["refs"])), F.coalesce("_known", F.array())
    rows = rows.where(F.col(key).isNotNull() & F.col("pos").isNotNull()).hint("merge").join(there, key, "left")
    good = F.array_sort(F.filter(refs, lambda x: F.array_contains(own, x)))
    unknown = F.array_sort(F.filter(refs, lambda x: ~F.array_contains(own, x)))
    return rows.select(key, "pos", "text", good.alias("refs"), unknown.alias("unknown"))


def inferred_references(found: DataFrame, key: str) -> DataFrame:
    """Numbers ``(key, n, first, last)`` of blocks; one that wasn't located but whose neighbours were takes the blocks between them, and is told as inferred."""
    w = W.partitionBy(key).orderBy("n")
    lo, hi = F.lag("last").over(w) + 1, F.lead("first").over(w) - 1
    open_ = F.col("first").isNull() & (lo <= hi)
    return found.withColumns({"_lo": lo, "_hi": hi, "inferred": F.coalesce(open_, F.lit(False))}).withColumns({"first": F.when(F.col("inferred"), F.col("_lo")).otherwise(F.col("first")), "last": F.when(F.col("inferred"), F.col("_hi")).otherwise(F.col("last"))}).drop("_lo", "_hi")


def overlaid(layers: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Layer spans on the blocks that they overlap, as places in the block; those on none are told as unplaced."""
    own = layers.withColumn("layer_id", F.xxhash64(*layers.columns))
    hit = overlap_join(own, blocks, key)
    cut = hit.select(key, "layer_id", "block_id_b", F.greatest(F.lit(0), F.col("start") - F.col("start_b")).alias("from"), (F.least("end", "end_b") - F.col("start_b")).alias("to"))
    rest = own.hint("merge").join(hit.select("layer_id").distinct(), "layer_id", "left_anti").select(key, "layer_id", F.lit(None).cast(dict(blocks.dtypes)["block_id"]).alias("block_id_b"), F.lit(None).cast(dict(cut.dtypes)["from"]).alias("from"), F.lit(None).cast(dict(cut.dtypes)["to"]).alias("to"))
    return cut.union(rest).withColumnRenamed("block_id_b", "block_id")


def row_agreement(rows: DataFrame, key: str, share: float = 0.5, variant: float = 0.9) -> DataFrame:
    """Rows ``(key, row, own, other)`` that agree with their counterpart by letters: ``agree``, ``variant`` (over half alike) or ``differs``."""
    alike = matching.ratio(T.letters_only("own"), T.letters_only("other"), F.lit(0.0))
    scored = rows.withColumn("alike", alike)
    return scored.withColumn("status", F.when(F.col("alike") >= variant, "agree").when(F.col("alike") >= share, "variant").otherwise("differs"))


def first_known(key: str, base: DataFrame, lookups: list[DataFrame], value: str) -> DataFrame:
    """The value of the first lookup table that has one."""
    out = base
    for i, df in enumerate(lookups):
        out = out.join(df.select(key, F.col(value).alias(f"_l{i}")), key, "left")
    return out.withColumn(value, F.coalesce(*(F.col(f"_l{i}") for i in range(len(lookups))))).drop(*(f"_l{i}" for i in range(len(lookups))))


def feedback(checked: DataFrame, key: str, major_only: bool = False) -> DataFrame:
    """Fact-checked rows with issues, or with major ones, as one line a row."""
    rows = checked.where("severity = 'major'") if major_only else checked
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "severity", "detail"))), "; ").alias("issues"), F.count("*").alias("n"))


def sibling_counts(nodes: DataFrame, lines: DataFrame, key: str, numerals: dict[str, int], near: int = 3) -> DataFrame:
    """Nodes whose number of children isn't the one announced within ``near`` lines of their pointer."""
    announced = None
    for word, n in numerals.items():
        announced = F.when(F.contains("line", F.lit(word)), n) if announced is None else announced.when(F.contains("line", F.lit(word)), n)
    said = lines.withColumn("_n", announced).where("_n is not null")
    close = nodes.withColumn("line_no", F.explode(F.sequence(F.col("pointer") - near, F.col("pointer") + near))).join(said, [key, "line_no"])
    kids = nodes.groupBy(key, F.col("parent_id").alias("node_id")).agg(F.count("*").alias("children"))
    return close.groupBy(key, "node_id").agg(F.min_by("_n", F.struct(F.abs(F.col("line_no") - F.col("pointer")), "line_no")).alias("announced")).join(kids, [key, "node_id"], "left").fillna(0, ["children"]).where("announced <> children")


def concept_lemmas(docs: DataFrame, key: str, heading: str, text: str = "text") -> DataFrame:
    """Lemmas listed in bold under a heading of a package note."""
    section = F.regexp_extract(text, rf"(?ms)^#+\s*{heading}\s*$(.*?)(?=^#|\z)", 1)
    return docs.select(key, F.explode(F.array_distinct(F.regexp_extract_all(section, F.lit(r"\*\*([^*]+)\*\*"), F.lit(1)))).alias("lemma"))


def typed_rows(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Auto-numbered rows of exported notes: a running number for each numbered line, and its runs of emphasis."""
    rows = docs.select(key, F.posexplode(F.split(text, "\n")).alias("i", "line")).where(F.rlike("line", F.lit(r"^\s*\d+\.\s")))
    n = F.row_number().over(W.partitionBy(key).orderBy("i"))
    content = F.regexp_replace("line", r"^\s*\d+\.\s+", "")
    return rows.select(key, n.alias("row"), F.regexp_replace(content, r"\*+", "").alias("text"), F.regexp_extract_all(content, F.lit(r"\*\*([^*]+)\*\*"), F.lit(1)).alias("bold"))


def related_segments(responses: DataFrame, key: str, column: str) -> DataFrame:
    """Segments and related texts of an API's JSON answer."""
    shape = "struct<segments:array<struct<id:string,span:struct<start:int,end:int>,related:array<struct<type:string,text:string>>>>>"
    rows = responses.select(key, F.explode(F.from_json(column, shape)["segments"]).alias("s"))
    return rows.select(key, F.col("s.id").alias("segment_id"), F.col("s.span.start").alias("start"), F.col("s.span.end").alias("end"), F.explode_outer("s.related").alias("r")).select(key, "segment_id", "start", "end", "r.type", "r.text")


