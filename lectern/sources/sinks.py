"""Sinks: tables, notes and payloads written from DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aligned_csv(aligned: DataFrame, path: str) -> None:
    aligned.select("block_id", "source_text", "target_text", "notes").write.mode("overwrite").csv(path, header=True)


def report_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("sep", "\t").csv(path, header=True)


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def glossary_notes(renderings: DataFrame) -> DataFrame:
    """A section a keyword: its renderings by falling frequency as a pipe table."""
    row = F.concat(F.lit("| "), "rendering", F.lit(" | "), F.col("freq").cast("string"), F.lit(" |"))
    lines = F.array_sort(F.collect_list(F.struct((-F.col("freq")).alias("n"), "rendering", row.alias("row"))))
    body = F.array_join(F.transform(lines, lambda s: s["row"]), "\n")
    return renderings.groupBy("keyword").agg(F.concat(F.lit("## "), F.first("keyword"), F.lit("\n\n| rendering | freq |\n|---|---|\n"), body).alias("note"))


def edition_payload(spans: DataFrame, key: str) -> DataFrame:
    """Content and segments of an edition as JSON: ``(key, ref, type, line_index, start, end, line)``."""
    per = spans.groupBy(key, "ref", "type").agg(F.min("start").alias("at"), F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("lines"))
    segments = F.transform(F.array_sort(F.collect_list(F.struct("at", "ref", "type", "lines"))), lambda s: F.struct(s["lines"].alias("lines"), s["type"].alias("type"), s["ref"].alias("reference")))
    content = spans.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "line"))), lambda s: s["line"]), "\n").alias("content"))
    return content.join(per.groupBy(key).agg(segments.alias("segments")), key).select(key, F.to_json(F.struct("content", "segments")).alias("payload"))


def termbase_tsv(terms: DataFrame) -> DataFrame:
    """One line a form and rendering; where a form has several, with the verses of each."""
    spread = terms.select(F.explode("forms").alias("form"), "rendering", "verse_ids").groupBy("form", "rendering").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("verse_ids")))).alias("v"))
    n = spread.groupBy("form").agg(F.count("*").alias("n"))
    return spread.join(n, "form").select(F.concat_ws("\t", "form", "rendering", F.when(F.col("n") > 1, F.array_join("v", ","))).alias("line"))


def termbase_table(terms: DataFrame) -> DataFrame:
    """One row a form with its renderings, and the verses of each where there are several."""
    spread = terms.select(F.explode("forms").alias("form"), "rendering", F.array_join("verse_ids", ",").alias("v")).groupBy("form").agg(F.array_sort(F.collect_set(F.struct("rendering", "v"))).alias("r"))
    text = F.array_join(F.transform("r", lambda s: F.when(F.size("r") > 1, F.concat(s["rendering"], F.lit(" ("), s["v"], F.lit(")"))).otherwise(s["rendering"])), "; ")
    return spread.select("form", text.alias("renderings"))


def rendered(rows: DataFrame, key: str, order: list[str], line: Column, joint: str = "\n") -> DataFrame:
    """Rows of a key as one text, in order."""
    parts = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(parts, lambda s: s["_line"]), joint).alias("text"))


def annotated(items: DataFrame, annotations: DataFrame, key: str, path: str) -> None:
    """A work's items and, beside them, its annotations."""
    items.write.mode("overwrite").partitionBy(key).parquet(f"{path}/items")
    annotations.write.mode("overwrite").partitionBy(key).parquet(f"{path}/annotations")


def baseline(files: DataFrame, key: str = "path") -> DataFrame:
    return files.select(key, F.sha2("content", 256).alias("sha"))
