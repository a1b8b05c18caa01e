"""Scans: notes, lines, blocks, tables, ledgers, JSON dumps and office files as DataFrames."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.sources import books

FRONTMATTER = r"(?s)\A---\r?\n(.*?)\r?\n---"


def notes(spark: SparkSession, path: str) -> DataFrame:
    """Text files as ``(note_id, frontmatter map, body)``; the flat ``key: value`` lines between dashes are the frontmatter."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("note_id"), F.col("value").alias("text"))
    return files.select("note_id", frontmatter("text").alias("frontmatter"), body("text").alias("body"))


def frontmatter(text: Column | str) -> Column:
    """Map of the flat ``key: value`` lines of a leading block; empty without one. Of a repeated key the last counts."""
    lines = F.filter(F.split(F.regexp_extract(text, FRONTMATTER, 1), r"\r?\n"), lambda x: F.rlike(x, F.lit(r"^[^\s:#-][^:]*:")))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.regexp_replace(F.trim(F.regexp_replace(x, r"^[^:]*:", "")), r"""^["'](.*)["']$""", "$1").alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"])))


def body(text: Column | str) -> Column:
    return F.regexp_replace(text, FRONTMATTER + r"\r?\n?", "")


def patched(text: Column | str, updates: dict[str, Column | str]) -> Column:
    """The text with frontmatter keys set, each to a value or a column's: in place where they are, else added at the block's end. A null value leaves the text as it is."""
    t = F.col(text) if isinstance(text, str) else text
    t = F.when(F.rlike(t, F.lit(FRONTMATTER)), t).otherwise(F.concat(F.lit("---\n---\n"), t))
    t = F.regexp_replace(t, r"\A---\n---", "---\n\n---")
    for key, value in updates.items():
        shown = value if isinstance(value, Column) else F.lit(value)
        line = F.concat(F.lit(f"{key}: "), F.replace(F.replace(shown.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$")))
        there = rf"(?m)^{re.escape(key)}:.*$"
        head = F.regexp_extract(t, FRONTMATTER, 0)
        rest = F.substring(t, F.length(head) + 1, F.length(t))
        new = F.when(F.rlike(head, F.lit(there)), F.regexp_replace(head, F.lit(there), line)).otherwise(F.regexp_replace(head, F.lit(r"\n+---\z"), F.concat(F.lit("\n"), line, F.lit("\n---"))))
        t = F.coalesce(F.concat(new, rest), t)
    return t


def lines(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Physical lines from 1, frontmatter counted too."""
    return docs.select(*keys, F.posexplode(F.split(text, r"\r?\n")).alias("i", "line")).select(*keys, (F.col("i") + 1).alias("line_no"), "line")


def blocks(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Paragraphs between blank lines, headings left out: ``pos``, ``block_id`` (of a closing ``^id``; else empty), ``block``."""
    parts = docs.select(*keys, F.posexplode(F.split(F.trim(body(text)), r"\n[ \t]*\n\s*")).alias("pos", "block")).where(~F.rlike(F.col("block"), F.lit(r"^#+\s")))
    mark = r"\s*\^([\w-]+)\s*$"
    return parts.select(*keys, "pos", F.regexp_extract("block", mark, 1).alias("block_id"), F.regexp_replace("block", mark, "").alias("block"))


def last_by_id(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Of blocks of one id the last."""
    return parts.groupBy(*keys, "block_id").agg(F.max_by("block", "pos").alias("block"), F.max("pos").alias("pos"))


def accumulated_blocks(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Lines joined up to the one that ends in an id; lines of transclusions are skipped."""
    rows = lines(docs, keys, text).where(~F.rlike(F.col("line"), F.lit(r"^\s*!\[\["))).withColumn("id", F.regexp_extract("line", r"\^([\w-]+)\s*$", 1))
    order = W.partitionBy(*keys).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("group", F.coalesce(F.sum((F.col("id") != "").cast("int")).over(order), F.lit(0)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n")
    found = rows.groupBy(*keys, "group").agg(F.max("id").alias("block_id"), joined.alias("block"), F.min("line_no").alias("line_no"))
    return found.where("block_id <> ''").select(*keys, "block_id", "line_no", F.regexp_replace("block", r"^\s+|\s*\^[\w-]+\s*$", "").alias("block"))


def typed_units(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Runs of lines between blank lines with their kind (heading, transclusion, note, block), first and last line, and the heading above."""
    rows = lines(docs, keys, text).withColumn("blank", F.trim("line") == "").withColumn("head", F.rlike("line", F.lit(r"^#{1,6}\s")))
    order = W.partitionBy(*keys).orderBy("line_no")
    rows = rows.withColumn("cut", (F.lag("blank", 1, True).over(order) | F.col("head") | F.lag("head", 1, False).over(order)).cast("int"))
    rows = rows.withColumn("unit", F.sum("cut").over(order)).where("not blank")
    units = rows.groupBy(*keys, "unit").agg(F.min("line_no").alias("start"), F.max("line_no").alias("end"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n").alias("text"))
    t = F.col("text")
    units = units.withColumn("kind", F.when(F.rlike(t, F.lit(r"^#{1,6}\s")), "heading").when(F.rlike(t, F.lit(r"^\s*!\[\[[^\]]*\]\]\s*$")), "transclusion").when(F.rlike(t, F.lit(r"^\[\^[^\]]+\]:")), "note").otherwise("block"))
    units = units.withColumn("block_id", F.regexp_extract("text", r"\^([\w-]+)\s*$", 1)).withColumn("level", F.when(F.col("kind") == "heading", F.length(F.regexp_extract("text", r"^(#+)", 1))).otherwise(0))
    above = F.when((F.col("kind") == "heading") & (F.col("level") >= 2), F.trim(F.regexp_replace("text", r"^#+\s*|\s*\^[\w-]+\s*$", "")))
    return units.withColumn("heading", F.last(above, ignorenulls=True).over(W.partitionBy(*keys).orderBy("start"))).drop("unit")


def root_ids(units: DataFrame, keys: list[str]) -> DataFrame:
    """Ids of content blocks; those of headings end in -0."""
    return units.where("block_id <> '' and block_id not like '%-0'").select(*keys, "block_id")


def edges(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Transclusion lines ``![[file#^id]]`` as ``(line_no, dst_note, dst_block)``."""
    rows = lines(docs, keys, text)
    target = r"!\[\[([^\]#|]+)(?:#\^([\w-]+))?[^\]]*\]\]"
    return rows.where(F.rlike("line", F.lit(target))).select(*keys, "line_no", F.regexp_extract("line", target, 1).alias("dst_note"), F.regexp_extract("line", target, 2).alias("dst_block"))


def block_links(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Own id and transcluded id of each run of lines."""
    units = typed_units(docs, keys, text)
    return units.select(*keys, "start", "block_id", F.regexp_extract("text", r"!\[\[[^\]#]*#\^([\w-]+)", 1).alias("transcluded_id"), "text")


def glossary_lines(raw: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Lines of source and target split by a tab, an arrow or a bar, with optional verse ids; lines from # on are comments."""
    rows = lines(raw, keys, text).where(~F.rlike("line", F.lit(r"^\s*(#.*)?$"))).withColumn("f", F.split("line", r"\t|\s*->\s*|\s*→\s*|\s*\|\s*"))
    ids = F.filter(F.split(F.coalesce(F.get("f", F.lit(2)), F.lit("")), r"[,\s]+"), lambda x: x != "")
    return rows.where(F.size("f") > 1).select(*keys, "line_no", F.trim(F.get("f", F.lit(0))).alias("source"), F.trim(F.get("f", F.lit(1))).alias("target"), ids.alias("verse_ids")).where("source <> '' and target <> ''")


def table_rows(docs: DataFrame, keys: list[str], heading: str | None = None, text: str = "text") -> DataFrame:
    """Cells of pipe tables, of those under a heading with a word where one is given; the first row of a table and its rule are no rows."""
    rows = lines(docs, keys, text)
    order = W.partitionBy(*keys).orderBy("line_no")
    rows = rows.withColumn("section", F.last(F.when(F.rlike("line", F.lit(r"^#+\s")), F.trim(F.regexp_replace("line", r"^#+\s*", ""))), ignorenulls=True).over(order))
    piped = F.rlike("line", F.lit(r"^\s*\|.*\|\s*$"))
    rows = rows.withColumn("piped", piped).withColumn("first", piped & ~F.lag(piped, 1, False).over(order))
    kept = rows.where("piped and not first").where(~F.rlike("line", F.lit(r"^\s*\|[\s:|-]+\|\s*$")))
    if heading:
        kept = kept.where(F.contains(F.lower("section"), F.lit(heading.lower())))
    cells = F.transform(F.split(F.regexp_replace("line", r"^\s*\||\|\s*$", ""), r"\|"), lambda x: F.trim(x))
    return kept.select(*keys, "line_no", "section", cells.alias("cells"))


def range_cell(cell: Column | str) -> Column:
    """``3.20-3.22`` or ``Prologue, 1.1-1.3`` as a struct of chapter, vstart, vend, well_formed; ``3.32-3-33`` is read but not well formed."""
    c = F.col(cell) if isinstance(cell, str) else cell
    tight, loose = r"(\d+)\.(\d+)(?:\s*[-–]\s*(?:(\d+)\.)?(\d+))?\s*$", r"(\d+)\.(\d+)\s*[-–]\s*(\d+)[-.](\d+)\s*$"
    good = F.rlike(c, F.lit(tight)) & ((F.regexp_extract(c, tight, 3) == "") | (F.regexp_extract(c, tight, 3) == F.regexp_extract(c, tight, 1)))
    pick = lambda i: F.coalesce(F.regexp_extract(c, tight, i).try_cast("int"), F.regexp_extract(c, loose, i).try_cast("int"))
    return F.struct(pick(1).alias("chapter"), pick(2).alias("vstart"), F.coalesce(pick(4), pick(2)).alias("vend"), good.alias("well_formed"))


def schedule(docs: DataFrame, keys: list[str], day: int = 0, cell: int = 1, text: str = "text") -> DataFrame:
    """Typed rows of a schedule table; rows whose day or range can't be read are left out."""
    rows = table_rows(docs, keys, text=text)
    return rows.select(*keys, "line_no", F.get("cells", F.lit(day)).try_cast("int").alias("day"), range_cell(F.get("cells", F.lit(cell))).alias("r")).select(*keys, "line_no", "day", "r.*").where("day is not null and chapter is not null")


def keyword_tables(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Glossary notes: a section a keyword, a table of renderings and their frequencies."""
    rows = table_rows(docs, keys, text=text)
    return rows.select(*keys, "line_no", F.col("section").alias("keyword"), F.get("cells", F.lit(0)).alias("rendering"), F.coalesce(F.get("cells", F.lit(1)).try_cast("long"), F.lit(1).cast("long")).alias("freq")).where("keyword is not null and rendering <> ''")


def consolidated(glossary: DataFrame, keys: list[str]) -> DataFrame:
    """A row a keyword with its renderings by falling frequency."""
    return glossary.groupBy(*keys, "keyword").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("freq")).alias("n"), "rendering"))), lambda s: F.struct(s["rendering"].alias("rendering"), (-s["n"]).alias("freq"))).alias("renderings"))


def gloss_tokens(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    r"""Tokens of the parallel lines ``\gla``, ``\glb`` and ``\glc`` of a block, side by side."""
    part = lambda name: F.split(F.trim(F.regexp_extract(text, rf"(?m)^\\{name}[ \t]+(.*)$", 1)), r"\s+")
    rows = docs.select(*keys, F.posexplode(F.arrays_zip(part("gla").alias("a"), part("glb").alias("b"), part("glc").alias("c"))).alias("pos", "t"))
    return rows.select(*keys, "pos", "t.*").where("coalesce(a, '') <> ''")


def claims(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Claim sections of a note: id, quote, citation and referent of each heading ``c-<node>-<n>``."""
    rows = lines(docs, keys, text)
    order = W.partitionBy(*keys).orderBy("line_no")
    rows = rows.withColumn("claim_id", F.last(F.nullif(F.regexp_extract("line", r"^#+\s*\^?(c-[\w-]+)", 1), F.lit("")), ignorenulls=True).over(order)).where("claim_id is not null")
    field = lambda name: F.max(F.nullif(F.trim(F.regexp_extract("line", rf"(?i)^\W*{name}\W*:\W*(.*?)\W*$", 1)), F.lit(""))).alias(name)
    return rows.groupBy(*keys, "claim_id").agg(F.min("line_no").alias("line_no"), field("quote"), field("cite"), field("referent"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n").alias("block"))


def toc(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Bullets of a decimal tree: node, path, parent, title and pointer; a bullet that can't be read has none of them and stays."""
    rows = lines(docs, keys, text).where(F.rlike("line", F.lit(r"^\s*[*-]\s")))
    pattern = r"^(\s*)[*-]\s+(\d+(?:\.\d+)*)\.?\s+(.*?)\s*(?:\[\[(\d+|\?|[^\]]*)\]\])?\s*$"
    node = F.nullif(F.regexp_extract("line", pattern, 2), F.lit(""))
    return rows.select(*keys, "line_no", node.alias("node_id"), F.transform(F.split(node, r"\."), lambda x: x.cast("int")).alias("path"), F.nullif(F.regexp_extract(node, r"^(.*)\.\d+$", 1), F.lit("")).alias("parent_id"), F.regexp_extract("line", pattern, 3).alias("title"), F.regexp_extract("line", pattern, 4).try_cast("int").alias("pointer"), F.regexp_extract("line", pattern, 4).alias("context"), F.length(F.regexp_extract("line", pattern, 1)).alias("indent"))


def latest(ledger: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of an append-only log the newest record of each key; with equal order the one that sorts last."""
    rest = [c for c in ledger.columns if c not in keys]
    return ledger.groupBy(*keys).agg(F.max(F.struct(order, *(c for c in rest if c != order))).alias("r")).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the largest array of objects in a JSON dump (or of its root, where that is one)."""
    df = spark.read.json(path, multiLine=True)
    fields = [f.name for f in df.schema.fields if f.dataType.typeName() == "array" and f.dataType.elementType.typeName() == "struct"]
    if not fields:
        return df
    sizes = df.agg(*(F.coalesce(F.sum(F.size(f)), F.lit(0)).alias(f) for f in fields)).first()
    best = max(fields, key=lambda f: sizes[f])
    return df.select(F.posexplode(best).alias("pos", "item")).select("pos", "item.*")


def json_profile(docs: DataFrame, column: str) -> DataFrame:
    """Keys of a JSON object column: how many rows have each, how many values there are, and the least as a sample."""
    entries = docs.select(F.explode(F.map_entries(F.from_json(column, "map<string,string>"))).alias("e")).select("e.key", "e.value")
    return entries.groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_values"), F.min("value").alias("sample"))


def unpivoted(items: DataFrame, columns: list[str]) -> DataFrame:
    return items.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns))).alias("e")).select("e.*")


def category_fields(items: DataFrame, columns: list[str], most: int = 20) -> DataFrame:
    """Columns with few enough values to be categories: more than one, at most ``most``, and under a fifth of the rows."""
    stats = unpivoted(items, columns).groupBy("field").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_values"))
    return stats.where((F.col("n_values") > 1) & (F.col("n_values") <= most) & (F.col("n_values") * 5 < F.col("n")))


def value_counts(items: DataFrame, columns: list[str]) -> DataFrame:
    return unpivoted(items, columns).groupBy("field", "value").agg(F.count("*").alias("n"))


def chapter_field(items: DataFrame, hints: list[str]) -> DataFrame:
    """The hinted column that is best for chapters: all whole numbers first, then the fewest values, of 2 to 200."""
    stats = unpivoted(items, hints).groupBy("field").agg(F.count_distinct("value").alias("n_values"), F.min(F.rlike("value", F.lit(r"^\d+$"))).alias("whole"))
    return stats.where("n_values between 2 and 200").orderBy(F.desc("whole"), "n_values", "field").limit(1)


def samples(items: DataFrame, order: str, k: int, by: list[str] | None = None) -> DataFrame:
    """The first k - 3 rows, the middle one and the last two, of all or of each group."""
    w = W.partitionBy(*(by or []))
    rows = items.withColumn("_i", F.row_number().over(w.orderBy(order))).withColumn("_n", F.count("*").over(w))
    return rows.where((F.col("_i") <= k - 3) | (F.col("_i") == F.floor(F.col("_n") / 2) + 1) | (F.col("_i") > F.col("_n") - 2)).drop("_i", "_n")


def span_segments(texts: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """Segments cut from contents by half-open spans of code points."""
    return spans.join(texts, key).select(key, "start", "end", F.substring(F.col("text"), F.col("start") + 1, F.col("end") - F.col("start")).alias("segment"))


def live_lines(segments: DataFrame, key: str) -> DataFrame:
    """Line spans of an edition's segments in the order of the content."""
    return segments.select(key, "ref", F.posexplode("lines").alias("line_index", "span")).select(key, "ref", "line_index", "span.start", "span.end").orderBy(key, "start")


def class_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Classes of tags with how often they stand, and on how many pages."""
    found = F.transform(F.regexp_extract_all(html, F.lit(r"<([a-zA-Z0-9]+)[^>]*\sclass=\"([^\"]*)\""), F.lit(0)), lambda m: F.struct(F.lower(F.regexp_extract(m, r"<([a-zA-Z0-9]+)", 1)).alias("tag"), F.regexp_extract(m, "class=\"([^\"]*)\"", 1).alias("class")))
    return pages.select("page_id", F.explode(found).alias("c")).groupBy("c.tag", "c.class").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"))


def tag_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.select("page_id", F.explode(F.transform(F.regexp_extract_all(html, F.lit(r"<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1)), F.lower)).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"))


def link_runs(pages: DataFrame, html: str = "html") -> DataFrame:
    """Links of a page in order: target and text."""
    found = F.regexp_extract_all(html, F.lit(r"<a\s+href=\"([^\"]*)\"[^>]*>([^<]*)</a>"), F.lit(0))
    return pages.select("page_id", F.posexplode(found).alias("pos", "a")).select("page_id", "pos", F.regexp_extract("a", "href=\"([^\"]*)\"", 1).alias("href"), F.regexp_extract("a", r">([^<]*)<", 1).alias("label"))


def wiki_stream(pages: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """Headings of wikitext pages with their offset in the work's whole text."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    rows = pages.withColumn("base", F.coalesce(F.sum(F.length(text) + 1).over(w), F.lit(0)))
    rows = rows.select(key, order, "base", F.posexplode(F.split(text, "\n")).alias("i", "line"), F.split(text, "\n").alias("all"))
    before = F.aggregate(F.slice("all", F.lit(1), F.col("i")), F.lit(0), lambda a, x: a + F.length(x) + 1)
    return rows.where(F.rlike("line", F.lit(r"^=+[^=].*=+\s*$"))).select(key, order, (F.col("base") + before).alias("offset"), F.length(F.regexp_extract("line", r"^(=+)", 1)).alias("depth"), F.trim(F.regexp_replace("line", r"^=+|=+\s*$", "")).alias("label"))


def outline_candidates(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Lines that could be outline entries: headings, bold list items and numbered lines, with their depth."""
    rows = lines(docs, keys, text)
    kind = F.when(F.rlike("line", F.lit(r"^=+[^=].*=+\s*$")), "heading").when(F.rlike("line", F.lit(r"^[*#:]+\s*'''")), "bold").when(F.rlike("line", F.lit(r"^\s*\d+[.)]\s")), "numbered")
    rows = rows.withColumn("kind", kind).where("kind is not null")
    depth = F.when(F.col("kind") == "numbered", 1).otherwise(F.length(F.regexp_extract("line", r"^([=*#:]+)", 1)))
    return rows.select(*keys, "line_no", "kind", depth.alias("depth"), F.trim(F.regexp_replace("line", r"^[=*#:]+|'''|=+\s*$|^\s*\d+[.)]", "")).alias("label"))


def csv_meta(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``field, BO, EN[, ZH]`` of metadata sheets, one row a field and language."""
    df = spark.read.csv(path, header=True)
    field, *langs = df.columns
    return df.select(F.col(field).alias("field"), F.explode(F.array(*(F.struct(F.lit(x).alias("lang"), F.trim(F.col(x)).alias("value")) for x in langs))).alias("e")).select("field", "e.*").where("coalesce(value, '') <> ''")


_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx_rows(content: bytes) -> list[tuple]:
    root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
    out = []
    for n, p in enumerate(root.iter(f"{_WORD}p")):
        at, style = 0, p.find(f"{_WORD}pPr/{_WORD}pStyle")
        for r in p.iter(f"{_WORD}r"):
            text = "".join(t.text or "" for t in r.iter(f"{_WORD}t"))
            if not text:
                continue
            color, bold = r.find(f"{_WORD}rPr/{_WORD}color"), r.find(f"{_WORD}rPr/{_WORD}b")
            out.append((n, style.get(f"{_WORD}val") if style is not None else None, text, color.get(f"{_WORD}val") if color is not None else None, bold is not None, at, at + len(text)))
            at += len(text)
    return out


def docx_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs of word-processor files: paragraph, style, text, colour, bold and their span in the paragraph."""
    schema = "path string, paragraph int, style string, text string, color string, bold boolean, start int, end int"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame([(p, *row) for row in _docx_rows(content)], columns=["path", "paragraph", "style", "text", "color", "bold", "start", "end"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, schema)


def docx_markdown(runs: DataFrame) -> DataFrame:
    """Paragraphs of `docx_runs` as Markdown: headings by style, bold runs in asterisks."""
    piece = F.when(F.col("bold"), F.concat(F.lit("**"), "text", F.lit("**"))).otherwise(F.col("text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", piece.alias("p")))), lambda s: s["p"]), "")
    rows = runs.groupBy("path", "paragraph").agg(F.max("style").alias("style"), joined.alias("line"))
    level = F.regexp_extract("style", r"(?i)heading\s*(\d)", 1).try_cast("int")
    return rows.select("path", "paragraph", F.when(level.isNotNull(), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), "line")).otherwise(F.col("line")).alias("line"))


def _epub_rows(content: bytes) -> list[tuple]:
    book, out = zipfile.ZipFile(io.BytesIO(content)), []
    for name in books.reading_order(book):
        root = books.page_tree(book.read(name))
        n = 0
        for e in root.iter():
            tag = str(e.tag).rpartition("}")[2]
            if tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li"):
                continue
            runs: list[list] = []

            def walk(node, role):
                if node.text:
                    add(node.text, role)
                for child in node:
                    walk(child, child.get("class") or role)
                    if child.tail:
                        add(child.tail, role)

            def add(text, role):
                if runs and runs[-1][0] == role:
                    runs[-1][1] += text
                else:
                    runs.append([role, text])

            walk(e, e.get("class"))
            out += [(name, n, tag, e.get("class"), i, role, " ".join(text.split())) for i, (role, text) in enumerate(runs) if text.strip()]
            n += 1
    return out


def epub_runs(spark: SparkSession, path: str) -> DataFrame:
    """Text of book files: file, paragraph, tag and class, and its runs of one role, neighbours of the same role as one."""
    names = ["path", "file", "paragraph", "tag", "class", "run", "role", "text"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame([(p, *row) for row in _epub_rows(content)], columns=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "path string, file string, paragraph int, tag string, class string, run int, role string, text string")


def mixed_class_paragraphs(runs: DataFrame, most: int = 2) -> DataFrame:
    """Classes of paragraphs that hold runs of another class, with up to ``most`` samples."""
    other = runs.where(~F.col("role").eqNullSafe(F.col("class")))
    return other.groupBy("class", "role").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set("text")), 1, most).alias("samples"))


def extract_block(units: DataFrame, keys: list[str], block_id: str) -> DataFrame:
    return units.where(F.col("block_id") == block_id).select(*keys, "start", "end", "text")


def doc_blocks(docs: DataFrame) -> DataFrame:
    """The documents table as blocks: each line that isn't blank, with an id of document and line."""
    rows = lines(docs.select("doc_id", "lang", "source", "text"), ["doc_id", "lang", "source"]).where("trim(line) <> ''")
    return rows.select("doc_id", "lang", "source", "line_no", F.concat_ws("-", F.col("doc_id").cast("string"), F.col("line_no").cast("string")).alias("block_id"), "line")


