"""Day files checked against a plan: rules as rows, findings in the common schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import fixed
from lectern.operators.checks import finding, union
from lectern.sources.stage import staged

#: What a plan says of a section. Only ``section``, ``heading`` and ``pos`` are needed in a row; what is null isn't asked.
PLAN = "section string, heading string, pos int, required boolean, ceiling int, low int, high int, unit string, opens string, closes string, label string, exempt boolean, ids boolean, tag string, tags array<string>"
# How far into a section's first line its opening may begin, the mark of a block id, and the status that no generator may set.
OPENING = 40
BLOCK_ID = r"\^(\d+-\d+)"
DONE = r"(?m)^status:\s*complete"


def _list(column: Column) -> Column:
    return F.array_join(column, ",")


def sections(files: DataFrame, plan: DataFrame, level: int = 2) -> DataFrame:
    """Sections of files ``(file, body)``: ``(file, nth, head, section, lines)``, by headings of a level; lines before the first are no section."""
    heading = "^#{" + str(level) + r"}\s+\S"
    rows = files.select("file", F.posexplode(F.split("body", "\n")).alias("at", "line"))
    by = W.partitionBy("file").orderBy("at")
    rows = rows.withColumn("_head", F.col("line").rlike(heading)).withColumn("nth", F.sum(F.col("_head").cast("int")).over(by)).where("nth > 0")
    lines = F.transform(F.array_sort(F.collect_list(F.when(~F.col("_head"), F.struct("at", "line")))), lambda x: x["line"])
    cut = rows.groupBy("file", "nth").agg(F.trim(F.max(F.when(F.col("_head"), F.col("line")))).alias("head"), lines.alias("lines"))
    known = plan.select(F.trim("heading").alias("head"), "section")
    return cut.join(known, "head", "left").select("file", "nth", "head", "section", "lines")


def _size(text: Column, unit: Column) -> Column:
    return F.when(unit == "syllables", F.size(F.regexp_extract_all(text, F.lit(fixed.TIBETAN_RUN), F.lit(0)))).otherwise(F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))))


def day_file_checks(files: DataFrame, plan: DataFrame, forbidden: DataFrame, keys: tuple[str, ...] = ("day", "chapter", "verses", "status"), level: int = 2) -> DataFrame:
    """Findings on files ``(file, frontmatter, body, expected)`` by a plan of the columns of `PLAN` and ``forbidden`` ``(name, pattern)``.

    Critical: frontmatter or one of its keys missing, a status that is set to
    complete, a required section missing, repeated or out of order, a ceiling
    passed, an opening or a closing that isn't there, a label not found, block
    ids that are none, not those of ``expected`` (if that is not null) or have a
    gap, a forbidden pattern outside exempt sections, a tag missing or not
    among those allowed. Minor: a heading that the plan lacks, a size outside its
    band. Files are independent of each other; plan and patterns are small tables
    that Spark broadcasts by its own measure.
    """
    name = F.col("file")
    cut = staged(sections(files, plan, level))
    known = cut.where("section is not null").join(plan.drop("heading"), "section")
    content = known.withColumn("text", F.array_join("lines", "\n"))
    after = F.expr("case when label is null then text when instr(text, label) > 0 then substring(text, instr(text, label) + length(label)) end")
    content = content.withColumn("counted", after)
    size = content.withColumn("n", _size(F.coalesce("counted", F.lit("")), F.coalesce("unit", F.lit("words"))))
    filled = F.filter("lines", lambda x: F.trim(x) != "")
    first, last = F.coalesce(F.get(filled, F.lit(0)), F.lit("")), F.coalesce(F.get(filled, F.size(filled) - 1), F.lit(""))
    start = F.ltrim(F.when(F.col("label").isNotNull() & (F.trim(F.coalesce("counted", F.lit(""))) != ""), F.regexp_replace("counted", r"^\s+", "")).otherwise(first))
    opened = F.expr("instr(substring(_start, 1, length(opens) + " + str(OPENING) + "), opens) > 0")
    closed = F.expr("endswith(rtrim(_last), closes)")

    front = F.coalesce("frontmatter", F.lit(""))
    keys_at = F.explode(F.array(*map(F.lit, keys)))
    lacking = files.where(front != "").select("file", "frontmatter", keys_at.alias("key")).where(F.expr("not regexp_like(frontmatter, concat('(?m)^', key, '[ \\t]*:'))"))
    have = cut.where("section is not null").groupBy("file").agg(F.collect_set("section").alias("_have"))
    asked = plan.where(F.coalesce("required", F.lit(True))).agg(F.collect_set("section").alias("_asked"))
    missing = files.select("file").join(have, "file", "left").crossJoin(F.broadcast(asked)).select("file", F.explode(F.array_except("_asked", F.coalesce("_have", F.array().cast("array<string>")))).alias("section"))
    order = known.withColumn("_most", F.max("pos").over(W.partitionBy("file").orderBy("nth").rowsBetween(W.unboundedPreceding, -1)))
    many = known.groupBy("file", "section").agg(F.count("*").alias("n")).where("n > 1")

    ids = content.where("ids").withColumn("found", F.regexp_extract_all("text", F.lit(BLOCK_ID), F.lit(1))).join(files.select("file", "expected"), "file")
    numbers = F.transform("found", lambda x: F.substring_index(x, "-", -1).cast("long"))
    gap = F.coalesce(numbers != F.expr("transform(found, (x, i) -> cast(substring_index(found[0], '-', -1) as bigint) + i)"), F.lit(False))
    scanned = cut.join(plan.where("exempt").select("section", "exempt"), "section", "left").where("exempt is null").select("file", F.explode("lines").alias("line")).join(F.broadcast(forbidden), F.expr("regexp_like(line, pattern)"))
    tagged = content.where("tag is not null").withColumn("found", F.expr("regexp_extract(text, tag, 1)")).withColumn("has", F.expr("regexp_like(text, tag)"))

    at = F.concat_ws("/", "file", "section")
    none = F.lit("")
    of = lambda rows, check, severity, entity, detail=none: finding(rows, check, severity, entity, detail)
    return union(
        of(files.where(front == ""), "no_frontmatter", "critical", name), of(lacking, "missing_key", "critical", name, "key"), of(files.where(front.rlike(DONE)), "status_complete", "critical", name),
        of(missing, "missing_section", "critical", name, "section"), of(many, "repeated_section", "critical", name, "section"), of(order.where("pos < _most"), "section_order", "critical", name, "section"),
        of(cut.where("section is null"), "unknown_heading", "minor", name, "head"), of(content.where("label is not null and counted is null"), "no_label", "critical", at, "label"),
        of(size.where("n > ceiling"), "over_ceiling", "critical", at, F.concat_ws("/", F.col("n").cast("string"), F.col("ceiling").cast("string"))),
        of(size.where("n < low or n > high"), "outside_band", "minor", at, F.col("n").cast("string")),
        of(content.withColumn("_start", start).where("opens is not null").where(~opened), "no_opening", "critical", at, "opens"), of(content.withColumn("_last", last).where("closes is not null").where(~closed), "no_closing", "critical", at, "closes"),
        of(ids.where(F.size("found") == 0), "no_ids", "critical", at), of(ids.where((F.size("found") > 0) & F.col("expected").isNotNull() & (F.col("found") != F.col("expected"))), "other_ids", "critical", at, _list(F.col("found"))),
        of(ids.where((F.size("found") > 0) & gap), "id_gap", "critical", at, _list(F.col("found"))),
        of(scanned.select("file", "name").distinct(), "forbidden", "critical", name, "name"),
        of(tagged.where("not has"), "no_tag", "critical", at), of(tagged.where(F.col("has") & F.col("tags").isNotNull() & ~F.coalesce(F.expr("array_contains(tags, trim(found))"), F.lit(False))), "other_tag", "critical", at, "found"),
    )
