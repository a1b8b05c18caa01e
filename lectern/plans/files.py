"""Queries that write a table in a format and read it back, by the sinks and scans of that format."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from lectern.functions import fold, tibetan
from lectern.functions import text as T
from lectern.operators import align, checks, fuzzy, hooks, layout
from lectern.plans.base import Listing, longs, table
from lectern.plans.planted import PART
from lectern.sources import notes, sinks
from lectern.sources.stage import fresh_path, put
from lectern.streaming import feed

L = Listing()


def _nation(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))


def _part(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))


@L.add("A1", "select n_name as name, n_regionkey || '' as region, 'Body of ' || n_name as body from nation")
def r_notes(spark, sf_dir):
    path = fresh_path(spark, "notes")
    text = F.expr("concat_ws(chr(10), '---', concat('name: ', name), concat('region: ', region), '---', concat('Body of ', name))")
    _nation(spark, sf_dir).select("k", text.alias("value")).repartition("k").write.partitionBy("k").text(path)
    found = notes.notes(spark, f"{path}/*/*.txt")
    return found.select(F.col("frontmatter")["name"].alias("name"), F.col("frontmatter")["region"].alias("region"), F.regexp_replace("body", r"\n\z", "").alias("body"))


@L.add("A25 A30", "select n_nationkey as id, n_name as name, left(n_name, 3) as segment from nation")
def r_json_items(spark, sf_dir):
    path = fresh_path(spark, "dump")
    rows = _nation(spark, sf_dir).select(F.struct(F.col("k").alias("id"), "name").alias("i"))
    rows.agg(F.to_json(F.struct(F.array(F.struct(F.lit(1).alias("x"))).alias("meta"), F.sort_array(F.collect_list("i")).alias("items"))).alias("value")).coalesce(1).write.text(path)
    items = notes.json_items(spark, path).select(F.col("id").cast("int").alias("id"), "name")
    cut = notes.span_segments(items.select("id", F.col("name").alias("text")), items.select("id", F.lit(0).alias("start"), F.lit(3).alias("end")), "id")
    return items.join(cut.select("id", "segment"), "id")


_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _zip(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in files.items():
            z.writestr(name, content)
    return out.getvalue()


def _names(spark, sf_dir) -> list[str]:
    """The names of the nations: 25 rows, whatever the scale."""
    return [r["name"] for r in _nation(spark, sf_dir).orderBy("k").collect()]


@L.add("A32 A33", "select n_nationkey * 2 as paragraph, '# ' || n_name as line, 1 as runs from nation union all select n_nationkey * 2 + 1, 'is **' || n_name || '**', 2 from nation")
def r_docx(spark, sf_dir):
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>{n}</w:t></w:r></w:p><w:p><w:r><w:t>is </w:t></w:r><w:r><w:rPr><w:b/></w:rPr><w:t>{n}</w:t></w:r></w:p>' for n in _names(spark, sf_dir))
    path = put(spark, fresh_path(spark, "doc") + ".docx", _zip({"word/document.xml": f'<w:document xmlns:w="{_W}"><w:body>{body}</w:body></w:document>'}))
    runs = notes.docx_runs(spark, path)
    return notes.docx_markdown(runs).select("paragraph", "line").join(runs.groupBy("paragraph").agg(F.count("*").cast("int").alias("runs")), "paragraph")


@L.add("A34 A35 A36 A38", "select n_nationkey as paragraph, 0 as run, 'verse' as role, 'of' as text, 'of ' || n_name || ' again' as plain, 'a' as href from nation union all select n_nationkey, 1, 'term', n_name, 'of ' || n_name || ' again', 'a' from nation union all select n_nationkey, 2, 'verse', 'again', 'of ' || n_name || ' again', 'a' from nation")
def r_epub(spark, sf_dir):
    names = _names(spark, sf_dir)
    body = "".join(f'<p class="verse">of <span class="term">{n}</span> again</p>' for n in names)
    path = put(spark, fresh_path(spark, "book") + ".epub", _zip({"t.xhtml": f'<html xmlns="http://www.w3.org/1999/xhtml"><body>{body}</body></html>'}))
    pages = _nation(spark, sf_dir).select(F.col("k").alias("page_id"), F.expr("concat('<p>of <i>', name, '</i> again</p>')").alias("html"), F.expr("concat('<a href=\"a\">', name, '</a>')").alias("link"))
    plain = pages.select(F.col("page_id").alias("paragraph"), T.plain_html("html").alias("plain"))
    links = notes.link_runs(pages.select("page_id", F.col("link").alias("html"))).select(F.col("page_id").alias("paragraph"), "href")
    return notes.epub_runs(spark, path).select("paragraph", "run", "role", "text").join(plain, "paragraph").join(links, "paragraph")


@L.add("A39", "select n_name as field, 'BO' as lang, 'bo ' || n_nationkey as value from nation union all select n_name, 'EN', n_name from nation where n_nationkey % 2 = 0")
def r_csv_meta(spark, sf_dir):
    path = fresh_path(spark, "meta")
    _nation(spark, sf_dir).select(F.col("name").alias("field"), F.expr("concat('bo ', k)").alias("BO"), F.expr("case when k % 2 = 0 then name end").alias("EN")).write.csv(path, header=True)
    return notes.csv_meta(spark, path)


@L.add("B1", f"with {PART} select '1-' || k as block_id, name as source_text, kind as target_text, case when k % 2 = 0 then brand end as notes from p")
def r_aligned_csv(spark, sf_dir):
    path = fresh_path(spark, "aligned")
    sinks.aligned_csv(_part(spark, sf_dir).select(F.expr("concat('1-', k)").alias("block_id"), F.col("name").alias("source_text"), F.col("kind").alias("target_text"), F.expr("case when k % 2 = 0 then brand end").alias("notes"), "size"), path)
    return spark.read.csv(path, header=True)


@L.add("B6", f"with {PART} select k || '' as k, name, size || '' as size from p")
def r_report_tsv(spark, sf_dir):
    path = fresh_path(spark, "report")
    sinks.report_tsv(_part(spark, sf_dir).select("k", "name", "size"), path)
    return spark.read.option("sep", "\t").csv(path, header=True)


@L.add("B5", f"with {PART} select kind, count(*) as items, count(*) filter (size > 25) as annotations from p group by kind")
def r_annotated(spark, sf_dir):
    path, p = fresh_path(spark, "work"), _part(spark, sf_dir)
    sinks.annotated(p.select("kind", "k", "name"), p.where("size > 25").select("kind", "k", F.lit("note").alias("note")), "kind", path)
    items = spark.read.parquet(f"{path}/items").groupBy("kind").agg(F.count("*").alias("items"))
    marks = spark.read.parquet(f"{path}/annotations").groupBy("kind").agg(F.count("*").alias("annotations"))
    return items.join(marks, "kind", "left").fillna(0, ["annotations"])


@L.add("B7 I9 A43 A44", "select event_type, count(*) as n, min(event_id) as first_id from events group by 1")
def r_ledger_stream(spark, sf_dir):
    """Events arrive twice, are stripped of repeats as a stream, and go into a ledger, twice over; and once more by the plain sink."""
    source, ledger, checkpoint, log = (fresh_path(spark, n) for n in ("events", "ledger", "state", "log"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(source)
    events.where("event_id % 3 = 0").write.mode("append").parquet(source)
    for turn in range(2):
        stream = feed.deduplicated(feed.messages(spark, source, events.schema), "event_id", "ts", "400 days")
        feed.into_ledger(stream, ledger, "event_id", f"{checkpoint}-{turn}").awaitTermination()
    done = spark.read.parquet(ledger)
    sinks.append_ledger(done.where("event_id % 2 = 0").select("event_id", "event_type"), log)
    sinks.append_ledger(done.where("event_id % 2 = 1").select("event_id", "event_type"), log)
    return spark.read.schema("event_id long, event_type string").json(log).groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@L.add("B7 I9", "select event_id, event_type, case when event_id % 3 = 0 then 1 when event_id % 3 = 1 then 2 else 3 end as run from events where event_id is not null")
def r_bucketed_ledger(spark, sf_dir):
    """Three runs over a growing folder of events, each with all of the earlier ones again; compacted between them."""
    source, path = fresh_path(spark, "growing"), fresh_path(spark, "buckets")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    for run in range(3):
        events.where(F.col("event_id") % 3 <= run).write.mode("append").parquet(source)
        stream = feed.messages(spark, source, events.schema)
        feed.into_ledger(stream, path, "event_id", fresh_path(spark, "marks"), lambda df, n=run + 1: df.withColumn("run", F.lit(n)), buckets=8).awaitTermination()
        feed.compacted(spark, path, "event_id", most=1)
    return feed.ledger(spark, path, "event_id").select("event_id", "event_type", "run")


# what needs no file, and stands in no other list


@L.add("A43 A45 I2", "select n_nationkey as id, n_name as name, 5 as pages from nation where n_nationkey >= 7")
def p_paged(spark, sf_dir):
    """Rows of a service of pages of four, newest first, until a page ends before a time; the nations, 25 rows, are the service."""
    rows = [{"id": r["k"], "ts": r["k"], "name": r["name"]} for r in _nation(spark, sf_dir).orderBy(F.desc("k")).collect()]
    asked: list[object] = []

    def fetch(last: object) -> list[dict]:
        asked.append(last)
        return [r for r in rows if last is None or r["id"] < last][:4]

    found = feed.paged(fetch, 7)
    return spark.createDataFrame([(r["id"], r["name"], len(asked)) for r in found], "id int, name string, pages int")


@L.add("I8", f"with {PART} select k, 0 as event, 'event: batch' || chr(10) || 'data: [\"' || name || '\",\"' || kind || '\"]' || chr(10) || chr(10) as text from p union all select k, 1, 'event: done' || chr(10) || 'data: [\"' || brand || '\"]' || chr(10) || chr(10) from p")
def p_events(spark, sf_dir):
    replies = _part(spark, sf_dir).select("k", F.posexplode(F.array("name", "kind", "brand")).alias("n", "reply"))
    return hooks.as_events(replies, "k", "n", 2)


@L.add("J9", f"with {PART} select k, '└─ ' || name || chr(10) || '   └─ ' || kind || chr(10) || '   └─ ' || brand || chr(10) || '└─ end' as text from p")
def p_tree_text(spark, sf_dir):
    nodes = _part(spark, sf_dir).select("k", F.explode(F.array(*(F.struct(F.lit(path).alias("path"), label.alias("label")) for path, label in (("1.10", F.col("brand")), ("2", F.lit("end")), ("1", F.col("name")), ("1.9", F.col("kind")))))).alias("n"))
    return layout.tree_text(nodes.select("k", "n.*"), "k")


@L.add("C10 C23 C25", f"with {PART} select k, replace(name, ' ', '') || 'é' as key, 'ང འི ཁ' as spaced, 'ཀྱུ' as ordered from p")
def p_normal_order(spark, sf_dir):
    p = _part(spark, sf_dir)
    return p.select("k", T.delimiter_key(fold.nfc(F.concat("name", F.lit("།é")))).alias("key"), tibetan.perplexity_text(F.lit("ངའི་ཁ")).alias("spaced"), tibetan.reordered(F.lit("ཀུྱ")).alias("ordered"))


@L.add("D24", f"""with {PART} select 'missing_term' as check_name, 'error' as severity, '1-' || k || '/t' || k as entity_id, '' as detail from p where k % 5 = 0
union all select 'rendering_differs', 'error', '1-' || k || '/t' || k, '' from p where k % 5 = 1 union all select 'out_of_scope', 'error', '1-' || k || '/t' || k, '' from p where k % 5 = 2
union all select 'not_in_text', 'warn', '1-' || k || '/t' || k, '' from p where k % 5 = 3 union all select 'overlapping_scope', 'error', name || ' ' || k, 't' || k || '/u' || k from p where k % 5 = 4""")
def p_grade_checks(spark, sf_dir):
    p = _part(spark, sf_dir).withColumns({"verse_id": F.expr("concat('1-', k)"), "term": F.expr("concat('t', k)"), "form": F.expr("concat(name, ' ', k)")})
    base = p.where("k % 5 <> 0").select("term", F.col("kind").alias("rendering"), F.expr("case when k % 5 = 2 then array('9-9') else array(verse_id) end").alias("verse_ids"), "form")
    second = p.where("k % 5 = 4").select(F.expr("concat('u', k)"), F.lit("other"), F.expr("array(verse_id)"), "form")
    grade = p.select("verse_id", "term", F.expr("case when k % 5 = 1 then 'wrong' else kind end").alias("rendering"), "form")
    texts = p.select("verse_id", F.expr("case when k % 5 = 3 then 'nothing' else concat('of ', form) end").alias("text"))
    return checks.grade_checks(grade, base.union(second), texts)


@L.add("E15", f"with {PART} select k as a, k as b, round(64 / 96, 9) as score from p where k % 2 = 1")
def p_best_rejected(spark, sf_dir):
    """Even rows have their own text on the other side, odd ones theirs with as much added."""
    t = _part(spark, sf_dir).select("k", F.expr("md5(cast(k as string))").alias("text"))
    other = t.select(F.col("k").alias("b"), F.expr("case when k % 2 = 0 then text else concat(text, repeat('#', 32)) end").alias("text"))
    return fuzzy.best_rejected(t.select(F.col("k").alias("a"), "text"), other, "a", "b", 0.9).select("a", "b", F.round("score", 9).alias("score"))


@L.add("D24", f"""with {PART}, v as (select k, k % 10 as m, '1-' || k as verse, 't' || k as term from p)
select case m when 0 then 'E1' when 1 then 'E2' when 2 then 'E3' when 3 then 'E4' else 'E6' end as check_name, 'error' as severity, verse || '/' || term as entity_id, '' as detail from v where m in (0, 1, 2, 3, 6)
union all select 'E5', 'error', verse || '/f' || k, '' from v where m = 4 union all select 'E4', 'error', verse || '/' || term, '' from v where m = 4 union all select 'E5', 'error', 'f' || k, '' from v where m = 5
union all select 'W3', 'warn', 'f' || k, '' from v where m = 7 union all select 'W1', 'warn', term || '/f…' || k, '' from v where m = 8 union all select 'W4', 'warn', term, '' from v where m = 9 union all select 'W2', 'warn', 'same' || k, '' from v where m = 9
union all select 'W5', 'warn', verse || '/' || term || '/x' || k, '' from v where m = 9 union all select 'E1', 'error', verse || '/y' || k, '' from v where m = 9""")
def p_grade_findings(spark, sf_dir):
    """One defect a verse: which one goes by the last digit of its key."""
    p = _part(spark, sf_dir).withColumns({"m": F.expr("k % 10"), "verse_id": F.expr("concat('1-', k)"), "term": F.expr("concat('t', k)"), "form": F.expr("concat('f', k)"), "text": F.expr("concat('of f', k, ' and f', k, 'long')")})
    columns = ["verse_id", "word", "term", "form", "rendering", "verse_text"]
    own = p.select("verse_id", F.expr("concat(case when m = 9 then 'same' else 'word' end, k)"), "term", F.expr("case when m = 2 then concat('f', k, 'long') when m = 8 then null else form end"), F.expr("case when m = 3 then 'wrong' when m = 6 then null else kind end"), F.expr("case when m = 1 then 'nothing' else text end"))
    more = p.where("m = 4").select("verse_id", F.expr("concat('word', k)"), "term", "form", F.lit("other"), "text")
    inner = p.where("m = 9").select("verse_id", F.expr("concat('Same', k)"), F.expr("concat('x', k)"), F.expr("concat('f', k, 'long')"), "kind", "text")
    lost = p.where("m = 9").select("verse_id", F.lit(""), F.expr("concat('y', k)"), F.lit(None).cast("string"), "kind", "text")
    grade = own.union(more).union(inner).union(lost).toDF(*columns)
    base = p.where("m <> 0").select("term", F.expr("case when m = 8 then array(concat('f…', k)) else array(form) end").alias("forms"), F.col("kind").alias("rendering"), F.expr("case when m = 9 then array('9-9') else array(verse_id) end").alias("verse_ids"))
    second = p.where("m in (5, 7)").select(F.expr("concat('z', k)"), F.array("form"), F.lit("other"), F.expr("case when m = 5 then array(verse_id) else array('8-8') end"))
    third = p.where("m = 9").select(F.expr("concat('x', k)"), F.array(F.expr("concat('f', k, 'long')")), "kind", F.array("verse_id"))
    return checks.grade_findings(grade, base.union(second).union(third))


@L.add("E19", f"with {PART} select k as work, 0 as a, 0 as b, length(replace(name, ' ', '')) as n from p union all select k, 1, 0, length(kind) from p")
def p_concordance(spark, sf_dir):
    pairs = _part(spark, sf_dir).select(F.col("k").cast("string").alias("work"), F.expr("array(concat(name, ' '), kind)").alias("a"), F.expr("array(concat(name, '. ', kind, '!'))").alias("b"))
    return align.concordance(pairs).toDF("work", "a", "b", "n").withColumn("work", F.col("work").cast("long"))


@L.add("E20", f"""with {PART}, t as (select k, name, length(name) as n, m from p, unnest([0, 1, 2, 3]) as u(m))
select k * 4 + m as k, case m when 3 then 0 else n + 2 end as "start", case m when 3 then n + 2 when 0 then n + 22 else n + 34 end as "end",
  case m when 0 then n + 9 when 1 then n + 2 when 2 then 2 end as to_start, case m when 0 then n + 29 when 1 then n + 35 when 2 then 34 end as to_end from t""")
def p_projected_spans(spark, sf_dir):
    """By turns: seven signs put in before the span, one put in inside it, what stands before it taken out, and a span that is itself taken out."""
    p = _part(spark, sf_dir).withColumn("tail", F.expr("md5(cast(k as string))")).withColumn("m", F.explode(F.array(*map(F.lit, range(4)))))
    a = "concat(name, '; ', tail)"
    b = "case m when 0 then concat(name, '; ', '#######', tail) when 1 then concat(name, '; ', left(tail, 16), '#', substring(tail, 17)) when 2 then concat('; ', tail) else tail end"
    own = p.select((F.col("k") * 4 + F.col("m")).alias("k"), "m", F.length("name").alias("n"), F.expr(a).alias("a"), F.expr(b).alias("b"))
    spans = own.select("k", F.expr("case m when 3 then 0 else n + 2 end").alias("start"), F.expr("case m when 3 then n + 2 when 0 then n + 22 else n + 34 end").alias("end"))
    return longs(align.projected_spans(spans, own.select("k", "a", "b"), "k"), "start", "end", "to_start", "to_end")


@L.add("E18", f"with {PART} select k, name || ' ' || md5(k || '') as line, round(2 * (n - 1) / (2 * n), 9) as score, '#' || substr(name || ' ' || md5(k || ''), 2) as \"window\" from (select *, length(name) + 33 as n from p)")
def p_best_windows(spark, sf_dir):
    """A line whose first sign was changed in the passage, between other words."""
    p = _part(spark, sf_dir).withColumn("line", F.expr("concat(name, ' ', md5(cast(k as string)))"))
    passages = p.select("k", F.expr("concat('x yy ', substring(name, 1, 3), ' # ', '#', substring(line, 2), ' ', kind, ' ', name)").alias("passage"))
    return align.best_windows(p.select("k", "line"), passages, "k").select("k", "line", F.round("score", 9).alias("score"), "window")


@L.add("E15 E16", f"with {PART}, t as (select k, 34 + length(kind) as n from p) select k as a, k as b, round(2 * n / (2 * n + 1), 9) as score from t")
def p_fuzzy_map(spark, sf_dir):
    """Texts of a digest each, so that only a row's own text is like it."""
    t = _part(spark, sf_dir).select("k", F.expr("concat(md5(cast(k as string)), ': ', kind)").alias("text"))
    found = fuzzy.fuzzy_map(t.select(F.col("k").alias("a"), "text"), t.select(F.col("k").alias("b"), F.concat("text", F.lit("!")).alias("text")), "a", "b", 0.95)
    return found.select("a", "b", F.round("score", 9).alias("score"))


@L.add("E22", f"with {PART} select k, 0 as pos, left(replace(name, ' ', ''), 4) as gram from p")
def p_unique_grams(spark, sf_dir):
    t = _part(spark, sf_dir).select("k", F.col("name").alias("text"))
    return align.unique_grams(t, "k", 4).where("pos = 0").select("k", "pos", "gram")


@L.add("B9 I5 I7 I8 J1 J2 J3 J7", f"with {PART} select k, case when k % 4 = 0 then 'dry-run' else 'sent' end as status, case when k % 4 = 0 then null else 'got ' || name end as answer, k % 7 = 0 as refused from p where k % 3 <> 0")
def p_delivered(spark, sf_dir):
    """Payloads that a ledger lacks are posted, every first try failing; a dry run posts none; refused ones are found by halving."""
    p = _part(spark, sf_dir)
    rows = p.select("k", F.col("name").alias("payload"))
    ledger = p.where("k % 3 = 0").select("k", F.lit("sent").alias("status"))
    dry = hooks.delivered(rows.where("k % 4 = 0"), "k", str, ledger)
    sent = hooks.delivered(rows.where("k % 4 <> 0"), "k", _post(), ledger, dry_run=False)
    bad = hooks.isolate([r["k"] for r in _nation(spark, sf_dir).select("k").collect()], lambda ks: not any(k % 7 == 0 for k in ks))
    refused = F.col("k") % 7 == 0 if all(k % 7 == 0 for k in bad) and bad else F.lit(None)
    return dry.union(sent).withColumn("refused", refused)


def _post():
    """A service that fails at every first try."""
    tries: dict[str, int] = {}

    def call(prompts: list[str]) -> list[str]:
        for x in prompts:
            tries[x] = tries.get(x, 0) + 1
            if tries[x] % 2:
                raise ConnectionError
        return [f"got {x}" for x in prompts]

    once = hooks.retrying(call, tries=3, sleep=lambda _: None)
    return lambda payload: once([payload])[0]
