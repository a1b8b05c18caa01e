"""Queries on text functions and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import segment, terms
from lectern.plans.base import LINES_SQL, Listing, longs, sql_words, table
from lectern.sources import notes, sinks
from lectern.sources.stage import staged

L = Listing()


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@L.add("C11 C12 D12", "select doc_id, length(regexp_replace(text, '\\s+', '', 'g')) as squeezed, length(regexp_replace(text, '[^\\p{L}]', '', 'g')) as letters, length(regexp_replace(text, '[།༎་༅༄༈\\s]', '', 'g')) as keyed from documents")
def c_text_keys(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.length(T.squeeze("text")).cast("long").alias("squeezed"), F.length(T.letters_only("text")).cast("long").alias("letters"), F.length(T.delimiter_key("text")).cast("long").alias("keyed"))


@L.add("C7 C8 C9", f"select doc_id, len(regexp_extract_all(text, '[ཀ-ྼ]+')) as syllables, len(regexp_extract_all(text, '[་༌]')) + 1 as tshegs, len(list_filter(regexp_split_to_array(regexp_replace({__import__('lectern.plans.base', fromlist=['x']).sql_clean('text')}, '[!-/:-@\\[-`{{-~“”‘’—–…]', ' ', 'g'), '\\s+'), lambda x: x <> '')) as words from documents")
def c_unit_counts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.syllable_count("text").cast("long").alias("syllables"), T.tsheg_count("text").cast("long").alias("tshegs"), T.unit_count("text", "words").cast("long").alias("words"))


@L.add("C17 C23", "select item_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), '\\b(the|a|an)\\b', ' ', 'g'), '[^\\w\\s]', ' ', 'g'), '\\b(\\w{4,})s\\b', '\\1', 'g'), '\\b(\\w{3,}?)(?:ing|ed|e)\\b', '\\1', 'g'), '\\s+', ' ', 'g')) as loose from benchmark where regexp_full_match(text, '[\\x00-\\x7f]*')")
def c_loose_form(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").where(F.rlike("text", F.lit(r"^[\x00-\x7f]*$"))).select("item_id", T.loose_form("text").alias("loose"))


@L.add("C40", "select p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') as slug from part")
def c_slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.slug("p_name").alias("slug"))


@L.add("C46 C47", "select doc_id, 'latn' as script, false as stray from documents")
def c_scripts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.script("text").alias("script"), T.has_stray_latin("text").alias("stray"))


@L.add("C38", "select conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(text, '<@!?&?\\d+>', '@someone', 'g'), '<#\\d+>', '#channel', 'g'), '<a?:(\\w+):\\d+>', ':\\1:', 'g')) as clean from conversations")
def c_message_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.message_text("text").alias("clean"))


@L.add("C39", "select conv_id, turn, length(trim(text)) < 60 or (length(trim(text)) < 160 and regexp_matches(lower(text), '\\b(this|that|it|here|these|those|same|above|below)\\b')) as vague from conversations")
def c_vague_messages(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.vague("text").alias("vague"))


@L.add("C50", "select cast((ts + interval '5 hours 30 minutes' - interval '1 hour') as date) as day, count(*) as n, count(distinct user_id) as users from events group by all")
def c_work_days(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(T.work_day("ts").alias("day")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@L.add("C41", "select o_orderkey, '1-' || o_orderkey as block_id, row_number() over (partition by o_custkey order by o_orderkey) as place from orders")
def c_natural_order(spark, sf_dir):
    from pyspark.sql import Window as W
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.concat(F.lit("1-"), F.col("o_orderkey").cast("string")).alias("block_id"))
    return rows.withColumn("place", F.row_number().over(W.partitionBy("o_custkey").orderBy(T.natural_key("block_id"))).cast("long")).drop("o_custkey")


@L.add("C37 A35 A36", "select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g')) as plain from pages")
def c_page_plain_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.plain_html("html").alias("plain"))


@L.add("A37", "select tag, class, count(*) as n, count(distinct page_id) as n_pages from (select page_id, lower(regexp_extract(m, '<([a-zA-Z0-9]+)', 1)) as tag, regexp_extract(m, 'class=\"([^\"]*)\"', 1) as class from (select page_id, unnest(regexp_extract_all(html, '<([a-zA-Z0-9]+)[^>]*\\sclass=\"([^\"]*)\"')) as m from pages)) group by all")
def a_class_counts(spark, sf_dir):
    return notes.class_counts(table(spark, sf_dir, "pages"))


@L.add("A35", "select tag, count(*) as n, count(distinct page_id) as n_pages from (select page_id, lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) as tag from pages) group by all")
def a_tag_counts(spark, sf_dir):
    return notes.tag_counts(table(spark, sf_dir, "pages"))


@L.add("A36 A41", "with a as (select page_id, regexp_extract_all(html, '<a\\s+href=\"([^\"]*)\"[^>]*>([^<]*)</a>') as l from pages) select page_id, i - 1 as pos, regexp_extract(l[i], 'href=\"([^\"]*)\"', 1) as href, regexp_extract(l[i], '>([^<]*)<', 1) as label from a, unnest(range(1, len(l) + 1)) as t(i)")
def a_link_runs(spark, sf_dir):
    return longs(notes.link_runs(table(spark, sf_dir, "pages")), "pos")


@L.add("A2 A7", f"with {LINES_SQL} select doc_id, lang, source, line_no, doc_id || '-' || line_no as block_id, line from ln where trim(line) <> ''")
def a_doc_blocks(spark, sf_dir):
    return longs(notes.doc_blocks(_docs(spark, sf_dir)), "line_no")


@L.add("A26", "with e as (select unnest(map_entries(cast(cast(props as json) as map(varchar, json)))) as e from events) select e.key as key, count(*) as n, count(distinct json_extract_string(e.value, '$')) as n_values, min(json_extract_string(e.value, '$')) as sample from e group by 1")
def a_json_profile(spark, sf_dir):
    return notes.json_profile(table(spark, sf_dir, "events"), "props")


CATEGORY = ["event_type", "user_id"]
_UNPIVOT = "u as (select 'event_type' as field, event_type as value from events union all select 'user_id', cast(user_id as varchar) from events)"


@L.add("A27 A28", f"with {_UNPIVOT} select field, count(*) as n, count(distinct value) as n_values from u group by field having count(distinct value) > 1 and count(distinct value) <= 20 and count(distinct value) * 5 < count(*)")
def a_category_fields(spark, sf_dir):
    return notes.category_fields(table(spark, sf_dir, "events"), CATEGORY)


@L.add("A27", f"with {_UNPIVOT} select field, value, count(*) as n from u group by all")
def a_value_counts(spark, sf_dir):
    return notes.value_counts(table(spark, sf_dir, "events"), CATEGORY)


@L.add("A29", "with r as (select conv_id, turn, text, row_number() over (partition by conv_id order by turn) as i, count(*) over (partition by conv_id) as n from conversations) select conv_id, turn, text from r where i <= 2 or i = n // 2 + 1 or i > n - 2")
def a_stratified_samples(spark, sf_dir):
    return notes.samples(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "turn", 5, ["conv_id"])


@L.add("A24 B7", "with l as (select l_orderkey, l_linenumber, max({a: l_shipdate, b: l_extendedprice}) as r from lineitem group by all) select l_orderkey, l_linenumber, r.a as l_shipdate, r.b as l_extendedprice from l")
def a_ledger_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    return notes.latest(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")


@L.add("A47 A30 A31 A49", "with s as (select doc_id, i * 100 as \"start\", least((i + 1) * 100, length(text)) as \"end\", text from documents, unnest(range(0, (length(text) + 99) // 100)) as t(i)) select doc_id, \"start\", \"end\", substr(text, \"start\" + 1, \"end\" - \"start\") as segment from s")
def a_span_segments(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    n = F.length("text")
    spans = docs.where(n > 0).select("doc_id", n.alias("n"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / 100).cast("int"))).alias("i")).select("doc_id", (F.col("i") * 100).alias("start"), F.least(F.col("i") * 100 + 100, F.col("n")).alias("end"))
    return longs(notes.span_segments(docs, spans, "doc_id"), "start", "end")


@L.add("B4 B5", "select doc_id, sha256(text) as sha from documents")
def b_hash_baseline(spark, sf_dir):
    return sinks.baseline(_docs(spark, sf_dir).select("doc_id", F.col("text").alias("content")), "doc_id")


@L.add("B2 B11 B12", "with f as (select p_brand as keyword, p_type as rendering, count(*) as freq from part group by all) select keyword, '## ' || keyword || chr(10) || chr(10) || '| rendering | freq |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || rendering || ' | ' || freq || ' |', chr(10) order by freq desc, rendering) as note from f group by keyword")
def b_glossary_notes(spark, sf_dir):
    return sinks.glossary_notes(table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("keyword"), F.col("p_type").alias("rendering")).agg(F.count("*").alias("freq")))


@L.add("B15 B16", "select conv_id, string_agg(role || ': ' || text, chr(10) order by turn) as text from conversations group by conv_id")
def b_threads(spark, sf_dir):
    return sinks.rendered(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], F.concat_ws(": ", "role", "text"))


@L.add("B1 B6", "select event_type, count(*) as n, sum(case when value >= 0 then 1 else 0 end)::bigint as ok, 0::bigint as skip, sum(case when value < 0 then 1 else 0 end)::bigint as abort from events group by 1")
def f_batch_summary(spark, sf_dir):
    from lectern.operators import scores
    return scores.batch_summary(table(spark, sf_dir, "events").withColumn("status", F.when(F.col("value") >= 0, "ok").otherwise("abort")), ["event_type"], "status")


@L.add("H26", f"with w as (select word, count(*) as c from (select unnest({sql_words('text')}) as word from documents) group by word), v as (select * from w where c >= 5), u as (select word from w where c < 5), k as (select word, k, left(word, k) as head, substr(word, k + 1) as tail from u, unnest(range(2, length(word) - 1)) as t(k)), b as (select k.*, a.c as h, z.c as t from k join v a on a.word = head join v z on z.word = tail) select word, head, tail from (select *, row_number() over (partition by word order by least(h, t) desc, k) as r from b) where r = 1")
def h_two_word_splits(spark, sf_dir):
    counts = staged(terms.word_counts(_docs(spark, sf_dir)))
    return segment.two_word_splits(counts.where("count < 5"), counts.where("count >= 5"))


@L.add("H2 H10", f"with {LINES_SQL}, c as (select doc_id, line_no, list_filter(list_transform(regexp_extract_all(line, '[^།.!?]+[།.!?]*\\s*'), lambda x: trim(x)), lambda x: x <> '') as l from ln) select doc_id, line_no, i - 1 as pos, l[i] as clause from c, unnest(range(1, len(l) + 1)) as t(i)")
def h_clauses(spark, sf_dir):
    rows = notes.lines(_docs(spark, sf_dir), ["doc_id"])
    return longs(rows.select("doc_id", "line_no", F.posexplode(segment.clauses("line")).alias("pos", "clause")), "line_no", "pos")


@L.add("H1 H3 H4 H6 H8")
def h_segments(spark, sf_dir):
    return segment.segments(_docs(spark, sf_dir), "doc_id")
