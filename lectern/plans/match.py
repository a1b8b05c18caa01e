"""Queries on joins and alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import align, fuzzy, search
from lectern.plans.base import LINES_SQL, Listing, longs, sql_words, table
from lectern.sources import notes

L = Listing()


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _blocks(spark, sf_dir, lang):
    docs = _docs(spark, sf_dir).where(F.col("lang") == lang)
    rows = notes.lines(docs.select("doc_id", "source", "text"), ["doc_id", "source"])
    return rows.groupBy(F.concat_ws("-", "source", F.col("line_no").cast("string")).alias("block_id")).agg(F.min_by("line", "doc_id").alias("text"))


def _sql_blocks(lang):
    return f"select source || '-' || line_no as block_id, arg_min(line, doc_id) as text from ln where lang = '{lang}' group by 1"


@L.add("E1 A2 B1", f"with {LINES_SQL}, a as ({_sql_blocks('fr')}), b as ({_sql_blocks('es')}) select block_id, coalesce(a.text, '') as source_text, coalesce(b.text, '') as target_text, case when coalesce(a.text, '') <> '' and coalesce(b.text, '') <> '' then '' when coalesce(a.text, '') <> '' then 'target-only-missing' else 'source-only-missing' end as notes from a full join b using (block_id)")
def e_full_outer_align(spark, sf_dir):
    return align.full_outer(_blocks(spark, sf_dir, "fr"), _blocks(spark, sf_dir, "es"))


@L.add("E3", "select a.doc_id as \"row\", coalesce(case when a.doc_id % 10 = 0 then a.doc_id + 1 end, a.doc_id) as target, b.lang as target_text from documents a left join documents b on b.doc_id = coalesce(case when a.doc_id % 10 = 0 then a.doc_id + 1 end, a.doc_id)")
def e_paired_rows(spark, sf_dir):
    rows = _docs(spark, sf_dir).select(F.col("doc_id").alias("row"))
    fix = rows.where("row % 10 = 0").select("row", (F.col("row") + 1).alias("target"))
    return align.paired_rows(rows, _docs(spark, sf_dir).select(F.col("doc_id").alias("row"), F.col("lang").alias("text")), fix)


@L.add("E4 A10", "select c.conv_id, c.turn, d.doc_id, d.lang from conversations c left join documents d on d.doc_id = c.conv_id where c.role = 'user'")
def e_by_transclusion(spark, sf_dir):
    tr = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.col("conv_id").cast("string").alias("transcluded_id"))
    root = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("block_id"), F.col("lang").alias("text"))
    return align.by_transclusion(tr, root).select("conv_id", "turn", F.when(F.col("root_text").isNotNull(), F.col("transcluded_id").cast("long")).alias("doc_id"), F.col("root_text").alias("lang"))


_GROUPS = "m as (select *, role = 'user' as m from conversations), g0 as (select *, sum((m and not coalesce(pm, false))::int) over (partition by conv_id order by turn rows unbounded preceding) as g from (select *, lag(m) over (partition by conv_id order by turn) as pm from m))"


@L.add("E5", f"with {_GROUPS} select distinct a.conv_id, a.turn as scope, b.turn as turn from g0 a join g0 b on a.conv_id = b.conv_id and a.g = b.g where a.m and not b.m and b.g > 0")
def e_scope_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return align.scope_pairs(rows, ["conv_id"], "turn", F.col("role") == "user", "scope", "turn")


@L.add("E6 E8", f"with {LINES_SQL}, f as (select *, last_value(case when length(line) < 25 then line end ignore nulls) over (partition by doc_id order by line_no rows unbounded preceding) as ref from ln) select doc_id, ref, string_agg(line, chr(10) order by line_no) as passage, count(*) as n_lines from f where not length(line) < 25 and ref is not null group by all")
def e_passages(spark, sf_dir):
    rows = notes.lines(_docs(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    return align.passages(rows, ["doc_id"], "line_no", F.when(F.length("line") < 25, F.col("line")), "line")


@L.add("E7", f"with {_GROUPS}, f as (select conv_id, min(g) as g from g0 where m and turn = 1 group by 1) select distinct conv_id, turn from g0 join f using (conv_id, g) where not m")
def e_blocks_under(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("t", F.col("turn").cast("string"))
    return align.blocks_under(rows, ["conv_id"], "turn", F.col("role") == "user", "t", "1", "turn")


_NODES = "nodes as (select r_regionkey || '.' || n_nationkey || '.' || s_suppkey as node from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey), targets as (select r_regionkey || '.' || n_nationkey as target from nation join region on n_regionkey = r_regionkey where n_nationkey % 2 = 0 union all select r_regionkey || '' from region where r_regionkey < 2)"


def _nodes(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    nodes = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat_ws(".", F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string"), F.col("s_suppkey").cast("string")).alias("node"))
    targets = nation.where("n_nationkey % 2 = 0").select(F.concat_ws(".", F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string")).alias("target")).union(table(spark, sf_dir, "region").where("r_regionkey < 2").select(F.col("r_regionkey").cast("string")))
    return nodes, targets


@L.add("E9", f"with {_NODES} select node, target from nodes join targets on node = target or starts_with(node, target || '.')")
def e_ancestor_join(spark, sf_dir):
    return align.under(*_nodes(spark, sf_dir))


@L.add("E10", f"with {_NODES}, s as (select 'slot' || (row_number() over (order by target) % 7) as slot, target from targets union all select 'empty', '99'), f as (select distinct slot, node as claim_id, 'mapped' as kind from nodes join s on node = target or starts_with(node, target || '.')) select * from f union all select distinct slot, null, 'gap' from s where slot not in (select slot from f)")
def e_slot_packets(spark, sf_dir):
    from pyspark.sql import Window as W
    nodes, targets = _nodes(spark, sf_dir)
    slots = targets.select(F.concat(F.lit("slot"), (F.row_number().over(W.orderBy("target")) % 7).cast("string")).alias("slot"), "target").union(spark.createDataFrame([("empty", "99")], "slot string, target string"))
    return align.packet(slots, nodes.withColumn("claim_id", F.col("node")))


@L.add("E11 E21", "select doc_id, item_id, (length(d.text) - length(replace(d.text, b.text, ''))) // length(b.text) as n from documents d join benchmark b on contains(d.text, b.text)")
def e_substring_join(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    hits = search.term_hits(_docs(spark, sf_dir), items.withColumnRenamed("text", "term"), "doc_id")
    return hits.join(items.select("item_id", F.col("text").alias("term")), "term").select("doc_id", "item_id", "n")


@L.add("E12", "with t as (select distinct p_type as term from part), h as (select p_partkey, term from part join t on contains(lower(p_name || ' ' || p_type), lower(term))), r as (select *, row_number() over (partition by p_partkey order by length(term) desc, term) as rank from h) select p_partkey, term, rank from r where rank <= 3")
def e_glossary_hits(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    texts = part.select("p_partkey", F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("text"))
    terms = part.select(F.lower("p_type").alias("term"), F.col("p_type").alias("shown")).distinct()
    hits = search.term_hits(texts, terms, "p_partkey").join(F.broadcast(terms), "term")
    return align.capped(hits, "p_partkey", [F.desc(F.length("shown")), "shown"], 3).select("p_partkey", F.col("shown").alias("term"), F.col("rank").cast("long").alias("rank"))


@L.add("E25 H33", f"with w as (select distinct doc_id, unnest({sql_words('text')}) as form from documents), g as (select doc_id, 0 as pos, lower(lang) as token from documents union all select doc_id, 1, 'the' from documents), s as (select 'the' as token, 'and' as form union all select 'en', 'that' union all select 'de', 'der'), f as (select doc_id, pos, token, token as form from g union all select doc_id, pos, g.token, s.form from g join s using (token)), h as (select doc_id, pos, token, min(form) as found from f join w using (doc_id, form) group by all) select g.doc_id, g.pos, g.token, found, coalesce(found, '(' || g.token || ')') as gloss from g left join h using (doc_id, pos, token)")
def e_verbatim_words(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    g = docs.select("doc_id", F.lit(0).alias("pos"), F.lower("lang").alias("token")).union(docs.select("doc_id", F.lit(1), F.lit("the")))
    s = spark.createDataFrame([("the", "and"), ("en", "that"), ("de", "der")], "token string, form string")
    return align.verbatim_words(g, s, docs, "doc_id")


@L.add("E26", "select l_partkey as dst_note, l_suppkey as src_note, arg_min(l_linenumber, l_linenumber) as first_block, max(l_linenumber) as last_block, count(distinct l_linenumber) as n_blocks from lineitem group by all")
def e_back_references(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src_note"), F.col("l_partkey").alias("dst_note"), F.col("l_linenumber").alias("dst_block"))
    order = e.select("dst_note", "dst_block").distinct().withColumn("pos", F.col("dst_block"))
    return align.back_references(e, order)


@L.add("E27", "select c_custkey, coalesce(nullif(case when c_custkey % 3 = 0 then '' else n_name end, ''), c_mktsegment) as author, coalesce(nullif(case when c_custkey % 3 = 0 then '' else n_name end, ''), c_mktsegment) is distinct from c_mktsegment as author_changed from customer join nation on c_nationkey = n_nationkey")
def e_propagated(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    own = c.select("c_custkey", F.col("c_mktsegment").alias("author"))
    src = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("n_name")).alias("author"))
    return align.propagated(own, src, "c_custkey", ["author"])


@L.add("E29 E37", "with a as (select conv_id as verse_id, min(text) as t from conversations where role = 'user' group by 1), b as (select conv_id as verse_id, min(text) as t from conversations where role = 'system' group by 1), v as (select distinct conv_id as verse_id from conversations) select verse_id, a.t as one, b.t as two, array_to_string(list_filter([case when coalesce(a.t, '') = '' then 'one' end, case when coalesce(b.t, '') = '' then 'two' end], lambda x: x is not null), ',') as missing from v full join a using (verse_id) full join b using (verse_id)")
def e_witnesses(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "verse_id")
    of = lambda r: c.where(F.col("role") == r).groupBy("verse_id").agg(F.min("text").alias("text"))
    return align.witnesses(c.select("verse_id").distinct(), {"one": of("user"), "two": of("system")})


@L.add("E30", "select doc_id, case when doc_id % 5 = 0 then '<small>' || lang || '</small>' else lang end as text, case when doc_id % 5 = 0 then 'small' end as mark from documents")
def e_carried_marks(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return align.carried_marks(docs.select("doc_id", F.col("lang").alias("text")), docs.where("doc_id % 5 = 0").select("doc_id", F.lit("small").alias("mark")), "doc_id")


@L.add("E36 H22", "with m as (select s_suppkey as old, s_suppkey * 10 + i as new, i as pos from supplier, unnest(range(0, 2)) as t(i) where s_suppkey % 4 <> 0) select l_orderkey, l_linenumber, coalesce(new, l_suppkey) as dst_block, coalesce(pos, 0) as new_pos, new is null as unmapped from lineitem left join m on l_suppkey = old")
def e_repointed(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("dst_block"))
    m = table(spark, sf_dir, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("old"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"))
    return longs(align.repointed(e, m.withColumn("new", F.col("old") * 10 + F.col("pos"))), "new_pos")


@L.add("E39", "with n as (select user_id % 10 as k, ts, event_id from events where event_id % 50 = 0) select e.event_id as id, e.user_id % 10 as k, n.event_id as node from events e asof left join n on e.user_id % 10 = n.k and e.ts >= n.ts")
def e_as_of(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("k"), "ts", F.col("event_id").alias("id"))
    nodes = e.where("id % 50 = 0").select("k", "ts", F.col("id").alias("node"))
    return align.as_of(e, nodes, ["k"], "ts", "node").select("id", "k", "node")


@L.add("E34 E40 E41", "with s as (select user_id as k, cast(floor(epoch(ts)) as bigint) as \"start\", cast(floor(epoch(ts)) as bigint) + 2000 as \"end\", event_id as id from events) select a.k, a.id, b.id as id_b from s a join s b on a.k = b.k and a.\"start\" < b.\"end\" and a.\"end\" > b.\"start\" and a.id <> b.id")
def e_overlap_join(spark, sf_dir):
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    s = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), start.alias("start"), (start + 2000).alias("end"), F.col("event_id").alias("id"))
    return align.overlap_join(s, s, "k").where("id <> id_b").select("k", "id", "id_b")


@L.add("E42 H35", f"with {LINES_SQL}, h as (select doc_id, line_no, abs(line_no - 10) as d from ln where contains(line, 'the ')) select doc_id, line_no from (select *, row_number() over (partition by doc_id order by d, line_no) as r from h) where r = 1")
def e_nearest_line(spark, sf_dir):
    rows = notes.lines(_docs(spark, sf_dir).select("doc_id", "text"), ["doc_id"]).where(F.contains(F.col("line"), F.lit("the "))).withColumn("target", F.lit(10))
    return longs(align.nearest(rows, "doc_id", "line_no", "target"), "line_no")


@L.add("E22", "with t as (select item_id, regexp_replace(text, '[^\\p{L}]', '', 'g') as t from benchmark), g as (select item_id, i - 1 as pos, substr(t, i, 12) as gram from t, unnest(range(1, greatest(1, length(t) - 11) + 1)) as u(i)) select item_id, gram, min(pos) as pos from g group by all having count(*) = 1")
def e_unique_grams(spark, sf_dir):
    return align.unique_grams(table(spark, sf_dir, "benchmark"), "item_id", 12).withColumn("pos", F.col("pos").cast("long"))


@L.add("E15 E16")
def e_fuzzy_map(spark, sf_dir):
    """Pairs of like texts, and each copy with the first of its text."""
    return fuzzy.like_groups(_docs(spark, sf_dir).select("doc_id", "text"), "doc_id", "other_id", 0.9)


@L.add("E18", "select doc_id, i - 1 as line_no, string_split(text, chr(10))[i] as line, len(regexp_extract_all(string_split(text, chr(10))[i], '[^ \t\n\r\f\v]+')) > 0 as found from documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) as t(i) where text is not null")
def e_best_windows(spark, sf_dir):
    """Every line of a document in the document itself, where it must be found whole."""
    docs = _docs(spark, sf_dir)
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))
    got = align.best_windows(lines, docs.select("doc_id", F.col("text").alias("passage")), "doc_id")
    return got.select("doc_id", "line_no", "line", ((F.col("score") == 1) & (F.col("window") == F.trim(F.regexp_replace("line", r"\s+", " ")))).alias("found"))


_SENTENCES = "string_split(regexp_replace(coalesce(text, ''), '[.][ \t\n\f\r]', '.' || chr(1), 'g'), chr(1))"


def _sql_letters(parts, name):
    """Spans of the parts of a text among its letters."""
    return f"{name} as (select doc_id, i - 1 as i, length(regexp_replace(p, '[^\\p{{L}}]', '', 'g')) as n, sum(length(regexp_replace(p, '[^\\p{{L}}]', '', 'g'))) over (partition by doc_id order by i) as e from (select doc_id, i, {parts}[i] as p from documents, unnest(range(1, len({parts}) + 1)) as t(i)))"


@L.add("E19", f"""with {_sql_letters("string_split(coalesce(text, ''), chr(10))", "a")}, {_sql_letters(_SENTENCES, "b")},
m as (select a.doc_id || '' as work, a.i as row, b.i as block, least(a.e, b.e) - greatest(a.e - a.n, b.e - b.n) as letters, a.n as na, b.n as nb from a join b on a.doc_id = b.doc_id and a.e - a.n < b.e and b.e - b.n < a.e)
select work, row, block, letters::bigint as letters from m where letters > 0 and (letters >= 8 or letters = na or letters = nb)""")
def e_concordance(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("work"), F.split(text, "\n").alias("a"), F.split(text, r"(?<=[.])\s").alias("b"))
    return longs(align.concordance(docs), "row", "block", "letters")


@L.add("E20", """with s as (select doc_id, coalesce(text, '') as t, least(10, length(coalesce(text, ''))) as a, least(40, length(coalesce(text, ''))) as z from documents),
p as (select *, substr(t, a + 1, z - a) as span from s), q as (select *, a + length(span) - length(ltrim(span, chr(10))) as f, z - (length(span) - length(rtrim(span, chr(10)))) as l from p),
n as (select *, length(left(t, f)) - length(replace(left(t, f), chr(10), '')) as nf, length(left(t, l)) - length(replace(left(t, l), chr(10), '')) as nl from q)
select doc_id, a as "start", z as "end", case when f < l then f + 2 * nf end as to_start, case when f < l then l + 2 * nl end as to_end from n""")
def e_projected_spans(spark, sf_dir):
    """Spans of a text in the same text with its line feeds written out."""
    docs = _docs(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit("")))
    texts = docs.select("doc_id", F.col("text").alias("a"), F.regexp_replace("text", "\n", "⏎⏎⏎").alias("b"))
    spans = docs.select("doc_id", F.least(F.lit(10), F.length("text")).alias("start"), F.least(F.lit(40), F.length("text")).alias("end"))
    return longs(align.projected_spans(spans, texts, "doc_id"), "start", "end", "to_start", "to_end")
