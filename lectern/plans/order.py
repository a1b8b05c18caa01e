"""Queries on ordered rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import scores, segment, sequence
from lectern.plans.base import LINES_SQL, Listing, longs, table
from lectern.sources import notes

L = Listing()


def _lines(spark, sf_dir):
    return notes.lines(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


@L.add("G1 G2", f"with {LINES_SQL}, n as (select doc_id, count(*) as n from ln group by doc_id), w as (select doc_id, n, i as \"window\" from n, unnest(range(0, greatest(0, cast(ceil((n - 15) / 10.0) as bigint)) + 1)) as t(i)) select doc_id, \"window\", \"window\" * 10 + 1 as \"start\", least(\"window\" * 10 + 15, n) as \"end\" from w")
def g_overlapping_windows(spark, sf_dir):
    return longs(sequence.overlapping_windows(_lines(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n")), ["doc_id"], "n", 15, 5), "window", "start")


_STITCH = "s as (select event_id, user_id, ts, sum(case when prev_user = user_id and epoch(ts) - epoch(prev_ts) <= 600 then 0 else 1 end) over (order by ts rows unbounded preceding)::bigint as unit from (select *, lag(user_id) over (order by ts) as prev_user, lag(ts) over (order by ts) as prev_ts from events))"


@L.add("G6", f"with {_STITCH} select unit, min(user_id) as user_id, min(ts) as \"start\", max(ts) as \"end\", count(*) as n from s group by unit")
def g_stitched_sessions(spark, sf_dir):
    return sequence.units(sequence.stitched(table(spark, sf_dir, "events"), "user_id", "ts"), "user_id", "ts")


@L.add("G6", "with s as (select conv_id, role, turn, sum(case when prev = role then 0 else 1 end) over (partition by conv_id order by turn rows unbounded preceding)::bigint as unit from (select *, lag(role) over (partition by conv_id order by turn) as prev from conversations)) select conv_id, unit, min(role) as role, min(ts) as \"start\", max(ts) as \"end\", count(*) as n from (select *, timestamp '2024-01-01' + turn * interval 1 minute as ts from s) group by all")
def g_stitched_turns(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, turn, 0)"))
    return sequence.units(sequence.stitched(rows, "role", "ts", channel=["conv_id"]), "role", "ts", ["conv_id"])


@L.add("G12", "with v as (select l_orderkey as chapter, l_linenumber as verse from lineitem group by all), r as (select *, (row_number() over (partition by chapter order by verse) - 1) // 3 as b from v), d as (select chapter, b, min(verse) as vstart, max(verse) as vend, count(*) as n from r group by all) select row_number() over (order by chapter, b) as day, chapter, vstart, vend, n from d")
def g_verse_buckets(spark, sf_dir):
    verses = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("verse")).distinct()
    return sequence.verse_buckets(verses, "chapter", "verse", 3)


@L.add("G16", f"with {LINES_SQL} select doc_id, line_no, coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0)::bigint as \"start\", coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0)::bigint + length(line) as \"end\" from ln")
def g_content_offsets(spark, sf_dir):
    return longs(sequence.content_offsets(_lines(spark, sf_dir), ["doc_id"], "line_no", "line").select("doc_id", "line_no", "start", "end"), "line_no")


_HEAD = "hd as (select doc_id, line_no, case when length(line) < 20 then 2 when length(line) < 40 then 3 else 0 end as level from ln)"


@L.add("G7", f"with {LINES_SQL}, {_HEAD}, a as (select *, sum((level = 2)::int) over (partition by doc_id order by line_no)::bigint as h2 from hd), b as (select *, sum((level = 0)::int) over (partition by doc_id, h2 order by line_no)::bigint as n, sum((level = 3)::int) over (partition by doc_id, h2 order by line_no)::bigint as h3 from a) select doc_id, line_no, case when level = 2 then h2 || '-0' when level = 3 then h2 || '-' || h3 || '-0' else h2 || '-' || n end as assigned_id from b")
def g_heading_numbers(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("level", F.when(F.length("line") < 20, 2).when(F.length("line") < 40, 3).otherwise(0))
    return longs(sequence.heading_numbers(rows, ["doc_id"], "line_no", "level").select("doc_id", "line_no", "assigned_id"), "line_no")


@L.add("G14 D41", f"with {LINES_SQL}, o as (select doc_id, line_no, line, coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0)::bigint as off, sum(length(line) + 1) over (partition by doc_id)::bigint as total from ln), h as (select doc_id, line_no as pos, case when length(line) < 20 then 1 else 2 end as level, off, total from o where length(line) < 40) select a.doc_id, a.pos, a.level, a.off as \"start\", coalesce(min(b.off), any_value(a.total)) as \"end\" from h a left join h b on a.doc_id = b.doc_id and b.pos > a.pos and b.level <= a.level group by a.doc_id, a.pos, a.level, a.off")
def g_nested_spans(spark, sf_dir):
    rows = sequence.content_offsets(_lines(spark, sf_dir), ["doc_id"], "line_no", "line")
    total = rows.groupBy("doc_id").agg(F.sum(F.length("line") + 1).alias("total"))
    heads = rows.where(F.length("line") < 40).select("doc_id", F.col("line_no").alias("pos"), F.when(F.length("line") < 20, 1).otherwise(2).alias("level"), F.col("start").alias("offset")).join(total, "doc_id")
    return longs(sequence.nested_spans(heads, ["doc_id"], "total"), "pos")


@L.add("G17 G18", "with n as (select conv_id, max(turn) as n from conversations group by 1 having max(turn) >= 2), w as (select conv_id, i as \"window\", i * 2 as s, least(i * 2 + 4, n) as e from n, unnest(range(0, greatest(0, cast(ceil((n - 4) / 2.0) as bigint)) + 1)) as t(i)), j as (select conv_id, \"window\", b from w, unnest(range(s, e)) as t(b) where (b * 7 + \"window\") % 3 <> 0), seen as (select k.conv_id, k.b, count(*) as seen from (select distinct conv_id, b from j) k join w using (conv_id) where s <= b and e >= b + 1 group by all), votes as (select conv_id, b, count(*) as votes from j group by all) select conv_id, b, votes, seen, votes = seen as kept from votes join seen using (conv_id, b)")
def g_join_votes(spark, sf_dir):
    n = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max("turn").alias("n")).where("n >= 2")
    last = F.greatest(F.lit(0), F.ceil((F.col("n") - 4) / 2)).cast("long")
    windows = n.select("conv_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("window")).select("conv_id", "window", (F.col("window") * 2).alias("start"), F.least(F.col("window") * 2 + 4, F.col("n")).alias("end"))
    joins = windows.where("start < `end`").select("conv_id", "window", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("b")).where("(b * 7 + window) % 3 <> 0")
    return sequence.join_votes(windows, joins, "conv_id")


@L.add("G18", "with v as (select distinct l_orderkey, l_linenumber from lineitem), r as (select *, l_linenumber - row_number() over (partition by l_orderkey order by l_linenumber) as g from v) select l_orderkey, min(l_linenumber) as \"first\", max(l_linenumber) as \"last\", count(*) as n from r group by l_orderkey, g")
def g_islands(spark, sf_dir):
    return sequence.islands(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct(), ["l_orderkey"], "l_linenumber")


_SPAN = "sp as (select user_id, cast(floor(epoch(ts)) as bigint) as \"start\", cast(floor(epoch(ts)) as bigint) + 3600 * (1 + event_id % 24) as \"end\" from events)"


@L.add("H25", f"with {_SPAN}, t as (select *, max(\"end\") over (partition by user_id order by \"start\", \"end\" rows between unbounded preceding and 1 preceding) as top from sp), g as (select *, sum(case when top is not null and \"start\" <= top then 0 else 1 end) over (partition by user_id order by \"start\", \"end\" rows unbounded preceding) as g from t) select user_id, min(\"start\") as \"start\", max(\"end\") as \"end\", count(*) as n from g group by user_id, g")
def h_merged_intervals(spark, sf_dir):
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    rows = table(spark, sf_dir, "events").select("user_id", start.alias("start"), (start + 3600 * (1 + F.col("event_id") % 24)).alias("end"))
    return sequence.merged_intervals(rows, ["user_id"])


@L.add("G5 E12", "select conv_id, turn, coalesce(array_to_string(list(role) over (partition by conv_id order by turn rows between 3 preceding and 1 preceding), ','), '') as context from conversations")
def g_rolling_context(spark, sf_dir):
    rows = sequence.rolling_context(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role", 3)
    return rows.select("conv_id", "turn", F.array_join("context", ",").alias("context"))


@L.add("G4", "with r as (select source, doc_id, n_chars, coalesce(sum(n_chars) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) as before, sum(n_chars) over (partition by source) as total from documents) select source, doc_id, least(3, cast(floor(before * 4 / greatest(1, total)) as int)) as lane from r")
def g_lanes(spark, sf_dir):
    return sequence.lanes(table(spark, sf_dir, "documents"), ["source"], "doc_id", "n_chars", 4).select("source", "doc_id", "lane")


@L.add("G3")
def g_capped_batches(spark, sf_dir):
    return sequence.capped_batches(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", 12, 20_000)


@L.add("G22 D34", "with r as (select *, case when lag(event_type) over w is not distinct from event_type and row_number() over w > 1 then 0 else 1 end as new from events window w as (partition by user_id order by event_id)), g as (select *, sum(new) over (partition by user_id order by event_id rows unbounded preceding) as g from r) select user_id, min(event_type) as event_type, min(event_id) as \"first\", max(event_id) as \"last\", count(*) as n from g group by user_id, g")
def g_same_target_islands(spark, sf_dir):
    return sequence.same_target_islands(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type")


@L.add("G24", "with sp as (select doc_id, (doc_id % 7) * 5 + i * 40 as \"start\", (doc_id % 7) * 5 + i * 40 + 30 as \"end\", n_chars from documents, unnest(range(0, 3)) as t(i) where n_chars >= 200), w as (select *, coalesce(lag(\"end\") over (partition by doc_id order by \"start\"), 0) as top from sp) select doc_id, \"start\", \"end\", 'span' as kind, \"start\" < top as overlap from w union all select doc_id, top, \"start\", 'gap', false from w where \"start\" > top union all select doc_id, max(\"end\"), max(n_chars), 'gap', false from sp group by doc_id having max(\"end\") < max(n_chars)")
def g_gap_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("n_chars >= 200").select("doc_id", "n_chars", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
    spans = docs.select("doc_id", ((F.col("doc_id") % 7) * 5 + F.col("i") * 40).alias("start"), ((F.col("doc_id") % 7) * 5 + F.col("i") * 40 + 30).alias("end"), "n_chars")
    return sequence.gap_spans(spans, ["doc_id"], "n_chars")


@L.add("G25 E39", "select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows unbounded preceding) as section from conversations")
def g_sections(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("node", F.when(F.col("role") == "user", F.col("turn")))
    return sequence.section_of(rows, ["conv_id"], "turn", "node").select("conv_id", "turn", "section")


@L.add("G21", "select source, string_agg(text, chr(10) || chr(10) order by doc_id) as text, count(*) as n_chapters from documents group by source")
def g_merged_chapters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", F.concat(F.lit("Chapter-"), F.col("doc_id").cast("string")).alias("name"), "text")
    return sequence.merged_chapters(docs, "source", "name", "text")


@L.add("C51", "select cast(d as date) as day, row_number() over (order by d) as n from (select unnest(generate_series(date '2024-01-01', date '2024-03-01', interval 1 day)) as d) where extract(isodow from d) < 6 and d not in (date '2024-01-15') order by d limit 30")
def c_date_series(spark, sf_dir):
    return sequence.date_series(spark, "2024-01-01", 30, (5, 6), ("2024-01-15",)).withColumn("n", F.col("n").cast("long"))


@L.add("G10 G9", "select conv_id, turn, case when role = 'assistant' and max(case when role = 'user' then turn end) over w is not null then (max(case when role = 'user' then turn end) over w) || '-' || n end as assigned_id from (select *, sum((role = 'assistant')::int) over (partition by conv_id, lab order by turn) as n from (select *, max(case when role = 'user' then turn end) over (partition by conv_id order by turn) as lab from conversations)) window w as (partition by conv_id order by turn)")
def g_body_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return sequence.body_ids(rows, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn").cast("string")), F.col("role") == "assistant").select("conv_id", "turn", "assigned_id")


@L.add("F34", f"with {LINES_SQL}, c as (select doc_id, line_no, length(line) // 40 + 1 as size from ln), n as (select *, coalesce(lag(size) over w = size, false) or coalesce(lead(size) over w = size, false) as alike from c window w as (partition by doc_id order by line_no)) select doc_id, sum(size)::bigint as syllables, round(sum(case when alike then size else 0 end) / greatest(sum(size), 1), 6) as share, case when round(sum(case when alike then size else 0 end) / greatest(sum(size), 1), 6) >= 0.8 then 'verse' when round(sum(case when alike then size else 0 end) / greatest(sum(size), 1), 6) >= 0.3 then 'mixed' else 'prose' end as kind from n group by doc_id")
def f_verse_share(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("size", F.floor(F.length("line") / 40) + 1)
    return segment.verse_share(rows, ["doc_id"], "line_no", "size")


_FACTS = "facts as (select user_id, (event_type = 'purchase')::int as prs, value as lines, (event_type = 'view')::int as reviews, (event_type = 'error')::int as bugs, (event_id % 5)::int as challenge from events)"


@L.add("F28", f"with {_FACTS}, s as (select user_id, sum(prs)::bigint as prs, sum(lines) as lines, sum(reviews)::bigint as reviews, sum(bugs)::bigint as bugs, sum(challenge)::bigint as challenge_total, max(challenge) as max_challenge from facts group by user_id), t as (select *, round(prs * 2 + lines / 100 + reviews * 3 + bugs * 4 + challenge_total * 5, 1) as total from s), r as (select *, row_number() over (order by total desc, user_id) as rank, row_number() over (order by max_challenge desc, bugs desc, reviews desc, user_id) as hard from t) select user_id, prs, round(lines, 4) as lines, reviews, bugs, challenge_total, max_challenge, total, rank, rank = 1 as is_lead, case when (select bool_or(hard = 1 and rank = 1) from r) then rank = (select min(rank) from r where rank > 1 and (max_challenge > 0 or bugs > 0)) else hard = 1 end as is_mvp from r")
def f_contributor_score(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    is_ = lambda t: (F.col("event_type") == t).cast("long")
    facts = e.select("user_id", is_("purchase").alias("prs"), F.col("value").alias("lines"), is_("view").alias("reviews"), is_("error").alias("bugs"), (F.col("event_id") % 5).cast("int").alias("max_challenge"), (F.col("event_id") % 5).cast("long").alias("challenge_total"))
    out = scores.contributors(facts, "user_id")
    return out.withColumn("lines", F.round("lines", 4)).withColumn("rank", F.col("rank").cast("long"))


@L.add("F29", "select p_partkey, case when p_size >= 13 then 5 when p_size >= 8 then 4 when p_size >= 5 then 3 when p_size >= 3 then 2 else 1 end as challenge from part")
def f_challenge(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scores.challenge(F.col("p_size"), F.lit(0), F.lit(0)).alias("challenge"))


_DAY = "cast((ts + interval '5 hours 30 minutes' - interval '1 hour') as date)"


@L.add("F31 I2 I3", f"select user_id, count(distinct case when d >= date '2024-01-10' and d < date '2024-01-20' then d end) as days, count(case when d >= date '2024-01-10' and d < date '2024-01-20' then d end) as commits, count(*) as unique_commits from (select *, {_DAY} as d from events) group by user_id")
def f_commit_days(spark, sf_dir):
    return scores.commit_days(table(spark, sf_dir, "events"), "user_id", "event_id", "ts", "2024-01-10", "2024-01-20")


@L.add("F32", f"with cal as (select unnest(generate_series(date '2024-01-10', date '2024-01-19', interval 1 day))::date as day), u as (select distinct user_id from events), c as (select distinct user_id, {_DAY} as day from events) select user_id, day from u, cal where (user_id, day) not in (select user_id, day from c)")
def f_skipped_days(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    calendar = spark.sql("select explode(sequence(date'2024-01-10', date'2024-01-19')) as day")
    return scores.skipped_days(calendar, e.select("user_id", T.work_day("ts").alias("day")), e.select("user_id").distinct(), "user_id")


@L.add("F21", "with r as (select l_returnflag as chapter, l_orderkey as verse, case when l_linestatus = 'F' and l_quantity > 45 then 'ERROR' when l_quantity > 30 then 'MISMATCH' end as result from lineitem), s as (select chapter, verse, max((coalesce(result, '') = 'ERROR')::int) as e, sum((coalesce(result, '') = 'MISMATCH')::int) as m from r group by all) select chapter, count(*) as verses, sum((e = 0 and m = 0)::int)::bigint as clean, sum(e)::bigint as error, sum((e = 0 and m > 0)::int)::bigint as mismatch_only, sum(m)::bigint as mismatch_rows from s group by rollup (chapter)")
def f_tally_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("chapter"), F.col("l_orderkey").alias("verse"), F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") > 45), "ERROR").when(F.col("l_quantity") > 30, "MISMATCH").alias("result"))
    return scores.tally(rows.where("result is not null"), rows, "chapter", "verse", "result")


@L.add("F22 F23", "select o_orderpriority, count(*) as passages, min(o_orderkey) as \"first\", max(o_orderkey) as \"last\" from orders group by 1")
def f_coverage(spark, sf_dir):
    return scores.coverage(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


@L.add("F30", "select p_partkey, case when p_type in ('PROMO') then 'bug' when p_type in ('ECONOMY') then 'infra' when p_type in ('STANDARD') then 'feature' when regexp_matches(lower(p_name), 'fix|bug|patch|hotfix') then 'bug' when regexp_matches(lower(p_name), 'infra|deploy|ci|refactor|migrate|performance') then 'infra' else 'feature' end as category from part")
def f_categorise(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scores.category(F.array("p_type"), F.col("p_name"), ["PROMO"], ["ECONOMY"], ["STANDARD"]).alias("category"))


@L.add("F37 B10", "select event_type, user_id % 10 as repo, count(*) as n from events group by all")
def f_catalogue(spark, sf_dir):
    return scores.catalogue(table(spark, sf_dir, "events").select("event_type", F.array(F.col("user_id") % 10).alias("repos")), "event_type", "repos")


@L.add("F39 F38", "with f as (select l_orderkey as item, l_linenumber as pos, case when l_linenumber % 2 = 0 then 'Estimate' else 'other' end as name, l_quantity as number, l_partkey from lineitem) select item, arg_min(number, pos * 1000000000000 + l_partkey * 100 + number) as points from f where regexp_matches(lower(name), 'point|size|estimate|effort') and number is not null group by item")
def f_story_points(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item"), (F.col("l_linenumber") * 1000000000000 + F.col("l_partkey") * 100 + F.col("l_quantity")).alias("pos"), F.when(F.col("l_linenumber") % 2 == 0, "Estimate").otherwise("other").alias("name"), F.col("l_quantity").alias("number"))
    return scores.story_points(f, "item")


@L.add("F40", "select distinct p_brand as package from part")
def f_package_union(spark, sf_dir):
    return scores.package_union(table(spark, sf_dir, "part").groupBy("p_type").agg(F.collect_list("p_brand").alias("packages")), "packages")
