"""Queries on notes, trees and edits that are planted in a table's rows, so that SQL can say from the columns what must come out.

A source text is an SQL expression over `part`; what an operator reads back
from it is told by SQL over the same columns, which knows nothing of the text.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as K

from lectern.functions import blocks, fold, tibetan
from lectern.functions import text as T
from lectern.operators import align, checks, fuzzy, hooks, intake, layout, scores, segment, sequence, terms
from lectern.operators import stanzas as stanza_search
from lectern.plans.base import Listing, table
from lectern.sources import notes, sinks
from lectern.sources.stage import staged
from lectern.streaming import feed

L = Listing()
NL = "chr(10)"


def _part(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))


#: The same columns in SQL.
PART = "p as (select p_partkey as k, p_name as name, p_type as kind, p_brand as brand, p_size as size from part)"


def _texts(spark, sf_dir, *parts: str):
    """``k`` and ``text`` of lines, each an SQL expression."""
    return _part(spark, sf_dir).select("k", "name", "kind", "brand", "size", F.expr(f"concat_ws({NL}, {', '.join(parts)})").alias("text"))


def _rows(sql: list[str], columns: str) -> str:
    """SQL for some rows a part: each a list of expressions."""
    return f"with {PART} " + " union all ".join(f"select {', '.join(f'{e} as {c}' for e, c in zip(r.split(' ; '), columns.split(), strict=True))} from p" for r in sql)


def _listed(f, *args, kind: K.DataType | None = None):
    """A function of one text as a column function."""
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: f(t, *args))
    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, kind or K.ArrayType(K.StringType()))


def _join(c: Column, by: str = "¦") -> Column:
    return F.array_join(c, by)


# scans


@L.add("A1 A44", _rows(["k ; name ; brand ; size || '' ; '# ' || kind || chr(10) || 'body'"], "k name brand size body"))
def p_frontmatter(spark, sf_dir):
    docs = _texts(spark, sf_dir, "'---'", "'name: ' || name", "'brand: \"' || brand || '\"'", "'# comment: no'", "'size: ' || size", "'---'", "'# ' || kind", "'body'")
    m = notes.frontmatter("text")
    return docs.select("k", m["name"].alias("name"), m["brand"].alias("brand"), m["size"].alias("size"), notes.body("text").alias("body"))


@L.add("B14", _rows(["k ; kind ; 'new ' || k ; name || chr(10) || 'kept: x'"], "k kind added body"))
def p_patched_frontmatter(spark, sf_dir):
    docs = _texts(spark, sf_dir, "'---'", "'kind: old'", "'---'", "name", "'kept: x'")
    out = None
    for kind in ("ECONOMY", "STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL"):  # a patch for each kind
        rows = docs.where(F.col("kind") == kind).select("k", notes.patched("text", {"kind": kind, "added": "new"}).alias("text"))
        out = rows if out is None else out.union(rows)
    rest = docs.where(~F.col("kind").isin("ECONOMY", "STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL")).select("k", F.lit("").alias("text"))
    m = notes.frontmatter("text")
    return out.union(rest).select("k", m["kind"].alias("kind"), F.concat(m["added"], F.lit(" "), F.col("k").cast("string")).alias("added"), notes.body("text").alias("body"))


@L.add("A2", _rows(["k ; 1 ; 'a-' || k ; name", "k ; 2 ; 'b-' || k ; kind || ' line' || chr(10) || 'more'", "k ; 3 ; '' ; 'plain ' || size"], "k pos block_id block"))
def p_blocks(spark, sf_dir):
    return notes.blocks(_texts(spark, sf_dir, "'# Title'", "''", "name || ' ^a-' || k", "''", "kind || ' line'", "'more ^b-' || k", "''", "'plain ' || size"), ["k"])


@L.add("A2", _rows(["k ; 'a' ; kind ; 1", "k ; 'b' ; brand ; 2"], "k block_id block pos"))
def p_last_blocks(spark, sf_dir):
    docs = _texts(spark, sf_dir, "name || ' ^a'", "''", "kind || ' ^a'", "''", "brand || ' ^b'")
    return notes.last_by_id(notes.blocks(docs, ["k"]), ["k"])


@L.add("A3 A9", _rows(["k ; '1-' || k ; 1 ; name || chr(10) || kind", "k ; '2-' || k ; 4 ; 'last ' || size"], "k block_id line_no block"))
def p_accumulated_blocks(spark, sf_dir):
    return notes.accumulated_blocks(_texts(spark, sf_dir, "name", "kind || ' ^1-' || k", "'![[x#^y]]'", "'last ' || size || ' ^2-' || k", "'open end'"), ["k"])


_UNITS = ("'# Top'", "''", "'## ' || kind", "''", "'![[root#^1-' || k || ']]'", "''", "name || ' ^2-2'", "'and ' || brand || ' ^2-' || size", "'## Next ^3-0'", "'[^1]: a note'")


@L.add("A4 A5 A6 A7 A8", _rows(["k ; 1 ; 1 ; 'heading' ; '' ; 1 ; null", "k ; 3 ; 3 ; 'heading' ; '' ; 2 ; kind", "k ; 5 ; 5 ; 'transclusion' ; '' ; 0 ; kind", "k ; 7 ; 8 ; 'block' ; '2-' || size ; 0 ; kind", "k ; 9 ; 9 ; 'heading' ; '3-0' ; 2 ; 'Next'", "k ; 10 ; 10 ; 'note' ; '' ; 0 ; 'Next'"], 'k start "end" kind block_id level heading'))
def p_typed_units(spark, sf_dir):
    return notes.typed_units(_texts(spark, sf_dir, *_UNITS), ["k"]).drop("text")


@L.add("A11 A48", _rows(["k ; '2-' || size ; 7 ; name || ' ^2-2' || chr(10) || 'and ' || brand || ' ^2-' || size"], "k block_id start text"))
def p_root_ids(spark, sf_dir):
    units = notes.typed_units(_texts(spark, sf_dir, *_UNITS), ["k"])
    units = staged(units.where("block_id <> ''").select("k", "block_id", "start", "end", "text"))
    out = None
    for n in range(1, 52):
        found = notes.extract_block(units, ["k"], f"2-{n}").select("k", F.lit(f"2-{n}").alias("block_id"), "start", "text") if n in (1, 2) else None
        out = found if out is None else out.union(found) if found is not None else out
    rest = notes.root_ids(units, ["k"]).join(units.select("k", "block_id", "start", "text"), ["k", "block_id"])
    return rest.join(out.select("k", "block_id"), ["k", "block_id"], "left_anti").select("k", "block_id", "start", "text").union(out)


@L.add("A10", _rows(["k ; 1 ; 'x-' || k ; '1-' || size", "k ; 4 ; '' ; ''"], "k start block_id transcluded_id"))
def p_block_links(spark, sf_dir):
    return notes.block_links(_texts(spark, sf_dir, "'![[root#^1-' || size || ']]'", "name || ' ^x-' || k", "''", "kind"), ["k"]).drop("text")


@L.add("A12", _rows(["k ; 2 ; name ; kind ; '1-1¦1-' || size", "k ; 3 ; kind ; name ; ''"], "k line_no source target verse_ids"))
def p_glossary_lines(spark, sf_dir):
    return notes.glossary_lines(_texts(spark, sf_dir, "'# comment'", "name || ' -> ' || kind || ' | 1-1, 1-' || size", "kind || chr(9) || name", "'no target'"), ["k"]).withColumn("verse_ids", _join(F.col("verse_ids")))


@L.add("A13 A19", _rows(["k ; 5 ; 'One of them' ; name || '¦' || size", "k ; 6 ; 'One of them' ; kind || '¦'"], "k line_no section cells"))
def p_table_rows(spark, sf_dir):
    docs = _texts(spark, sf_dir, "'# One of them'", "''", "'| a | b |'", "'|:--|--:|'", "'| ' || name || ' | ' || size || ' |'", "'| ' || kind || ' | |'", "'# Two'", "'| c |'", "'|---|'", "'| z |'")
    return notes.table_rows(docs, ["k"], "one").withColumn("cells", _join(F.col("cells")))


@L.add("A14 A15", _rows(["k ; 3 ; k ; 1 ; size ; size + 2 ; true", "k ; 4 ; 7 ; 3 ; 32 ; 33 ; false", "k ; 5 ; 8 ; 4 ; size ; size ; true"], "k line_no day chapter vstart vend well_formed"))
def p_schedule(spark, sf_dir):
    docs = _texts(spark, sf_dir, "'| Day | Verses |'", "'|---|---|'", "'| ' || k || ' | Prologue, 1.' || size || '-1.' || (size + 2) || ' |'", "'| 7 | 3.32-3-33 |'", "'| 8 | 4.' || size || ' |'", "'| x | 5.1 |'")
    return notes.schedule(docs, ["k"]).withColumn("day", F.col("day").cast("long"))


@L.add("A16 A17", f"with {PART} select k, name as keyword, case when size > 3 then 'beta:' || size || '¦alpha:3' when size = 3 then 'alpha:3¦beta:3' else 'alpha:3¦beta:' || size end as renderings from p")
def p_consolidated_glossary(spark, sf_dir):
    docs = _texts(spark, sf_dir, "'## ' || name", "''", "'| rendering | freq |'", "'|---|---|'", "'| alpha | 3 |'", "'| beta | ' || size || ' |'")
    found = notes.consolidated(notes.keyword_tables(docs, ["k"]), ["k"])
    return found.withColumn("renderings", _join(F.transform("renderings", lambda r: F.concat_ws(":", r["rendering"], r["freq"].cast("string")))))


@L.add("A18", _rows(["k ; 0 ; split_part(name, ' ', 1) ; 'x' ; '1'", "k ; 1 ; split_part(name, ' ', 2) ; 'y' ; null"], "k pos a b c"))
def p_gloss_tokens(spark, sf_dir):
    return notes.gloss_tokens(_texts(spark, sf_dir, "'text'", r"'\\gla ' || name", r"'\\glb x y'", r"'\\glc 1'"), ["k"])


@L.add("A20 A21", _rows(["k ; 'c-1-' || k ; 2 ; name ; '1-' || size ; kind ; '## c-1-' || k || chr(10) || 'Quote: \"' || name || '\"' || chr(10) || 'cite: ^1-' || size || chr(10) || '**referent**: ' || kind", "k ; 'c-2-9' ; 6 ; null ; null ; null ; '## c-2-9' || chr(10) || 'nothing'"], "k claim_id line_no quote cite referent block"))
def p_claims(spark, sf_dir):
    return notes.claims(_texts(spark, sf_dir, "'before'", "'## c-1-' || k", "'Quote: \"' || name || '\"'", "'cite: ^1-' || size", "'**referent**: ' || kind", "'## c-2-9'", "'nothing'"), ["k"])


_TOC = ("'* 1. ' || name || ' [[5]]'", "'   * 1.1 Sub [[' || (size + 6) || ']]'", "'   * 1.2 Other [[6]]'", "'  * 1.4 Far [[?]]'", "'* bad'", "'* 3.1 ' || kind || ' [[6]]'", "'* 1.1 Twice [[6]]'")


@L.add("A22 A23", _rows(["k ; 1 ; '1' ; 1 ; null ; name ; 5 ; '5' ; 0", "k ; 2 ; '1.1' ; 2 ; '1' ; 'Sub' ; size + 6 ; (size + 6) || '' ; 3", "k ; 3 ; '1.2' ; 2 ; '1' ; 'Other' ; 6 ; '6' ; 3", "k ; 4 ; '1.4' ; 2 ; '1' ; 'Far' ; null ; '?' ; 2", "k ; 5 ; null ; null ; null ; '' ; null ; '' ; 0", "k ; 6 ; '3.1' ; 2 ; '3' ; kind ; 6 ; '6' ; 0", "k ; 7 ; '1.1' ; 2 ; '1' ; 'Twice' ; 6 ; '6' ; 0"], "k line_no node_id depth parent_id title pointer context indent"))
def p_toc(spark, sf_dir):
    return notes.toc(_texts(spark, sf_dir, *_TOC), ["k"]).select("k", "line_no", "node_id", F.when(F.col("path").isNotNull(), F.size("path")).alias("depth"), "parent_id", "title", "pointer", "context", "indent")


_FINDING = "check_name severity entity_id detail"


@L.add("D31", _rows(["'unreadable' ; 'major' ; k || '-5' ; ''", "'duplicate_node' ; 'major' ; k || '-1.1' ; '2'", "'missing_parent' ; 'critical' ; k || '-3.1' ; '3'"], _FINDING))
def p_tree_checks(spark, sf_dir):
    return checks.tree_checks(notes.toc(_texts(spark, sf_dir, *_TOC), ["k"]), ["k"]).where("check_name in ('unreadable', 'duplicate_node', 'missing_parent')")


@L.add("D34", _rows(["'pointer_decreases' ; 'major' ; k || '-1.2' ; (size + 6) || '>6'", "'pointer_shared' ; 'minor' ; k || '-6' ; '3'"], _FINDING))
def p_pointers(spark, sf_dir):
    found = checks.monotonic(notes.toc(_texts(spark, sf_dir, *_TOC), ["k"]), ["k"])
    shared = F.col("check_name") == "pointer_shared"
    return found.withColumns({"severity": F.when(shared, "minor").otherwise(F.col("severity")), "entity_id": F.when(shared, F.regexp_replace("entity_id", "-[^-]*$", "-6")).otherwise(F.col("entity_id")), "detail": F.when(shared, "3").otherwise(F.col("detail"))})


@L.add("A28", "with s as (select 'l_linenumber' as field, count(distinct l_linenumber) as n_values, true as whole from lineitem union all select 'l_returnflag', count(distinct l_returnflag), false from lineitem) select * from s where n_values between 2 and 200 order by whole desc, n_values limit 1")
def p_chapter_field(spark, sf_dir):
    return notes.chapter_field(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linenumber"])


@L.add("A38", f"with {PART}, r as (select kind as class, case when size % 3 = 0 then brand when size % 3 = 1 then null else kind end as role, name from p), c as (select class, role, count(*) as n, list_sort(list(distinct name)) as s from r where role is distinct from class group by 1, 2) select class, role, n, array_to_string(s[1:2], '¦') as samples from c")
def p_mixed_classes(spark, sf_dir):
    runs = _part(spark, sf_dir).select(F.col("kind").alias("class"), F.expr("case when size % 3 = 0 then brand when size % 3 = 1 then null else kind end").alias("role"), F.col("name").alias("text"))
    return notes.mixed_class_paragraphs(runs).withColumn("samples", _join(F.col("samples")))


@L.add("A40", _rows(["k ; 1 ; name || ' and ' || kind ; name", "k ; 2 ; 'plain ' || size ; ''"], "k row text bold"))
def p_typed_rows(spark, sf_dir):
    return intake.typed_rows(_texts(spark, sf_dir, "'1. **' || name || '** and *' || kind || '*'", "'no row'", "'1. plain ' || size"), "k").withColumn("bold", _join(F.col("bold")))


@L.add("A41", "with s as (select s_nationkey as nation, s_suppkey as page, s_name as name, coalesce(sum(length('== ' || s_name || ' ==') + 17) over (partition by s_nationkey order by s_suppkey rows between unbounded preceding and 1 preceding), 0) as base from supplier) select nation, page, base as \"offset\", 2 as depth, name as label from s union all select nation, page, base + length('== ' || name || ' ==') + 5, 3, 'sub' from s")
def p_wiki_headings(spark, sf_dir):
    pages = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("page"), F.expr(f"concat_ws({NL}, '== ' || s_name || ' ==', 'abc', '=== sub ===')").alias("text"))
    return notes.wiki_stream(pages, "nation", "page")


@L.add("A42", _rows(["k ; 1 ; 'heading' ; 2 ; name", "k ; 2 ; 'bold' ; 1 ; kind", "k ; 3 ; 'numbered' ; 1 ; 'point ' || size"], "k line_no kind depth label"))
def p_outline_candidates(spark, sf_dir):
    return notes.outline_candidates(_texts(spark, sf_dir, "'== ' || name || ' =='", "concat('* ', repeat(chr(39), 3), kind, repeat(chr(39), 3))", "'12. point ' || size", "'no entry'"), ["k"])


@L.add("A46 A47", _rows(["k ; 's1' ; 0 ; size ; 'parallel' ; name", "k ; 's1' ; 0 ; size ; 'note' ; kind", "k ; 's2' ; size ; size + 3 ; null ; null"], 'k segment_id start "end" type text'))
def p_related_segments(spark, sf_dir):
    body = "'{\"segments\":[{\"id\":\"s1\",\"span\":{\"start\":0,\"end\":' || size || '},\"related\":[{\"type\":\"parallel\",\"text\":\"' || name || '\"},{\"type\":\"note\",\"text\":\"' || kind || '\"}]},{\"id\":\"s2\",\"span\":{\"start\":' || size || ',\"end\":' || (size + 3) || '},\"related\":[]}]}'"
    found = intake.related_segments(_texts(spark, sf_dir, body), "k", "text")
    return found.toDF("k", "segment_id", "start", "end", "type", "text")


@L.add("A49", _rows(["k ; 'r' ; 0 ; 0 ; size", "k ; 'r' ; 1 ; size ; size + 4", "k ; 's' ; 0 ; size + 4 ; 99"], 'k ref line_index start "end"'))
def p_live_lines(spark, sf_dir):
    p = _part(spark, sf_dir)
    spans = p.select("k", F.lit("r").alias("ref"), F.expr("array(named_struct('start', 0, 'end', size), named_struct('start', size, 'end', size + 4))").alias("lines"))
    return notes.live_lines(spans.union(p.select("k", F.lit("s"), F.expr("array(named_struct('start', size + 4, 'end', 99))"))), "k")


@L.add("A44 I2", "select event_type, count(*) as n from events where ts >= timestamp '2024-01-01 01:00:00' and ts < timestamp '2024-01-01 06:00:00' group by 1")
def p_events_since(spark, sf_dir):
    return feed.since(table(spark, sf_dir, "events"), "ts", "2024-01-01 01:00:00", "2024-01-01 06:00:00").groupBy("event_type").agg(F.count("*").alias("n"))


# sinks


@L.add("B4", _rows(["k ; '{\"content\":\"' || name || '\\n' || kind || '\",\"segments\":[{\"lines\":[{\"start\":0,\"end\":' || length(name) || '}],\"type\":\"verse\",\"reference\":\"1-1\"},{\"lines\":[{\"start\":' || (length(name) + 1) || ',\"end\":' || (length(name) + 1 + length(kind)) || '}],\"type\":\"prose\",\"reference\":\"1-2\"}]}'"], "k payload"))
def p_edition_payload(spark, sf_dir):
    p = _part(spark, sf_dir)
    n = F.length("name")
    a = p.select("k", F.lit("1-1").alias("ref"), F.lit("verse").alias("type"), F.lit(0).alias("line_index"), F.lit(0).alias("start"), n.alias("end"), F.col("name").alias("line"))
    b = p.select("k", F.lit("1-2"), F.lit("prose"), F.lit(0), n + 1, n + 1 + F.length("kind"), F.col("kind"))
    return sinks.edition_payload(a.union(b), "k")


_TERMS = "t as (select n_name as form, lower(n_name) as rendering, '1-' || n_nationkey as v from nation union all select 'alias' || n_regionkey, lower(n_name), '1-' || n_nationkey from nation), n as (select form, count(*) as n from t group by 1)"


def _terms(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.expr("array(n_name, 'alias' || n_regionkey)").alias("forms"), F.lower("n_name").alias("rendering"), F.expr("array('1-' || n_nationkey)").alias("verse_ids"))


@L.add("B11", f"with {_TERMS} select form || chr(9) || rendering || case when n > 1 then chr(9) || v else '' end as line from t join n using (form)")
def p_termbase_tsv(spark, sf_dir):
    return sinks.termbase_tsv(_terms(spark, sf_dir))


@L.add("B12", f"with {_TERMS} select form, string_agg(case when n > 1 then rendering || ' (' || v || ')' else rendering end, '; ' order by rendering) as renderings from t join n using (form) group by form")
def p_termbase_table(spark, sf_dir):
    return sinks.termbase_table(_terms(spark, sf_dir))


# text functions


@L.add("C4 C5 C6 C16 C22", _rows(["k ; array_to_string(list_concat(['dhammaṃ'], list_filter(string_split(name, ' '), lambda w: length(w) > 3), ['suttā']), '¦') ; case when name = 'small ring' then 'small ring¦end' else array_to_string(string_split(name, ' '), '¦') || '¦end' end ; 'Ae n ' || name ; 'e ''' || name || ''' x' ; 'a' || name || ' b'"], "k diacritic phrases plain phrase corpus"))
def p_tokens_and_forms(spark, sf_dir):
    name = F.col("name")
    return _part(spark, sf_dir).select(
        "k", _join(T.diacritic_tokens(F.concat(F.lit("Dhammaṃ [x y] "), name, F.lit(" 12 Suttā")))).alias("diacritic"), _join(fold.phrase_tokens(["small ring", "ring small"])(F.split(F.concat(name, F.lit(" end")), " "))).alias("phrases"),
        fold.plain(F.concat(F.lit("Ãé ñ "), name)).alias("plain"), fold.phrase(F.concat(F.lit("É ‘"), F.upper(name), F.lit("’  X"))).alias("phrase"), fold.corpus(F.concat(F.lit("a​"), name, F.lit(" b"))).alias("corpus"))


@L.add("C10 C14 C15 C26 C27 C34 C35 C37", _rows(["k ; replace(name, ' ', '') ; 'བཀྲ་ཤིས' ; replace(name, ' ', '') || kind ; name || ' and ' || kind ; 'ཀ། །ཁ།།ག' ; name || chr(10) || 'two spaces' ; 'ཀ། ཁ།།' || k ; name || ' b ' || size"], "k key tibetan transclusion links shads cleaned spacing wiki"))
def p_normal_forms(spark, sf_dir):
    name, kind = F.col("name"), F.col("kind")
    return _part(spark, sf_dir).select(
        "k", T.delimiter_key(F.concat(F.lit("་ །"), name)).alias("key"), T.tibetan_norm(F.concat(F.lit("<small>ཀ</small>བཀྲ་ཤིས། "), name)).alias("tibetan"), tibetan.transclusion_norm(F.concat(F.lit("![[a#^b]] **"), name, F.lit("** ^1-2 །"), kind)).alias("transclusion"),
        T.unwrap_wikilinks(F.concat(F.lit("[[a|"), name, F.lit("]] and [["), kind, F.lit("]]"))).alias("links"), T.shad_groups(F.lit("ཀ།   །ཁ།།ག")).alias("shads"), T.mechanical_clean(F.concat(F.lit("page 12\n"), name, F.lit("\n 45 \ntwo   spaces"))).alias("cleaned"),
        T.shad_spacing(F.concat(F.lit("ཀ།ཁ།།"), F.col("k").cast("string"))).alias("spacing"), T.plain_wikitext(F.concat(F.lit("<noinclude>x</noinclude>{{t|u}}<b>"), name, F.lit("</b> [[a|b]] "), F.col("size").cast("string"))).alias("wiki"))


@L.add("C13 C23 C24 C25 C28 C29 C32 C36", _rows(["k ; 'བཀྲཤིས' || k ; 0 ; 'ང འི་དགའ' ; 'བཀྲ་ཤིས། །' || chr(10) || 'ཀ' ; '**བཀྲ་** ཤིས' ; name || ' x 34' ; name ; 1"], "k canon first_place affixes breaks bold numbers precleaned quotes"))
def p_tibetan_forms(spark, sf_dir):
    name, key = F.col("name"), F.col("k").cast("string")
    canon = tibetan.canon(F.concat(F.lit("བཀྲ ཤིས།"), key))
    clean = tibetan.precleaned(F.concat(F.lit("> ༡"), name))
    return _part(spark, sf_dir).select(
        "k", canon["canon"].alias("canon"), F.element_at(canon["places"], 1).cast("int").alias("first_place"), tibetan.split_affixes(F.lit("ངའི་དགའ")).alias("affixes"), tibetan.line_breaks(F.lit("བཀྲ་ཤིས། །ཀ")).alias("breaks"),
        tibetan.bold_roots(F.lit("བཀྲ༷་ཤིས")).alias("bold"), tibetan.removed_numbers(F.concat(name, F.lit("12 x 34")), F.array(F.lit(12))).alias("numbers"), F.when(clean["text"].isNotNull(), name).alias("precleaned"), clean["blockquotes"].cast("int").alias("quotes"))


@L.add("C43 C44 C45 C48 C53 C55 D23 D40", _rows(["k ; '^1-' || size || '-2-0' ; '1.' || size ; '1-' || size || '¦1-' || (size + 1) || '¦1-' || (size + 2) ; true ; 'new ' || kind ; size || '¦' || (size + 1) || '¦99' ; case when size % 2 = 0 then 'exact' else 'none' end ; 'tibetan' ; '105'"], "k heading node ids english corrected refs tier numerals digits"))
def p_ids_and_numbers(spark, sf_dir):
    name, kind, size = F.col("name"), F.col("kind"), F.col("size").cast("string")
    return _part(spark, sf_dir).select(
        "k", T.decimal_block_id(F.concat(F.lit("1."), size, F.lit(".2"))).alias("heading"), T.claim_node(F.concat(F.lit("c-1-"), size, F.lit("-4"))).alias("node"), _join(T.expand_range(F.concat(F.lit("1-"), size), F.concat(F.lit("1-"), (F.col("size") + 2).cast("string")))).alias("ids"),
        T.plain_english(name).alias("english"), T.corrected(F.concat(F.lit("old "), kind), F.lit("old"), F.lit("new")).alias("corrected"), _join(F.transform(T.reference_list(F.concat(size, F.lit("-"), (F.col("size") + 1).cast("string"), F.lit(", 99. text"))), lambda x: x.cast("string"))).alias("refs"),
        T.match_tier(F.when(F.col("size") % 2 == 0, F.upper(name)).otherwise("zzzz"), F.concat(F.lit("the "), name, F.lit(" of it"))).alias("tier"), T.numeral_system(F.concat(name, F.lit("༡༠༥"))).alias("numerals"), T.to_ascii_digits(F.lit("༡༠༥")).alias("digits"))


@L.add("C52", f"with {PART}, d as (select kind, count(distinct size % 3) as n from p group by 1) select k, case when brand in ('Brand#1', 'Brand#2') then brand else 'Brand#2' end as section, case when size % 2 = 0 then 'high' else 'low' end as priority, 'a¦b' as images, n as reporter_days from p join d using (kind)")
def p_digest_items(spark, sf_dir):
    items = _part(spark, sf_dir).select("k", F.col("brand").alias("section"), F.expr("case when size % 2 = 0 then 'high' else 'odd' end").alias("priority"), F.expr("array('a', 'b', 'a')").alias("images"), F.col("kind").alias("reporter"), F.expr("date_add(date'2024-01-01', size % 3)").alias("ts"))
    return scores.digest_items(items, ["Brand#1", "Brand#2"], ["high", "low"]).select("k", "section", "priority", _join(F.col("images")).alias("images"), "reporter_days")


@L.add("C54", _rows(["k ; kind", "k ; name"], "k lemma"))
def p_concept_lemmas(spark, sf_dir):
    return intake.concept_lemmas(_texts(spark, sf_dir, "'# Other'", "'**no**'", "'# Concepts'", "'- **' || name || '**'", "'- **' || kind || '** and **' || name || '**'", "'# After'", "'**none**'"), "k", "Concepts")


# checks


@L.add("D11 D12", f"with {PART} select 'text_lost' as check_name, 'critical' as severity, k || '' as entity_id, length(replace(name, ' ', '')) || '/' || case when k % 97 = 0 then -1 else length(replace(name, ' ', '')) - 1 end as detail from p where k % 97 = 0 or k % 10 = 0")
def p_lost_texts(spark, sf_dir):
    p = _part(spark, sf_dir)
    other = p.where("k % 97 <> 0").select("k", F.expr("case when k % 10 = 0 then substring(name, 2) else concat('  ', replace(name, ' ', '   '), ' ') end").alias("text"))
    return checks.squeezed_equal(p.select("k", F.col("name").alias("text")), other, "k")


@L.add("H29 H30 D11", _rows(["k ; 'insert' ; length(name) ; length(name) ; length(name) ; length(name) + 2", "k ; 'replace' ; 0 ; 1 ; 0 ; 1"], "k tag a0 a1 b0 b1"))
def p_text_edits(spark, sf_dir):
    edits = blocks.opcodes("name", F.concat(F.lit("#"), F.expr("substring(name, 2)"), F.lit("!?")))
    return _part(spark, sf_dir).select("k", F.explode(edits).alias("e")).select("k", "e.*")


@L.add("D14", f"with {PART} select k, case k % 3 when 0 then 'agree' when 1 then 'variant' else 'differs' end as status from p")
def p_row_agreement(spark, sf_dir):
    rows = _part(spark, sf_dir).select("k", F.lit(1).alias("row"), F.col("name").alias("own"), F.expr("case k % 3 when 0 then concat(' ', name, '.') when 1 then concat(name, name) else '123' end").alias("other"))
    return intake.row_agreement(rows, "k").select("k", "status")


@L.add("D18 D19", f"with {PART} select 'missing:brand' as check_name, 'error' as severity, k || '' as entity_id, '' as detail from p where k % 7 = 0 union all select 'unknown:kind', 'warn', k || '', '' from p where kind not in ('PROMO', 'ECONOMY')")
def p_metadata(spark, sf_dir):
    return checks.metadata(_part(spark, sf_dir).withColumn("brand", F.expr("case when k % 7 = 0 then '' else brand end")), "k", ["brand", "name"], {"kind": ["PROMO", "ECONOMY"]})


@L.add("D20 D3", f"with {PART} select 'malformed_id' as check_name, 'major' as severity, 'Bad id ' || k as entity_id, '^[a-z]+-\\d+$' as detail from p where k % 50 = 0")
def p_malformed_ids(spark, sf_dir):
    ids = _part(spark, sf_dir).select(F.expr("case when k % 50 = 0 then concat('Bad id ', k) else concat('ok-', k) end").alias("id"))
    return checks.malformed_ids(ids, "id", r"^[a-z]+-\d+$")


@L.add("D21 D22 D23", f"with {PART} select 'v' || k as verse_id, 'kw' as keyword, case k % 3 when 0 then upper(name) when 1 then 'zzz qqq' else 'The marbles' end as rendering, case k % 3 when 0 then 'exact' when 1 then 'missing' else 'loose' end as tier from p union all select 'w' || k, 'kw', 'x', 'missing' from p where k % 40 = 0")
def p_termbase_consistency(spark, sf_dir):
    p = _part(spark, sf_dir)
    words = p.select(F.expr("concat('v', k)").alias("verse_id"), F.lit("kw").alias("keyword"), F.expr("case k % 3 when 0 then upper(name) when 1 then 'zzz qqq' else 'The marbles' end").alias("rendering"))
    words = words.union(p.where("k % 40 = 0").select(F.expr("concat('w', k)"), F.lit("kw"), F.lit("x")))
    return checks.termbase_consistency(words, p.select(F.expr("concat('v', k)").alias("verse_id"), F.expr("concat('one ', name, ' of a marble, again')").alias("text"))).toDF("verse_id", "keyword", "rendering", "tier")


@L.add("D32", f"with {PART} select k, '1' as node_id, 5 as pointer, case k % 3 when 0 then 'near' when 1 then 'elsewhere' else 'absent' end as attested from p")
def p_title_attestation(spark, sf_dir):
    p = _part(spark, sf_dir)
    tree = p.select("k", F.lit("1").alias("node_id"), F.lit(5).alias("pointer"), F.concat("name", F.lit(" "), F.col("k").cast("string")).alias("title"))
    lines = p.select("k", F.explode(F.expr("array(named_struct('line_no', 1, 'line', 'x'), named_struct('line_no', case k % 3 when 0 then 7 else 20 end, 'line', case when k % 3 = 2 then 'none' else concat('of ', name, k, ' here') end))")).alias("l")).select("k", "l.*")
    return checks.title_attestation(tree, lines, ["k"])


@L.add("D35", f"with {PART} select k, '1' as node_id, 3 as announced, size % 4 as children from p where size % 4 <> 3")
def p_sibling_counts(spark, sf_dir):
    p = _part(spark, sf_dir)
    nodes = p.select("k", F.lit("1").alias("node_id"), F.lit("").alias("parent_id"), F.lit(10).alias("pointer"))
    kids = p.where("size % 4 > 0").select("k", F.explode(F.expr("sequence(1, size % 4)")).alias("i")).select("k", F.expr("concat('1.', i)").alias("node_id"), F.lit("1").alias("parent_id"), F.lit(100).alias("pointer"))
    lines = p.select("k", F.lit(11).alias("line_no"), F.lit("it has three parts").alias("line"))
    found = intake.sibling_counts(nodes.union(kids), lines, "k", {"two": 2, "three": 3})
    return found.select("k", "node_id", "announced", "children")


@L.add("D37", _rows(["k ; k % 4 = 0"], "k passes"))
def p_reply_gates(spark, sf_dir):
    reply = F.expr("case k % 4 when 0 then concat('⟦1⟧ ', reverse(name)) when 1 then name when 2 then concat('⟦1⟧ ', repeat(name, 4)) else concat('```', name, '⟦1⟧') end")
    return _part(spark, sf_dir).select("k", hooks.reply_gates(F.concat("name", F.lit(" ⟦1⟧")), reply).alias("passes"))


@L.add("D38", _rows(["k ; 2 ; false", "k ; 3 ; true", "k ; 5 ; true", "k ; 0 ; false", "k ; 6 + length(name) ; false"], "k at valid"))
def p_valid_cuts(spark, sf_dir):
    rows = _part(spark, sf_dir).select("k", F.concat(F.lit("ཀ་ཁ། "), "name", F.lit("  ")).alias("t"), F.explode(F.array(F.lit(2), F.lit(3), F.lit(5), F.lit(0), 6 + F.length("name"))).alias("at"))
    return rows.select("k", "at", _valid("t", "at").alias("valid"))


@F.pandas_udf(K.BooleanType())
def _valid(t: pd.Series, at: pd.Series) -> pd.Series:
    return pd.Series([segment.valid_cut(x, int(n)) for x, n in zip(t, at, strict=True)])


@L.add("D41", f"with {PART} select 'tree_shape' as check_name, 'major' as severity, k || '-1' as entity_id, 'a/a' as detail from p where k % 5 = 0 union all select 'tree_shape', 'major', k || '-1.2', 'c/-' from p where k % 5 = 0 union all select 'tree_shape', 'major', k || '-1.1', 'b/z' from p where k % 5 = 1")
def p_tree_shapes(spark, sf_dir):
    p = _part(spark, sf_dir)
    nodes = lambda c: p.select("k", F.explode(F.expr(c)).alias("n")).select("k", "n.*")
    root = nodes("array(named_struct('path', '1', 'ref', 'a'), named_struct('path', '1.1', 'ref', 'b'), named_struct('path', '1.2', 'ref', 'c'))")
    other = nodes("filter(array(named_struct('path', '1', 'ref', 'a'), named_struct('path', '1.1', 'ref', case when k % 5 = 1 then 'z' else 'b' end), named_struct('path', '1.2', 'ref', 'c')), x -> not (k % 5 = 0 and x.path = '1.2'))")
    return checks.tree_shapes(root, other, ["k"])


# joins


@L.add("E2", _rows(["k ; 'ka' ; name ; 'first ' || kind", "k ; 'kha' ; brand ; 'second'"], "k label source_part target_part"))
def p_labelled_pairs(spark, sf_dir):
    p = _part(spark, sf_dir)
    source = p.select("k", F.concat(F.lit("(Ka) "), "name", F.lit(" (Kha) "), "brand").alias("text"))
    return align.labelled_pairs(source, p.select("k", F.concat(F.lit("(Kha) second (Ka) first "), "kind").alias("text")), "k")


@L.add("E17", f"with {PART} select k as doc_id, s::bigint as stanza_id, case when s = 2 then 6 when k % 5 = 1 then 1 when k % 5 = 3 then 4 else 2 end as start_line, case when s = 2 then 1 when k % 5 = 2 then 2 else 3 end as matched from p, unnest([1, 2]) as t(s) where s = 1 or k % 5 = 4")
def p_stanza_places(spark, sf_dir):
    """A stanza of three lines: as it is, in one line, with another line in its midst, after a place with fewer of its lines, and before a single line that a closing line follows; and one that is nowhere."""
    p = _part(spark, sf_dir).withColumns({"a": F.expr("concat('aaaa ', name)"), "b": F.expr("concat('bbbb ', kind, ' ', brand)"), "c": F.expr("concat('cccc ', brand, ' ', name)"), "d": F.expr("concat('dddd ', k, kind, name)")})
    stanza = lambda n, *lines: p.select(F.col("k").alias("doc_id"), F.lit(n).cast("long").alias("stanza_id"), F.array(*lines).alias("lines"))
    own = stanza(1, "a", "b", "c").union(stanza(2, "d", F.lit("0000 missing"), F.lit("0001 missing")).where("doc_id % 5 = 4")).union(stanza(3, F.lit("9999 nowhere"), F.lit("9998 nowhere")))
    docs = p.select(F.col("k").alias("doc_id"), F.expr("""case k % 5 when 0 then array('qqqqq', 'rrrrr', a, b, c, 'sssss') when 1 then array('qqqqq', concat(a, b, c), 'rrrrr') when 2 then array('qqqqq', 'rrrrr', a, 'zzzzzzz', c, 'sssss')
        when 3 then array('qqqqq', a, b, 'rrrrr', a, b, c, 'sssss') else array('qqqqq', 'rrrrr', a, b, c, 'sssss', d, 'uuuuuuu', 'cespani 1') end""").alias("lines"))
    return stanza_search.stanza_places(own, docs)


@L.add("E21 E35", f"with {PART} select k, 0 as row, 3 as place from p union all select k, 1, 3 + length(replace(name, ' ', '')) + 4 from p union all select k, 2, -1 from p")
def p_located_rows(spark, sf_dir):
    p = _part(spark, sf_dir)
    works = p.select("k", F.concat(F.lit("xyz. "), "name", F.lit(", and— then "), "kind").alias("content"))
    rows = p.select("k", F.posexplode(F.array(F.concat("name", F.lit("!")), F.concat(F.lit("hen "), "kind"), F.lit("qqqqqqqq"))).alias("row", "text"))
    return intake.located_rows(rows, works, "k")


@L.add("E23", _rows(["k ; 0 ; 0", "k ; 1 ; 2", "k ; 2 ; 3"], "k entry candidate"))
def p_outline_alignment(spark, sf_dir):
    p = _part(spark, sf_dir)
    outline = p.select("k", F.posexplode(F.array("name", "kind", F.lit("the end of all"))).alias("pos", "label"))
    return layout.outline_alignment(outline, p.select("k", F.posexplode(F.array("name", F.lit("0123456789"), F.concat("kind", F.lit(" more")), F.lit("the end of all"))).alias("pos", "label")), "k")


@L.add("E24", f"with {PART} select k as a, k + 1 as b, round(2 * (n - 1) / (2 * n), 9) as score from (select k, length(name) + length(kind) + 34 as n from p) where k % 2 = 0 and k + 1 in (select k from p)")
def p_best_matches(spark, sf_dir):
    """Each even row's text with one sign changed is the odd row's after it; the odd row after that has two changed."""
    p = _part(spark, sf_dir).withColumn("text", F.expr("concat(name, ' ', md5(cast(k as string)), ' ', kind)"))
    odd = p.select((F.col("k") + 1).alias("b"), F.expr("concat('#', substring(text, 2))").alias("text")).union(p.select((F.col("k") + 3).alias("b"), F.expr("concat('#', substring(text, 2, length(text) - 2), '#')").alias("text"))).where("b % 2 = 1")
    odd = odd.join(p.select(F.col("k").alias("b")), "b", "left_semi")
    found = fuzzy.best_match(p.where("k % 2 = 0").select(F.col("k").alias("a"), "text"), odd, "a", "b", 0.95)
    return found.select("a", "b", F.round("score", 9).alias("score"))


@L.add("E31", f"with {PART} select k, 1 as row, 't1' as text, name as block, false as flagged from p union all select k, 2, 't2', kind, false from p union all select k, 3, 't3', kind, true from p")
def p_parallel_rows(spark, sf_dir):
    p = _part(spark, sf_dir)
    source = p.select("k", F.posexplode(F.array("name", "kind")).alias("row", "block")).withColumn("row", F.col("row") + 1)
    return intake.parallel_rows(source, p.select("k", F.posexplode(F.expr("array('t1', 't2', 't3')")).alias("row", "text")).withColumn("row", F.col("row") + 1), "k", "block").select("k", "row", "text", "block", "flagged")


@L.add("E32", _rows(["k ; 1 ; '1. ' || name ; '1' ; ''", "k ; 2 ; 'goes on' ; '1' ; ''", "k ; 4 ; kind ; '2¦3' ; '9'"], "k pos text refs unknown"))
def p_referenced(spark, sf_dir):
    p = _part(spark, sf_dir)
    paragraphs = p.select("k", F.posexplode(F.array(F.concat(F.lit("1. "), "name"), F.lit("goes on"), F.lit("2-3, 9."), F.col("kind"))).alias("pos", "text")).withColumn("pos", F.col("pos") + 1)
    known = p.select("k", F.explode(F.expr("sequence(1, 5)")).alias("ref"))
    shown = lambda c: _join(F.transform(c, lambda x: x.cast("string"))).alias(c)
    return intake.referenced(paragraphs, known, "k").select("k", "pos", "text", shown("refs"), shown("unknown"))


@L.add("E33", f"with {PART} select k, 1 as n, 1 as first, size as last, false as inferred from p union all select k, 2, size + 1, size + 4, true from p union all select k, 3, size + 5, size + 6, false from p")
def p_inferred_references(spark, sf_dir):
    rows = _part(spark, sf_dir).select("k", F.explode(F.expr("array(named_struct('n', 1, 'first', 1, 'last', size), named_struct('n', 2, 'first', cast(null as int), 'last', cast(null as int)), named_struct('n', 3, 'first', size + 5, 'last', size + 6))")).alias("r")).select("k", "r.*")
    return intake.inferred_references(rows, "k")


@L.add("E33 E28", f"with {PART} select k, case when k % 2 = 0 then name when k % 3 = 0 then kind end as value from p")
def p_first_known(spark, sf_dir):
    p = _part(spark, sf_dir)
    return intake.first_known("k", p.select("k"), [p.where("k % 2 = 0").select("k", F.col("name").alias("value")), p.where("k % 3 = 0").select("k", F.col("kind").alias("value"))], "value")


@L.add("E34", f"with {PART} select k, 'b1' as block_id, 3 as \"from\", 10 as \"to\" from p where k % 3 <> 0 union all select k, 'b2', 0, 2 + size from p where k % 3 <> 0 union all select k, null, null, null from p where k % 3 = 0")
def p_overlaid(spark, sf_dir):
    p = _part(spark, sf_dir)
    layers = p.select("k", F.expr("case when k % 3 = 0 then 900 else 3 end").alias("start"), F.expr("case when k % 3 = 0 then 905 else 12 + size end").alias("end"))
    blocks = p.select("k", F.explode(F.expr("array(named_struct('block_id', 'b1', 'start', 0, 'end', 10), named_struct('block_id', 'b2', 'start', 10, 'end', 200))")).alias("b")).select("k", "b.*")
    return intake.overlaid(layers, blocks, "k").select("k", "block_id", "from", "to")


@L.add("E38", f"with {PART} select k, 'major: ' || kind || '; minor: ' || name as issues, 2 as n from p where k % 2 = 0 union all select k, 'minor: ' || name, 1 from p where k % 2 = 1")
def p_feedback(spark, sf_dir):
    p = _part(spark, sf_dir)
    rows = p.select("k", F.lit("minor").alias("severity"), F.col("name").alias("detail")).union(p.where("k % 2 = 0").select("k", F.lit("major"), F.col("kind")))
    return intake.feedback(rows, "k")


# counts


@L.add("F10", "select word, count(distinct doc_id) as df from (select doc_id, unnest(string_split(lower(text), ' ')) as word from documents) group by word")
def p_block_df(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.lower("text"), " ")).alias("word"))
    return terms.block_df(words, "doc_id", words)


@L.add("F35 B6", f"with {PART} select kind, count(*) as n, count(*) filter (size % 3 = 0) as ok, count(*) filter (size % 3 = 1) as skip, count(*) filter (size % 3 = 2) as abort from p group by kind")
def p_batch_summary(spark, sf_dir):
    return scores.batch_summary(_part(spark, sf_dir).withColumn("status", F.expr("element_at(array('ok', 'skip', 'abort'), size % 3 + 1)")), ["kind"], "status")


@L.add("F38", "select 3 as sprint, date '2024-01-29' as start, 14 as days")
def p_current_period(spark, sf_dir):
    periods = table(spark, sf_dir, "nation").where("n_nationkey between 1 and 9").select(F.col("n_nationkey").alias("sprint"), F.expr("date_add(date'2023-12-18', 14 * n_nationkey)").alias("start"), F.lit(14).alias("days"))
    return scores.current_period(periods, "2024-02-05")


# sequences and layout


@L.add("G3", f"with {PART}, r as (select k % 50 as note, k, row_number() over (partition by k % 50 order by k) - 1 as i from p) select note, k, (i // 4)::int as batch from r")
def p_capped_batches(spark, sf_dir):
    rows = _part(spark, sf_dir).select((F.col("k") % 50).alias("note"), "k", F.lit(10).alias("chars"))
    return sequence.capped_batches(rows, "note", "k", "chars", 5, 45).select("note", "k", "batch")


@L.add("G8", _rows(["k ; 0 ; 1 ; '1-0'", "k ; 1 ; 2 ; '1-1-0'", "k ; 2 ; 2 ; '1-2-0'", "k ; 3 ; 3 ; '1-2-1-0'", "k ; 4 ; 1 ; '2-0'", "k ; 5 ; 2 ; '2-1-0'"], "k pos depth assigned_id"))
def p_depth_ids(spark, sf_dir):
    return sequence.depth_ids(_part(spark, sf_dir).select("k", F.posexplode(F.expr("array(1, 2, 2, 3, 1, 2)")).alias("pos", "depth")), ["k"], "pos", "depth")


@L.add("G11", _rows(["k ; 0 ; '0'", "k ; 1 ; 'I-0'", "k ; 2 ; 'I-1'", "k ; 3 ; '1-0'", "k ; 4 ; '1-' || size", "k ; 5 ; '1-' || size || 'x1'", "k ; 6 ; null"], "k pos assigned_id"))
def p_zone_ids(spark, sf_dir):
    lines = F.array(F.lit("# Title"), F.lit("## 0. Front"), F.col("name"), F.lit("## 1. One"), F.expr("concat(kind, ' || ', size, ' ||')"), F.expr("concat(brand, ' || ', size, ' ||')"), F.lit(""))
    rows = _part(spark, sf_dir).select("k", F.posexplode(lines).alias("pos", "line"))
    return layout.zone_ids(rows, ["k"], "pos", F.lit(False)).select("k", "pos", "assigned_id")


@L.add("G13", "select n_nationkey as day, 1 as chapter, case when n_nationkey = 4 then 15 else n_nationkey * 4 end as vstart, case when n_nationkey = 3 then 14 else n_nationkey * 4 + 3 end as vend from nation where n_nationkey between 1 and 9")
def p_shifted_schedule(spark, sf_dir):
    days = table(spark, sf_dir, "nation").where("n_nationkey between 1 and 9").select(F.col("n_nationkey").alias("day"), F.lit(1).alias("chapter"), (F.col("n_nationkey") * 4).alias("vstart"), (F.col("n_nationkey") * 4 + 3).alias("vend"))
    return sequence.shifted(days, 1, 15, 4)


@L.add("G15", _rows(["k ; 0 ; 1 ; null", "k ; 1 ; 2 ; 0", "k ; 2 ; 2 ; 0", "k ; 3 ; 3 ; 2", "k ; 4 ; 1 ; null", "k ; 5 ; 3 ; null"], "k pos level parent"))
def p_parents(spark, sf_dir):
    return layout.parents(_part(spark, sf_dir).select("k", F.posexplode(F.expr("array(1, 2, 2, 3, 1, 3)")).alias("pos", "level")), ["k"], "pos", "level")


@L.add("G19", f"with {PART} select k, '1.2' as node_id, 'a' as name, 2 as \"order\" from p union all select k, '1.1', 'b', 1 from p union all select k, '1.3', 'c', 3 from p")
def p_reordered(spark, sf_dir):
    nodes = _part(spark, sf_dir).select("k", F.lit("1").alias("parent_id"), F.explode(F.expr("array(named_struct('pos', 1, 'name', 'a', 'place', 100 + size), named_struct('pos', 2, 'name', 'b', 'place', size), named_struct('pos', 3, 'name', 'c', 'place', 200 + size))")).alias("n")).select("k", "parent_id", "n.*")
    return layout.reordered(nodes, ["k"], True).select("k", "node_id", "name", "order")


@L.add("G20", "select n_name, case when n_nationkey = 7 then 1 when n_nationkey < 7 then n_nationkey + 2 else n_nationkey + 1 end as pos from nation")
def p_pinned_first(spark, sf_dir):
    return sequence.pinned_first(table(spark, sf_dir, "nation"), "n_name", "NATION_7", "n_nationkey").select("n_name", "pos")


@L.add("G23 H41", _rows(["k ; true ; 0 ; 'ab ' || name || ' '", "k ; true ; 1 ; 'X1 ' || kind || ' '", "k ; true ; 2 ; 'Y2 end'"], "k ok part text"))
def p_row_splits(spark, sf_dir):
    p = _part(spark, sf_dir)
    rows = p.select("k", F.concat(F.lit("ab "), "name", F.lit(" X1 "), "kind", F.lit(" Y2 end")).alias("text"))
    return layout.row_splits(rows, p.select("k", F.posexplode(F.array(F.lit("X1"), F.lit("Y2"))).alias("n", "clause")), "k")


@L.add("G26", _rows(["k ; 1 ; '1' ; false", "k ; 1 ; '1.1' ; false", "k ; 3 ; '1.2' ; false", "k ; 4 ; '1.1' ; true", "k ; 5 ; '2' ; false"], "k pos heading backward"))
def p_projected_headings(spark, sf_dir):
    rows = _part(spark, sf_dir).select("k", F.posexplode(F.expr("array('1.1', cast(null as string), '1.2', '1.1', '2')")).alias("pos", "node")).withColumn("pos", F.col("pos") + 1)
    return layout.projected_headings(rows, ["k"], "pos", "node")


@L.add("G27", _rows(["k ; 0 ; 'x ' || kind ; length(name) + 1", "k ; 1 ; 'nowhere' ; -1", "k ; 2 ; 'y' ; length(name) + length(kind) + 4"], "k n label place"))
def p_label_places(spark, sf_dir):
    p = _part(spark, sf_dir)
    texts = p.select("k", F.concat("name", F.lit(" x "), "kind", F.lit(" y")).alias("text"))
    labels = p.select("k", F.posexplode(F.array(F.concat(F.lit("x "), "kind"), F.lit("nowhere"), F.lit("y"))).alias("n", "label"))
    return layout.label_places(labels, texts, "k")


@L.add("G28", _rows(["k ; 0 ; 0", "k ; 1 ; 0", "k ; 2 ; 0", "k ; 3 ; 1", "k ; 4 ; 1", "k ; 5 ; 2"], "k pos part"))
def p_bounded_parts(spark, sf_dir):
    lines = _part(spark, sf_dir).select("k", F.posexplode(F.expr("array(true, true, false, true, false, true)")).alias("pos", "mark"))
    return sequence.size_bounded_parts(lines, "k", "pos", "mark", 152, 150).select("k", "pos", "part")


@L.add("G29", _rows(["k ; 'ab' ; 'ab ' || left(name, 1)"], "k anchor unique_anchor"))
def p_unique_anchors(spark, sf_dir):
    p = _part(spark, sf_dir)
    return layout.unique_anchors(p.select("k", F.lit("ab").alias("anchor")), p.select("k", F.concat(F.lit("ab "), "name", F.lit(" ab x")).alias("text")), "k").select("k", "anchor", "unique_anchor")


# segmentation and edits


@L.add("H1 H3 H4 H5 H7 H8 H10", _rows(["k ; name || '. ¦' || kind || '; ¦end' ; 'a b ¦c d ¦e' ; 'a b c ¦d e f' ; '0-2¦2-4' ; name || ' x x ¦and ' || kind || ' y y' ; name || ' །  །¦' || kind || ' xxxx' ; name || '།།¦' || kind || '།'"], "k cuts capped merged stanzas connectors halves lines"))
def p_cuts(spark, sf_dir):
    name, kind = F.col("name"), F.col("kind")
    cuts = _listed(lambda t: segment.split_at(t, [c for c, _ in segment.rule_cuts(t)]))
    runs = _listed(lambda t: [f"{a}-{b}" for a, b in segment.stanzas(t.split("\n"))])
    return _part(spark, sf_dir).select(
        "k", _join(cuts(F.concat(name, F.lit(". "), kind, F.lit("; end")))).alias("cuts"), _join(_listed(segment.capped, 2)(F.lit("a b c d e"))).alias("capped"), _join(_listed(lambda t: segment.merged_short(t.split("|"), 2, 3))(F.lit("a b |c |d e f"))).alias("merged"),
        _join(runs(F.concat(F.lit("a b c d e f\n"), F.lit("g h i j k l\n"), F.lit("a b c d e f g\na b c d e f g\n"), name))).alias("stanzas"), _join(_listed(segment.at_connectors, 5)(F.concat(name, F.lit(" x x and "), kind, F.lit(" y y")))).alias("connectors"),
        _join(_listed(segment.halved, 6)(F.concat(name, F.lit(" །  །  "), kind, F.lit(" xxxx")))).alias("halves"), _join(segment.stanza_cut(F.concat(name, F.lit("།། "), kind, F.lit("།")))).alias("lines"))


@L.add("H9", _rows(["k ; 'ཀ་ཁ །¦ག་ང ། །¦ཅ ^1-' || k"], "k lines"))
def p_mid_verse(spark, sf_dir):
    return _part(spark, sf_dir).select("k", _join(tibetan.mid_verse_lines(F.concat(F.lit("ཀ་ཁ །ག་ང ། །ཅ ^1-"), F.col("k").cast("string")))).alias("lines"))


@L.add("H11 H12", f"with {PART} select k, 1 as pos, name || ' ' || kind as text, 2 as n from p union all select k, 3, brand, 1 from p")
def p_applied_merges(spark, sf_dir):
    p = _part(spark, sf_dir)
    ops = p.select("k", F.explode(F.expr("array(named_struct('op_id', 1, 'first', 1, 'last', 2), named_struct('op_id', 2, 'first', 2, 'last', 3), named_struct('op_id', 3, 'first', 3, 'last', 3))")).alias("o")).select("k", "o.*")
    merges = segment.valid_ops(ops, "k").where("valid").select("k", "first", "last")
    blocks = p.select("k", F.posexplode(F.array("name", "kind", "brand")).alias("pos", "text")).withColumn("pos", F.col("pos") + 1)
    return segment.applied_groups(blocks, merges, "k")


_CLAUSES = {  # sizes, which are closed, which end a sentence; and the units and kinds (v for verse) that they make
    0: ([7, 7, 7, 7, 40, 30, 12], 4, [5], [0, 1, 2, 3, 4, 4, 5], "vvvvppp"),  # a passage, then sentences
    1: ([7, 7, 7, 7, 6, 30], 5, [], [0, 1, 2, 3, 4, 5], "vvvvvp"),  # a contraction after it
    2: ([9, 9, 9, 9, 3, 9, 9, 9, 9, 20], 9, [], [0, 1, 2, 3, 4, 5, 6, 7, 8, 9], "vvvvvvvvvp"),  # a damaged line between
    3: ([11, 12, 11, 12, 30], 4, [0, 1, 2], [0, 1, 2, 3, 3], "ppppp"),  # a list of sentences of about one length
    4: ([11, 12, 11, 12, 30], 4, [0, 1, 2], [0, 1, 2, 3, 4], "vvvvp"),  # the same as a refrain
    5: ([7, 7, 7, 8, 8, 8, 8, 70, 60, 5], 7, [], [0, 0, 0, 1, 2, 3, 4, 5, 5, 6], "pppvvvvppp"),  # too few lines of one metre before another; a long sentence
}


@L.add("H14", f"with {PART}, c as (select * from (values " + ", ".join(f"({m}, {units}, '{kinds}')" for m, (_, _, _, units, kinds) in _CLAUSES.items()) + ") as t(m, units, kinds)) select k, i - 1 as pos, units[i] as unit, case when kinds[i] = 'v' then 'verse' else 'prose' end as kind from p join c on k % 6 = m, unnest(range(1, len(units) + 1)) as u(i)")
def p_verse_units(spark, sf_dir):
    """A text of one of six kinds a row, by its key."""
    def of(m):
        sizes, closed, finals, _, _ = _CLAUSES[m]
        end = "'ཕྱག་འཚལ'" if m == 4 else "'x'"
        return f"transform(array({', '.join(map(str, sizes))}), (n, i) -> named_struct('pos', i, 'size', n, 'closed', i < {closed}, 'final', array_contains(array({', '.join(map(str, finals or [-1]))}), i), 'ending', {end}))"
    choice = "case k % 6 " + " ".join(f"when {m} then {of(m)}" for m in _CLAUSES) + " end"
    return layout.verse_units(_part(spark, sf_dir).select("k", F.explode(F.expr(choice)).alias("c")).select("k", "c.*"), "k", longest=120).select("k", "pos", "unit", "kind")


_CUT_LINES = {  # what stands between the name and the kind; where it is cut (after so many characters), and the rules that name the piece after and before
    0: (" ཞེས་སོ། །", 10, None, "quote-close"), 1: (" མདོ་ལས།", 8, None, "quote-open"), 2: (" གཉིས་སྟེ།", 10, None, "enumeration-head"), 3: ("། དང་པོ་", 2, "ordinal-open", None),
    4: (" ཞེ་ན།", 6, None, "objection-close"), 5: ("། འོ་ན་", 2, "objection-open", None), 6: (" ཡིན་ནོ། །", 10, None, "terminal-particle"), 7: ("། (གཉིས་པ་", 2, "ordinal-open", None),
}


@L.add("H1", f"with {PART}, c as (select * from (values " + ", ".join(f"({m}, '{t}', {len(t) if e else a}, {repr(b) if b else 'null'}, {repr(e) if e else 'null'})" for m, (t, a, b, e) in _CUT_LINES.items()) + """) as t(m, x, a, b, e)), w as (select k, name || x as head, length(name) + a as cut, name || x || kind as line, b, e from p join c on k % 9 = m)
select k, 0 as pos, null as begins, e as ends, left(line, cut) as piece from w union all select k, 1, b, null, substr(line, cut + 1) from w
union all select k, 0, null, null, name || 'འོ་ན་' || kind from p where k % 9 = 8 union all select k, -1, 'objection-open', null, null from p where k % 9 = 8""")
def p_rule_cuts(spark, sf_dir):
    """A line that one of the rules cuts, by its key; the last is one where a weak rule has no closing mark near."""
    choice = "case k % 9 " + " ".join(f"when {m} then '{t}'" for m, (t, _, _, _) in _CUT_LINES.items()) + " else 'འོ་ན་' end"
    lines = _part(spark, sf_dir).select("k", F.concat("name", F.expr(choice), "kind").alias("text"))
    return segment.named_pieces(lines, "k").select("k", "pos", "begins", "ends", "piece")


@L.add("H15 E41", _rows(["k ; 1 ; name", "k ; 2 ; '## ' || brand", "k ; 3 ; kind"], "k new_line line"))
def p_inserted_headings(spark, sf_dir):
    p = _part(spark, sf_dir)
    lines = p.select("k", F.posexplode(F.array("name", "kind")).alias("pos", "line")).withColumn("pos", F.col("pos") + 1)
    return segment.inserted_headings(lines, p.select("k", F.lit(2).alias("at"), F.concat(F.lit("## "), "brand").alias("heading")), ["k"], "pos")


@L.add("H16 H42 H43", _rows(["k ; kind || ' <b>T1</b> ' || name || ' T1' ; name || '.' || chr(10) || kind || '.' ; '0-' || (size + 5)"], "k wrapped broken runs"))
def p_wraps(spark, sf_dir):
    rows = _part(spark, sf_dir)
    wrapped = segment.first_wrap(F.concat("kind", F.lit(" T1 "), "name", F.lit(" T1")), "T1", "<b>", "</b>")
    runs = segment.shifted_runs(F.expr("array(named_struct('start', 0, 'end', size + 3, 'style', 'b'))"), 1, 1, 3)
    return rows.select("k", wrapped.alias("wrapped"), layout.broken_lines(F.concat("name", F.lit(". "), "kind", F.lit(".")), r"\.").alias("broken"), F.concat_ws("-", runs[0]["start"].cast("string"), runs[0]["end"].cast("string")).alias("runs"))


@L.add("H17 H18", _rows(["k ; 1 ; 0 ; name", "k ; 2 ; 0 ; '![[' || kind || ']]'", "k ; 2 ; 1 ; ''", "k ; 2 ; 2 ; brand"], "k src_line sub line"))
def p_with_transclusions(spark, sf_dir):
    lines = _part(spark, sf_dir).select("k", "kind", F.posexplode(F.array("name", "brand")).alias("pos", "line")).withColumn("pos", F.col("pos") + 1)
    return segment.with_transclusions(lines, ["k"], "pos", F.when(F.col("pos") == 2, F.concat(F.lit("![["), "kind", F.lit("]]"))))


@L.add("H19 H20", _rows(["k ; 0 ; name", "k ; 2 ; ''", "k ; 4 ; kind"], "k pos line"))
def p_without_transclusions(spark, sf_dir):
    lines = _part(spark, sf_dir).select("k", F.posexplode(F.array(F.col("name"), F.lit("![[a#^b]]"), F.lit(""), F.lit("  "), F.col("kind"))).alias("pos", "line"))
    return segment.without_transclusions(lines, ["k"], "pos")


@L.add("H20", _rows(["k ; 0 ; 2", "k ; 1 ; 1", "k ; 2 ; 3", "k ; 3 ; 4"], "k pos new_line"))
def p_moved_up(spark, sf_dir):
    lines = _part(spark, sf_dir).select("k", F.posexplode(F.array(F.col("name"), F.lit("![[a]]"), F.lit(""), F.col("kind"))).alias("pos", "line"))
    return layout.moved_up(lines, ["k"], "pos", F.startswith("line", F.lit("![["))).select("k", "pos", "new_line")


@L.add("H21", _rows(["k ; 0 ; name", "k ; 1 ; ''", "k ; 2 ; '![[a]]'", "k ; 3 ; ''", "k ; 4 ; kind"], "k i line"))
def p_one_blank_around(spark, sf_dir):
    from pyspark.sql import Window as W
    lines = _part(spark, sf_dir).select("k", F.posexplode(F.array(F.col("name"), F.lit(""), F.lit(""), F.lit("![[a]]"), F.col("kind"))).alias("pos", "line"))
    out = layout.one_blank_around(lines, ["k"], "pos", F.startswith("line", F.lit("![[")))
    return out.withColumn("i", F.row_number().over(W.partitionBy("k").orderBy("pos", "sub")) - 1).select("k", "i", "line")


@L.add("H23", f"with {PART} select '1-' || k as block_id, case when k % 4 = 0 then kind end as translation, case k % 4 when 1 then 'separators' when 2 then 'no root block' when 3 then 'root differs' end as problem from p")
def p_bilingual_split(spark, sf_dir):
    p = _part(spark, sf_dir).withColumn("block_id", F.expr("concat('1-', k)"))
    blocks = p.select("block_id", F.expr("case when k % 4 = 1 then name when k % 4 = 3 then concat('other', ' || ', kind) else concat(' ', name, ' || ', kind) end").alias("text"))
    return layout.bilingual_split(blocks, p.where("k % 4 <> 2").select("block_id", F.col("name").alias("text")), "||")


@L.add("H24", _rows(["k ; 'double_space' ; length(name) + 1 ; length(name) + 2", "k ; 'punct_no_space' ; length(name) + 4 ; length(name) + 4"], 'k category start "end"'))
def p_spacing_hits(spark, sf_dir):
    lines = _part(spark, sf_dir).select("k", F.concat("name", F.lit("  x,y")).alias("line"))
    return segment.spacing_hits(lines, ["k"]).where("category in ('double_space', 'punct_no_space')").select("k", "category", "start", "end")


@L.add("H27 H28", _rows(["k ; 'a' ; 0 ; size + 3", "k ; 'b' ; size + 3 ; size + 8"], 'k ref start "end"'))
def p_simulated_edits(spark, sf_dir):
    p = _part(spark, sf_dir)
    spans = p.select("k", F.explode(F.expr("array(named_struct('ref', 'a', 'start', 0, 'end', size + 1), named_struct('ref', 'b', 'start', size + 1, 'end', size + 7))")).alias("s")).select("k", "s.*")
    ops = p.select("k", F.expr("array(named_struct('type', 'insert', 'start', 0, 'end', 0, 'text', 'xy'), named_struct('type', 'delete', 'start', size + 3, 'end', size + 4, 'text', cast(null as string)))").alias("ops"))
    return segment.simulated(spans, ops, "k").select("k", "ref", "start", "end")


@L.add("H32", _rows(["k ; length(name) ; length(name) + length(kind)", "k ; length(name) + length(kind) + 1 ; length(name) + length(kind) + 3"], 'k start "end"'))
def p_tag_spans(spark, sf_dir):
    return layout.tag_spans(_part(spark, sf_dir).select("k", F.concat("name", F.lit("<small>"), "kind", F.lit("</small> <small>xy</small>z")).alias("text")), ["k"])


@L.add("H34", _rows(["k ; 'once' ; 2"], "k context line_no"))
def p_unique_context(spark, sf_dir):
    p = _part(spark, sf_dir)
    lines = p.select("k", F.posexplode(F.array(F.lit("twice here"), F.concat("name", F.lit(" once")), F.lit("twice there"))).alias("i", "line")).withColumn("line_no", F.col("i") + 1).drop("i")
    return segment.unique_context(lines, p.select("k", F.explode(F.expr("array('once', 'twice', 'never')")).alias("context")), ["k"])


@L.add("H36", _rows(["k ; 4 ; 1.0::double", "k ; 0 ; 0.75::double", "k ; null ; 0.25::double"], "k place share"))
def p_fuzzy_places(spark, sf_dir):
    rows = _part(spark, sf_dir).select("k", F.explode(F.expr("array('two three', 'one two three zzz', 'qq three rr ss')")).alias("query"))
    return rows.select("k", _placed("query").alias("p")).select("k", "p.place", "p.share")


@F.pandas_udf(K.StructType([K.StructField("place", K.IntegerType()), K.StructField("share", K.DoubleType())]))
def _placed(q: pd.Series) -> pd.DataFrame:
    found = [layout.fuzzy_place("one two three four", x) for x in q]
    return pd.DataFrame({"place": pd.array([p for p, _ in found], dtype="Int32"), "share": [s for _, s in found]})


@L.add("H37", _rows(["k ; name || '[1] and ' || kind || '[2] again[1] b' ; 'n1¦' || brand"], "k text notes"))
def p_footnoted(spark, sf_dir):
    t = layout.footnoted(F.concat("name", F.lit("<ref>n1</ref> and "), "kind", F.lit("<ref name=x>"), "brand", F.lit("</ref> again<ref>n1</ref> [[a|b]]")))
    return _part(spark, sf_dir).select("k", t.alias("t")).select("k", "t.text", _join(F.col("t.notes")).alias("notes"))


@L.add("H38 H39 H40", _rows(["k ; 1 ; 3 ; 'T ' || kind", "k ; 2 ; 6 ; 'T ' || kind"], "k pos line_no title"))
def p_paragraph_lines(spark, sf_dir):
    items = _part(spark, sf_dir).select("k", "kind", F.posexplode(F.array(F.concat("name", F.lit("\nsecond")), F.col("brand"))).alias("i", "text")).withColumn("pos", F.col("i") + 1)
    return layout.one_paragraph_each(items, "k", "pos", F.concat(F.lit("T "), "kind")).select("k", "pos", "line_no", "title")


@L.add("H39", _rows(["k ; 0 ; 0 ; '^a'", "k ; 0 ; 1 ; '## ' || name", "k ; 1 ; 0 ; '^a'", "k ; 2 ; 0 ; '## ' || kind"], "k pos sub line"))
def p_anchored(spark, sf_dir):
    lines = _part(spark, sf_dir).select("k", F.posexplode(F.array(F.concat(F.lit("## "), "name"), F.lit("^a"), F.concat(F.lit("## "), "kind"))).alias("pos", "line"))
    return layout.anchored(lines, ["k"], "pos", "^## ", F.lit("^a"))


@L.add("H40", _rows(["k ; name || chr(10) || chr(10) || brand"], "k text"))
def p_assembled(spark, sf_dir):
    sections = _part(spark, sf_dir).select("k", F.explode(F.array(F.struct(F.lit(1).alias("pos"), F.lit("One").alias("section"), F.col("name").alias("text")), F.struct(F.lit(2).alias("pos"), F.lit("Drop").alias("section"), F.col("kind").alias("text")), F.struct(F.lit(3).alias("pos"), F.lit("Two").alias("section"), F.col("brand").alias("text")))).alias("s")).select("k", "s.*")
    return layout.assembled(sections, "k", ["drop"])


@L.add("H44", f"with {PART} select k, 1 as title_line, case when k % 2 = 0 then 4 else 3 end as line_no, k % 2 = 0 as announced from p")
def p_announcements(spark, sf_dir):
    p = _part(spark, sf_dir)
    lines = p.select("k", F.posexplode(F.expr("array('title', '', 'prose', case when k % 2 = 0 then concat('parts: ', name) else 'none' end)")).alias("i", "line")).withColumn("line_no", F.col("i") + 1).drop("i")
    return segment.announcement_start(lines, p.select("k", F.lit(1).alias("title_line"), F.col("name").alias("title")), ["k"], "parts")


# increments and replies


@L.add("I1", "with m as (select user_id, max(event_id) as last from events where event_id < 500 group by 1) select e.event_id, e.user_id from events e left join m using (user_id) where m.last is null or e.event_id > m.last")
def p_after_marks(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return feed.after(events, feed.last_ids(events.where("event_id < 500"), "user_id", "event_id"), "user_id", "event_id").select("event_id", "user_id")


@L.add("I3 I2", "select event_type, count(*) as n from events where ts >= timestamp '2023-12-27' and ts < timestamp '2024-01-02' group by 1")
def p_day_window(spark, sf_dir):
    first, end = scores.window_bounds("2024-01-02", 6)
    return feed.since(table(spark, sf_dir, "events"), "ts", first, end).groupBy("event_type").agg(F.count("*").alias("n"))


@L.add("I4 I9 B7", f"with {PART} select k from p where k % 3 <> 0")
def p_pending(spark, sf_dir):
    p = _part(spark, sf_dir)
    return feed.pending(p.select("k"), p.where("k % 3 = 0").select("k").union(p.where("k % 9 = 0").select("k")), "k")


@L.add("J4 J5 J6", f"with {PART} select k, case when k % 2 = 0 then name end as marked, case when k % 2 = 0 then kind end as json, case when k % 2 = 0 then brand end as numbered from p")
def p_replies(spark, sf_dir):
    good = F.col("k") % 2 == 0
    marked = hooks.marked_reply(F.concat(F.lit("[[1]] "), "name", F.when(good, F.lit(" [[2]] y")).otherwise(F.lit(" [[3]] y"))), 2)
    json = hooks.json_reply(F.concat(F.lit('[{"id":"a","text":"'), "kind", F.lit('"},{"id":"'), F.when(good, F.lit("b")).otherwise(F.lit("x")), F.lit('","text":"t"}]')), F.array(F.lit("a"), F.lit("b")))
    numbered = hooks.numbered_reply(F.concat(F.lit("1| "), "brand", F.when(good, F.lit("\n2| z")).otherwise(F.lit("\nz"))), 2)
    return _part(spark, sf_dir).select("k", marked[0].alias("marked"), json["a"].alias("json"), numbered[0].alias("numbered"))


@L.add("J1 J2 J4 J7 I5 I6 J8 J10", f"with {PART} select k, 'ok ' || name as reply, 2 as passes, case when k % 2 = 0 then 'A:' || kind end as adapted from p")
def p_model_calls(spark, sf_dir):
    hooks.register_adapter("planted", lambda df: df.where("k % 2 = 0").select("k", F.concat(F.lit("A:"), "kind").alias("adapted")))
    p = _part(spark, sf_dir)
    asked = hooks.repaired(p.select("k", "name"), "name", _answer(), lambda prompt, reply: reply == f"ok {prompt}")
    return asked.select("k", "reply", "passes").join(hooks.adapt("planted", p), "k", "left")


def _answer():
    """A model that answers every second time: a call of one prompt, whose first reply is not well formed."""
    seen: dict[str, int] = {}

    def call(prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            seen[p] = seen.get(p, 0) + 1
            out.append(f"ok {p}" if seen[p] % 2 == 0 else "bad")
        return out
    return call
