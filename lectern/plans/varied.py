"""Queries whose outlines, pointers, parts and values differ from row to row, and whose rows are what the operators give."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import checks, layout, sequence
from lectern.plans.base import Listing, table
from lectern.plans.planted import PART
from lectern.sources import notes

L = Listing()


def _outlines(spark, sf_dir):
    """The lines of each order as headings, one to four deep by their quantity."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("pos"), (F.col("l_quantity").cast("int") % 4 + 1).alias("depth")).groupBy("k", "pos").agg(F.min("depth").alias("depth"))


#: The same in SQL.
_OUTLINES = "h as (select l_orderkey as k, l_linenumber::bigint as pos, min(l_quantity::int % 4 + 1) as depth from lineitem group by 1, 2)"


@L.add("G8", f"""with {_OUTLINES}, c as (select *, {', '.join(f'count(*) filter (depth = {i}) over w as c{i}' for i in range(1, 5))} from h window w as (partition by k order by pos)),
n as (select *, {', '.join(f'c{i} - coalesce(max(c{i}) filter (depth < {i}) over w, 0) as n{i}' for i in range(1, 5))} from c window w as (partition by k order by pos))
select k, pos, depth, array_to_string(list_slice([n1, n2, n3, n4], 1, depth), '-') || '-0' as assigned_id from n""")
def g_heading_ids(spark, sf_dir):
    return sequence.depth_ids(_outlines(spark, sf_dir), ["k"], "pos", "depth")


@L.add("G15", f"""with {_OUTLINES}, up as (select a.k, a.pos, a.depth, max(b.pos) as above from h a left join h b on a.k = b.k and b.pos < a.pos and b.depth < a.depth group by all)
select u.k, u.pos, u.depth, p.pos as parent from up u left join h p on u.k = p.k and u.above = p.pos and p.depth = u.depth - 1""")
def g_heading_parents(spark, sf_dir):
    return layout.parents(_outlines(spark, sf_dir), ["k"], "pos", "depth")


@L.add("G28", """with recursive o as (select o_custkey as k, o_orderkey as pos, o_orderkey % 3 <> 0 as mark, row_number() over (partition by o_custkey order by o_orderkey) as i from orders),
s as (select k, pos, i, 0 as part, 1 as n from o where i = 1 union all
select o.k, o.pos, o.i, case when o.mark and s.n >= 3 then s.part + 1 else s.part end, case when o.mark and s.n >= 3 then 1 else s.n + 1 end from s join o on o.k = s.k and o.i = s.i + 1)
select k, pos, part from s""")
def g_bounded_parts(spark, sf_dir):
    """The orders of a customer in parts of three or more, begun only at keys that three doesn't divide."""
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("pos"), (F.col("o_orderkey") % 3 != 0).alias("mark"))
    return sequence.size_bounded_parts(lines, "k", "pos", "mark", 153, 150).select("k", "pos", "part")


@L.add("D34", f"""with {PART}, t as (select k, unnest([1, 2, 3, 4, 5]) as i, unnest(['1', '1.1', '1.2', '1.3', '2']) as node, unnest([size, k % 5 + 1, size, case when k % 4 > 0 then k % 3 + 1 end, size % 7 + 1]) as pointer from p),
r as (select *, lag(pointer) over (partition by k order by i) as before from t where pointer is not null)
select 'pointer_decreases' as check_name, 'major' as severity, k || '-' || node as entity_id, before || '>' || pointer as detail from r where pointer < before
union all select 'pointer_shared', 'minor', k || '-' || pointer, count(*) || '' from r group by k, pointer having count(*) >= 3""")
def p_varied_pointers(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.expr("""concat_ws(chr(10), '* 1. ' || p_name || ' [[' || p_size || ']]', '  * 1.1 a [[' || (p_partkey % 5 + 1) || ']]',
        '  * 1.2 b [[' || p_size || ']]', '  * 1.3 c [[' || if(p_partkey % 4 > 0, cast(p_partkey % 3 + 1 as string), '?') || ']]', '* 2. d [[' || (p_size % 7 + 1) || ']]')""").alias("text"))
    return checks.monotonic(notes.toc(p, ["k"]), ["k"])


@L.add("B14", f"""with {PART} select k, case when k % 3 = 0 then '' else '---' || chr(10) || 'kind: ' || kind || ' $1' || chr(10) || case when k % 3 = 1 then 'kept: ' || brand || chr(10) else '' end || 'size: ' || size || chr(10) || '---' || chr(10) end
|| case when k % 3 = 0 then '---' || chr(10) || 'kind: ' || kind || ' $1' || chr(10) || 'size: ' || size || chr(10) || '---' || chr(10) else '' end || name as text from p""")
def p_patched_values(spark, sf_dir):
    """A key replaced or added and another added, by the row's own values, in notes with and without frontmatter."""
    text = F.expr("""case p_partkey % 3 when 0 then p_name when 1 then concat_ws(chr(10), '---', 'kind: old', 'kept: ' || p_brand, '---', p_name)
        else concat_ws(chr(10), '---', 'kind: older', '---', p_name) end""")
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("k"), notes.patched(text, {"kind": F.concat("p_type", F.lit(" $1")), "size": F.col("p_size")}).alias("text"))
