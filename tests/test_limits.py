"""What operators ask of the driver and of a task, and rows that are empty, tied or odd."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import types as K

from lectern.functions import features
from lectern.operators import align, checks, layout, sequence, stanzas, units
from lectern.plans import audit


def test_titles_of_small_files_are_not_broadcast(spark, tmp_path):
    """A few bytes of file may be many lines: the driver takes none of them."""
    spark.range(2000).selectExpr("id as k", "concat('a title ', id) as title", "'1' as node_id", "5 as pointer").write.parquet(str(tmp_path / "toc"))
    toc = spark.read.parquet(str(tmp_path / "toc"))
    lines = toc.selectExpr("k", "case k % 3 when 0 then 7 else 20 end as line_no", "case when k % 3 = 2 then 'none' else concat('of ', title) end as line")
    found = checks.title_attestation(toc, lines, ["k"])
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["k"], r["attested"]) for r in found.collect()) == [(k, ("near", "elsewhere", "absent")[k % 3]) for k in range(2000)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_come_by_in_order_across_batches(spark):
    """A key that goes over batches is made once, of all its rows in order; rows may be null."""
    df = spark.range(3000).selectExpr("case when id % 7 = 0 then null else id % 7 end as k", "2999 - id as pos", "if(id % 5 = 0, null, id) as v").repartition(3)
    kind = K.StructType([K.StructField("k", K.LongType()), K.StructField("n", K.IntegerType()), K.StructField("vs", K.ArrayType(K.LongType()))])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        got = {r["k"]: (r["n"], r["vs"]) for r in sequence.by_key(df, ["k"], ["pos"], ["v"], lambda key, own: [(*key, len(own), [v for v, in own])], kind).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for k in range(7):
        ids = [i for i in range(2999, -1, -1) if i % 7 == k]
        assert got[k or None] == (len(ids), [None if i % 5 == 0 else i for i in ids])


def test_works_need_no_python_group_each(spark):
    root = units.root_lines(spark.createDataFrame([(1, "ཀ་ཁ་ག་ང་ཅ་ཆ་ཇ་ཉ་ཏ། །")], "pos int, text string"))
    blocks = spark.createDataFrame([("b", 2, "P", "y"), ("b", 1, "H", "# x"), ("a", 1, "P", "z"), ("a", 2, "P", " ")], "k string, pos int, kind string, text string")
    found = units.functional_units(blocks, root, "k")
    assert "FlatMapGroupsInPandas" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [("a", 0, "P", "z"), ("b", 0, "H", "# x"), ("b", 1, "P", "y")]


def test_texts_need_no_python_group_each(spark):
    c = spark.createDataFrame([(k, i, n, True, False) for k in ("k", "l") for i, n in enumerate([7, 7, 7, 7, 30, 3])], "k string, pos int, size int, closed boolean, final boolean")
    found = layout.verse_units(c, "k")
    assert "FlatMapGroupsInPandas" not in plan(found)
    assert [(r["k"], r["unit"], r["kind"]) for r in found.orderBy("k", "pos").collect()] == [(k, u, w) for k in "kl" for u, w in [(0, "verse"), (1, "verse"), (2, "verse"), (3, "verse"), (4, "prose"), (4, "prose")]]


def test_stanzas_are_found_in_one_scan_over_documents(spark):
    """Documents come by once, sorted, and without a Python group each; lines may be null or empty, and there may be none."""
    stanza = spark.createDataFrame([(1, 5, ["one line", "two line"]), (1, 6, ["two line", "end of it"]), (1, 7, ["zero zero", None, "uno line"]), (2, 1, []), (3, 1, ["one line"]), (1, None, ["one line"])], "doc_id long, stanza_id long, lines array<string>")
    doc = spark.createDataFrame([(1, ["zero zero", None, "one line", "two line", "", "two line", "end of it"]), (2, ["x"]), (3, None)], "doc_id long, lines array<string>")
    found = stanzas.stanza_places(stanza, doc)
    assert "FlatMapGroupsInPandas" not in plan(found) and "SortMergeJoin" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, 5, 2, 2), (1, 6, 5, 2)]


def test_empty_texts_keep_their_rows(spark, tmp_path):
    """As in the SQL: an empty text is kept whole, a missing one has neither length nor verdict."""
    spark.createDataFrame([(1, "one two. three"), (2, ""), (3, None), (4, " ")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, audit.d_segments_keep_text(spark, str(tmp_path)).collect())) == [(1, 14, True), (2, 0, True), (3, None, None), (4, 1, True)]


def test_an_empty_source_needs_no_translation(spark, tmp_path):
    """Nor is a footnote mark another one for a line break in it."""
    u = spark.createDataFrame([("a", "", ""), ("b", " ", " "), ("c", "x", ""), ("d", "y [^see p. 3]", "y [^see p.\n3]"), ("e", "y [^1]", "y [^2]")], "id string, source string, target string")
    assert sorted((r["check_name"], r["entity_id"]) for r in checks.unit_check(u, "id").collect()) == [("empty", "c"), ("footnote_marks", "e"), ("line_parity", "d")]


def test_messages_of_one_time_count_in_one_order(spark):
    """Ties at the end of a day: the next day goes on with the one that is last in the day's own order."""
    at = lambda s: datetime(2024, 1, 2) + timedelta(seconds=s)
    rows = [("C", at(-1)), ("A", at(-1)), ("B", at(-1)), ("C", at(1)), ("B", at(1)), ("A", at(2)), ("B", at(2))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "author string, ts timestamp").repartition(3)
        got = sequence.stitched(df, "author", "ts").orderBy("unit", "ts", "author").collect()
        assert [(r["author"], r["ts"], r["unit"]) for r in got] == [("A", at(-1), 1), ("B", at(-1), 2), ("C", at(-1), 3), ("B", at(1), 4), ("C", at(1), 5), ("A", at(2), 6), ("B", at(2), 7)]
        assert [r["n"] for r in sequence.units(sequence.stitched(df.where("ts <> timestamp'2024-01-02 00:00:02'").where("not (author = 'B' and ts > timestamp'2024-01-02')"), "author", "ts"), "author", "ts").orderBy("unit").collect()] == [1, 1, 2]


def test_words_of_many_texts_are_counted_in_bounded_stretches():
    """A stretch has a bounded number of words or one text; a text's counts are its own wherever it stands."""
    assert list(features.chunks(np.array([3, 3, 9, 0, 1]), 6)) == [(0, 2), (2, 3), (3, 5)] and list(features.chunks(np.array([], int))) == []
    words = [["a", "b", "a"], ["b"], ["b", "c", "b", "b"]]
    sents, marks = [[0, 0, 1], [0], [0, 0, 1, 1]], [[4, 6, 4], [4], [4, 0, 4, 5]]
    at, columns = features.word_features(*map(pa.array, (words, sents, marks)))
    got = {(i, *row) for i, *row in zip(at.tolist(), *(c.to_pylist() for c in columns), strict=True)}
    for i in range(3):
        _, alone = features.word_features(*(pa.array([x[i]]) for x in (words, sents, marks)))
        assert {g[1:] for g in got if g[0] == i} == set(zip(*(c.to_pylist() for c in alone), strict=True))
    assert (0, "b", 1, 0, 1, 1, 0.0, 1, 1, 0, 0, 2, 1.5, 0.5, 2) in got and len(got) == 4


def test_spans_of_one_length_meet_in_cells(spark):
    """Spans of about one length are listed twice at most and give the pairs that all pairs give, negative places and empty spans among others."""
    rnd = random.Random(5)
    for sizes in ((9, 16), (0, 1), (3, 40)):
        spans = [(rnd.randint(0, 1), s := rnd.randint(-60, 60), s + rnd.randint(*sizes), i) for i in range(80)]
        df = spark.createDataFrame([*spans, (0, None, 4, 99)], "k long, start long, end long, id long")
        found = align.overlap_join(df, df, "k")
        assert ("_cell" in plan(found)) == (sizes[1] < 40)
        assert found.columns == ["k", "start", "end", "id", "start_b", "end_b", "id_b"]
        assert sorted((r["id"], r["id_b"]) for r in found.collect()) == sorted((a[3], b[3]) for a in spans for b in spans if a[0] == b[0] and a[1] < b[2] and a[2] > b[1])
