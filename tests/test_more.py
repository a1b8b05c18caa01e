"""Operators that no query runs, on literal rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lectern.functions import fold, tibetan
from lectern.functions import text as T
from lectern.operators import align, checks, fuzzy, hooks, intake, layout, scores, segment, sequence
from lectern.sources import notes, sinks


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def names(df):
    return sorted((r["check_name"], r["entity_id"]) for r in df.collect())


@pytest.fixture(scope="module")
def toc(spark):
    text = "* 1 One [[1]]\n   * 1.1 Sub two [[5]]\n   * 1.3 Other [[3]]\n* 3 Late [[3]]\n* 1 Again [[3]]\n* nonsense\n      * 4.1.1 Deep [[?]]"
    return notes.toc(spark.createDataFrame([("n", text)], "note string, text string"), ["note"])


def test_tree_checks(toc):
    got = names(checks.tree_checks(toc, ["note"]))
    assert ("duplicate_node", "n-1") in got and ("missing_parent", "n-4.1.1") in got and ("unreadable", "n-6") in got
    assert ("siblings", "n-1") in got and ("siblings", "n-") in got


def test_pointers(toc):
    got = names(checks.monotonic(toc, ["note"]))
    assert ("pointer_decreases", "n-1.3") in got and ("pointer_shared", "n-3") in got


def test_titles(spark, toc):
    lines = spark.createDataFrame([("n", 2, "the One here"), ("n", 40, "a Sub two far")], "note string, line_no int, line string")
    got = dict(rows(checks.title_attestation(toc.where("node_id in ('1.1', '3') or title = 'One'"), lines, ["note"]), "node_id", "attested"))
    assert got == {"1": "near", "1.1": "elsewhere", "3": "absent"}


def test_sibling_counts(spark):
    nodes = spark.createDataFrame([("k", "1", None, 10), ("k", "1.1", "1", 11), ("k", "1.2", "1", 14)], "k string, node_id string, parent_id string, pointer int")
    lines = spark.createDataFrame([("k", 9, "there are three parts")], "k string, line_no int, line string")
    got = rows(intake.sibling_counts(nodes, lines, "k", {"two": 2, "three": 3}), "node_id", "announced", "children")
    assert ("1", 3, 2) in got


def test_grades(spark):
    grade = spark.createDataFrame([("v1", "t1", "form", "r1"), ("v9", "t1", "form", "rX"), ("v1", "t9", "x", "r")], "verse_id string, term string, form string, rendering string")
    base = spark.createDataFrame([("t1", "form", "r1", ["v1"]), ("t2", "form", "r2", ["v1", "v2"])], "term string, form string, rendering string, verse_ids array<string>")
    texts = spark.createDataFrame([("v1", "a form here")], "verse_id string, text string")
    got = names(checks.grade_checks(grade, base, texts))
    assert got == [("missing_term", "v1/t9"), ("not_in_text", "v1/t9"), ("not_in_text", "v9/t1"), ("out_of_scope", "v9/t1"), ("overlapping_scope", "form"), ("rendering_differs", "v9/t1")]


def test_termbase(spark):
    words = spark.createDataFrame([("v", "k1", "great fire"), ("v", "k2", "fire"), ("v", "k3", "burning"), ("v", "k4", "great fires"), ("w", "k5", "x")], "verse_id string, keyword string, rendering string")
    text = spark.createDataFrame([("v", "The great fires burned")], "verse_id string, text string")
    got = dict(rows(checks.termbase_consistency(words, text), "keyword", "status"))
    assert got == {"k1": "exact", "k2": "exact", "k3": "loose", "k4": "exact", "k5": "missing"}


def test_units_and_groups(spark):
    u = spark.createDataFrame([("a", "x\ny[^1]", "x[^1]"), ("b", "x", " "), ("c", "p[^1]", "p[^2]")], "id string, source string, target string")
    assert names(checks.unit_check(u, "id")) == [("empty", "b"), ("footnote_marks", "c"), ("line_parity", "a")]
    units = spark.createDataFrame([("k", i, "v" if i < 3 else "p") for i in range(1, 5)], "k string, unit int, kind string")
    groups = spark.createDataFrame([("k", 1, 1, 1), ("k", 1, 2, 2), ("k", 2, 1, 2), ("k", 2, 2, 3)], "k string, group_id int, pos int, unit int")
    assert [n for n, _ in names(checks.group_coverage(groups, units, "k"))] == ["mixed_kinds", "order", "twice", "uncovered"]
    meta = spark.createDataFrame([("a", "", "xx"), ("b", "t", "en")], "id string, title string, lang string")
    assert names(checks.metadata(meta, "id", ["title"], {"lang": ["en", "bo"]})) == [("missing:title", "a"), ("unknown:lang", "a")]


def test_block_flags(spark):
    df = spark.createDataFrame([("a", "ཀ་ཁ་དང་།"), ("b", "ཀ།"), ("c", "# head"), ("d", "ཀ་ཁ།།")], "id string, text string")
    assert names(checks.block_flags(df, "id", 60, 3, "དང་།\\s*$", "ཞེ་ན།", "འོ་ན")) == [("CONNECTOR_ENDING", "a"), ("SHORT_FRAGMENT", "b")]


def test_transclusions(spark):
    lines = spark.createDataFrame([("n", 1, "a ^1"), ("n", 2, "b ^2")], "k string, n int, line string")
    with_ = segment.with_transclusions(lines, ["k"], "n", F.when(F.col("line").endswith("^2"), F.lit("![[r#^2]]")))
    got = [r["line"] for r in with_.orderBy("src_line", "sub").collect()]
    assert got == ["a ^1", "![[r#^2]]", "", "b ^2"]
    again = spark.createDataFrame([("n", i, x) for i, x in enumerate(got)], "k string, n int, line string")
    same = segment.with_transclusions(again, ["k"], "n", F.when(F.col("line").endswith("^2"), F.lit("![[r#^2]]")))
    assert [r["line"] for r in same.orderBy("src_line", "sub").collect()] == got
    assert [r["line"] for r in segment.without_transclusions(again, ["k"], "n").orderBy("n").collect()] == ["a ^1", "", "b ^2"]
    heads = spark.createDataFrame([("n", 2, "## H")], "k string, at int, heading string")
    assert [r["line"] for r in segment.inserted_headings(lines, heads, ["k"], "n").orderBy("new_line").collect()] == ["a ^1", "## H", "b ^2"]
    blank = layout.one_blank_around(spark.createDataFrame([("n", i, x) for i, x in enumerate(["a", "M", "b", "", "", "c"])], "k string, n int, line string"), ["k"], "n", F.col("line") == "M")
    assert [r["line"] for r in blank.orderBy("n", "sub").collect()] == ["a", "", "M", "", "b", "", "c"]
    anchored = layout.anchored(lines, ["k"], "n", r"\^2$", F.lit("%%x%%"))
    assert [r["line"] for r in anchored.orderBy("n", "sub").collect()] == ["a ^1", "%%x%%", "b ^2"]


def test_lines_by_context(spark):
    lines = spark.createDataFrame([("n", 1, "alpha beta"), ("n", 2, "alpha"), ("n", 3, "second division of gamma")], "k string, line_no int, line string")
    ctx = spark.createDataFrame([("n", "beta"), ("n", "alpha")], "k string, context string")
    assert rows(segment.unique_context(lines, ctx, ["k"]), "context", "line_no") == [("beta", 1)]
    titles = spark.createDataFrame([("n", 0, "gamma rays")], "k string, title_line int, title string")
    assert rows(segment.announcement_start(lines, titles, ["k"], "division"), "line_no", "announced") == [(3, True)]
    assert rows(segment.announcement_start(lines, titles, ["k"], "nothing"), "line_no", "announced") == [(1, False)]


def test_runs_and_wraps(spark):
    df = spark.createDataFrame([([(0, 2, "b"), (4, 8, "i")], "a term, a term")], "runs array<struct<start:int,end:int,style:string>>, t string")
    got = df.select(segment.shifted_runs(F.col("runs"), 2, 2, 5).alias("r"), segment.first_wrap(F.col("t"), "term", "[[", "]]").alias("w")).first()
    assert [tuple(x) for x in got["r"]] == [(0, 2, "b"), (7, 11, "i")] and got["w"] == "a [[term]], a term"
    assert spark.range(1).select(layout.broken_lines(F.lit("a; b; c"), ";").alias("x")).first()["x"] == "a;\nb;\nc"
    assert spark.range(1).select(segment.stanza_cut(F.lit("ཀ། །ཁ། །")).alias("x")).first()["x"] == ["ཀ། །", "ཁ། །"]


def test_scores(spark):
    periods = spark.createDataFrame([("a", date(2024, 1, 1), 14), ("b", date(2024, 1, 15), 14)], "id string, start date, days int")
    assert scores.current_period(periods, "2024-01-20").first()["id"] == "b" and scores.current_period(periods, "2024-06-01").first()["id"] == "b"
    assert scores.window_bounds("2024-03-10", 7) == ("2024-03-03", "2024-03-10")
    items = spark.createDataFrame([("bug", "p9", ["x", "x"], "r", datetime(2024, 1, 1)), ("odd", "p1", [], "r", datetime(2024, 1, 2))], "section string, priority string, images array<string>, reporter string, ts timestamp")
    got = rows(scores.digest_items(items, ["bug", "other"], ["p1", "p2"]), "section", "priority", "reporter_days")
    assert got == [("bug", "p2", 2), ("other", "p1", 2)]
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "day date")
    commits = spark.createDataFrame([("u", date(2024, 1, 2))], "user string, day date")
    skipped = scores.skipped_days(days, commits, spark.createDataFrame([("u",)], "user string"), "user")
    assert skipped.count() == 2 and scores.skipped_days(days, commits, spark.createDataFrame([("u",)], "user string"), "user", skipped).count() == 0


def test_layout_rest(spark):
    nodes = spark.createDataFrame([("k", "1", "1.1", 1, 9), ("k", "1", "1.2", 2, 3)], "k string, parent_id string, node_id string, pos int, place int")
    assert rows(layout.reordered(nodes, ["k"], renumber=True), "place", "node_id") == [(3, "1.1"), (9, "1.2")]
    labels = spark.createDataFrame([("k", 0, "one"), ("k", 1, "two"), ("k", 2, "gone")], "k string, n int, label string")
    text = spark.createDataFrame([("k", "two one two")], "k string, text string")
    assert rows(layout.label_places(labels, text, "k"), "n", "place") == [(0, 4), (1, 8), (2, -1)]
    a = spark.createDataFrame([("k", 0, "alpha"), ("k", 1, "beta")], "k string, pos int, label string")
    b = spark.createDataFrame([("k", 0, "noise"), ("k", 1, "alpha"), ("k", 2, "betas")], "k string, pos int, label string")
    assert rows(layout.outline_alignment(a, b, "k"), "entry", "candidate") == [(0, 1), (1, 2)]
    items = spark.createDataFrame([("k", 0, "a\nb"), ("k", 1, "c")], "k string, pos int, text string")
    assert rows(layout.one_paragraph_each(items, "k", "pos", F.lit("T")), "pos", "line_no") == [(0, 3), (1, 6)]
    parts = spark.createDataFrame([("k", 0, "Keep", "x"), ("k", 1, "Notes", "y"), ("k", 2, "More", "z")], "k string, pos int, section string, text string")
    assert layout.assembled(parts, "k", ["notes"]).first()["text"] == "x\n\nz"


def test_intake_rest(spark):
    src = spark.createDataFrame([("k", 0, "b1"), ("k", 2, "b3")], "k string, row int, block string")
    tgt = spark.createDataFrame([("k", i) for i in range(3)], "k string, row int")
    assert rows(intake.parallel_rows(src, tgt, "k", "block"), "row", "block", "flagged") == [(0, "b1", False), (1, "b1", True), (2, "b3", False)]
    pairs = spark.createDataFrame([("k", 0, "abc def", "abcdef"), ("k", 1, "abcdef", "abcxyz"), ("k", 2, "abc", "xyz")], "k string, row int, own string, other string")
    assert rows(intake.row_agreement(pairs, "k"), "row", "status") == [(0, "agree"), (1, "variant"), (2, "differs")]
    base = spark.createDataFrame([("a",), ("b",)], "name string")
    l1, l2 = (spark.createDataFrame(x, "name string, pid string") for x in ([("a", "1")], [("a", "2"), ("b", "3")]))
    assert rows(intake.first_known("name", base, [l1, l2], "pid")) == [("a", "1"), ("b", "3")]
    c = spark.createDataFrame([("v", "major", "x"), ("v", "minor", "y")], "verse string, severity string, detail string")
    assert intake.feedback(c, "verse").first()["issues"] == "major: x; minor: y" and intake.feedback(c, "verse", True).first()["n"] == 1
    d = spark.createDataFrame([("k", "# Terms\n**a** and **b**\n# Else\n**c**\n1. x **y** z\n2. w")], "k string, text string")
    assert rows(intake.concept_lemmas(d, "k", "Terms"), "lemma") == [("a",), ("b",)]
    assert rows(intake.typed_rows(d, "k"), "row", "text", "bold") == [(1, "x y z", ["y"]), (2, "w", [])]
    j = spark.createDataFrame([("k", '{"segments": [{"id": "s", "span": {"start": 1, "end": 3}, "related": [{"type": "t", "text": "x"}]}]}')], "k string, j string")
    assert rows(intake.related_segments(j, "k", "j")) == [("k", "s", 1, 3, "t", "x")]


def test_sequence_rest(spark):
    df = spark.createDataFrame([("k", i, i % 3 == 0) for i in range(8)], "k string, n int, mark boolean")
    assert [r["part"] for r in sequence.size_bounded_parts(df, "k", "n", "mark", 4, 1).orderBy("n").collect()] == [0, 0, 0, 1, 1, 1, 2, 2]
    assert [r["n"] for r in sequence.pinned_first(df, "n", "5", "n").orderBy("pos").collect()][:3] == [5, 0, 1]
    sizes = spark.createDataFrame([("k", i, s) for i, s in enumerate([5, 5, 5, 20, 1])], "k string, n int, size int")
    assert [r["batch"] for r in sequence.capped_batches(sizes, "k", "n", "size", 2, 12).orderBy("n").collect()] == [0, 0, 1, 2, 3]


def test_text_rest(spark):
    v = lambda c: spark.range(1).select(c.alias("v")).first()["v"]
    assert v(T.mechanical_clean(F.lit("a\n 12 \nཀ༌ ཁ  b"))) == "a\nཀ་ཁ b"
    assert v(T.shad_spacing(F.lit("ཀ།ཁ། །"))) == "ཀ། ཁ། །" and v(T.shad_groups(F.lit("ཀ།   །"))) == "ཀ། །"
    assert v(T.plain_wikitext(F.lit("<noinclude>x</noinclude>{{t}}a [[b|c]]<br>"))) == "a c"
    assert v(T.numeral_system(F.lit("༣"))) == "tibetan" and v(T.to_ascii_digits(F.lit("༣४"))) == "34"
    assert v(T.corrected(F.lit("abc"), F.lit("b"), F.lit("x"))) == "axc" and v(T.corrected(F.lit("abc"), F.lit(None), F.lit("x"))) == "abc"
    assert v(T.tibetan_norm(F.lit("<small>x</small>ཀ་ b"))) == "ཀ་" and v(T.plain_english(F.lit("Ārya"))) is False
    assert v(tibetan.transclusion_norm(F.lit("![[x#^1]] **ཀ**། ^1-1"))) == "ཀ" and v(tibetan.reordered(F.lit("ཀི"))) == "ཀི"
    assert v(tibetan.split_affixes(F.lit("པའི་ཆོས"))) == "པ འི་ཆོས"


def test_sinks_rest(spark, tmp_path):
    df = spark.createDataFrame([("w", "a", 1)], "w string, t string, n int")
    sinks.annotated(df, df, "w", str(tmp_path / "o"))
    sinks.report_tsv(df, str(tmp_path / "t"))
    sinks.append_ledger(df, str(tmp_path / "l"))
    sinks.append_ledger(df, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "o/items")).count() == 1 and spark.read.json(str(tmp_path / "l")).count() == 2
    assert sinks.rendered(df.union(spark.createDataFrame([("w", "b", 0)], df.schema)), "w", ["n"], F.col("t")).first()["text"] == "b\na"
    segs = spark.createDataFrame([("e", "r", [(3, 5), (0, 2)])], "e string, ref string, lines array<struct<start:int,end:int>>")
    assert [r["start"] for r in notes.live_lines(segs, "e").collect()] == [0, 3]


def test_hooks_rest(spark):
    waits, calls = [], []

    def flaky(p):
        calls.append(p)
        if len(calls) < 3:
            raise OSError
        return [x.upper() for x in p]

    assert hooks.retrying(flaky, sleep=waits.append)(["a"]) == ["A"] and waits == [1.0, 2.0]
    with pytest.raises(hooks.QuotaSpent):
        hooks.retrying(lambda p: (_ for _ in ()).throw(hooks.QuotaSpent()), sleep=waits.append)(["a"])
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, payload string")
    assert rows(hooks.repaired(df, "payload", lambda p: [p[0] * 2], lambda p, r: p == "x"), "k", "passes") == [("a", 1), ("b", 0)]
    assert rows(hooks.delivered(df, "k", str.upper)) == [("a", "dry-run", None), ("b", "dry-run", None)]
    done = spark.createDataFrame([("a", "sent")], "k string, status string")
    assert rows(hooks.delivered(df, "k", str.upper, done, dry_run=False)) == [("b", "sent", "Y")]


def test_align_rest(spark):
    a = spark.createDataFrame([("1", "(Ka) one (Kha) two"), ("2", "plain")], "k string, text string")
    b = spark.createDataFrame([("1", "(ka) eins (Ga) drei"), ("2", "(ka) zwei (kha) drei")], "k string, text string")
    assert rows(align.labelled_pairs(a, b, "k")) == [("1", "ka", "one", "eins"), ("2", "", "plain", "zwei")]
    x = spark.createDataFrame([(1, "the quick brown fox")], "x int, text string")
    y = spark.createDataFrame([(7, "the quick brown fax"), (8, "the quick brown foxes")], "y int, text string")
    assert rows(fuzzy.best_match(x, y, "x", "y", 0.8), "x", "y") in ([(1, 7)], [(1, 8)])
    words = spark.createDataFrame([(["the", "noble", "truth"],)], "w array<string>")
    assert words.select(fold.phrase_tokens(["noble truth"])("w").alias("w")).first()["w"] == ["the", "noble truth"]
    assert segment.valid_cut("One. Two", 5) and not segment.valid_cut("ཀ་ཁ། ག", 2) and not segment.valid_cut("One", 3)


def test_simulation_tiles(spark):
    spans = spark.createDataFrame([("k", 0, 4), ("k", 4, 9)], "k string, start int, end int")
    ops = spark.createDataFrame([("k", [("insert", 4, 4, "xy"), ("delete", 6, 8, None)])], "k string, ops array<struct<type:string,start:int,end:int,text:string>>")
    after = segment.simulated(spans, ops, "k")
    assert rows(after, "start", "end") == [(0, 6), (6, 9)]
    assert checks.tiling(after.withColumn("n", F.lit(9)), ["k"], "n").count() == 0


def test_shapes_and_moves(spark):
    a = spark.createDataFrame([("t", "1", "r1"), ("t", "1.1", "r2"), ("t", "2", "r3")], "k string, path string, ref string")
    b = spark.createDataFrame([("t", "1", "r1"), ("t", "2", "rX")], "k string, path string, ref string")
    assert names(checks.tree_shapes(a, a, ["k"])) == [] and [e for _, e in names(checks.tree_shapes(a, b, ["k"]))] == ["t-1", "t-1.1", "t-2"]
    lines = spark.createDataFrame([("n", i, x) for i, x in enumerate(["a", "b", "![[r]]", "", "c"])], "k string, n int, line string")
    moved = layout.moved_up(lines, ["k"], "n", F.col("line").startswith("![["))
    assert [r["line"] for r in moved.orderBy("new_line").collect()] == ["![[r]]", "a", "b", "", "c"]


def test_queries_without_sql_read_all_documents(spark, tmp_path):
    from lectern.plans import match
    long = " ".join(f"word{i}." for i in range(600))
    docs = [(1, long + "\nend", None), (2, long + "\nend!", 5000), (3, "x", 1), (4, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert [(r["doc_id"], r["other_id"]) for r in match.e_fuzzy_map(spark, str(tmp_path)).collect()] == [(1, 2)]
    assert {r["work"] for r in match.e_concordance(spark, str(tmp_path)).collect()} == {"1", "2", "3"}
    assert {(r["doc_id"], r["end"]) for r in match.e_projected_spans(spark, str(tmp_path)).collect()} == {(1, 40), (2, 40), (3, 1), (4, 0)}


def test_best_windows_query_searches_every_line(spark, tmp_path):
    from lectern.plans import match
    docs = [(1, "one line", None), (2, "first words here\nsecond words\n\nthird", 5000)]
    spark.createDataFrame(docs, "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["line_no"], r["found"]) for r in match.e_best_windows(spark, str(tmp_path)).collect()}
    assert got == {(1, 0, True), (2, 0, True), (2, 1, True), (2, 2, False), (2, 3, True)}


def test_scan_over_batches(spark):
    import random

    from lectern.operators import layout, sequence
    rng = random.Random(3)
    notes = {k: [rng.randint(1, 5) for _ in range(n)] for k, n in (("a", 1), ("b", 700), ("c", 2), ("d", 40))}
    rows = [(k, i, d) for k, ds in notes.items() for i, d in enumerate(ds)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i long, d int").repartition(5)
    ids, parents = {}, {}
    for k, ds in notes.items():
        for i, d in enumerate(ds):
            at = []
            for level in range(1, d + 1):  # rows of the level since the last above it
                since = max((j for j in range(i + 1) if ds[j] < level), default=-1)
                at.append(sum(ds[j] == level for j in range(since + 1, i + 1)))
            ids[k, i] = "-".join(map(str, at)) + "-0"
            above = max((j for j in range(i) if ds[j] < d), default=None)
            parents[k, i] = above if above is not None and ds[above] == d - 1 else None
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # keys stand in many batches, and batches in many keys
    try:
        assert {(r["k"], r["i"]): r["assigned_id"] for r in sequence.depth_ids(df, ["k"], "i", "d").collect()} == ids
        assert {(r["k"], r["i"]): r["parent"] for r in layout.parents(df, ["k"], "i", "d").collect()} == parents
        assert sequence.depth_ids(df.limit(0), ["k"], "i", "d").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
