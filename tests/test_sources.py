from __future__ import annotations

import zipfile


from lectern.sources import notes, sinks
from lectern.streaming import feed

NOTE = """---
title: "A note"
claim_count: 2
---
# Title

## One ^1-0

first line
second ^1-1

![[root#^1-2]]
third ^1-2

| day | range |
|---|---|
| 1 | 1.1-1.3 |
| 2 | 1.4-1-6 |
| x | y |
"""


def one(spark, text):
    return spark.createDataFrame([("n", text)], "note string, text string")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_notes(spark, tmp_path):
    (tmp_path / "a.md").write_text(NOTE)
    r = notes.notes(spark, str(tmp_path / "*.md")).first()
    assert r["frontmatter"] == {"title": "A note", "claim_count": "2"} and r["body"].startswith("# Title")


def test_blocks(spark):
    df = one(spark, NOTE)
    assert rows(notes.blocks(df, ["note"]).where("block_id <> ''"), "block_id", "block")[0] == ("1-1", "first line\nsecond")
    units = notes.typed_units(df, ["note"])
    assert {r["kind"] for r in units.collect()} == {"heading", "block"} and rows(notes.root_ids(units, ["note"]), "block_id") == [("1-1",), ("1-2",)]
    assert rows(notes.accumulated_blocks(df, ["note"]).where("block_id = '1-2'"), "block") == [("third",)]
    assert rows(notes.edges(df, ["note"]), "dst_note", "dst_block") == [("root", "1-2")]
    assert ("1-2", "1-2") in rows(notes.block_links(df, ["note"]), "block_id", "transcluded_id")
    assert rows(notes.extract_block(units, ["note"], "1-1"), "start", "end") == [(9, 10)]


def test_tables(spark):
    s = notes.schedule(one(spark, NOTE), ["note"])
    assert rows(s, "day", "chapter", "vstart", "vend", "well_formed") == [(1, 1, 1, 3, True), (2, 1, 4, 6, False)]
    g = one(spark, "# c\nsrc\ttgt\t1-1, 1-2\na -> b\nx | y")
    assert rows(notes.glossary_lines(g, ["note"]), "source", "target") == [("a", "b"), ("src", "tgt"), ("x", "y")]
    k = one(spark, "## key\n\n| rendering | freq |\n|---|---|\n| x | 3 |\n| y | 5 |")
    assert notes.consolidated(notes.keyword_tables(k, ["note"]), ["note"]).first()["renderings"] == [("y", 5), ("x", 3)]
    gloss = one(spark, "\\gla a b\n\\glb c d\n\\glc e f")
    assert rows(notes.gloss_tokens(gloss, ["note"]), "pos", "a", "b", "c") == [(0, "a", "c", "e"), (1, "b", "d", "f")]


def test_trees_and_claims(spark):
    t = notes.toc(one(spark, "* 1 One [[3]]\n   * 1.1 Sub [[?]]\n* bad"), ["note"])
    assert rows(t.where("node_id is not null"), "node_id", "parent_id", "pointer") == [("1", None, 3), ("1.1", "1", None)]
    c = notes.claims(one(spark, "## c-1-1\nquote: abc\ncite: b1\nreferent: X\n## c-1-2\nquote: d"), ["note"])
    assert rows(c, "claim_id", "quote", "cite", "referent")[0] == ("c-1-1", "abc", "b1", "X")


def test_json_and_ledger(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"meta": {"a": 1}, "items": [{"k": 1, "t": "x"}, {"k": 2, "t": "y"}], "few": [{"z": 0}]}')
    assert rows(notes.json_items(spark, str(tmp_path / "d.json")), "k", "t") == [(1, "x"), (2, "y")]
    log = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "id string, seq int, v string")
    assert rows(notes.latest(log, ["id"], "seq"), "id", "v") == [("a", "new"), ("b", "only")]
    items = spark.createDataFrame([(str(i % 3), str(i)) for i in range(30)], "ch string, other string")
    assert notes.chapter_field(items, ["ch", "other"]).first()["field"] == "ch"
    (tmp_path / "m.csv").write_text("field,BO,EN\ntitle,ཀ,K\nauthor,,A\n")
    assert rows(notes.csv_meta(spark, str(tmp_path / "m.csv"))) == [("author", "EN", "A"), ("title", "BO", "ཀ"), ("title", "EN", "K")]


def test_office_files(spark, tmp_path):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Top</w:t></w:r></w:p><w:p><w:r><w:t>a </w:t></w:r><w:r><w:rPr><w:b/><w:color w:val="FF0000"/></w:rPr><w:t>bold</w:t></w:r></w:p></w:body></w:document>')
    runs = notes.docx_runs(spark, str(tmp_path / "a.docx"))
    assert rows(runs, "paragraph", "text", "bold", "start", "end") == [(0, "Top", False, 0, 3), (1, "a ", False, 0, 2), (1, "bold", True, 2, 6)]
    assert rows(notes.docx_markdown(runs), "line") == [("# Top",), ("a **bold**",)]
    with zipfile.ZipFile(tmp_path / "b.epub", "w") as z:
        z.writestr("t.xhtml", '<html xmlns="http://www.w3.org/1999/xhtml"><body><p class="v">one <span class="r">two</span><span class="r"> three</span></p></body></html>')
    got = notes.epub_runs(spark, str(tmp_path / "b.epub"))
    assert rows(got, "run", "role", "text") == [(0, "v", "one"), (1, "r", "two three")]
    assert rows(notes.mixed_class_paragraphs(got), "class", "role", "n") == [("v", "r", 1)]


def test_wiki(spark):
    p = spark.createDataFrame([("w", 1, "a\n== H ==\nb"), ("w", 2, "=== S ===")], "w string, page int, text string")
    assert rows(notes.wiki_stream(p, "w", "page"), "offset", "depth", "label") == [(2, 2, "H"), (12, 3, "S")]
    o = one(spark, "== A ==\n* '''B''' x\n1. C\nplain")
    assert rows(notes.outline_candidates(o, ["note"]), "line_no", "kind", "depth") == [(1, "heading", 2), (2, "bold", 1), (3, "numbered", 1)]


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([("1-1", "a", "b", "")], "block_id string, source_text string, target_text string, notes string")
    sinks.aligned_csv(a, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 1
    text = one(spark, NOTE).select(notes.patched("text", {"title": "B", "new": "c"}).alias("t")).first()["t"]
    assert "title: B\n" in text and "new: c\n---" in text and "claim_count: 2" in text
    t = spark.createDataFrame([(["f", "g"], "r1", ["1"]), (["f"], "r2", ["2"])], "forms array<string>, rendering string, verse_ids array<string>")
    assert rows(sinks.termbase_tsv(t)) == [("f\tr1\t1",), ("f\tr2\t2",), ("g\tr1",)]
    assert dict(rows(sinks.termbase_table(t)))["f"] == "r1 (1); r2 (2)"
    s = spark.createDataFrame([("e", "1-1", "verse", 0, 2, "ab"), ("e", "1-1", "verse", 3, 5, "cd")], "e string, ref string, type string, start int, end int, line string")
    assert '"content":"ab\\ncd"' in sinks.edition_payload(s, "e").first()["payload"]


def test_streams(spark, tmp_path):
    schema = "channel string, id long, author string, ts timestamp"
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = spark.createDataFrame([("c", 1, "A", 600), ("c", 2, "A", 1200), ("c", 3, "B", 1210), ("c", 2, "A", 1200)], "channel string, id long, author string, s long").selectExpr("channel", "id", "author", "timestamp_seconds(1700000400 + s) as ts")
    data.coalesce(1).write.parquet(src)
    stream = feed.messages(spark, src, schema)
    q = feed.stitched(feed.deduplicated(stream, "id", "ts")).writeStream.format("memory").queryName("units").outputMode("append").option("checkpointLocation", str(tmp_path / "ck1")).start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("units"), "id", "unit") == [(1, 1), (2, 1), (3, 2)]
    for n in (1, 2):  # a second run with a new checkpoint reads all again and adds nothing
        feed.into_ledger(feed.messages(spark, src, schema), out, "id", str(tmp_path / f"ck{n + 1}")).awaitTermination()
        assert spark.read.parquet(out).count() == 3
    marks = feed.last_ids(spark.read.parquet(out), "channel", "id")
    assert feed.after(data, marks, "channel", "id").count() == 0
    assert feed.pending(data, spark.read.parquet(out).where("id < 3"), "id").count() == 1
    counts = feed.windowed_counts(feed.messages(spark, src, schema), "ts", ["channel"], "10 minutes")
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.table("counts").collect()) == [1, 3]
