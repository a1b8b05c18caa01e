"""Word-processor and book files: numbers of lists against plain counters, orders, odd pages."""

from __future__ import annotations

import random

from lectern.plans import office
from lectern.sources import books

FORMATS = ("decimal", "lowerLetter", "upperLetter", "lowerRoman", "upperRoman", "bullet")


def files(spark, contents):
    return spark.createDataFrame([(str(i), bytearray(c) if c is not None else None) for i, c in enumerate(contents)], "path string, content binary")


def plain_numeral(n, form):
    if "Letter" in form:
        out = ""
        while n:
            n, r = divmod(n - 1, 26)
            out = chr(97 + r) + out
    elif "Roman" in form:
        out = ""
        for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split(), strict=True):
            out += sign * (n // value)
            n %= value
    else:
        return "" if form == "bullet" else str(n)
    return out.upper() if form.startswith("upper") else out


def plain_labels(rows, levels):
    """Labels of ``(list, level)`` by counters that are thrown away when a level above them counts on."""
    counts, out = {}, []
    for number, level in rows:
        if number is None:
            out.append(None)
            continue
        mine = counts.setdefault(number, {})
        mine[level] = mine.get(level, levels[level][2] - 1) + 1
        for deeper in [i for i in mine if i > level]:
            del mine[deeper]
        text = levels[level][1]
        for i in range(level + 1):
            text = text.replace(f"%{i + 1}", plain_numeral(mine.get(i, levels[i][2]), levels[i][0]))
        out.append(text)
    return out


def test_numbers_of_lists(spark):
    rng, contents, want = random.Random(5), [], {}
    for n in range(40):
        levels = [(rng.choice(FORMATS), "".join(f"%{j + 1}." for j in range(rng.randint(0, i), i + 1)), rng.choice((1, 1, 3, 26, 49))) for i in range(9)]
        rows = [(rng.choice(("1", "1", "1", None)), rng.choice((0, 0, 1, 1, 2, 5, 8))) for _ in range(rng.randint(0, 60))]
        contents.append(office.word_file("".join(office.paragraph("x", level if number else None) for number, level in rows), levels, {}))
        want[str(n)] = plain_labels(rows, levels)
    got = books.numbered(books.word_paragraphs(files(spark, contents))).select("path", "paragraph", "label").collect()
    found = {p: [None] * len(v) for p, v in want.items()}
    for r in got:
        found[r["path"]][r["paragraph"]] = r["label"]
    assert found == want


def test_lists_without_properties_and_two_lists(spark):
    body = office.paragraph("a", 0, "1") + office.paragraph("b", 0, "9") + office.paragraph("", 1, "9") + office.paragraph("c", 0, "1") + office.paragraph("d", 1, "9")
    lines = books.word_markdown(*(f(files(spark, [office.word_file(body, [("upperRoman", "(%1)", 4)], {})])) for f in (books.word_paragraphs, books.word_notes)))
    assert books.joined(lines).first()["text"] == "(IV) a ^sIV\n1. b ^s1\n    1. ^s1-1\n(V) c ^sV\n    1. d ^s1-2\n"  # without properties every level shows the first number


def test_word_text(spark):
    body = office.paragraph("") + office.paragraph("  one ", marks='<w:highlight w:val="red"/>', note="3") + office.paragraph("") * 3 + office.paragraph("two", note="2") + office.paragraph("3", note="3") + office.paragraph("lost", note="8")
    source = files(spark, [office.word_file(body, [], {"2": "B", "3": "A  a"}), b"no zip", None, office.packed({"x": "y"}), office.word_file("", [], {})])
    paragraphs = books.word_paragraphs(source)
    text = {r["path"]: r["text"] for r in books.joined(books.word_markdown(paragraphs, books.word_notes(source))).collect()}
    assert text == {"0": "==one== [^3]\n\ntwo[^2]\n3[^3]\nlost[^8]\n\n[^3]: A a\n[^2]: B\n"}
    assert sorted(r["path"] for r in paragraphs.where("error is not null").collect()) == ["1", "2", "3"]
    assert books.word_paragraphs(source.limit(0)).count() == 0


def test_numerals(spark):
    rows = [(n, f) for n in (0, 1, 4, 9, 26, 27, 52, 53, 702, 703, 1999, 3888, 4000) for f in FORMATS if n or f == "decimal"]
    df = spark.createDataFrame(rows, "n int, f string").select("n", "f", books.numeral(*(__import__("pyspark").sql.functions.col(c) for c in "nf")).alias("s"))
    assert {(r["n"], r["f"]): r["s"] for r in df.collect()} == {(n, f): plain_numeral(n, f) for n, f in rows}


def page(body):
    return f'<html xmlns="http://www.w3.org/1999/xhtml"><body>{body}</body></html>'


def heading(label, level, title):
    return f'<h3 class="section-heading" data-bm="{label}" data-bm-level="{level}">{title}</h3>'


def test_ids_of_headings_and_passages(spark):
    body = (heading("", 1, "Before") + heading("i. Start", 1, "Start") + heading("1. Part", 3, "Part") + heading("", 2, "Essay") + office.passage("i.7", "<p>a</p>")
            + heading("1. First", 1, "First") + heading("", 9, "Deep") + office.passage("1.", "<h5>Chapter</h5><h5>One</h5>") + office.passage("", "<p>none</p>") + office.passage("1.2", "<p> </p>")
            + office.passage("", '<span class="inline-label">1.3</span><div class="verse-group"><p>v</p><p>w</p></div>'))
    blocks = books.book_blocks(books.book_parts(files(spark, [office.packed({"a.html": page(body)})])))
    assert [r["block"] for r in blocks.orderBy("pos").collect()] == [
        "### Before ^section-1-0", "## Start ^i-0", "### Part ^i-1-0", "#### Essay ^i-2-0", "a ^i-7", "## First ^1-0", "###### Deep ^1-1-0", "### Chapter One ^1-0", "none", "v  \nw ^1-3"]
    assert [(r["check"], r["entity"]) for r in books.book_findings(blocks).collect()] == [("repeated_id", "1-0")]
    labelled = books.book_blocks(books.book_parts(files(spark, [office.packed({"a.html": page(office.passage("i.7", "<p>a</p><p>b</p>"))})])), labels=True)
    assert labelled.first()["block"] == "**i.7** a  \nb ^i-7"


def test_lines_of_pages(spark):
    body = ('<p>a <em>b <i>c</i></em>d<sup>2</sup> <a href="http://x/(y) z"> l </a><a href="#k">k</a><a class="glossary-link" href="http://g">g</a> s­oft &eacute;&mdash;&amp;</p>'
            '<div class="endnote"><a class="note-back">4.</a> text</div><p>ref<a class="endnote-ref">5</a></p>')
    blocks = books.book_blocks(books.book_parts(files(spark, [office.packed({"a.html": page(body)}), office.packed({"b.html": page("<p>x<br>y &lt;z&gt; <b>open</p><p>next</p>")}), b"junk"])))
    got = [r["block"] for r in blocks.orderBy("path", "pos").collect()]
    assert got == ["a *b c*d<sup>2</sup> [l](http://x/%28y%29%20z)kg soft é—&", "[^4]: text", "ref[^5]", "x  \ny <z> **open**", "next"]
    assert sorted((r["check"], r["entity"]) for r in books.book_findings(blocks).collect()) == [("note_without_reference", "4"), ("reference_without_note", "5")]


def test_order_of_pages():
    import io
    import zipfile
    opf = '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="1" href="z%20z.html"/><item id="2" href="a.html"/></manifest><spine><itemref idref="1"/><itemref idref="no"/><itemref idref="2"/><itemref idref="1"/></spine></package>'
    z = zipfile.ZipFile(io.BytesIO(office.packed({"o/c.opf": opf, "o/a.html": "", "o/b.html": "", "o/z z.html": ""})))
    assert books.reading_order(z) == ["o/z z.html", "o/a.html", "o/b.html"]
    assert books.reading_order(zipfile.ZipFile(io.BytesIO(office.packed({"b.html": "", "a.xhtml": "", "c.css": ""})))) == ["a.xhtml", "b.html"]
