"""Word-processor and book files as DataFrames: parts of a file are read in its task, all numbering and layout is done on columns.

Every scan takes ``files`` with ``path`` and ``content``: what `files` reads
from a folder, or any table that holds the bytes. A file that can't be read
gives one row whose ``error`` says why, and no other row.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.entities import html5
from html.parser import HTMLParser
from pathlib import PurePosixPath
from urllib.parse import unquote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as K
from pyspark.sql.pandas.types import to_arrow_schema


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


#: Rows that go to Spark at once: a small file's would each cost a batch of their own.
BATCH = 5000


def _scan(source: DataFrame, read: Callable[[zipfile.ZipFile], Iterator[tuple]], schema: str) -> DataFrame:
    names = K.StructType.fromDDL(schema).names
    shape = to_arrow_schema(K.StructType.fromDDL(f"path string, error string, {schema}"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = len(found)
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        found += [(path, None, *r) for r in read(z)]
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, UnicodeDecodeError, ValueError) as e:
                    found[start:] = [(path, f"{type(e).__name__}: {e}", *[None] * len(names))]
                if len(found) >= BATCH:
                    yield framed(found)
                    found = []
        if found:
            yield framed(found)

    def framed(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), shape, strict=True)], schema=shape)

    return source.select("path", "content").mapInArrow(rows, f"path string, error string, {schema}")


# word-processor files

_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: What the format says of a level without properties of its own: number format, pattern, first number.
_PLAIN_LEVEL = ("decimal", "%1.", 1)
#: The format has nine levels.
LEVELS = 9


def _of(e, path: str, default=None):
    """The value of a property below an element."""
    at = None if e is None else e.find("/".join(_WORD + p for p in path.split("/")))
    return default if at is None else at.get(f"{_WORD}val", default)


def _lists(z: zipfile.ZipFile) -> dict[str, dict[int, tuple[str, str, int]]]:
    """Format, pattern and first number of each level of each list."""
    if "word/numbering.xml" not in z.namelist():
        return {}
    root = ElementTree.fromstring(z.read("word/numbering.xml"))
    kinds, lists = {}, {}
    for a in root.iterfind(f"{_WORD}abstractNum"):
        kinds[a.get(f"{_WORD}abstractNumId")] = {int(e.get(f"{_WORD}ilvl", 0)): (_of(e, "numFmt", "decimal"), _of(e, "lvlText", "%1."), int(_of(e, "start", 1))) for e in a.iterfind(f"{_WORD}lvl")}
    for n in root.iterfind(f"{_WORD}num"):
        levels = dict(kinds.get(_of(n, "abstractNumId"), {}))
        for o in n.iterfind(f"{_WORD}lvlOverride"):
            level, start = int(o.get(f"{_WORD}ilvl", 0)), _of(o, "startOverride")
            if start is not None:
                levels[level] = (*levels.get(level, _PLAIN_LEVEL)[:2], int(start))
        lists[n.get(f"{_WORD}numId")] = levels
    return lists


def _run(r) -> dict:
    text, refs = [], []
    for e in r.iter():
        match e.tag.removeprefix(_WORD):
            case "t":
                text.append(e.text or "")
            case "tab":
                text.append("\t")
            case "br" | "cr":
                text.append("\n")
            case "footnoteReference":
                refs.append(e.get(f"{_WORD}id"))
    marks = r.find(f"{_WORD}rPr")
    return {"text": "".join(text), "bold": marks is not None and marks.find(f"{_WORD}b") is not None, "highlight": _of(marks, "highlight", "none") != "none", "notes": refs}


def _paragraphs(z: zipfile.ZipFile) -> Iterator[tuple]:
    lists, root = _lists(z), ElementTree.fromstring(z.read("word/document.xml"))
    for n, p in enumerate(root.iter(f"{_WORD}p")):
        number, level = _of(p, "pPr/numPr/numId"), int(_of(p, "pPr/numPr/ilvl", 0))
        known = lists.get(number, {})
        levels = [known.get(i, _PLAIN_LEVEL) for i in range(level + 1)]
        yield n, _of(p, "pPr/pStyle"), number, level, [f for f, _, _ in levels], [s for _, _, s in levels], levels[-1][1], [_run(r) for r in p.iter(f"{_WORD}r")]


def word_paragraphs(source: DataFrame) -> DataFrame:
    """Paragraphs of word-processor files: style, list and level, what the levels above say of numbers, and runs."""
    return _scan(source, _paragraphs, "paragraph int, style string, num_id string, level int, formats array<string>, starts array<int>, pattern string, runs array<struct<text:string,bold:boolean,highlight:boolean,notes:array<string>>>")


def _notes(z: zipfile.ZipFile) -> Iterator[tuple]:
    for kind in ("footnote", "endnote", "comment"):
        name = f"word/{kind}s.xml"
        for e in ElementTree.fromstring(z.read(name)).iterfind(f"{_WORD}{kind}") if name in z.namelist() else ():
            text = " ".join("".join(t.text or "" for t in e.iter(f"{_WORD}t")).split())
            if text and e.get(f"{_WORD}type") not in ("separator", "continuationSeparator"):
                yield kind, e.get(f"{_WORD}id"), text


def word_notes(source: DataFrame) -> DataFrame:
    """Footnotes, endnotes and comments of word-processor files."""
    return _scan(source, _notes, "kind string, note_id string, text string")


def numeral(n: Column, form: Column) -> Column:
    """A number as a list shows it: by digits, letters (z, aa), Roman, or not at all (bullets)."""
    letters = F.aggregate(F.sequence(F.lit(1), F.lit(7)), F.struct(n.alias("n"), F.lit("").alias("s")),
        lambda a, _: F.when(a["n"] > 0, F.struct(F.floor((a["n"] - 1) / 26).cast("int").alias("n"), F.concat(F.char(97 + (a["n"] - 1) % 26), a["s"]).alias("s"))).otherwise(a), lambda a: a["s"])

    def digit(one: str, five: str, ten: str, at: int) -> Column:
        shown = ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten]
        return F.get(F.array(*map(F.lit, shown)), F.floor(n / at).cast("int") % 10)

    roman = F.concat(F.repeat(F.lit("m"), F.floor(n / 1000).cast("int")), digit("c", "d", "m", 100), digit("x", "l", "c", 10), digit("i", "v", "x", 1))
    return (F.when(form == "lowerLetter", letters).when(form == "upperLetter", F.upper(letters)).when(form == "lowerRoman", roman).when(form == "upperRoman", F.upper(roman))
            .when(form.isin("bullet", "none"), "").otherwise(n.cast("string")))


def numbered(paragraphs: DataFrame) -> DataFrame:
    """Paragraphs with the ``label`` that their list shows and its numbers as ``fragment``; null outside lists.

    A level counts on until a paragraph of a level above it; one that hasn't
    come yet shows its first number. Paragraphs without text count too.
    """
    so_far = W.partitionBy("path", "num_id").orderBy("paragraph").rowsBetween(W.unboundedPreceding, 0)
    rows = paragraphs.withColumns({f"_seen{i}": F.count_if(F.col("level") == i).over(so_far) for i in range(LEVELS)})
    rows = rows.withColumns({f"_left{i}": F.coalesce(F.max(F.when(F.col("level") < i, F.col(f"_seen{i}"))).over(so_far), F.lit(0)) for i in range(LEVELS)})
    counts = [F.get("starts", F.lit(i)) + F.greatest(F.col(f"_seen{i}") - F.col(f"_left{i}") - 1, F.lit(0)).cast("int") for i in range(LEVELS)]
    rows = rows.withColumn("_shown", F.zip_with(F.slice(F.array(*counts), F.lit(1), F.col("level") + 1), "formats", numeral))
    label = F.col("pattern")
    for i in range(LEVELS):
        sign = F.lit(f"%{i + 1}")
        label = F.replace(label, sign, F.coalesce(F.get("_shown", F.lit(i)), sign))
    listed = F.col("num_id").isNotNull()
    rows = rows.withColumns({"label": F.when(listed, label), "fragment": F.when(listed, F.array_join(F.filter("_shown", lambda s: s != ""), "-"))})
    return rows.drop("_shown", *(f"_{c}{i}" for c in ("seen", "left") for i in range(LEVELS)))


_EDGES = r"(?U)^\s+|\s+$"


def word_markdown(paragraphs: DataFrame, noted: DataFrame) -> DataFrame:
    """Word-processor files as Markdown lines ``(path, part, pos, line, blank_before)``: paragraphs, then the footnotes referred to, in order.

    Paragraphs of lists show their number and have it as a block id; highlighted
    runs stand in equal signs; blank paragraphs are told by ``blank_before``.
    """
    def shown(r: Column) -> Column:
        marked = F.when(r["highlight"] & (F.regexp_replace(r["text"], r"(?U)\s+", "") != ""), F.regexp_replace(r["text"], r"(?Us)^(\s*)(.*?)(\s*)$", "$1==$2==$3")).otherwise(r["text"])
        return F.concat(marked, F.array_join(F.transform(r["notes"], lambda n: F.concat(F.lit("[^"), n, F.lit("]"))), ""))

    body = numbered(paragraphs.where("error is null"))
    text = F.regexp_replace(F.array_join(F.transform("runs", shown), ""), _EDGES, "")
    body = body.withColumn("_text", text)
    line = F.when(F.col("label").isNull(), F.col("_text")).otherwise(F.concat(F.repeat(F.lit("    "), F.col("level")), "label", F.when(F.col("_text") != "", F.concat(F.lit(" "), "_text")).otherwise(""), F.lit(" ^s"), "fragment"))
    lines = body.select("path", F.lit(0).alias("part"), F.col("paragraph").alias("pos"), line.alias("line")).where("line <> ''")
    last = F.lag("pos").over(W.partitionBy("path").orderBy("pos"))
    lines = lines.withColumn("blank_before", F.coalesce(F.col("pos") - last > 1, F.lit(False)))
    used = paragraphs.where("error is null").select("path", "paragraph", F.posexplode(F.flatten(F.col("runs.notes"))).alias("at", "note_id"))
    used = used.groupBy("path", "note_id").agg(F.min(F.struct("paragraph", "at")).alias("first"))
    used = used.join(noted.where("kind = 'footnote'").select("path", "note_id", "text"), ["path", "note_id"])
    used = used.withColumn("pos", F.row_number().over(W.partitionBy("path").orderBy("first")))
    return lines.union(used.select("path", F.lit(1), "pos", F.concat(F.lit("[^"), "note_id", F.lit("]: "), "text"), F.col("pos") == 1))


def joined(lines: DataFrame) -> DataFrame:
    """One text a file of `word_markdown`'s lines."""
    row = F.struct("part", "pos", F.concat(F.when(F.col("blank_before"), "\n").otherwise(""), "line", F.lit("\n")).alias("s"))
    return lines.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["s"]), "").alias("text"))


# books

#: Characters of layout inside words (soft hyphen, zero-width space and joiner).
_UNSEEN = dict.fromkeys((0x00AD, 0x200B, 0x200D))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Lenient(HTMLParser):
    """A tree of a page that is no well-formed XML: what is left open is closed where something around it ends."""

    def __init__(self, page: str):
        super().__init__()
        self.tree, self.open = ElementTree.TreeBuilder(), ["html"]
        self.tree.start("html", {})
        self.feed(page)
        self.close()
        for tag in reversed(self.open):
            self.tree.end(tag)

    def handle_starttag(self, tag, attrs):
        self.tree.start(tag, {k: v or "" for k, v in attrs})
        if tag in _VOID:
            self.tree.end(tag)
        else:
            self.open.append(tag)

    def handle_endtag(self, tag):
        while tag in self.open[1:]:
            last = self.open.pop()
            self.tree.end(last)
            if last == tag:
                return

    def handle_data(self, data):
        self.tree.data(data)


def page_tree(content: bytes):
    """The root element of a page. Named references of HTML are understood, and pages that are no XML are read as HTML."""
    page = content.decode("utf-8", "replace")
    known = re.sub(r"&(\w+;)", lambda m: m[0] if m[1] in ("amp;", "lt;", "gt;", "quot;", "apos;") else html5.get(m[1], m[0]), page)
    try:
        return ElementTree.fromstring(re.sub(r"<!DOCTYPE[^>]*>", "", known).encode())
    except ElementTree.ParseError:
        return _Lenient(page).tree.close()


def package(z: zipfile.ZipFile):
    """The root of a book's package file and its folder, or nothing where there is none."""
    name = None
    if "META-INF/container.xml" in z.namelist():
        found = ElementTree.fromstring(z.read("META-INF/container.xml")).find(".//{*}rootfile")
        name = None if found is None else found.get("full-path")
    name = name or min((n for n in z.namelist() if n.endswith(".opf")), default=None)
    return (None, PurePosixPath()) if name is None else (ElementTree.fromstring(z.read(name)), PurePosixPath(name).parent)


def reading_order(z: zipfile.ZipFile) -> list[str]:
    """The pages of a book as its spine has them; pages outside it, or all where there is none, follow by name."""
    root, folder = package(z)
    pages = sorted(n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")))
    if root is None:
        return pages
    named = {e.get("id"): str(folder / unquote(e.get("href", ""))) for e in root.iterfind(".//{*}manifest/{*}item")}
    spine = [named.get(e.get("idref")) for e in root.iterfind(".//{*}spine/{*}itemref")]
    return list(dict.fromkeys(n for n in [*spine, *pages] if n in pages))


def _tag(e) -> str:
    return str(e.tag).rpartition("}")[2]


def _classes(e) -> list[str]:
    return (e.get("class") or "").split()


def _has(e, *names: str) -> bool:
    return not set(names).isdisjoint(_classes(e))


def _words(s: str) -> str:
    return " ".join(s.translate(_UNSEEN).split())


def _plain(e) -> str:
    return _words("".join(e.itertext()))


_MARK = {"em": "*", "i": "*", "b": "**", "strong": "**"}


def _around(mark: str, s: str) -> str:
    return re.sub(r"(?s)^(\s*)(\S.*?)(\s*)$", lambda m: f"{m[1]}{mark}{m[2]}{mark}{m[3]}", s)


def _inline(e, slanted: bool = False) -> str:
    """What stands inside an element, with Markdown for emphasis, links, notes and hard breaks."""
    out = [e.text or ""]
    for c in e:
        tag = _tag(c)
        if tag == "br":
            out.append("  \n")
        elif tag == "a" and _has(c, "endnote-ref"):
            out.append(f"[^{_plain(c)}]")
        elif not _has(c, "inline-label", "passage-label") and not (tag == "a" and _has(c, "note-back")):
            mark = "" if slanted and _MARK.get(tag) == "*" else _MARK.get(tag, "")
            inside = _around(mark, _inline(c, slanted or mark == "*"))
            target = c.get("href", "") if tag == "a" and not _has(c, "glossary-link") else ""
            if tag == "sup":
                inside = f"<sup>{inside}</sup>"
            elif target.startswith("http"):
                inside = inside.strip() and f"[{inside.strip()}]({target.replace('(', '%28').replace(')', '%29').replace(' ', '%20')})"
            out.append(inside)
        out.append(c.tail or "")
    return "".join(out)


def _line(e) -> str:
    return "  \n".join(_words(s) for s in _inline(e).split("  \n"))


def _lines(e) -> list[str]:
    """The lines of a container: of a group of verses its children, of nested blocks theirs."""
    if _tag(e) == "span" and _has(e, "inline-label"):
        return []
    if _tag(e) == "div" and _has(e, "verse-group"):
        return [_line(c) for c in e]
    if _tag(e) == "div" and any(_tag(c) in ("p", "div") for c in e):
        return [s for c in e for s in _lines(c)]
    return [_line(e)]


def _child(e, name: str):
    return next((c for c in e if _has(c, name)), None)


def _passage(e) -> tuple:
    content, gutter = _child(e, "passage-content"), _child(e, "passage-gutter")
    label = "" if gutter is None else _plain(gutter)
    label = label or next((_plain(s) for s in content.iter() if _tag(s) == "span" and _has(s, "inline-label")), "")
    if len(content) and all(_tag(c) == "h5" for c in content):
        return "title", label, None, [" ".join(_line(c) for c in content)], []
    lines = []
    for c in content:
        if _tag(c) == "blockquote" and not any(_tag(s) in ("div", "p") for s in c):
            lines.append(_line(c))
        else:
            lines += [s for b in (c if _tag(c) == "blockquote" else [c]) for s in _lines(b)]
    return "quote" if any(_tag(c) == "blockquote" for c in content) else "passage", label, None, [s for s in lines if s.strip()], []


def _gloss(e) -> tuple:
    term, fields, told = "", {}, []
    for c in _child(e, "passage-content"):
        if _has(c, "gloss-term"):
            term = _line(c)
        elif _has(c, "gloss-def"):
            told += [_line(p) for p in c if _tag(p) == "p"]
        else:
            fields |= {k.removeprefix("gloss-"): _line(c) for k in _classes(c) if k.startswith("gloss-")}
    return "gloss", term, None, told, [f"{k.capitalize()}: {v}" for k, v in fields.items() if v]


def _endnote(e) -> tuple:
    back = _child(e, "note-back")
    return "endnote", "" if back is None else _plain(back).rstrip("."), None, [_line(e)], []


def _parts(e) -> Iterator[tuple]:
    """The parts of a body in order; sections are opened, and what has no rule is a line of its own."""
    for c in e:
        if _has(c, "section-heading") and _tag(c).startswith("h"):
            yield "heading", c.get("data-bm", ""), int(c.get("data-bm-level") or 1), [_plain(c)], []
        elif _tag(c) == "section":
            yield from _parts(c)
        elif _tag(c) == "div" and _has(c, "passage") and _child(c, "passage-content") is not None:
            yield _gloss(c) if _has(c, "gloss-entry") else _passage(c)
        elif _tag(c) == "div" and _has(c, "endnote"):
            yield _endnote(c)
        elif _tag(c) == "div" and _has(c, "bibl-entry"):
            yield "bibliography", "", None, [" ".join(_line(p) for p in c if _tag(p) == "p")], []
        elif not _has(c, "passage") and _plain(c):
            yield "other", "", None, [_line(c)], []


def _book(z: zipfile.ZipFile) -> Iterator[tuple]:
    for n, name in enumerate(reading_order(z)):
        body = page_tree(z.read(name)).find(".//{*}body")
        for at, part in enumerate(() if body is None else _parts(body)):
            yield n, name, at, *part


def book_parts(source: DataFrame) -> DataFrame:
    """Parts of books in reading order: headings, titles, passages, quotes, glossary entries, notes, references, other lines."""
    return _scan(source, _book, "page int, file string, pos int, kind string, label string, depth int, lines array<string>, fields array<string>")


#: Classes of an imprint's paragraphs and the fields they hold.
_IMPRINT = {"title-tibetan": "title_bo", "imprint-wylie": "title_wylie", "imprint-title-en": "title_en", "imprint-title-sa": "title_sa", "imprint-toh": "toh", "imprint-source": "source_reference", "imprint-names": "translators"}


def _metadata(z: zipfile.ZipFile) -> Iterator[tuple]:
    root, _ = package(z)
    for e in () if root is None else root.iterfind("{*}metadata/*"):
        field = {"dcterms:modified": "modified"}.get(e.get("property")) if _tag(e) == "meta" else _tag(e)
        if field and _plain(e):
            yield field, _plain(e)
    for name in (n for n in z.namelist() if PurePosixPath(n).name == "imprint.xhtml"):
        for p in page_tree(z.read(name)).iter():
            for field in (_IMPRINT[c] for c in _classes(p) if c in _IMPRINT) if _tag(p) == "p" else ():
                text = _words(p.text or "") if field == "source_reference" else _plain(p)
                if field == "toh":
                    number = re.search(r"Toh\s*([\w\-]+)", text)
                    text = number[1] if number else text.strip("· ")
                for value in text.split("·") if field == "translators" else [text]:
                    if value.strip():
                        yield field, value.strip()


def book_metadata(source: DataFrame) -> DataFrame:
    """Fields of books, one row a value: those of the package file and of the imprint."""
    return _scan(source, _metadata, "field string, value string")


def _slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "[^0-9A-Za-z]+", "-"), "^-|-$", "")


def book_blocks(parts: DataFrame, labels: bool = False) -> DataFrame:
    """Parts of books as Markdown blocks with ids.

    A heading "1. Name" opens section 1; others, and numbered ones three deep,
    are counted under the last section. Passages are named by their label,
    glossary entries by their number in the book.
    """
    rows = parts.where("error is null")
    so_far = W.partitionBy("path").orderBy("page", "pos").rowsBetween(W.unboundedPreceding, 0)
    heading, short = F.col("kind") == "heading", F.regexp_extract("label", r"(?U)^(\w{1,4})\.\s+.", 1)
    listed = heading & F.rlike(short, F.lit(r"(?U)^\d+$")) & (F.col("depth") >= 3)
    rows = rows.withColumns({"_listed": listed, "_opens": heading & (short != "") & ~listed})
    rows = rows.withColumns({"_section": F.coalesce(F.last(F.when(F.col("_opens"), short), ignorenulls=True).over(so_far), F.lit("section")),
                             "_under": F.count_if(heading & ~F.col("_opens")).over(so_far), "_entry": F.count_if(F.col("kind") == "gloss").over(so_far)})
    rows = rows.withColumn("_under", F.col("_under") - F.coalesce(F.max(F.when(F.col("_opens"), F.col("_under"))).over(so_far), F.lit(0)))
    named = (F.when(F.col("_opens"), F.concat("_section", F.lit("-0"))).when(heading, F.concat_ws("-", "_section", F.col("_under").cast("string"), F.lit("0")))
             .when(F.col("kind") == "title", F.when(F.col("label") == "", "title-0").otherwise(F.concat(F.regexp_replace("label", r"\.+$", ""), F.lit("-0"))))
             .when(F.col("kind") == "gloss", F.concat(F.lit("g-"), F.col("_entry").cast("string")))
             .when(F.col("kind").isin("passage", "quote") & (F.col("label") != ""), F.col("label")))
    rows = rows.withColumn("block_id", _slug(named)).where("kind not in ('passage', 'quote') or size(lines) > 0")
    shown = F.col("lines")
    if labels:
        marked = F.concat(F.array(F.concat(F.lit("**"), "label", F.lit("** "), F.get("lines", F.lit(0)))), F.slice("lines", F.lit(2), F.size("lines")))
        shown = F.when(F.col("kind").isin("passage", "quote") & (F.col("label") != ""), marked).otherwise(shown)
    mark = F.coalesce(F.concat(F.lit(" ^"), "block_id"), F.lit(""))
    level = F.when(F.col("_opens"), 2).when(F.col("_listed"), 3).otherwise(F.least(F.col("depth") + 2, F.lit(6)))
    first = F.get("lines", F.lit(0))
    told = F.when(F.size("lines") > 0, F.concat(F.array(F.lit("")), F.col("lines"))).otherwise(F.array().cast("array<string>"))
    entry = F.array_join(F.concat(F.array(F.concat(F.lit("### "), "label", mark), F.lit("")), F.transform("fields", lambda f: F.concat(F.lit("- "), f)), told), "\n")
    block = (F.when(heading, F.concat(F.repeat(F.lit("#"), level), F.lit(" "), first, mark)).when(F.col("kind") == "title", F.concat(F.lit("### "), first, mark))
             .when(F.col("kind") == "quote", F.concat(F.array_join(F.transform(shown, lambda s: F.concat(F.lit("> "), s)), "\n"), F.coalesce(F.concat(F.lit("\n\n^"), "block_id"), F.lit(""))))
             .when(F.col("kind") == "endnote", F.concat(F.lit("[^"), "label", F.lit("]: "), first)).when(F.col("kind") == "bibliography", F.concat(F.lit("- "), first))
             .when(F.col("kind") == "gloss", entry).otherwise(F.concat(F.array_join(shown, "  \n"), mark)))
    return rows.select("path", "file", "page", "pos", "kind", "block_id", block.alias("block"))


def book_findings(blocks: DataFrame) -> DataFrame:
    """What is wrong in the blocks of books: ids used twice, notes without a reference and references without a note."""
    twice = blocks.where("block_id is not null").groupBy("path", "block_id").count().where("count > 1").select("path", F.lit("repeated_id").alias("check"), F.col("block_id").alias("entity"))
    refs = blocks.where("kind <> 'endnote'").select("path", F.explode(F.array_distinct(F.regexp_extract_all("block", F.lit(r"\[\^([^\]]+)\]"), F.lit(1)))).alias("entity")).distinct().withColumn("_ref", F.lit(True))
    held = blocks.where("kind = 'endnote'").select("path", F.regexp_extract("block", r"^\[\^([^\]]*)\]", 1).alias("entity")).distinct().withColumn("_held", F.lit(True))
    lone = refs.join(held, ["path", "entity"], "full").where("_ref is null or _held is null")
    return twice.union(lone.select("path", F.when(F.col("_ref").isNull(), "note_without_reference").otherwise("reference_without_note"), "entity"))
