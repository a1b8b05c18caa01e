"""Queries that make a word-processor file or a book of each row of a table, and read all of them."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from lectern.plans.base import Listing, table
from lectern.plans.planted import PART
from lectern.sources import books
from lectern.sources.stage import staged

L = Listing()
_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def packed(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in files.items():
            z.writestr(name, content)
    return out.getvalue()


def paragraph(text: str, level: int | None = None, number: str = "1", marks: str = "", note: str = "") -> str:
    listed = "" if level is None else f'<w:pPr><w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="{number}"/></w:numPr></w:pPr>'
    ref = f'<w:r><w:footnoteReference w:id="{note}"/></w:r>' if note else ""
    return f"<w:p>{listed}<w:r><w:rPr>{marks}</w:rPr><w:t>{text}</w:t></w:r>{ref}</w:p>"


def word_file(body: str, levels: list[tuple[str, str, int]], notes: dict[str, str], override: int | None = None) -> bytes:
    """A file with one list, whose levels have a format, a pattern and a first number, and its footnotes."""
    told = "".join(f'<w:lvl w:ilvl="{i}"><w:start w:val="{s}"/><w:numFmt w:val="{f}"/><w:lvlText w:val="{t}"/></w:lvl>' for i, (f, t, s) in enumerate(levels))
    start = "" if override is None else f'<w:lvlOverride w:ilvl="0"><w:startOverride w:val="{override}"/></w:lvlOverride>'
    return packed({
        "word/document.xml": f'<w:document xmlns:w="{_W}"><w:body>{body}</w:body></w:document>',
        "word/numbering.xml": f'<w:numbering xmlns:w="{_W}"><w:abstractNum w:abstractNumId="7">{told}</w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="7"/>{start}</w:num></w:numbering>',
        "word/footnotes.xml": f'<w:footnotes xmlns:w="{_W}"><w:footnote w:id="0" w:type="separator"><w:p><w:r><w:t>-</w:t></w:r></w:p></w:footnote>' + "".join(f'<w:footnote w:id="{i}"><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:footnote>' for i, t in notes.items()) + "</w:footnotes>",
    })


def _files(spark, sf_dir, make):
    """``path`` and ``content`` of a file for each part: ``make`` of its key, name, type and size."""
    def made(k: pd.Series, name: pd.Series, kind: pd.Series, size: pd.Series) -> pd.Series:
        return pd.Series([make(*r) for r in zip(k, name, kind, size, strict=True)], dtype=object)
    made.__annotations__ = dict.fromkeys(("k", "name", "kind", "size", "return"), pd.Series)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), F.pandas_udf(made, "binary")("p_partkey", "p_name", "p_type", "p_size").alias("content"))


def _listed(k, name, kind, size) -> bytes:
    """A line; ``size``. with k mod 4 + 1 lettered items; the next number, highlighted, with a note; a lettered item anew; a blank; a line with the other note."""
    body = [paragraph(name), paragraph(kind, 0), *(paragraph(f"{name} {i}", 1) for i in range(k % 4 + 1)),
            paragraph(kind, 0, marks='<w:highlight w:val="yellow"/>', note="5"), paragraph("", 1), paragraph(""), paragraph("end", note="2")]
    return word_file("".join(body), [("decimal", "%1.", 1), ("lowerLetter", "%1.%2)", 1)], {"2": f"two of {kind}", "5": f"five of {name}"}, override=size)


@L.add("A32 A33", f"""with {PART}, n as (select *, k % 4 + 1 as items from p) select k || '' as path, part, pos, line, blank_before from (
select k, 0 as part, 0 as pos, name as line, false as blank_before from n union all
select k, 0, 1, size || '. ' || kind || ' ^s' || size, false from n union all
select k, 0, 2 + i, '    ' || size || '.' || chr((97 + i)::int) || ') ' || name || ' ' || i || ' ^s' || size || '-' || chr((97 + i)::int), false from n, unnest(range(items)) t(i) union all
select k, 0, 2 + items, (size + 1) || '. ==' || kind || '==[^5] ^s' || (size + 1), false from n union all
select k, 0, 3 + items, '    ' || (size + 1) || '.a) ^s' || (size + 1) || '-a', false from n union all
select k, 0, 5 + items, 'end[^2]', true from n union all
select k, 1, 1, '[^5]: five of ' || name, true from n union all
select k, 1, 2, '[^2]: two of ' || kind, false from n)""")
def r_word_lists(spark, sf_dir):
    """Numbered paragraphs, highlights and footnotes of a word-processor file a part."""
    files = _files(spark, sf_dir, _listed)
    return books.word_markdown(staged(books.word_paragraphs(files)), books.word_notes(files))


def _page(body: str) -> str:
    return f'<!DOCTYPE html><html xmlns="http://www.w3.org/1999/xhtml"><body>{body}</body></html>'


def passage(label: str, content: str, more: str = "") -> str:
    return f'<div class="passage{more}"><div class="passage-gutter">{label}</div><div class="passage-content">{content}</div></div>'


def _volume(k, name, kind, size) -> bytes:
    """Two pages, the second by name the first of the spine; every seventh is no XML."""
    first = (f'<section><h2 class="section-heading" data-bm="{size}. {kind}" data-bm-level="1">{kind}</h2>'
             + passage(f"{size}.1", f'<p>of&nbsp;<em>{name}</em><a class="endnote-ref" href="#n">1</a></p><p>in <b>{kind}</b></p>')
             + passage(f"{size}.2", f"<blockquote><p>{name}</p><p>again</p></blockquote>")
             + '<h3 class="section-heading" data-bm="" data-bm-level="2">More</h3></section>' + ("<p>open <br>" if k % 7 == 0 else ""))
    second = (passage("", f'<div class="gloss-term">{name}</div><div class="gloss-wylie">{kind}</div><div class="gloss-def"><p>size {size}</p></div>', " gloss-entry")
              + f'<div class="endnote"><a class="note-back" href="#r">1.</a> see {kind}</div><div class="bibl-entry"><p>{name}.</p><p>{size}</p></div>')
    package = (f'<package xmlns="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata><dc:title>{name}</dc:title><dc:language>en</dc:language>'
               '<meta property="dcterms:modified">2020-01-01</meta></metadata><manifest><item id="x" href="text/b.xhtml"/><item id="y" href="text/a.xhtml"/></manifest><spine><itemref idref="x"/><itemref idref="y"/></spine></package>')
    return packed({"META-INF/container.xml": '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="o/content.opf"/></rootfiles></container>',
                   "o/content.opf": package, "o/text/a.xhtml": _page(second), "o/text/b.xhtml": _page(first),
                   "o/text/imprint.xhtml": _page(f'<p class="imprint-toh">Toh {size}-a · x</p><p class="imprint-names">{kind} · {name}</p>')})


_N = "chr(10)"


@L.add("A34 A35", f"""with {PART} select k || '' as path, page, pos, kind, block_id, block from (
select k, 0 as page, 0 as pos, 'heading' as kind, size || '-0' as block_id, '## ' || kind || ' ^' || size || '-0' as block from p union all
select k, 0, 1, 'passage', size || '-1', 'of *' || name || '*[^1]  ' || {_N} || 'in **' || kind || '** ^' || size || '-1' from p union all
select k, 0, 2, 'quote', size || '-2', '> ' || name || {_N} || '> again' || {_N} || {_N} || '^' || size || '-2' from p union all
select k, 0, 3, 'heading', size || '-1-0', '#### More ^' || size || '-1-0' from p union all
select k, 0, 4, 'other', null, 'open  ' || {_N} from p where k % 7 = 0 union all
select k, 1, 0, 'gloss', 'g-1', '### ' || name || ' ^g-1' || {_N} || {_N} || '- Wylie: ' || kind || {_N} || {_N} || 'size ' || size from p union all
select k, 1, 1, 'endnote', null, '[^1]: see ' || kind from p union all
select k, 1, 2, 'bibliography', null, '- ' || name || '. ' || size from p)""")
def r_book_blocks(spark, sf_dir):
    """Blocks of a book a part, in the order of its spine, with ids."""
    blocks = books.book_blocks(books.book_parts(_files(spark, sf_dir, _volume)))
    return blocks.where(~F.col("file").endswith("imprint.xhtml")).drop("file")


@L.add("A34", f"""with {PART} select k || '' as path, field, value from (
select k, 'title' as field, name as value from p union all select k, 'language', 'en' from p union all select k, 'modified', '2020-01-01' from p union all
select k, 'toh', size || '-a' from p union all select k, 'translators', kind from p union all select k, 'translators', name from p)""")
def r_book_metadata(spark, sf_dir):
    return books.book_metadata(_files(spark, sf_dir, _volume)).drop("error")
