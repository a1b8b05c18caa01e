"""Queries on commentaries and day files that are planted in a table's rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import dayfile, roottext, units
from lectern.plans.base import Listing
from lectern.plans.planted import PART, _part

L = Listing()

# Three root lines: two of one stanza, and one that is a block by itself.
_ONE, _TWO, _THREE = "ཀ་ཁ་ག་ང་ཅ་ཆ་ཇ་ཉ་ཏ། །", "ཐ་ད་ན་པ་ཕ་བ་མ་ཙ་ཚ། །", "ཛ་ཝ་ཞ་ཟ་འ་ཡ་ར་ལ་ཤ། །"
_FALSE = "ཧ་ཧ་ཧ་ཧ་ཧ་ཧ། །"
_MANY, _MORE = "ག་" * 30, "ང་" * 30
#: By the key: the blocks of a work, and the units that they make; NAME and KIND stand for the row's.
_WORKS = {
    0: ([("P", f"NAME ནི། {_ONE}{_TWO}ཞེས་ KIND། །")], [("P", "NAME ནི།"), ("V", f"{_ONE}\n{_TWO}"), ("P", "ཞེས་ KIND། །")]),  # a quoted stanza
    1: ([("P", f"NAME ནི། {_ONE}ཞེས་ KIND། །")], [("P", f"NAME ནི། {_ONE}ཞེས་ KIND། །")]),  # one line of it in a gloss
    2: ([("P", f"NAME ནི། {_THREE}ཞེས་ KIND། །")], [("P", "NAME ནི།"), ("V", _THREE), ("P", "ཞེས་ KIND། །")]),  # a line that is a whole block
    3: ([("V", _FALSE + _FALSE), ("P", "NAME། །")], [("P", _FALSE + _FALSE), ("P", "NAME། །")]),  # a stanza that is none
    4: ([("P", "NAME ལ་གསུམ། །"), ("P", "དང་པོ་ནི་ KIND། །")], [("P", "NAME ལ་གསུམ། །དང་པོ་ནི་ KIND། །")]),  # the first of the points announced
    5: ([("P", "NAMEའོ། །"), ("P", "KINDའོ། །")], [("P", "NAMEའོ། །"), ("P", "KINDའོ། །")]),  # nothing asks for the next block
    6: ([("P", "NAMEའོ། །"), ("P", "གང་ལ་ན། KIND། །")], [("P", "NAMEའོ། །གང་ལ་ན། KIND། །")]),  # a question on the sentence before
    7: ([("V", _ONE), ("P", f"{_TWO}KIND། །")], [("V", f"{_ONE}\n{_TWO}"), ("P", "KIND། །")]),  # the rest of a stanza
    8: ([("P", f"{_MANY}NAME ལ་གསུམ། །"), ("P", f"དང་པོ་ནི་ {_MORE}KIND། །")], [("P", f"{_MANY}NAME ལ་གསུམ། །"), ("P", f"དང་པོ་ནི་ {_MORE}KIND། །")]),  # joined it would be too long
    9: ([("H", "# NAME"), ("P", "ན་མོ་NAME། KIND། །")], [("H", "# NAME"), ("P", "ན་མོ་NAME།"), ("P", "KIND། །")]),  # a homage
}


def _sql_units(inline: bool = False) -> str:
    rows = []
    for m, (_, made) in _WORKS.items():
        rows += [f"({m}, {i}, '{kind}', '{text}')" for i, (kind, text) in enumerate(made)]
    return f"with {PART}, u as (select * from (values {', '.join(rows)}) as t(m, unit, kind, x)) select k, unit, u.kind, replace(replace(x, 'NAME', name), 'KIND', p.kind) as text from p join u on k % 10 = m"


@L.add("H6 H2", _sql_units())
def p_functional_units(spark, sf_dir):
    """A work a row, of one of ten forms by its key."""
    forms = "case k % 10 " + " ".join(f"when {m} then array({', '.join(f'named_struct({chr(39)}kind{chr(39)}, {kind!r}, {chr(39)}text{chr(39)}, {text!r})' for kind, text in blocks)})" for m, (blocks, _) in _WORKS.items()) + " end"
    rows = _part(spark, sf_dir).select("k", "name", F.col("kind").alias("said"), F.posexplode(F.expr(forms)).alias("pos", "b"))
    text = F.replace(F.replace("b.text", F.lit("NAME"), F.col("name")), F.lit("KIND"), F.col("said"))
    root = units.root_lines(spark.createDataFrame([(1, _ONE + _TWO), (2, _THREE)], "pos int, text string"))
    return units.functional_units(rows.select("k", "pos", F.col("b.kind").alias("kind"), text.alias("text")), root, "k", longest=40)


_FRONT = "day: 1\nchapter: 1\nverses: 1-2\nstatus: draft"
_OPENING, _VERSES, _PRACTICE = "## Opening\nToday''s practice is based on BRAND.", "## Verses\nfirst — ^1-1\nsecond ^1-2", "## Practice\n**Actual Practice:** do it now\n_(Patience)_"
_BODY = f"{_OPENING}\n{_VERSES}\n{_PRACTICE}"
#: By the key: frontmatter, body, block ids expected, and what must be found: check, severity, section, detail.
_FILES = {
    0: (_FRONT, _BODY, True, []),
    1: ("", _BODY, True, [("no_frontmatter", "critical", "", "")]),
    2: (_FRONT.replace("chapter: 1\n", ""), _BODY, True, [("missing_key", "critical", "", "chapter")]),
    3: (_FRONT.replace("draft", "complete"), _BODY, True, [("status_complete", "critical", "", "")]),
    4: (_FRONT, f"{_OPENING}\n{_PRACTICE}", True, [("missing_section", "critical", "", "verses")]),
    5: (_FRONT, f"{_OPENING}\n{_BODY}", True, [("repeated_section", "critical", "", "opening")]),
    6: (_FRONT, f"{_OPENING}\n{_PRACTICE}\n{_VERSES}", True, [("section_order", "critical", "", "verses")]),
    7: (_FRONT, f"{_BODY}\n## Extra\nmore", True, [("unknown_heading", "minor", "", "## Extra")]),
    8: (_FRONT, _BODY.replace("BRAND.", "BRAND." + " word" * 10), True, [("over_ceiling", "critical", "opening", "16/12")]),
    9: (_FRONT, _BODY.replace("do it now", "do it now and then again here"), True, [("outside_band", "minor", "practice", "8")]),
    10: (_FRONT, _BODY.replace("Today''s practice", "Yesterday''s practice"), True, [("no_opening", "critical", "opening", "Today''s practice is based on")]),
    11: (_FRONT, _BODY.replace("_(Patience)_", "_(Patience)_ x"), True, [("no_closing", "critical", "practice", "_")]),
    12: (_FRONT, _BODY.replace(" ^1-1", "").replace(" ^1-2", ""), True, [("no_ids", "critical", "verses", "")]),
    13: (_FRONT, _BODY.replace("^1-2", "^1-3").replace("^1-1", "^1-2"), True, [("other_ids", "critical", "verses", "1-2,1-3")]),
    14: (_FRONT, _BODY.replace("^1-2", "^1-3"), False, [("id_gap", "critical", "verses", "1-1,1-3")]),
    15: (_FRONT, _BODY.replace("do it now", "do it now —"), True, [("forbidden", "critical", "", "em dash")]),
    16: (_FRONT, _BODY.replace("_(Patience)_", "[Patience]_"), True, [("no_tag", "critical", "practice", "")]),
    17: (_FRONT, _BODY.replace("_(Patience)_", "_(Sloth)_"), True, [("other_tag", "critical", "practice", "Sloth")]),
    18: (_FRONT, _BODY.replace("**Actual Practice:** ", ""), True, [("no_label", "critical", "practice", "**Actual Practice:**"), ("outside_band", "minor", "practice", "0")]),
}


def _sql_files() -> str:
    rows = [f"({m}, '{check}', '{severity}', '{section}', '{detail}')" for m, (*_, found) in _FILES.items() for check, severity, section, detail in found]
    return f"with {PART}, f as (select * from (values {', '.join(rows)}) as t(m, c, s, e, d)) select c as check_name, s as severity, 'day-' || k || case when e <> '' then '/' || e else '' end as entity_id, d as detail from p join f on k % 19 = m"


@L.add("D26", _sql_files())
def p_day_files(spark, sf_dir):
    """A day file a row, with one defect by its key: one for each rule."""
    said = lambda t: "'" + t.replace("\n", "\\n").replace("''", "\\'") + "'"
    of = lambda i: F.expr("case k % 19 " + " ".join(f"when {m} then {said(f[i])}" for m, f in _FILES.items()) + " end")
    files = _part(spark, sf_dir).select(F.concat(F.lit("day-"), F.col("k").cast("string")).alias("file"), of(0).alias("frontmatter"), F.replace(of(1), F.lit("BRAND"), F.col("brand")).alias("body"), F.expr("case when k % 19 <> 14 then array('1-1', '1-2') end").alias("expected"))
    plan = spark.createDataFrame([
        ("opening", "## Opening", 1, True, 12, None, None, "words", "Today's practice is based on", None, None, None, None, None, None),
        ("verses", "## Verses", 2, True, None, None, None, None, None, None, None, True, True, None, None),
        ("practice", "## Practice", 3, True, None, 3, 5, "words", None, "_", "**Actual Practice:**", None, None, r"_\(([^)]+)\)_", ["Patience", "Doing good"]),
    ], dayfile.PLAN)
    return dayfile.day_file_checks(files, plan, spark.createDataFrame([("em dash", "—"), ("two blanks", "  ")], "name string, pattern string"))


_LINE, _LONG, _SAID = "ཀ་ཁ་ག་ང་ཅ་ཆ་ཇ། །", "བཀའ་སྩལ་ནས་ནི་འདི་ལྟར་རབ་ཏུ་གསུངས་ཏེ། འཁོར་རྣམས་ཀྱིས་ཉན་པར་འདོད་པ་ཡིན་ནོ། །", "བཀའ་སྩལ་ཏོ། །"
_LABELS, _HONOUR = "རྒྱ་གར་སྐད་དུ། ས་ར། བོད་སྐད་དུ། མདོ་ཀ་ཁ།", "སངས་རྒྱས་ལ་ཕྱག་འཚལ་ལོ། །"
_WROTE, _TURNED = "སློབ་དཔོན་གྱིས་མཛད་པ་རྫོགས་སོ། །", "རྒྱ་གར་གྱི་མཁན་པོ་དང་། ལོ་ཙཱ་བ་ཡིས་བསྒྱུར་བའོ། །"
_I, _B, _A = ("front", "heading", "## ཀླད་ཀྱི་དོན། ^I-0"), ("body", "heading", "## གཞུང་དངོས། ^1-0"), ("closing", "heading", "## མཇུག་བྱང། ^a-0")
_BY, _OF = "### མཛད་བྱང། ^a-%d-0", "### འགྱུར་བྱང། ^a-%d-0"
#: By the key: a root text, and its lines: zone, kind, text, and whether a paragraph ends there (1) inside a sentence (2). NAME and KIND stand for the row's, BRAND for a title.
_ROOTS = {
    # a verse text with all of a frame
    0: (f"# BRAND\n\n{_LABELS} {_HONOUR}{_LINE * 6}\n\n{_LINE * 4}{_WROTE}{_TURNED}\n\n[^1]: NAME", [("title", "heading", "# BRAND ^0"), _I, ("front", "text", _LABELS), ("front", "text", _HONOUR), _B, *[("body", "P", _LINE)] * 5, ("body", "P", _LINE, 1), *[("body", "P", _LINE)] * 4, _A, ("closing", "heading", _BY % 1), ("closing", "text", _WROTE), ("closing", "heading", _OF % 2), ("closing", "text", _TURNED), ("notes", "text", "[^1]: NAME")]),
    # prose with a stanza in it, and no frame
    1: (f"NAME {_LONG}{_SAID}{_LINE * 4}ཀ་ཞེས་KIND། {_SAID}", [_B, ("body", "S", f"NAME {_LONG}"), ("body", "S", _SAID), *[("body", "V", _LINE)] * 4, ("body", "S", f"ཀ་ཞེས་KIND། {_SAID}")]),
    # a title that the text repeats, and homage; a paragraph that ends inside a sentence, another that does not
    2: (f"# མདོ་ཀ་ཁ་BRAND\n\nམདོ་ཀ་ཁ། {_HONOUR}ཀ་NAME་ནས།\n\nཁ་KIND {_SAID}\n\nག་NAME {_SAID}", [("title", "heading", "# མདོ་ཀ་ཁ་BRAND ^0"), _I, ("front", "text", "མདོ་ཀ་ཁ།"), ("front", "text", _HONOUR), _B, ("body", "S", "ཀ་NAME་ནས།", 2), ("body", "S", f"ཁ་KIND {_SAID}", 1), ("body", "S", f"ག་NAME {_SAID}")]),
    # frontmatter; language labels without homage; translators only
    3: (f"---\na: NAME\n---\n{_LABELS} ང་KIND {_SAID}{_TURNED}", [("frontmatter", "text", "---\na: NAME\n---\n"), _I, ("front", "text", _LABELS), _B, ("body", "S", f"ང་KIND {_SAID}"), _A, ("closing", "heading", _OF % 1), ("closing", "text", _TURNED)]),
    # an instruction between the lines of a verse text is one line
    4: (f"{_LINE * 12}ཧ་NAME། ཀ་ཁ་KINDའོ། །{_LINE * 12}", [_B, *[("body", "P", _LINE)] * 12, ("body", "P", "ཧ་NAME། ཀ་ཁ་KINDའོ། །"), *[("body", "P", _LINE)] * 12]),
    # the marks that open a text go with its first line; a verse text whose author alone is named
    5: (f"༄༅། །{_LINE * 8}{_WROTE}", [_B, ("body", "P", f"༄༅། །{_LINE}"), *[("body", "P", _LINE)] * 7, _A, ("closing", "heading", _BY % 1), ("closing", "text", _WROTE)]),
}
#: The parts of a work whose key is 6 in 7, and its lines.
_PARTED = (f"# BRAND\n\nང་KIND {_SAID}ཅ་NAME {_SAID}ཆ་KIND། ཇ་BRAND {_SAID}", [("title", "heading", "# BRAND ^0"), ("body", "heading", "## NAME ^1-0"), ("body", "S", f"ང་KIND {_SAID}"), ("body", "S", f"ཅ་NAME {_SAID}"), ("body", "S", "ཆ་KIND།"), ("body", "heading", "## KIND ^2-0"), ("body", "S", f"ཇ་BRAND {_SAID}"), ("unplaced", "heading", "BRAND")])
_ALL_ROOTS = {**_ROOTS, 6: _PARTED}


def _sql_roots() -> str:
    rows = [f"({m}, {i}, '{zone}', '{kind}', '{text.strip() if zone != 'frontmatter' else text}', {str(bool(ends)).lower()}, {str(ends == [2]).lower()})" for m, (_, made) in _ALL_ROOTS.items() for i, (zone, kind, text, *ends) in enumerate(made)]
    return f"with {PART}, u as (select * from (values {', '.join(rows)}) as t(m, line, zone, kind, x, breaks, doubtful)) select k, line, zone, u.kind, replace(replace(replace(x, 'NAME', name), 'KIND', p.kind), 'BRAND', brand) as text, breaks, doubtful from p join u on k % 7 = m"


@L.add("H13 H14 F34", _sql_roots())
def p_root_texts(spark, sf_dir):
    """A root text a row, of one of seven forms by its key; the last has parts, of which the first moves up and the last is not found."""
    said = lambda t: "'" + t.replace("\n", "\\n") + "'"
    form = F.expr("case k % 7 " + " ".join(f"when {m} then {said(t)}" for m, (t, _) in _ALL_ROOTS.items()) + " end")
    rows = _part(spark, sf_dir)
    text = form
    for word, column in (("NAME", "name"), ("KIND", "kind"), ("BRAND", "brand")):
        text = F.replace(text, F.lit(word), F.col(column))
    parts = rows.where("k % 7 = 6").select("k", F.expr("inline(array(named_struct('pos', 1, 'label', name, 'anchor', concat('ཅ་', name)), named_struct('pos', 2, 'label', kind, 'anchor', concat('ཇ་', brand)), named_struct('pos', 3, 'label', brand, 'anchor', concat(name, kind))))"))
    return roottext.laid_out(rows.select("k", text.alias("text")), "k", parts)
