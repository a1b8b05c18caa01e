"""Layout of root texts: titles and homage, body by verse or sentence, colophons, parts.

A work is one row, and all its clauses stay in it: zones are found by array
functions, so that nothing is shuffled; only the metre of the body is told by
an Arrow function, which gets numbers and flags and no text.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as K

from lectern.functions import fixed, metre
from lectern.functions import text as T

# Footnote markers; closing marks of a clause; how verse lines close; finite endings of sentences, and those that end a rubric.
NOTE = r"\[\^\d+\]"
CLOSING = rf"[།༔][།༔ \t]*+(?:{NOTE}[།༔ \t]*+)*+"
PAIR = rf"།[\s་]*(?:{NOTE})?\s*།"
LINE_CLOSE = rf"(?:{PAIR}|[གཀཤ]\s+།|༔)[\s།༔]*(?:{NOTE})*\s*$"
PADA_CLOSE = rf"(?:{PAIR}|ག\s+།|༔)[\s།༔]*(?:{NOTE})*\s*$"
RUBRIC = "(?:འོ|(?<![ཀ-ྼ])[སཏནརལདངག]ོ)[\\s་]*$"
FINAL = "(?:འོ|(?<![ཀ-ྼ])[སཏནརལདངག]ོ|ཤོག|[ཅཤ]ིག|[ཞཅཤ]ེ་ན|བ་[བཔ]ོ|མ་མོ)[\\s་]*$"
# Syllables after which a paragraph has stopped inside a sentence.
CONNECTIVES = "ཏེ སྟེ དེ ནས ཞིང ཅིང ཤིང དང ཀྱང ཡང པས བས ཀྱིས གྱིས ཀྱི གྱི ལས ཞེས ཅེས ཤེས པའི བའི མའི".split()
# Wording of authors' and translators' colophons, of scholars and orders before the latter, of commentaries and glosses, of titles and homage.
AUTHOR = "མཛད་པ(?:་|འི་)?(?:རྫོགས|ཡིན|ལགས)|མཛད་པ(?:འི)?་[^།]{0,300}?རྫོགས|[གཀ]ྱིས་སྦྱར་བ|བརྩམས་པ་རྫོགས"
TRANSLATORS = "ལོ་ཙཱ་བ|བསྒྱུར་(?:ཅིང|ཞིང|ནས|ཏེ|བ)|ཞུས་ཏེ|གཏན་ལ་ཕབ|འགྱུར་བཅོས"
SCHOLARS = "མཁན་པོ|པཎྜི་ཏ|བཀའ་ལུང་གིས"
TRANSLATOR_WORD = "ལོ་ཙཱ"
COMMENTARY = "འགྲེལ|རྣམ་པར་བཤད|རྣམ་བཤད|ཊཱི་ཀཱ|ཊཱི་ཀ|བཤད་སྦྱར|དཀའ་འགྲེལ"
GLOSSES = "ཞེས་པ་(?:ནི|སྟེ|ལ)|ཞེས་བྱ་བ་(?:ནི|ལ)"
SOURCE_LANGUAGE, OWN_LANGUAGE = "རྒྱ་གར་སྐད་དུ|རྒྱའི་སྐད་དུ|རྒྱ་ནག་སྐད་དུ", "བོད་སྐད་དུ"
HOMAGE, SHORT_HOMAGE, QUOTED = "ཕྱག་འཚལ་ལོ", "འཚལ་ལོ", "ཞེས"
SEATED = "བཞུགས(?:་སོ)?"
# Where titles and homage may stand (characters, clauses, syllables); clauses at the end of a text in which a colophon is looked for.
LABEL_WITHIN, TITLE_WITHIN, LEAD_WITHIN, LEAD_CLAUSES, HOMAGE_SYLLABLES, TITLE_EXCESS = 200, 600, 400, 3, 20, 6
PROSE_TAIL, LATE_TAIL, WORK_TAIL, OFF_METRE = 30, 16, 40, 2
# Syllables of a metrical clause, and the shares and rates that tell a text's kind.
METRICAL, VERSE_SHARE, PROSE_SHARE, GLOSS_RATE, HEAVY_GLOSS = 5, 0.6, 0.3, 1.0, 3.0
# Headings.
FRONT_TITLE, BODY_TITLE, CLOSING_TITLE, AUTHOR_TITLE, TRANSLATORS_TITLE = "ཀླད་ཀྱི་དོན།", "གཞུང་དངོས།", "མཇུག་བྱང།", "མཛད་བྱང།", "འགྱུར་བྱང།"

UNITS = K.ArrayType(K.StructType([K.StructField("begins", K.BooleanType()), K.StructField("kind", K.StringType())]))
LINE = "array<struct<zone:string,kind:string,text:string,breaks:boolean,doubtful:boolean>>"
#: Every clause has two characters at least, so these hold all that a title may reach to.
HEAD = TITLE_WITHIN


def _plain(t: Column) -> Column:
    """Without footnote markers, and with one form of the syllable mark."""
    return F.translate(F.regexp_replace(t, NOTE, ""), fixed.TSHEG_NB, fixed.TSHEG)


def _syllables(t: Column) -> Column:
    return F.regexp_count(t, F.lit(fixed.TIBETAN_RUN))


def _core(t: Column) -> Column:
    """Syllables of letters alone, to compare a title with its repetition."""
    return F.split(F.regexp_replace(F.regexp_replace(_plain(t), "[^ཀ-ྼ་]", ""), "^་+|་+$", ""), fixed.TSHEG)


def _first(array: str, test, start: Column | int = 0) -> Column:
    """Place of the first element from a place on that passes; null if none does. The place is bound, or it would be computed for each element."""
    begin = F.lit(start) if isinstance(start, int) else start
    return T.let(begin, lambda s: F.array_min(F.transform(array, lambda c, i: F.when((i >= s) & test(c), i))))


def _last(array: str, test, start: Column | int, end: Column) -> Column:
    return T.let(F.struct(start.alias("a"), end.alias("z")), lambda s: F.array_max(F.transform(array, lambda c, i: F.when((i >= s["a"]) & (i < s["z"]) & test(c), i))))


def _joined(first: Column, size: Column) -> Column:
    return F.trim(F.array_join(F.transform(F.slice("_c", first + 1, size), lambda c: c["text"]), ""))


def _line(zone: str, kind: Column | str, text: Column, breaks: Column | None = None, doubtful: Column | None = None) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(F.lit(zone).alias("zone"), kind.alias("kind"), text.alias("text"), (F.lit(False) if breaks is None else breaks).alias("breaks"), (F.lit(False) if doubtful is None else doubtful).alias("doubtful"))


def _lines(when: Column, *lines: Column) -> Column:
    return F.when(when, F.array(*lines)).otherwise(F.array()).cast(LINE)


def parts_of(texts: DataFrame) -> DataFrame:
    """A text's frontmatter, title line, paragraphs and notes, as ``_front``, ``_title``, ``_paras`` and ``_notes``."""
    text = F.coalesce("text", F.lit(""))
    rows = texts.withColumn("_front", F.regexp_extract(text, r"(?s)\A---\n.*?\n---\n", 0))
    rows = rows.withColumn("_rest", F.substring(text, F.length("_front") + 1, F.length(text)))
    rows = rows.withColumn("_notes", F.regexp_extract("_rest", rf"(?sm)^{NOTE}:.*\z", 0))
    rows = rows.withColumn("_rest", F.substring(F.col("_rest"), F.lit(1), F.length("_rest") - F.length("_notes")))
    rows = rows.withColumn("_title", F.regexp_extract("_rest", r"\A\n*[ \t]*(#[^\n]*)", 1))
    body = F.when(F.col("_title") == "", F.col("_rest")).otherwise(F.regexp_replace("_rest", r"\A\n*[^\n]*", ""))
    paras = F.transform(F.split(body, r"\n[ \t]*\n"), lambda p: F.regexp_replace(F.regexp_replace(p, r"(?<![^\S\n])[^\S\n]*+\n\s*+", " "), r"^\s++|(?<!\s)\s++$", ""))
    return rows.withColumn("_paras", F.filter(paras, lambda p: p != ""))


def text_kind(texts: DataFrame) -> DataFrame:
    """``kind`` (commentary, verse, mixed, prose), ``gloss`` marks for 1000 syllables and metrical share ``verse`` of texts that `parts_of` has parted."""
    t = _plain(F.col("_rest"))
    rows = texts.withColumn("_sizes", F.filter(F.transform(F.split(t, "[།༔]+"), _syllables), lambda n: n > 0))
    total = F.greatest(_syllables(t), F.lit(1))
    beside = lambda n, i: (n == F.get("_sizes", i - 1)) | (n == F.get("_sizes", i + 1))
    metrical = F.transform("_sizes", lambda n, i: F.when((n >= METRICAL) & F.coalesce(beside(n, i), F.lit(False)), n).otherwise(0))
    rows = rows.withColumn("verse", F.aggregate(metrical, F.lit(0), lambda a, n: a + n) / total).withColumn("gloss", F.regexp_count(t, F.lit(GLOSSES)) / total * 1000)
    first_line = F.regexp_extract("_rest", r"\A\s*([^\n]*)", 1)
    loose = F.col("verse") < VERSE_SHARE
    commentary = ((F.col("gloss") >= GLOSS_RATE) & loose) | (F.col("gloss") >= HEAVY_GLOSS) | (F.rlike(first_line, F.lit(COMMENTARY)) & loose)
    return rows.withColumn("kind", F.when(commentary, "commentary").when(~loose, "verse").when(F.col("verse") < PROSE_SHARE, "prose").otherwise("mixed")).drop("_sizes")


def with_clauses(texts: DataFrame) -> DataFrame:
    """``_c``: a work's clauses with their sizes and flags; one ends at closing marks before a letter, and at each paragraph's end. Opening marks go with the clause after them."""
    one = rf"(?s)[༄-༔\s]*+.+?{CLOSING}(?=[ཀ-ྼ༄])|.+\z"
    # a paragraph's last clause is told by a mark that no paragraph has: a line break
    marked = F.transform("_paras", lambda p: F.regexp_extract_all(F.concat(p, F.lit("\n")), F.lit(one), F.lit(0)))
    rows = texts.withColumn("_raw", F.flatten(marked))

    def facts(c: Column) -> Column:
        ends = F.endswith(c, F.lit("\n"))
        text = F.when(ends, F.concat(F.rtrim(F.regexp_replace(c, "\n$", "")), F.lit(" "))).otherwise(c)
        return F.struct(text.alias("text"), ends.alias("cut"), F.regexp_replace(_plain(c), r"(?<![།༔\s])[།༔\s]++$", "").alias("bare"), F.regexp_replace(_plain(c), r"[()\s]", "").alias("norm"))
    rows = rows.withColumn("_raw", F.transform("_raw", facts))

    def flags(c: Column) -> Column:
        last = F.regexp_replace(c["bare"], "་+$", "")
        closed = F.rlike(c["text"], F.lit(LINE_CLOSE)) & ~F.rlike(c["bare"], F.lit(rf"^[༄-༔\s]*{QUOTED}"))
        return F.struct(
            c["text"].alias("text"), c["cut"].alias("cut"), c["bare"].alias("bare"), c["norm"].alias("norm"), _syllables(c["bare"]).alias("size"), closed.alias("closed"),
            F.rlike(c["text"], F.lit(PADA_CLOSE)).alias("pada"), F.rlike(c["bare"], F.lit(FINAL)).alias("final"), F.rlike(c["bare"], F.lit(RUBRIC)).alias("rubric"), F.contains(c["text"], F.lit(QUOTED)).alias("quotes"),
            F.array_join(F.slice(F.concat(F.array(F.lit(""), F.lit("")), F.regexp_extract_all(c["bare"], F.lit(fixed.TIBETAN_RUN), F.lit(0))), -2, 2), " ").alias("ending"),
            F.rlike(c["norm"], F.lit(AUTHOR)).alias("author"), F.rlike(c["norm"], F.lit(TRANSLATORS)).alias("translator"), F.rlike(c["norm"], F.lit(SCHOLARS)).alias("scholar"),
            (F.rlike(c["norm"], F.lit(f"{SCHOLARS}|{TRANSLATOR_WORD}")) & F.rlike(c["text"], F.lit(rf"དང[་༌]?(?:{NOTE})*\s*།(?:{NOTE})*\s*$"))).alias("leads"),
            (c["cut"] & (~F.rlike(_plain(c["text"]), F.lit(r"[།༔]\s*$")) | F.element_at(F.split(last, r"[་\s]"), -1).isin(CONNECTIVES))).alias("doubtful"),
        )
    return rows.withColumn("_c", F.transform("_raw", flags)).drop("_raw").withColumn("_n", F.size("_c"))


def with_front(rows: DataFrame) -> DataFrame:
    """``_pos``: clauses of the front matter; ``_fronts``: where its units begin.

    With language labels these are the titles, and the homage; else up to three
    leading clauses that repeat the title or, in prose, pay homage.
    """
    head = F.slice("_c", 1, HEAD)
    ends = F.aggregate(head, F.array().cast("array<int>"), lambda a, c: F.array_append(a, F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) + F.length(c["text"])))
    rows = rows.withColumn("_head", head)
    opening = F.array_join(F.transform(F.slice("_head", 1, LABEL_WITHIN), lambda c: c["text"]), "")
    own = _first("_head", lambda c: F.contains(c["text"], F.lit(OWN_LANGUAGE)))
    rows = rows.withColumns({"_ends": ends, "_t": F.when(F.rlike(F.substring(opening, 1, LABEL_WITHIN), F.lit(SOURCE_LANGUAGE)), own)})
    place = lambda i, word: F.coalesce(F.get("_ends", i - 1), F.lit(0)) + F.instr(F.get("_head", i)["text"], F.lit(word)) - 1
    rows = rows.withColumn("_i", F.when(F.col("_t").isNotNull(), place(F.col("_t"), OWN_LANGUAGE)))
    rows = rows.withColumn("_t", F.when((F.col("_i") > 0) & (F.col("_i") < TITLE_WITHIN), F.col("_t")))
    full, short = _first("_head", lambda c: F.contains(c["text"], F.lit(HOMAGE)), F.col("_t")), F.col("_t") + 2
    near = lambda i, word: F.contains(F.get("_head", i)["text"], F.lit(word)) & (place(i, word) - F.col("_i") < TITLE_WITHIN)
    rows = rows.withColumn("_h", full).withColumn("_h", F.when(near(F.col("_h"), HOMAGE), F.col("_h")).when(near(short, SHORT_HOMAGE), short))
    labelled = F.when(F.col("_t").isNotNull(), F.coalesce(F.col("_h") + 1, F.least(F.col("_t") + 2, F.col("_n"))))
    rows = rows.withColumn("_tc", _core(F.regexp_replace("_title", SEATED, "")))

    def leads(c: Column) -> Column:
        core = _core(c["text"])
        again = (F.size("_tc") >= 3) & (F.slice(core, 1, 3) == F.slice("_tc", 1, 3)) & (F.size(core) <= F.size("_tc") + TITLE_EXCESS)
        return again | ((F.col("_form") == "prose") & F.contains(c["text"], F.lit(HOMAGE)) & (c["size"] <= HOMAGE_SYLLABLES))
    few = F.least(F.lit(LEAD_CLAUSES), F.greatest(F.col("_n") - 1, F.lit(0)), F.size(F.filter("_ends", lambda e: e <= LEAD_WITHIN)))
    rows = rows.withColumn("_few", F.slice("_head", F.lit(1), few))
    led = F.when(F.col("_title") == "", 0).otherwise(F.coalesce(_first("_few", lambda c: ~leads(c)), F.size("_few")))
    rows = rows.withColumn("_pos", F.coalesce(labelled, led))
    begins = lambda j: F.col("_t").isNull() | (j == 0) | F.coalesce(j == F.col("_h"), F.lit(False)) | F.coalesce(F.get("_head", j - 1)["cut"], F.lit(False))
    fronts = F.when(F.col("_pos") > 0, F.filter(F.sequence(F.lit(0), F.greatest(F.col("_pos") - 1, F.lit(0))), begins)).otherwise(F.array().cast("array<int>"))
    return rows.withColumn("_fronts", fronts).drop("_head", "_ends", "_few", "_t", "_i", "_h")


def with_colophons(rows: DataFrame) -> DataFrame:
    """``_end``: clauses before the colophons; ``_by``: those before the translators' own; ``_metre``: the size that most clauses have."""
    pos, n = F.col("_pos"), F.col("_n")
    rows = rows.withColumn("_sz", F.transform(F.slice("_c", pos + 1, F.greatest(n - pos, F.lit(0))), lambda c: c["size"]))
    most = F.array_max(F.transform(F.array_distinct("_sz"), lambda s, i: F.struct(F.size(F.filter("_sz", lambda x: x == s)).alias("times"), (-i).alias("late"), s.alias("size"))))
    rows = rows.withColumn("_metre", F.coalesce(most["size"], F.lit(0))).drop("_sz")
    told = lambda c: c["author"] | c["translator"]
    body = lambda c: ~told(c) & (F.abs(c["size"] - F.col("_metre")) <= OFF_METRE) & c["pada"]
    floor = F.when(F.col("_form") == "prose", F.greatest(pos, n - PROSE_TAIL)).otherwise(pos)
    rows = rows.withColumn("_k", F.coalesce(_last("_c", body, floor, n) + 1, floor))
    rows = rows.withColumn("_k", F.coalesce(_first("_c", told, F.col("_k")), _first("_c", told, F.greatest(pos, n - LATE_TAIL)), n))
    # the work's own closing line, when translators follow it
    name = F.concat(F.lit(r"(?:"), F.array_join("_tc", fixed.TSHEG), F.lit(")་*(?:ཞེས་བྱ་བ་*)?རྫོགས"))
    closing = F.when(F.size("_tc") >= 2, _last("_c", lambda c: F.rlike(c["norm"], name), F.greatest(pos, n - WORK_TAIL), n))
    rows = rows.withColumn("_j", closing)
    after = F.exists(F.slice("_c", F.col("_j") + 2, F.greatest(n - F.col("_j") - 1, F.lit(0))), lambda c: c["translator"])
    rows = rows.withColumn("_closed", F.coalesce((F.col("_j") + 1 < F.col("_k")) & after & ~F.get("_c", F.col("_j"))["author"], F.lit(False)))
    rows = rows.withColumn("_k", F.when(F.col("_closed"), F.col("_j") + 1).otherwise(F.col("_k")))
    # scholars named in the clauses before, up to "and"
    back = F.coalesce(_last("_c", lambda c: ~(c["leads"] & ~c["author"]), pos, F.col("_k")) + 1, pos)
    rows = rows.withColumn("_end", F.when(F.col("_k") < n, back).otherwise(n))
    wrote = _first("_c", lambda c: c["author"], F.col("_end")) + 1
    turned = F.when(F.col("_closed"), _first("_c", lambda c: c["translator"] | c["scholar"], F.col("_end")))
    rows = rows.withColumn("_by", F.coalesce(wrote, turned, F.col("_end")))
    return rows.withColumn("_by", F.when(_first("_c", lambda c: c["translator"], F.col("_by")).isNotNull(), F.col("_by")).otherwise(n)).drop("_k", "_j", "_closed")


@F.pandas_udf(UNITS)
def _units(form: pd.Series, main: pd.Series, size: pd.Series, closed: pd.Series, final: pd.Series, rubric: pd.Series, quotes: pd.Series, ending: pd.Series, cut: pd.Series) -> pd.Series:
    out = []
    for way, m, *columns in zip(form, main, size, closed, final, rubric, quotes, ending, cut, strict=True):
        n, c, f, r, q, e, p = ([] if x is None else list(x) for x in columns)
        if way == "verse":
            number, kind = metre.padas(n, c, f, r, p, m), ["P"] * len(n)
        else:
            verse = metre.verse_lines(n, c, f, e, q)
            number, kind = metre.units(n, verse, f, p), ["V" if v else "S" for v in verse]
        out.append([{"begins": not i or number[i - 1] != number[i], "kind": k} for i, k in enumerate(kind)])
    return pd.Series(out)


def laid_out(texts: DataFrame, key: str, parts: DataFrame | None = None, form: str = "auto", front_title: str = FRONT_TITLE, body_title: str = BODY_TITLE) -> DataFrame:
    """Works ``(key, text)`` as lines ``(key, line, zone, kind, text, breaks, doubtful)`` in order.

    Zones are frontmatter, title, front, body, closing and notes; kinds are
    heading, S (sentence), V (verse line in prose), P (line of a verse text)
    and text. ``breaks`` tells that a paragraph of the source ends with a unit
    of the body, ``doubtful`` that it ends inside a sentence. The form is
    verse or prose; ``auto`` takes that of `text_kind`.

    ``parts (key, pos, label, anchor)`` are the headings of the body: one
    stands before the first clause that has its anchor (spaces and closing
    marks aside), which begins a unit, and the first also before what comes
    earlier. Parts that are not found come last, in the zone unplaced. Without
    any, the body has one heading. Null texts count as empty and have no lines.
    No letter of a text is lost: a work's lines less those of the kind heading
    (but with the title) are its text, spaces aside.
    """
    rows = text_kind(parts_of(texts.select(key, "text")))
    rows = rows.withColumn("_form", F.lit(form) if form != "auto" else F.when(F.col("kind") == "verse", "verse").otherwise("prose"))
    rows = with_colophons(with_front(with_clauses(rows)))
    rows = rows.withColumn("_b", F.slice("_c", F.col("_pos") + 1, F.greatest(F.col("_end") - F.col("_pos"), F.lit(0))))
    heading = "struct<at:int,no:int,label:string>"
    if parts is None:
        rows = rows.withColumn("_p", F.array().cast(f"array<{heading}>"))
    else:
        listed = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "label", "anchor"))).alias("_p"))
        rows = rows.join(listed, key, "left")
        bare = lambda c: F.regexp_replace(c, r"[\s།༎༑༔]|\[\^\d+\]", "")
        rows = rows.withColumn("_bare", F.transform("_b", lambda c: bare(c["text"])))
        placed = F.transform(F.coalesce("_p", F.array().cast(rows.schema["_p"].dataType)), lambda p, i: F.struct(F.array_min(F.transform("_bare", lambda b, j: F.when(F.contains(b, bare(p["anchor"])), j))).alias("at"), (i + 1).alias("no"), p["label"].alias("label")))
        rows = rows.withColumn("_p", placed.cast(f"array<{heading}>")).drop("_bare")
    rows = rows.withColumn("_first", F.array_min(F.transform("_p", lambda p: p["at"])))
    rows = rows.withColumn("_p", F.transform("_p", lambda p: F.struct(F.when(p["at"] == F.col("_first"), 0).otherwise(p["at"]).alias("at"), p["no"].alias("no"), p["label"].alias("label"))))
    starts = F.transform("_p", lambda p: p["at"])
    field = lambda name: F.transform("_b", lambda c: c[name])
    flags = [field(f) for f in ("size", "closed", "final", "rubric", "quotes", "ending")]
    cuts = F.transform("_b", lambda c, i: c["cut"] | F.coalesce(F.array_contains("_s", i + 1), F.lit(False)))
    rows = rows.withColumn("_s", F.filter(starts, lambda s: s.isNotNull())).withColumn("_m", _units("_form", "_metre", *flags, cuts))
    # all units by one join and one split, as a slice for each would read the whole array each time; no clause has a line break
    marked = F.transform("_b", lambda c, i: F.when((i > 0) & F.get("_m", i)["begins"], F.concat(F.lit("\n"), c["text"])).otherwise(c["text"]))
    begins = F.filter(F.transform("_m", lambda m, i: F.struct(i.alias("first"), m["kind"].alias("kind"), m["begins"].alias("begins"))), lambda u: u["begins"])
    rows = rows.withColumn("_t", F.split(F.array_join(marked, ""), "\n")).withColumn("_u", begins)

    def unit(u: Column, i: Column) -> Column:
        here = F.filter("_p", lambda p: p["at"] == u["first"])
        end = F.coalesce(F.get("_u", i + 1)["first"], F.size("_b"))
        last, inner = F.get("_b", end - 1), end < F.size("_b")
        heads = F.transform(here, lambda p: _line("body", "heading", F.concat(F.lit("## "), p["label"], F.lit(" ^"), p["no"].cast("string"), F.lit("-0"))))
        return F.concat(heads.cast(LINE), F.array(_line("body", u["kind"], F.trim(F.get("_t", i)), last["cut"] & inner, last["doubtful"] & inner)).cast(LINE))
    front = F.transform("_fronts", lambda s, i: _line("front", "text", _joined(s, F.coalesce(F.get("_fronts", i + 1), F.col("_pos")) - s)))
    wrote, turned, n = F.col("_by") > F.col("_end"), F.col("_by") < F.col("_n"), F.col("_n")
    second = F.when(wrote, "2").otherwise("1")
    said = lambda t: F.lit(t)
    lines = F.concat(
        _lines(F.col("_front") != "", _line("frontmatter", "text", F.col("_front"))),
        _lines(F.col("_title") != "", _line("title", "heading", F.concat(F.rtrim(F.regexp_replace("_title", r"^#+\s*", "# ")), said(" ^0")))),
        _lines(F.col("_pos") > 0, _line("front", "heading", said(f"## {front_title} ^I-0"))), front.cast(LINE),
        _lines((F.size("_u") > 0) & (F.size("_s") == 0), _line("body", "heading", said(f"## {body_title} ^1-0"))),
        F.flatten(F.transform("_u", unit)).cast(LINE),
        _lines(F.col("_end") < n, _line("closing", "heading", said(f"## {CLOSING_TITLE} ^a-0"))),
        _lines(wrote & (F.col("_end") < n), _line("closing", "heading", said(f"### {AUTHOR_TITLE} ^a-1-0")), _line("closing", "text", _joined(F.col("_end"), F.col("_by") - F.col("_end")))),
        _lines(turned, _line("closing", "heading", F.concat(said(f"### {TRANSLATORS_TITLE} ^a-"), second, said("-0"))), _line("closing", "text", _joined(F.col("_by"), F.greatest(n - F.col("_by"), F.lit(0))))),
        _lines(F.col("_notes") != "", _line("notes", "text", F.col("_notes"))),
        F.transform(F.filter("_p", lambda p: p["at"].isNull()), lambda p: _line("unplaced", "heading", p["label"])).cast(LINE),
    )
    return rows.select(key, F.posexplode(lines).alias("line", "_l")).select(key, "line", "_l.*")
