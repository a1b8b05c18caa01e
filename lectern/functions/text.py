"""Text functions as column expressions; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import fixed

#: The plain letters are tried first and the others only from À on: a class is tried member by member.
WORD = f"[a-zA-Z[\\x{{C0}}-\\x{{FFFF}}&&[{fixed.TRANSLITERATION}À-ÖØ-öø-ÿß]]]++"


def _c(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without_frontmatter(text: Column | str) -> Column:
    """The text after a leading block between lines of three dashes."""
    return F.regexp_replace(_c(text), r"(?s)\A---.*?\n---", "")


#: Transclusion lines and block ids.
_WORDS_AWAY = (r"(?m)^!\[\[.*$", r"\^[\w\-]+")


def plain_markup(text: Column | str) -> Column:
    """Without transclusion lines, block ids, markup signs and digits."""
    t = without_frontmatter(text)
    for pattern in (*_WORDS_AWAY, r"[#\[\]`*_>|§]", r"\d+"):
        t = F.regexp_replace(t, pattern, " ")
    return t


def english_tokens(text: Column | str) -> Column:
    """Lower-cased words of `plain_markup`; parts joined by a hyphen are one.

    Markup signs and digits are in no word and join none, so only what takes
    words away is cut out first, and from the texts that have a sign of it.
    """
    t = _c(text)
    cut = without_frontmatter(t)
    for pattern in _WORDS_AWAY:
        cut = F.regexp_replace(cut, pattern, " ")
    marked = t.startswith("---") | F.contains(t, F.lit("^")) | F.contains(t, F.lit("![["))
    return F.transform(F.regexp_extract_all(F.when(marked, cut).otherwise(t), F.lit(f"{WORD}(?:-{WORD})*+"), F.lit(0)), F.lower)


def term_tokens(text: Column | str) -> Column:
    """`english_tokens` of three letters or more that are no stop words."""
    return F.filter(english_tokens(text), lambda w: (F.length(w) > 2) & ~w.isin(fixed.STOPWORDS))


def formula_words(text: Column | str, stop: list[str] | None = None) -> Column:
    """Lower-cased words of three characters or more, without bracketed parts, headings, punctuation and numbers."""
    t = F.regexp_replace(F.regexp_replace(_c(text), r"\[[^\]]*\]", ""), r"(?m)^#+.*$", "")
    words = F.split(F.lower(F.regexp_replace(t, r"[\p{Punct}“”‘’—–…]", " ")), r"\s+")
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~F.rlike(w, F.lit(r"^\d+$")) & ~w.isin(stop or fixed.STOPWORDS))


def diacritic_tokens(text: Column | str, stop: list[str] | None = None) -> Column:
    """Lower-cased words of a transliterated text; short plain ones, numbers and stop words go."""
    words = F.transform(F.regexp_extract_all(F.regexp_replace(_c(text), r"\[[^\]]*\]", ""), F.lit(r"[\wĀ-žḀ-ỿ]+"), F.lit(0)), F.lower)
    return F.filter(words, lambda w: (F.length(w) >= 2) & ~F.rlike(w, F.lit(r"^(\d+|[\x00-\x7f]{1,3})$")) & ~w.isin(stop or fixed.STOPWORDS))


def syllable_count(text: Column | str) -> Column:
    """Runs of Tibetan letters, bracketed notes aside."""
    return F.regexp_count(F.regexp_replace(_c(text), r"\[\^[^\]]*\]", ""), F.lit(fixed.TIBETAN_RUN))


def tsheg_count(text: Column | str) -> Column:
    """Syllable marks of either form, and one."""
    return F.regexp_count(_c(text), F.lit(f"[{fixed.TSHEG}{fixed.TSHEG_NB}]")) + 1


def syllables(text: Column | str) -> Column:
    """Syllables between marks, those without a Tibetan letter dropped."""
    return F.filter(F.split(F.regexp_replace(_c(text), r"[^ཀ-ྼ]+", fixed.TSHEG), fixed.TSHEG), lambda s: F.rlike(s, F.lit("[ཀ-ྼ]")))


def unit_count(text: Column | str, unit: str) -> Column:
    """Syllables, or words after markup and punctuation are gone."""
    if unit == "syllables":
        return F.size(syllables(text))
    return F.size(F.filter(F.split(F.regexp_replace(plain_markup(text), r"[\p{Punct}“”‘’—–…]", " "), r"\s+"), lambda w: w != ""))


def delimiter_key(text: Column | str) -> Column:
    """The text without clause and syllable marks and white space (in a normal form if it had one)."""
    return F.regexp_replace(_c(text), fixed.DELIMITERS, "")


def letters_only(text: Column | str) -> Column:
    return F.regexp_replace(_c(text), r"[^\p{L}]", "")


def squeeze(text: Column | str) -> Column:
    """The text without white space: equal before and after any step that only moves it."""
    return F.regexp_replace(_c(text), r"\s+", "")


def tibetan_norm(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(text), r"(?s)<small>.*?</small>", ""), r"[^ཀ-ྼ་]", "")


def loose_form(text: Column | str) -> Column:
    """Without articles, punctuation and the commonest endings, for a second try at a match."""
    t = F.lower(_c(text))
    for pattern, by in ((r"\b(the|a|an)\b", " "), (r"[^\w\s]", " "), (r"\b(\w{4,})s\b", "$1"), (r"\b(\w{3,}?)(?:ing|ed|e)\b", "$1"), (r"\s+", " ")):
        t = F.regexp_replace(t, pattern, by)
    return F.trim(t)


def match_tier(form: Column | str, text: Column | str) -> Column:
    """``exact``, ``loose`` or ``none``: how a form occurs in a text."""
    a, b = F.trim(F.lower(_c(form))), F.lower(_c(text))
    return F.when(F.contains(b, a), "exact").when((loose_form(form) != "") & F.contains(loose_form(text), loose_form(form)), "loose").otherwise("none")


def lemma(text: Column | str) -> Column:
    """A gloss's lemma: the part before a hyphen and a capital, lower-cased, without a trailing …pe…."""
    head = F.regexp_replace(_c(text), r"-[A-Z].*$", "")
    return F.lower(F.regexp_replace(head, r"…pe…$", ""))


def degenerate(word: Column | str) -> Column:
    """Whether a lemma is none: empty, an open affix, one character, or no letter at all."""
    w = _c(word)
    return w.isNull() | (w == "") | w.startswith("--") | (F.length(w) < 2) | F.rlike(w, F.lit(r"^[.…\-+0-9]+$"))


def rendering(text: Column | str) -> Column:
    return F.lower(F.trim(_c(text)))


def variants(word: Column | str) -> Column:
    """A word with and without the endings s, es, ing and ed."""
    w = _c(word)
    n = F.length(w)
    cut = lambda k: F.substring(w, F.lit(1), n - k)
    out = F.array(
        w, F.concat(w, F.lit("s")), F.concat(w, F.lit("es")),
        F.when(w.endswith("es") & (n > 4), cut(2)), F.when(w.endswith("s") & (n > 3), cut(1)),
        F.when(w.endswith("ing") & (n > 5), cut(3)), F.when(w.endswith("ing") & (n > 5), F.concat(cut(3), F.lit("e"))),
        F.when(w.endswith("ed") & (n > 4), cut(2)), F.when(w.endswith("ed") & (n > 4), cut(1)))
    return F.array_distinct(F.array_compact(out))


def unwrap_wikilinks(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(text), r"\[\[[^\]|]*\|([^\]]*)\]\]", "$1"), r"\[\[([^\]|]*)\]\]", "$1")


def shad_groups(text: Column | str) -> Column:
    """A tight pair of clause marks stays tight, a spaced one gets one space."""
    return F.regexp_replace(_c(text), r"།\s+།", "། །")


def shad_spacing(text: Column | str) -> Column:
    """A space after a single clause mark that runs into the next word."""
    return F.regexp_replace(_c(text), r"(?<!།)།(?=[^\s།])", "། ")


def mechanical_clean(text: Column | str) -> Column:
    """Without page markers, lines of a bare number, non-breaking marks and doubled spaces."""
    t = _c(text)
    for pattern, by in ((r"(?m)^\s*\[?(?:p\.?|page)\s*\d+\]?\s*$\n?", ""), (r"(?m)^\s*\d+\s*$\n?", ""), (fixed.TSHEG_NB, fixed.TSHEG), (r"(?<=[ཀ-ྼ་])[ ]+(?=[ཀ-ྼ])", ""), (r"[ \t]{2,}", " ")):
        t = F.regexp_replace(t, pattern, by)
    return t


def plain_wikitext(text: Column | str) -> Column:
    """Without noinclude parts, templates and tags."""
    t = _c(text)
    for pattern in (r"(?is)<noinclude>.*?</noinclude>", r"\{\{[^{}]*\}\}", r"<[^>]+>"):
        t = F.regexp_replace(t, pattern, "")
    return unwrap_wikilinks(t)


def plain_html(text: Column | str) -> Column:
    """Text of a page: without scripts, styles, comments and tags, the commonest references decoded, white space as one space."""
    t = _c(text)
    for pattern in (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"):
        t = F.regexp_replace(t, pattern, " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def message_text(text: Column | str) -> Column:
    """A chat message with mentions, channels and custom emoji as plain words."""
    t = F.regexp_replace(_c(text), r"<@!?&?\d+>", "@someone")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"<#\d+>", "#channel"), r"<a?:(\w+):\d+>", ":$1:"))


def vague(text: Column | str) -> Column:
    t = F.trim(_c(text))
    return (F.length(t) < fixed.VAGUE_SHORT) | ((F.length(t) < fixed.VAGUE_LONG) & F.rlike(F.lower(t), F.lit(fixed.VAGUE)))


def slug(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(_c(text)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def natural_key(block_id: Column | str) -> Column:
    """Sort key of a hyphen path: numbers by value, and before words."""
    return F.transform(F.split(_c(block_id), "-"), lambda p: F.struct(F.when(F.rlike(p, F.lit(r"^\d+$")), 0).otherwise(1).alias("kind"), F.coalesce(p.try_cast("long"), F.lit(0)).alias("num"), F.when(F.rlike(p, F.lit(r"^\d+$")), "").otherwise(p).alias("str")))


def suffixed_key(block_id: Column | str) -> Column:
    """Sort key of a path whose numbers may end in letters."""
    return F.transform(F.split(_c(block_id), "-"), lambda p: F.struct(F.coalesce(F.regexp_extract(p, r"^(\d+)", 1).try_cast("long"), F.lit(2 ** 31)).alias("num"), F.regexp_extract(p, r"^\d*(.*)$", 1).alias("str")))


def decimal_block_id(path: Column | str) -> Column:
    """``1.3.2`` as the heading id ``^1-3-2-0``."""
    return F.concat(F.lit("^"), F.translate(_c(path), ".", "-"), F.lit("-0"))


def claim_node(claim: Column | str) -> Column:
    """``c-1-1-4-2`` is a claim of node ``1.1.4``."""
    parts = F.split(_c(claim), "-")
    return F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), ".")


def expand_range(first: Column | str, last: Column | str, most: int = 500) -> Column:
    """The ids from first to last, which differ in their last number only; null where they don't, or are too many."""
    a, b = F.split(_c(first), "-"), F.split(_c(last), "-")
    stem = lambda p: F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), "-")
    lo, hi = F.element_at(a, -1).try_cast("int"), F.element_at(b, -1).try_cast("int")
    fits = (F.size(a) > 1) & (F.size(a) == F.size(b)) & (stem(a) == stem(b)) & (lo <= hi) & (hi - lo < most)
    return F.when(fits, F.transform(F.sequence(lo, F.greatest(lo, hi)), lambda i: F.concat_ws("-", stem(a), i.cast("string"))))


def script(text: Column | str, sample: int | None = None) -> Column:
    """The script with the most letters in the text, or in a sample of so many characters at its head; ties in the order listed, Latin last and where there are none.

    Letters are counted only where a text has a character of the listed scripts.
    """
    t = _c(text) if sample is None else F.substring(_c(text), 1, sample)
    ranges = {name: f"\\x{{{a:X}}}-\\x{{{b:X}}}" for name, a, b in fixed.SCRIPTS}
    counts = [(name, F.regexp_count(t, F.lit(f"[{r}]"))) for name, r in ranges.items()]
    counts.append(("latn", F.regexp_count(t, F.lit(r"[\p{L}&&[\x{0}-\x{24F}]]|[\x{1E00}-\x{1EFF}]"))))
    most = F.greatest(*(n for _, n in counts))
    out = F.when(F.length(t) == F.octet_length(t), "latn").when(~F.rlike(t, F.lit(f"[{''.join(ranges.values())}]")), "latn")
    for name, n in counts:
        out = out.when(n == most, F.lit(name))
    return out


def has_stray_latin(text: Column | str) -> Column:
    """Latin words in a text that is mostly of another script."""
    return (script(text) != "latn") & F.rlike(_c(text), F.lit("[A-Za-z]{2,}"))


def plain_english(word: Column | str) -> Column:
    return ~F.rlike(_c(word), F.lit(f"[{fixed.TRANSLITERATION}]"))


def band(score: Column | str) -> Column:
    s = _c(score)
    out = None
    for least, name in fixed.BANDS:
        out = F.when(s >= least, name) if out is None else out.when(s >= least, name)
    return out.otherwise(fixed.BANDS[-1][1])


def work_day(ts: Column | str, zone: str = "Asia/Kolkata", start_hour: int = 1) -> Column:
    """The day of a UTC time in the zone, days starting at an hour after midnight."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts).cast("timestamp_ntz")) - F.expr(f"interval {start_hour} hours"))


def reference_list(text: Column | str) -> Column:
    """Numbers of a leading typed reference: ``1-3,5.`` gives 1, 2, 3, 5."""
    head = F.regexp_extract(_c(text), r"^\s*(\d+(?:\s*[-–,]\s*\d+)*)[.)]?", 1)
    part = F.filter(F.split(F.regexp_replace(head, r"\s+", ""), ","), lambda p: p != "")
    spread = F.transform(part, lambda p: F.sequence(F.regexp_extract(p, r"^(\d+)", 1).try_cast("int"), F.greatest(F.regexp_extract(p, r"^(\d+)", 1).try_cast("int"), F.regexp_extract(p, r"(\d+)$", 1).try_cast("int"))))
    return F.flatten(spread)


def numeral_system(text: Column | str) -> Column:
    return F.when(F.rlike(_c(text), F.lit("[༠-༩]")), "tibetan").when(F.rlike(_c(text), F.lit("[०-९]")), "devanagari").when(F.rlike(_c(text), F.lit("[0-9]")), "ascii").otherwise("none")


def to_ascii_digits(text: Column | str) -> Column:
    return F.translate(_c(text), "༠༡༢༣༤༥༦༧༨༩०१२३४५६७८९", "01234567890123456789")


def corrected(text: Column | str, find: Column | str, by: Column | str) -> Column:
    """A human correction applied where there is one for the row."""
    return F.when(_c(find).isNotNull(), F.replace(_c(text), _c(find), F.coalesce(_c(by), F.lit("")))).otherwise(_c(text))


#: Names under which the functions of one text argument can be called in SQL once `register` has run.
SQL_NAMES = ("squeeze", "letters_only", "loose_form", "lemma", "slug", "script", "plain_html", "message_text", "syllable_count", "delimiter_key", "work_day")


def register(spark) -> None:
    """Makes `SQL_NAMES` callable in ``spark.sql`` as temporary SQL functions, inlined by the optimizer and so inside the JVM."""
    for name in SQL_NAMES:
        kind, out = ("timestamp", "date") if name == "work_day" else ("string", "bigint" if name.endswith("count") else "string")
        probe = spark.range(1).select(F.lit(None).cast(kind).alias("x")).select(globals()[name]("x").alias("y"))
        body = probe._jdf.queryExecution().analyzed().expressions().head().child().sql()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {kind}) RETURNS {out} RETURN CAST({body} AS {out})")
