"""Functions for Tibetan text: marks, affixes, line breaks, cleaning. Column expressions, but for the recursive affix split."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as K

from lectern.functions.text import _c

# Case affixes, marks of emphasis on root words, honorific marks, the head marks and digits.
AFFIXES = ("འིས", "འི", "འོ", "འམ", "འང", "འས", "འད", "འར")
ROOT_MARK = "༷"
HONORIFICS = "༹༵༷"
HEAD_MARKS = "༄༅༆༇༈"
LETTERS = "ཀ-ྼ"


def affix_parts(syllable: str) -> list[str]:
    """A syllable's stem and its case affixes; the terminative after འུ is an affix too."""
    if syllable.endswith("འུར") and len(syllable) > 3:
        return [*affix_parts(syllable[:-1]), "ར"]
    for a in AFFIXES:
        if syllable.endswith(a) and len(syllable) > len(a):
            return [*affix_parts(syllable[:-len(a)]), a]
    return [syllable]


@F.pandas_udf(K.StringType())
def split_affixes(s: pd.Series) -> pd.Series:
    """Affixes split off all syllables by spaces."""
    one = re.compile(f"[{LETTERS}]+")
    return s.map(lambda t: one.sub(lambda m: " ".join(affix_parts(m[0])), t) if isinstance(t, str) else None)


@F.pandas_udf(K.StringType())
def reordered(s: pd.Series) -> pd.Series:
    """Normal form with the marks of each stack in one order: subjoined letters, vowels below, vowels above, other marks."""
    def rank(c: str) -> int:
        if 0x0F90 <= ord(c) <= 0x0FBC:
            return 0
        if c in "྄ཱུ":
            return 1
        return 2 if c in "ཱིེཻོཽྀ" else 3

    def fix(t: str) -> str:
        out: list[str] = []
        run: list[str] = []
        for c in unicodedata.normalize("NFC", t) + "\0":
            if unicodedata.category(c) == "Mn":
                run.append(c)
                continue
            out += [*sorted(run, key=rank), c]
            run = []
        return "".join(out)[:-1]

    return s.map(lambda t: fix(t) if isinstance(t, str) else None)


def model_tokens(text: Column | str) -> Column:
    """Text as a language model reads it: plain marks, digit runs as D, clause ends as །, spaces between syllables."""
    t = _c(text)
    steps = (("࿒", "་"), ("་{2,}", "་"), (f"[{HONORIFICS}]", ""), ("[ྂྃ]", "ཾ"), (f"([{LETTERS}])\n", "$1་\n"), ("\n", ""), (f"[{HEAD_MARKS}]", ""), ("[0-9༠-༳][0-9༠-༳, ]*", "D"), ("[^ༀ-࿿ D]", " "), ("[།-༔ ]+", " ། "), ("([༼༽])", " $1 "))
    for pattern, by in steps:
        t = F.regexp_replace(t, pattern, by)
    return t


def spaced(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, "་", " "), " {2,}", " "))


def perplexity_text(text: Column | str) -> Column:
    return spaced(split_affixes(model_tokens(text)))


def bold_roots(text: Column | str) -> Column:
    """Runs of marked syllables in bold, the marks taken off; a space before a bold run that has none, and one after it."""
    syllable = f"[^་། \n]*{ROOT_MARK}[^་། \n]*[་། \n]?"
    t = F.regexp_replace(_c(text), f"((?:{syllable})+)", " **$1** ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, ROOT_MARK, ""), r"\A \*\*", "**"), "  \\*\\*", " **")


def line_breaks(text: Column | str) -> Column:
    """A line break after each group of clause marks: pairs as they are, a single one with a space, none before a closing bracket; closing emphasis stays with its clause."""
    t = F.regexp_replace(_c(text), r"\s+", " ")
    t = F.regexp_replace(t, "((?:[།༎༑༔] ?)*[།༎༑༔])(\\*\\*|\\*|_)? ?(?![།༎༑༔\\]\\)༽]|$)", "$1$2\n")
    return F.regexp_replace(t, "(?<![།༎༑༔] ?)([།༎༑༔])\n", "$1 \n")


def mid_verse_lines(line: Column | str) -> Column:
    """Lines of a merged verse line: cut after a spaced single mark inside it and after a pair; a closing id goes with the last."""
    core = F.regexp_replace(_c(line), r"(\s*\^\S+)\s*$", "")
    tail = F.regexp_extract(_c(line), r"(\s*\^\S+)\s*$", 1)
    cut = F.regexp_replace(F.regexp_replace(core, "(?<!།) །(?=[^\\s།])", " །\u0001"), "། །(?=[ༀ-ཿ])", "། །\u0001")
    parts = F.filter(F.transform(F.split(cut, "\u0001"), lambda p: F.trim(p)), lambda p: p != "")
    n = F.size(parts)
    return F.when(n == 0, F.array(_c(line))).otherwise(F.concat(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(F.concat(F.element_at(parts, -1), tail))))


# What cleaning takes out, in order, by name.
CLEANING = (("git_markers", r"(?m)^(<{7}|={7}|>{7}).*$\n?"), ("blockquotes", r"(?m)^[ \t]*>[ \t]?"), ("bare_headings", r"(?m)^[ \t]*#+[ \t]*$\n?"), ("hashes", "#"), ("latin", "[A-Za-z]+"), ("ascii_digits", "[0-9]+"), ("replacement_chars", "�"), ("block_ids", r"\^[\w-]+"), ("numbers", "(?<![༠-༩ཀ-ྼ])[༠-༩]+(?![༠-༩ཀ-ྼ])"))


def precleaned(text: Column | str) -> Column:
    """Struct of the cleaned text, its paragraphs joined into lines, and how much each pass took out."""
    t, counts = F.regexp_replace(_c(text), r"(?s)\A---.*?\n---\n?", ""), []
    for name, pattern in CLEANING:
        counts.append(F.regexp_count(t, F.lit(pattern)).alias(name))
        t = F.regexp_replace(t, pattern, "")
    joined = F.regexp_replace(F.regexp_replace(t, r"(?<!\n)\n(?!\n)", " "), r"[ \t]+", " ")
    joined = F.regexp_replace(F.regexp_replace(joined, "་ +", "་"), "(?<!༅)(། །) +(?=[ཀ-ྼ])", "$1\n\n")
    return F.struct(F.trim(joined).alias("text"), *counts)


def canon(text: Column | str) -> Column:
    """Struct of the text without spaces and clause marks, and the place of each of its characters in the text."""
    chars = F.filter(F.transform(F.split(_c(text), ""), lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda s: ~F.rlike(s["c"], F.lit("^[\\s།༎༔]?$")))
    return F.struct(F.array_join(F.transform(chars, lambda s: s["c"]), "").alias("canon"), F.transform(chars, lambda s: s["i"]).alias("places"))


def transclusion_norm(text: Column | str) -> Column:
    """Without transclusions, ids, bold and punctuation."""
    t = _c(text)
    for pattern in (r"!\[\[[^\]]*\]\]", r"\^[\w-]+", r"\*\*", r"[།༎༔༄༅༈\p{Punct}\s]"):
        t = F.regexp_replace(t, pattern, "")
    return t


def removed_numbers(line: Column | str, numbers: Column) -> Column:
    """The line without the approved digit runs that are glued to a word."""
    return F.aggregate(numbers, _c(line), lambda t, n: F.regexp_replace(t, F.concat(F.lit(r"(?<=[^\s^\-\d])"), n.cast("string"), F.lit(r"(?!\d)")), F.lit("")))
