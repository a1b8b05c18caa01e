from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import fold, letters, tibetan
from lectern.functions import text as T


@pytest.fixture(scope="module")
def value(spark):
    def of(column, **cols):
        df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols)) if cols else spark.range(1)
        return df.select(column.alias("v")).first()["v"]
    return of


def test_tokens(value):
    x = "---\na: b\n---\n# The self-made Āryas 12 ^1-2\n![[x#^1]]\nblazing wheels"
    assert value(T.english_tokens("x"), x=x) == ["the", "self-made", "āryas", "blazing", "wheels"]
    assert value(T.term_tokens("x"), x=x) == ["self-made", "āryas", "blazing", "wheels"]
    assert value(T.formula_words("x"), x="So [he] said: 123 the very Good-bye") == ["said", "bye"]
    assert value(T.diacritic_tokens("x"), x="Evaṃ me sutaṃ ekaṃ 12 bhagavā") == ["evaṃ", "sutaṃ", "ekaṃ", "bhagavā"]


def test_natural_sort(spark):
    rows = [(i,) for i in ("1-10", "1-2", "1-100", "a-1", "I-2")]
    got = [r[0] for r in spark.createDataFrame(rows, "id string").orderBy(T.natural_key("id")).collect()]
    assert got == ["1-2", "1-10", "1-100", "I-2", "a-1"]
    rows = [(i,) for i in ("1-272", "1-0a-1", "1-2", "1-10")]
    assert [r[0] for r in spark.createDataFrame(rows, "id string").orderBy(T.suffixed_key("id")).collect()] == ["1-0a-1", "1-2", "1-10", "1-272"]


def test_ids(value):
    assert value(T.expand_range("a", "b"), a="c-1-2", b="c-1-4") == ["c-1-2", "c-1-3", "c-1-4"]
    assert value(T.expand_range("a", "b"), a="c-1-2", b="c-2-4") is None
    assert value(T.claim_node("a"), a="c-1-1-4-2") == "1.1.4"
    assert value(T.decimal_block_id("a"), a="1.3.2.2") == "^1-3-2-2-0"
    assert value(T.reference_list("a"), a="1-3, 5. text") == [1, 2, 3, 5]


def test_forms(value):
    assert value(T.loose_form("a"), a="The blazing fires") == "blaz fir"
    assert value(T.match_tier("a", "b"), a="blazing fire", b="blazed a fire at night") == "loose"
    assert set(value(T.variants("a"), a="making")) == {"making", "makings", "makinges", "mak", "make"}
    assert value(T.lemma("a"), a="Buddha-Nom…pe…") == "buddha"
    assert value(T.message_text("a"), a=" <@12> see <#3> <:ok:9> ") == "@someone see #channel :ok:"
    assert value(T.script("a"), a="བདེ་ abc") == "tibt" and value(T.script("a"), a="") == "latn" and value(T.script("a"), a="नमः x") == "deva"
    assert value(T.slug("a"), a=" Hello, World! ") == "hello_world"
    assert value(T.plain_html("a"), a="<p>a &amp; <b>b</b></p><script>x</script>") == "a & b"
    assert value(T.unwrap_wikilinks("a"), a="[[x|y]] and [[z]]") == "y and z"
    assert value(T.band(F.lit(600.0))) == "medium"


def test_tibetan(value):
    assert value(T.syllable_count("a"), a="བདེ་གཤེགས་ཆོས།") == 3
    assert value(F.array_join(T.syllables("a"), "|"), a="བདེ་གཤེགས། ཆོས།") == "བདེ|གཤེགས|ཆོས"
    assert value(T.delimiter_key("a"), a="བདེ་ གཤེགས།") == "བདེགཤེགས"
    assert tibetan.affix_parts("པའི") == ["པ", "འི"] and tibetan.affix_parts("ཆོས") == ["ཆོས"]
    assert value(tibetan.perplexity_text("a"), a="པའི་ཆོས་༡༢།\nབདེ།") == "པ འི ཆོས D ། བདེ །"
    assert value(tibetan.bold_roots("a"), a="ན་འཐད༷་པ༷་བཞི་དང༷་བཅ༷ས་པ") == "ན་ **འཐད་པ་** བཞི་ **དང་བཅས་** པ"
    assert value(tibetan.line_breaks("a"), a="ཀ། །ཁ། ག") == "ཀ། །\nཁ། \nག"
    assert value(F.array_join(tibetan.mid_verse_lines("a"), "/"), a="ཀ། །ཁ། ། ^1-2") .endswith("^1-2")
    row = value(tibetan.precleaned("a"), a="# ཀ་ abc 12\n> ཁ ^1-1")
    assert (row["hashes"], row["latin"], row["ascii_digits"], row["blockquotes"]) == (1, 1, 3, 1)
    c = value(tibetan.canon("a"), a="ཀ། ཁ")
    assert c["canon"] == "ཀཁ" and c["places"] == [0, 3]
    assert value(tibetan.removed_numbers("a", F.array(F.lit(25))), a="bliss,25 x 25 a25b") == "bliss, x 25 ab"


def test_normal_forms(value):
    assert value(fold.nfc("a"), a="é") == "é"
    assert value(fold.plain("a"), a="Āryā é") == "Arya e"
    assert value(fold.phrase("a"), a="“Ārya”  Ś") == '"arya" s'
    assert value(fold.corpus("a"), a="a​ b\x07") == "a b"
    assert fold.greedy_phrases("the four noble truths here".split(), frozenset({"four noble truths", "noble truths"})) == ["the", "four noble truths", "here"]


def test_alignment_functions():
    assert fold.similarity("abcd", "bcde") == 0.75 and fold.similarity("abcd", "wxyz", 0.5) == 0
    assert letters.locate_letters("A, bcd efg", "cd e") == 2 and letters.locate_letters("abc", "zzz") == -1 and letters.locate_letters("ab ab ab", "ab", 3) == 4
    assert letters.letter_span("xx abcdefgh ijkl mnop yy", "abcdefgh mnop") is None and letters.letter_span("xx abcdefgh ij mnopqrst yy", "abcdefghmnopqrst") == (2, 20)  # by its ends
    assert fold.align_outline(["alpha", "beta"], ["noise", "alpha", "betas"]) == [(0, 1), (1, 2)]
    chain = fold.anchor_chain("abcdefgh12345678", "zzabcdefgh__12345678", 4)
    assert chain[0] == (0, 2) and chain[-1] == (12, 16)


@settings(deadline=None, max_examples=50)
@given(st.text(alphabet="abc ", max_size=30), st.text(alphabet="abc ", max_size=30))
def test_anchor_chains_rise(a, b):
    chain = fold.anchor_chain(a, b, 3)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(chain, chain[1:], strict=False))
    assert all(a[x:x + 3] == b[y:y + 3] for x, y in chain)


def test_sql_names(spark):
    T.register(spark)
    row = spark.sql("select squeeze('a b') a, script('བོད') b, plain_html('<p>a') c, cast(work_day(timestamp'2024-01-01 20:00:00') as string) d").first()
    assert tuple(row) == ("ab", "tibt", "a", "2024-01-02")


def test_script_of_a_whole_text(spark):
    row = spark.createDataFrame([("a" * 30_000 + "བོད" * 20_000,)], "t string").select(T.script("t").alias("whole"), T.script("t", 20_000).alias("head")).first()
    assert (row["whole"], row["head"]) == ("tibt", "latn")
