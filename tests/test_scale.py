"""What operators send and read, by their plans and by what they call."""

from __future__ import annotations

import difflib
import random

from pyspark.sql import functions as F

from lectern.functions import blocks, fixed, windows
from lectern.functions import text as T
from lectern.operators import align, fuzzy, intake, stanzas, terms
from lectern.plans import base, files, planted, text
from lectern.sources import books, notes
from lectern.sources.stage import dealt


blocks_common = blocks.common_subsequence


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_line_needs_no_letters():
    p = windows.Passage("b a  b c a b")
    assert p.best("a b") == (1.0, "a b") and "sums" not in vars(p)
    assert p.best("b d a")[1] == "b c a" and "sums" in vars(p)


def test_lines_of_a_passage_go_together(spark):
    lines = spark.createDataFrame([(1, "a b", 7), (1, "c x", 8), (2, "a", 9)], "k long, line string, n long")
    got = align.best_windows(lines, spark.createDataFrame([(1, "z a b c d"), (2, None)], "k long, passage string"), "k")
    assert "BroadcastHashJoin" not in plan(got) and "collect_list" in plan(got)
    assert sorted((r["k"], r["n"], r["window"]) for r in got.collect()) == [(1, 7, "a b"), (1, 8, "c d"), (2, 9, "")]


def test_long_runs_are_found_by_seeds(monkeypatch):
    dice = random.Random(3)
    lines = ["".join(dice.choice("abcdefghij ") for _ in range(dice.randint(60, 90))) for _ in range(12)]
    a, b = "\n".join(lines), "###".join(lines)
    want = [(m.a, m.b, m.size) for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
    monkeypatch.setattr(blocks, "_longest", None)
    assert blocks.matching_blocks(a, b) == want
    monkeypatch.undo()
    for _ in range(40):
        words = ["".join(dice.choice("abc") for _ in range(dice.randint(1, 9))) for _ in range(dice.choice((3, 30)))]
        a = " ".join(dice.choices(words, k=150))
        at = sorted(dice.sample(range(len(a)), 3))
        b = a[at[1]:at[2]] + "#" + a[:at[0]] + a[at[0] + 9:]
        want = [(m.a, m.b, m.size) for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
        assert blocks.matching_blocks(a, b) == want


def test_words_of_a_text_are_counted_in_its_row(spark):
    docs = spark.createDataFrame([(1, "The cat saw NATO. A Cat ran!\nThe cat"), (2, None), (3, "..."), (4, "of a")], "k long, text string")
    got = terms.keyword_features(docs, "k")
    assert "Exchange" not in plan(got)
    assert sorted((r["k"], r["word"], r["tf"]) for r in got.collect()) == [(1, "cat", 3), (1, "nato", 1), (1, "ran", 1), (1, "saw", 1)]


def test_first_example_is_a_text(spark):
    source = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (1, "y")], "pair long, token string")
    texts = spark.createDataFrame([(1, None), (2, "two"), (3, "three")], "pair long, text string")
    got = sorted(tuple(r) for r in terms.first_examples(source, texts, "pair", "pair").collect())
    assert got == [("x", "two", 1), ("y", None, 1)]


def test_no_side_of_a_table_is_broadcast(spark):
    spans = spark.createDataFrame([(1, "p", 0, 5)], "k long, block_id string, start long, end long")
    texts = spark.createDataFrame([(1, "abc def", "abc xx def")], "k long, a string, b string")
    rows = spark.createDataFrame([(1, 1, ["abcdef", "ghijkl"])], "doc_id long, stanza_id long, lines array<string>")
    for df in (align.overlap_join(spans, spans, "k"), intake.overlaid(spans.drop("block_id"), spans, "k"), align.projected_spans(spans.select("k", "start", "end"), texts, "k"), stanzas.stanza_places(rows, rows.select("doc_id", "lines"))):
        assert "BroadcastExchange" not in plan(df) and df.count() == 1


def test_best_rejected_query_has_no_floor_near_its_rows(spark):
    found = files.p_best_rejected(spark, "/root/testdata/sf0.001").collect()
    assert len(found) > 50 and {r["score"] for r in found} == {round(64 / 96, 9)} and all(r["a"] == r["b"] and r["a"] % 2 for r in found)


def test_short_texts_are_compared_at_once(monkeypatch):
    dice = random.Random(5)
    texts = ["".join(dice.choices("abcdefghij𝄞", k=dice.choice((30, 40, 63)))) for _ in range(60)] + [""]
    texts += [t[:12] + "#" + t[13:] for t in texts]
    for least in (0.5, 0.9):
        want = [(i, j, blocks.ratio_of(t, u)) for i, t in enumerate(texts) for j, u in enumerate(texts) if blocks.ratio_of(t, u) >= least]
        monkeypatch.setattr(blocks, "common_subsequence", lambda a, b, least=0: blocks_common(a, b, least) if calls.append(a) is None else 0)
        calls = []
        assert fuzzy.compare(texts, texts, least) == want
        assert len(calls) < len(texts) ** 2 / (1 if least == 0.5 else 20)
        monkeypatch.undo()


def test_best_rejected_leaves_out_equal_texts_first(spark):
    a = spark.createDataFrame([(1, "abcdefgh"), (2, "abcdefxx"), (3, None)], "a long, text string")
    b = spark.createDataFrame([(7, "abcdefgh"), (8, "zzzz")], "b long, text string")
    got = fuzzy.best_rejected(a, b, "a", "b", 0.9)
    assert [(r["a"], r["b"]) for r in got.collect()] == [(2, 7)]
    assert [(r["a"], r["b"], r["score"]) for r in fuzzy.best_rejected(a, b, "a", "b", 1.5).orderBy("a").collect()] == [(1, 7, 1.0), (2, 7, 0.75)]


def test_terms_are_counted_in_their_row(spark):
    docs = spark.createDataFrame([(1, "x", "Bodhi-tree, bodhi! śīla śīla"), (2, "x", "the"), (3, "x", None), (None, "y", "seven karmas"), (None, "y", "karmas")], "doc_id long, lang string, text string")
    got = terms.counted(docs.where("doc_id is not null"), ["doc_id", "lang"])
    assert "Exchange" not in plan(got)
    assert sorted((r["doc_id"], r["word"], r["count"]) for r in got.collect()) == [(1, "bodhi", 1), (1, "bodhi-tree", 1), (1, "śīla", 2)]
    assert {(r["doc_id"], r["word"], r["count"]) for r in terms.counted(docs, ["doc_id", "lang"]).where("lang = 'y'").collect()} == {(None, "karmas", 2)}


def test_words_without_the_passes_that_change_none(spark):
    dice = random.Random(11)
    signs = ["a", "Bé", "ñ", "Ō", "×", "\xaa", "ŋ", "-", "--", " ", "\n", "#", "[", "*", "7", "^", "^a-1", "![[", "]]", "---\n", "\n---", "K", "|"]
    rows = [("".join(dice.choices(signs, k=dice.randint(0, 30))),) for _ in range(400)] + [(None,), ("---\na: b\n---\nc",)]
    word = f"[a-zA-Z{fixed.TRANSLITERATION}À-ÖØ-öø-ÿß]+"
    plain = F.transform(F.regexp_extract_all(T.plain_markup("t"), F.lit(f"{word}(?:-{word})*"), F.lit(0)), F.lower)
    df = spark.createDataFrame(rows, "t string").select("t", plain.alias("want"), T.english_tokens("t").alias("got"))
    assert [r for r in df.collect() if r["want"] != r["got"]] == []
    assert plan(df.select("got")).count("regexp_replace") == 3


def test_word_counts_are_written_once(spark):
    assert "documents" not in plan(text.h_two_word_splits(spark, "/root/testdata/sf0.001"))


def test_terms_of_a_verse_go_together(spark):
    found = spark.createDataFrame([("a", "A b", 1), ("a", "a b", 2), ("c", "zz", 1), ("c", "zz", 1), ("d", None, 1), ("e", "x", None)], "term string, rendering string, verse_id long")
    got = terms.evidence_ratio(found, spark.createDataFrame([(1, "xa By"), (2, None), (3, "a b")], "verse_id long, text string"))
    assert "collect_list" in plan(got)
    assert sorted(map(tuple, got.collect())) == [("a", "A b", 1, 1, 1.0), ("c", "zz", 2, 0, 0.0), ("d", None, 1, None, None)]


def test_edges_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(align, "BACK_ROWS", 1)
    edges = spark.createDataFrame([("a", "t", 1), ("a", "t", 1), ("a", "t", 3), ("b", "t", 2), ("b", "t", None), ("c", "u", 9)], "src_note string, dst_note string, dst_block long")
    order = spark.createDataFrame([("t", 1, 5), ("t", 1, 9), ("t", 2, 1), ("t", 3, 7)], "dst_note string, dst_block long, pos long")
    got = align.back_references(edges, order)
    assert plan(got).count(", 6), REPARTITION_BY_NUM") == 3
    assert sorted(map(tuple, got.collect())) == [("t", "a", 1, 1, 2), ("t", "b", 2, 2, 1)]


def test_references_are_compared_in_their_row(spark):
    rows = spark.createDataFrame([(1, 1, "1-3. a"), (1, 2, "3, 7."), (1, 3, "b"), (2, 1, "c"), (2, 2, "4. d"), (None, 1, "1. e")], "k long, pos long, text string")
    got = intake.referenced(rows, spark.createDataFrame([(1, 1), (1, 3), (1, 3), (None, 1), (1, None)], "k long, ref int"), "k")
    assert "Generate" not in plan(got)
    assert sorted((r["k"], r["pos"], r["refs"], r["unknown"]) for r in got.collect()) == [(1, 1, [1, 3], [2]), (1, 3, [3], [7]), (2, 1, [], []), (2, 2, [], [4])]


def test_lines_of_a_part_stay_in_its_task(spark, monkeypatch):
    monkeypatch.setattr(base, "PART_ROWS", 10)
    units = notes.typed_units(planted._texts(spark, "/root/testdata/sf0.001", "name", "kind"), ["k"])
    assert plan(units).count("Exchange hashpartitioning") == 1 and ", 20), REPARTITION_BY_NUM" in plan(units)


def test_pairs_of_a_text_are_counted_in_its_row(spark):
    docs = spark.createDataFrame([(1, "a b a b c"), (2, "a"), (3, ""), (4, None), (5, "c c c b")], "k long, text string")
    got = terms.perplexity(terms.pair_logs(terms.bigrams(docs, "k"), "k"), "k")
    assert "Window" not in plan(got)
    words = docs.select("k", F.posexplode(T.english_tokens("text")).alias("pos", "word"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, terms.perplexity(terms.bigram_logs(words, "k", "pos"), "k").collect()))


def test_phrases_are_counted_once_in_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(terms, "PHRASE_TASK_BYTES", 100)
    docs = spark.createDataFrame([(i, "red deer run far " * 2) for i in range(3)] + [(9, "red deer")], "k long, text string")
    assert dealt(spark.range(100), ["id"], 80).rdd.getNumPartitions() == 10 and dealt(docs, ["k"], 80).rdd.getNumPartitions() == 4
    got = terms.phrases(docs, ["k"])
    assert "concat_ws" not in plan(got)
    assert {(r["phrase"], r["df"]) for r in got.collect()} == {("red deer run far", 3), ("deer run far red", 3), ("run far red deer", 3), ("far red deer run", 3)}


def test_script_without_passes_over_latin_texts(spark):
    rows = [("abc", "latn", False), ("été", "latn", False), ("བོད་ abc xyz", "latn", False), ("བོད་ཡིག ab", "tibt", True), ("ab བོད", "tibt", True), ("कखग བོད", "deva", False), ("བོད་ ab1", "tibt", True), ("", "latn", False), (None, None, None)]
    df = spark.createDataFrame([r[:1] for r in rows], "t string").select("t", T.script("t").alias("s"), T.has_stray_latin("t").alias("x"))
    assert [r["s"] for r in df.collect()] == [r[1] for r in rows]
    assert "octet_length" in plan(df)


def test_concordance_reads_few_texts_at_a_time(spark):
    got = align.concordance(spark.createDataFrame([(str(i), ["abc def", "ghi"], ["abcdefg", "hi"]) for i in range(200)], "work string, a array<string>, b array<string>"))
    assert "MapInArrow" in plan(got) and got.count() == 400


def test_word_files_are_read_by_arrow(spark):
    assert "MapInArrow" in plan(books.word_notes(spark.createDataFrame([("a", b"")], "path string, content binary")))
