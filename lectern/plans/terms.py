"""Queries on term statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import terms
from lectern.plans.base import IDF_SQL, RANKED_SQL, SCORED_SQL, STOP, TF_SQL, TOKENS_SQL, Listing, sql_formula, sql_terms, sql_variants, sql_words, table
from lectern.sources.stage import staged

L = Listing()
LANGS = ["de", "en", "es", "fr"]
TOP = 50


def _words(spark, sf_dir):
    """The terms of every document, counted and written once: no query reads the texts twice."""
    return staged(terms.counted(table(spark, sf_dir, "documents"), ["doc_id", "lang"]))


def _scored(spark, sf_dir):
    words = _words(spark, sf_dir)
    return words, terms.tf_idf(terms.term_frequency(words, ["lang"]), terms.smooth_idf(words, "doc_id"))


@L.add("C1 C2", f"with {TF_SQL} select lang, word, \"count\", total from tf")
def f_term_frequency(spark, sf_dir):
    return terms.term_frequency(_words(spark, sf_dir), ["lang"])


@L.add("F8", f"with {TOKENS_SQL}, {IDF_SQL} select word, df, idf from idf")
def f_smooth_idf(spark, sf_dir):
    return terms.smooth_idf(_words(spark, sf_dir), "doc_id")


@L.add("F1 F2", f"with {RANKED_SQL} select lang, word, \"count\", total, idf, score, rank from ranked")
def f_tfidf_keywords(spark, sf_dir):
    return terms.ranked(_scored(spark, sf_dir)[1], ["lang"]).select("lang", "word", "count", "total", "idf", "score", F.col("rank").cast("long").alias("rank"))


@L.add("C49", f"with {SCORED_SQL} select lang, band, count(*) as n from (select lang, case when score >= 50000 then 'dominant' when score >= 10000 then 'very high' when score >= 3000 then 'high' when score >= 500 then 'medium' when score >= 50 then 'low' else 'very low' end as band from scored) group by all")
def c_score_bands(spark, sf_dir):
    return _scored(spark, sf_dir)[1].groupBy("lang", T.band("score").alias("band")).agg(F.count("*").alias("n"))


@L.add("F4", f"with {SCORED_SQL}, o as (select a.lang, a.word, a.score, coalesce((select max(b.score) from scored b where b.word = a.word and b.lang <> a.lang), 0) as best_other from scored a), k as (select *, row_number() over (partition by lang order by score desc, word) as rank from o where score >= 3 * best_other) select lang, rank, word, score, best_other from k where rank <= 25")
def f_signature_terms(spark, sf_dir):
    return terms.signature_terms(_scored(spark, sf_dir)[1], "lang").withColumn("rank", F.col("rank").cast("long"))


@L.add("F3", f"with {SCORED_SQL} select word, " + ", ".join(f"coalesce(max(score) filter (lang = '{x}'), 0) as {x}" for x in LANGS) + ", round((" + " + ".join(f"coalesce(max(score) filter (lang = '{x}'), 0)" for x in LANGS) + ") / 4, 6) as avg_score from scored group by word")
def f_cross_lang_pivot(spark, sf_dir):
    return terms.comparison(_scored(spark, sf_dir)[1], "lang", LANGS)


TOP_SQL = f"{RANKED_SQL}, top as (select word, min(rank) as rank, max(score) as score from ranked where rank <= {TOP} group by word), occ as (select word, doc_id, count(*) as c from tok join top using (word) group by all)"


def _top(spark, sf_dir):
    words, scored = _scored(spark, sf_dir)
    top = terms.ranked(scored, ["lang"], TOP).groupBy("word").agg(F.min("rank").alias("rank"), F.max("score").alias("score"))
    return words, staged(top)  # at most TOP a language


@L.add("F5 E13 B3", f"with {TOP_SQL}, total as (select word, sum(c)::bigint as total_count from occ group by word) select word, doc_id // 1000 as part, any_value(rank) as rank, any_value(score) as score, any_value(total_count) as total_count, string_agg(doc_id || ':' || c, ',' order by doc_id) as occurrences from occ join top using (word) join total using (word) group by 1, 2")
def f_keyword_occurrences(spark, sf_dir):
    words, top = _top(spark, sf_dir)
    found = terms.keyword_blocks(terms.occurrences(words.join(F.broadcast(top.select("word")), "word"), ["doc_id"]), top, ["doc_id"], F.expr("doc_id div 1000"))
    flat = F.array_join(F.transform("occurrences", lambda o: F.concat_ws(":", o["doc_id"].cast("string"), o["count"].cast("string"))), ",")
    return found.select("word", "part", F.col("rank").cast("long").alias("rank"), "score", "total_count", flat.alias("occurrences"))


@L.add("F7", f"with {TOP_SQL} select doc_id, string_agg(rank || ':' || word, ',' order by rank, word) as keywords from (select distinct doc_id, word from occ) join top using (word) group by doc_id")
def f_document_keywords(spark, sf_dir):
    words, top = _top(spark, sf_dir)
    found = terms.block_keywords(terms.keyword_blocks(terms.occurrences(words.join(F.broadcast(top.select("word")), "word"), ["doc_id"]), top, ["doc_id"], F.expr("doc_id div 1000")), "doc_id")
    return found.select("doc_id", F.array_join(F.transform("keywords", lambda k: F.concat_ws(":", k["rank"].cast("string"), k["word"])), ",").alias("keywords"))


@L.add("F6", f"with {SCORED_SQL}, most as (select word, \"count\", score from scored where lang = 'en' order by \"count\" desc, word limit 100) select word, \"count\", score, row_number() over (order by score, word) as bottom_rank from most")
def f_bottom_n_frequent(spark, sf_dir):
    return terms.bottom_frequent(_scored(spark, sf_dir)[1].where("lang = 'en'").select("word", "count", "score"), 100).withColumn("bottom_rank", F.col("bottom_rank").cast("long"))


@L.add("E14 C21", f"with {RANKED_SQL}, top as (select word, rank from ranked where lang = 'en' and rank <= 60), cov as (select distinct unnest({sql_terms('text')}) as word from benchmark), forms as (select distinct unnest({sql_variants('word')}) as form from cov), v as (select word, unnest({sql_variants('word')}) as form from top) select word, rank from top where word not in (select word from v where form in (select form from forms))")
def e_keyword_gaps(spark, sf_dir):
    top = terms.ranked(_scored(spark, sf_dir)[1].where("lang = 'en'"), ["lang"], 60).select("word", F.col("rank").cast("long").alias("rank"))
    covered = table(spark, sf_dir, "benchmark").select(F.explode(T.term_tokens("text")).alias("word")).distinct()
    return terms.keyword_gaps(top, covered)


_GRAMS = " union all ".join(f"select doc_id, array_to_string(w[i:i+{n - 1}], ' ') as phrase, {n} as n from fw, unnest(range(1, len(w) - {n} + 2)) as t(i)" for n in (2, 3, 4))
PHRASE_SQL = f"fw as (select doc_id, {sql_formula('text')} as w from documents), g as ({_GRAMS}), good as (select phrase, count(distinct doc_id) as df, any_value(n)::int as n_words from g group by phrase having count(distinct doc_id) >= 3)"
_PARTS = " union ".join(f"select array_to_string(string_split(phrase, ' ')[i:i+{k - 1}], ' ') as phrase from good, unnest(range(1, n_words - {k} + 2)) as t(i) where n_words > {k}" for k in (2, 3))


@L.add("F12 C3", f"with {PHRASE_SQL}, inside as ({_PARTS}) select phrase, df, n_words from good where phrase not in (select phrase from inside)")
def f_ngram_phrases(spark, sf_dir):
    return terms.phrases(table(spark, sf_dir, "documents"), ["doc_id"])


_FEATURES = f"""se as (select doc_id, i - 1 as sent, s[i] as t from (select doc_id, regexp_split_to_array(text, '[.!?\\n]+') as s from documents), unnest(range(1, len(s) + 1)) as x(i)),
tk as (select doc_id, sent, i - 1 as pos, f[i] as form, lower(f[i]) as word from (select doc_id, sent, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+') as f from se), unnest(range(1, len(f) + 1)) as x(i)),
ft as (select *, upper(form) = form and length(form) > 1 as up, lag(word) over w as before, lead(word) over w as after from tk window w as (partition by doc_id, sent order by pos)),
pw as (select doc_id, word, count(*) as tf, count(*) filter (up and not regexp_full_match(form, '\\p{{N}}+')) as acronyms, count(*) filter (upper(left(form, 1)) = left(form, 1) and lower(left(form, 1)) <> left(form, 1) and not up and pos > 0) as capitals,
 length(word) > 2 and not list_contains({STOP}, word) as content, count(distinct sent) as in_sents, median(sent) as middle, count(distinct before) as kb, count(before) as nb, count(distinct after) as ka, count(after) as na from ft group by doc_id, word),
dc as (select doc_id, max(tf) as most, coalesce(avg(tf) filter (content), 0) as mean, coalesce(stddev_pop(tf) filter (content), 0) as spread from pw group by 1), ds as (select doc_id, count(distinct sent) as sents from tk group by 1),
rl as (select *, 1 + (case when nb > 0 then kb / nb else 0 end + case when na > 0 then ka / na else 0 end) * tf / most as rel from pw join dc using (doc_id) join ds using (doc_id) where content)"""


@L.add("F9", f"with {_FEATURES} select doc_id, word, tf, round(rel * ln(ln(3 + middle)) / (greatest(acronyms, capitals) / (1 + ln(tf)) + tf / (mean + spread) / rel + in_sents / sents / rel), 6) as score from rl")
def f_document_features(spark, sf_dir):
    return terms.keyword_features(table(spark, sf_dir, "documents"), "doc_id")


@L.add("F9", f"with {_FEATURES}, sc as (select doc_id, word, tf, round(rel * ln(ln(3 + middle)) / (greatest(acronyms, capitals) / (1 + ln(tf)) + tf / (mean + spread) / rel + in_sents / sents / rel), 6) as score from rl), k as (select doc_id, count(*) as n, min(score) as best from sc where score <= 0.3 group by 1) select * from k")
def f_document_keyphrases(spark, sf_dir):
    found = terms.best_keywords(terms.keyword_features(table(spark, sf_dir, "documents"), "doc_id"), "doc_id")
    return found.groupBy("doc_id").agg(F.max("rank").cast("long").alias("n"), F.min("score").alias("best"))


KEY_SQL = f"{TOKENS_SQL}, {IDF_SQL}, ks as (select word, df, idf, round(df / n * idf, 9) as score from idf, nd where df >= 2 and idf >= 3.5 order by score desc, word limit 600)"


@L.add("F10 F11", f"with {KEY_SQL} select word, df, idf, score from ks")
def f_keyword_scores(spark, sf_dir):
    return terms.keyword_scores(_words(spark, sf_dir), "doc_id")


PAIR_SQL = f"{KEY_SQL}, src as (select distinct doc_id // 2 as pair, word as token from tok where doc_id % 2 = 0), kw as (select word as keyword from ks order by score desc, word limit 200), tgt as (select distinct doc_id // 2 as pair, word as keyword from tok where doc_id % 2 = 1 and word in (select keyword from kw)), rare as (select token from src group by token having count(*) <= 20), s2 as (select * from src where token in (select token from rare) and pair in (select pair from tgt)), sh as (select pair, 1.0::double / count(*) as weight from s2 group by pair), co as (select keyword, token, count(*) as raw, round(sum(weight), 9) as weighted from tgt join s2 using (pair) join sh using (pair) group by all)"


def _pairs(spark, sf_dir):
    words = _words(spark, sf_dir)
    top = staged(terms.keyword_scores(words, "doc_id").orderBy(F.desc("score"), "word").limit(200).select(F.col("word").alias("keyword")))
    pair = words.withColumn("pair", F.expr("doc_id div 2"))
    source = pair.where("doc_id % 2 = 0").select("pair", F.col("word").alias("token"))
    target = pair.where("doc_id % 2 = 1").select("pair", F.col("word").alias("keyword")).join(F.broadcast(top), "keyword")
    return source, target


@L.add("F13 E2", f"with {PAIR_SQL} select keyword, token, raw, weighted from co")
def f_cooccurrence(spark, sf_dir):
    return terms.cooccurrence(*_pairs(spark, sf_dir), "pair", 20)


@L.add("F14", f"with {PAIR_SQL}, k as (select *, row_number() over (partition by keyword order by weighted desc, token) as rank from co where raw >= 2 and weighted >= 0.01) select keyword, token, raw, weighted, rank from k where rank <= 5")
def f_glossary_top(spark, sf_dir):
    return terms.glossary_top(terms.cooccurrence(*_pairs(spark, sf_dir), "pair", 20), min_score=0.01).withColumn("rank", F.col("rank").cast("long"))


@L.add("F15", f"with {PAIR_SQL}, hit as (select distinct pair from src where token in ('the', 'nicht', 'que', 'thion')) select keyword, count(*) as df from tgt where pair in (select pair from hit) group by keyword having count(*) >= 2")
def f_focused_keywords(spark, sf_dir):
    source, target = _pairs(spark, sf_dir)
    return terms.focused_keywords(source, target, "pair", ["the", "nicht", "que", "thion"])


@L.add("F16", f"with {PAIR_SQL} select token, min_by(text, pair) as example, min(pair) as \"at\" from src join (select doc_id // 2 as pair, text from documents where doc_id % 2 = 1) using (pair) group by token")
def f_first_examples(spark, sf_dir):
    source, _ = _pairs(spark, sf_dir)
    texts = table(spark, sf_dir, "documents").where("doc_id % 2 = 1").select(F.expr("doc_id div 2").alias("pair"), "text")
    return terms.first_examples(source.distinct(), texts, "pair", "pair")


PART_SQL = "g as (select p_brand as keyword, lower(trim(p_type)) as form, 'size' || (p_size % 3) as source, p_type, p_partkey from part)"


def _glossary(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("keyword"), F.col("p_type").alias("rendering"), F.concat(F.lit("size"), (F.col("p_size") % 3).cast("string")).alias("source"), F.lit(1).cast("long").alias("freq"), F.col("p_partkey").alias("pos"))


@L.add("F17 C20", f"with {PART_SQL} select keyword, form, source, count(*) as freq, min_by(p_type, p_partkey) as display from g group by all")
def f_glossary_combine(spark, sf_dir):
    return terms.combine_glossaries(_glossary(spark, sf_dir))


FREQ_SQL = "f as (select p_brand as keyword, p_type as form, count(*) as freq from part group by all), v as (select keyword, sum(freq)::bigint as total, max(freq) as largest, coalesce(list_reverse_sort(list(freq))[2], 0) as second, round(1 - max(freq) / sum(freq), 6) as variation from f group by keyword)"


def _freqs(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("keyword"), F.col("p_type").alias("form")).agg(F.count("*").alias("freq"))


@L.add("F18", f"with {FREQ_SQL} select keyword, total, largest, second, variation from v")
def f_variation_score(spark, sf_dir):
    return terms.variation(_freqs(spark, sf_dir)).withColumn("second", F.col("second").cast("long"))


@L.add("F19 A17", f"with {FREQ_SQL} select keyword, total, largest, second, variation from v where total >= 5 and second >= 2 and variation >= 0.15")
def f_contested_terms(spark, sf_dir):
    return terms.contested(_freqs(spark, sf_dir)).withColumn("second", F.col("second").cast("long"))


@L.add("F20 C18 C19 C42", "with b as (select lower(p_type) as lemma, lower(trim(p_brand)) as rendering, p_partkey from part where length(p_type) >= 2) select lemma, rendering, count(distinct p_partkey) as blocks, '1-' || min(p_partkey) as first_block from b group by all")
def f_lemma_renderings(spark, sf_dir):
    glosses = table(spark, sf_dir, "part").select(F.concat(F.lit("1-"), F.col("p_partkey").cast("string")).alias("block_id"), F.col("p_type").alias("lemma"), F.col("p_brand").alias("rendering"))
    return terms.lemma_renderings(glosses)


@L.add("F24", f"select word, count(*) as \"count\" from (select unnest({sql_words('text')}) as word from documents) group by word")
def f_word_counts(spark, sf_dir):
    return terms.word_counts(table(spark, sf_dir, "documents"))


@L.add("F25", "with s as (select sum(len(regexp_extract_all(text, ' \\| ')))::bigint as n_spaced, sum(len(regexp_extract_all(text, '[a-z]\\|[a-z]')))::bigint as n_closed from documents) select n_spaced, n_closed, case when n_spaced > n_closed then 'spaced' else 'closed' end as style from s")
def f_dominant_style(spark, sf_dir):
    return terms.dominant_style(table(spark, sf_dir, "documents"), r" \| ", r"[a-z]\|[a-z]")


@L.add("F26", f"with {TOP_SQL} select word as term, word as rendering, count(*) as verses, sum((contains(lower(text), word))::int)::bigint as hits, round(sum((contains(lower(text), word))::int) / count(*), 6) as ratio from occ join documents using (doc_id) group by word")
def f_evidence_ratio(spark, sf_dir):
    words, top = _top(spark, sf_dir)
    found = words.join(F.broadcast(top.select("word")), "word").distinct().select(F.col("word").alias("term"), F.col("word").alias("rendering"), F.col("doc_id").alias("verse_id"))
    return terms.evidence_ratio(found, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("verse_id"), "text"))


@L.add("F27", f"with {RANKED_SQL}, t as (select rank as term, lang, word, rank % 2 as scope from ranked where rank <= {TOP}) select term, min(term) as pos, count(distinct scope) > 1 as scopes_differ, " + ", ".join(f"coalesce(min(word) filter (lang = '{x}'), '—') as {x}" for x in LANGS) + " from t group by term")
def f_multilingual_table(spark, sf_dir):
    top = terms.ranked(_scored(spark, sf_dir)[1], ["lang"], TOP).select(F.col("rank").cast("long").alias("term"), "lang", F.col("word").alias("rendering"), F.col("rank").cast("long").alias("pos"), (F.col("rank") % 2).alias("scope"))
    return terms.multilingual(top, LANGS)


@L.add("F33 C23", f"with w as (select doc_id, {sql_words('text')} as w from documents), p as (select doc_id, i as pos, w[i] as word, case when i > 1 then w[i-1] else '<s>' end as prev from w, unnest(range(1, len(w) + 1)) as t(i)), two as (select prev, word, count(*) as n2 from p group by all), one as (select prev, count(*) as n1 from p group by prev), v as (select count(distinct word) as v from p) select doc_id, count(*) as n_tokens, round(power(10.0, -sum(log10((n2 + 1) / (n1 + v))) / count(*)), 6) as perplexity from p join two using (prev, word) join one using (prev), v group by doc_id")
def f_bigram_perplexity(spark, sf_dir):
    return terms.perplexity(terms.pair_logs(terms.bigrams(table(spark, sf_dir, "documents"), "doc_id"), "doc_id"))


