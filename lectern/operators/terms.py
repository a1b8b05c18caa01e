"""Term statistics: frequencies, TF-IDF, phrases, bilingual pairs and glossaries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as K
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.functions import features, fixed
from lectern.functions import text as T
from lectern.sources.stage import dealt, staged


def tokens(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """A row for each term token of a text, with the given columns."""
    return docs.select(*keys, F.explode(T.term_tokens(text)).alias("word"))


def counted(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``count`` of each term by the given columns, which tell documents apart: the one table that the statistics below start from.

    They take it, or the rows of `tokens`; with ``count`` among the columns a row is a document's word.
    Words are counted in a document's own row, as runs of its sorted tokens, so
    no token is shuffled; counts are added up only where rows share their keys.
    """
    out = docs.select(*keys, F.inline(runs(T.term_tokens(text))))
    if docs.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").isEmpty():
        return out
    return out.groupBy(*keys, "word").agg(F.sum("count").alias("count"))


def runs(items: Column) -> Column:
    """How often each item is in an array, as structs of ``word`` and ``count``."""
    def of(s: Column) -> Column:
        starts = F.array_compact(F.transform(s, lambda w, i: F.when((i == 0) | (F.get(s, i - 1) != w), i)))
        return T.let(starts, lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("word"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("count"))))

    return T.let(F.sort_array(items), of)


def _times(words: DataFrame):
    return (F.sum("count") if "count" in words.columns else F.count("*")).alias("count")


def term_frequency(words: DataFrame, keys: list[str]) -> DataFrame:
    """``count`` of each word by keys, and ``total`` of all words by keys.

    The total is taken from the counts, so the tokens are shuffled once, already
    added up on the map side.
    """
    counts = words.groupBy(*keys, "word").agg(_times(words))
    return counts.join(counts.groupBy(*keys).agg(F.sum("count").alias("total")), keys)


def smooth_idf(words: DataFrame, doc: str) -> DataFrame:
    """``df`` and ``idf`` = ln((1 + N) / (1 + df)) + 1 of each word over the documents that have a word."""
    return _idf(words, doc).drop("n_docs")


def _idf(words: DataFrame, doc: str) -> DataFrame:
    n = words.agg(F.count_distinct(doc).alias("n_docs"))
    pairs = words.select(doc, "word") if "count" in words.columns else words.select(doc, "word").distinct()
    df = pairs.groupBy("word").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("word", "df", F.round(F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1, 6).alias("idf"), "n_docs")


def tf_idf(frequencies: DataFrame, idf: DataFrame) -> DataFrame:
    """``score`` = count / total x idf x the scale; a word that the table lacks is taken as the rarest."""
    joined = frequencies.join(idf.select("word", "idf"), "word", "left")
    return joined.withColumn("idf", F.coalesce("idf", F.lit(fixed.UNKNOWN_IDF))).withColumn("score", F.round(F.col("count") / F.col("total") * F.col("idf") * fixed.TFIDF_SCALE, 4))


def ranked(scored: DataFrame, keys: list[str], top: int | None = None) -> DataFrame:
    """``rank`` by falling score, ties by word; the first ``top`` of each where that is asked."""
    out = scored.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "word")))
    return out.where(F.col("rank") <= top) if top else out


def comparison(scored: DataFrame, by: str, values: list[str]) -> DataFrame:
    """A row for each word with its score in each source, 0 where it is not, and their mean."""
    wide = scored.groupBy("word").pivot(by, values).agg(F.first("score")).fillna(0.0)
    return wide.withColumn("avg_score", F.round(sum(F.col(v) for v in values) / len(values), 6))


def signature_terms(scored: DataFrame, by: str, factor: float = fixed.SIGNATURE_FACTOR, top: int = fixed.SIGNATURE_TOP) -> DataFrame:
    """Words of a source that score ``factor`` times every other source's score or more."""
    own = W.partitionBy("word")
    best = F.max(F.struct("score", by)).over(own)
    rest = F.array_sort(F.collect_list("score").over(own))
    other = scored.withColumn("best", best).withColumn("scores", rest)
    other = other.withColumn("others", F.when(F.size("scores") > 1, F.when(F.col(f"best.{by}") == F.col(by), F.element_at("scores", -2)).otherwise(F.element_at("scores", -1))).otherwise(0.0))
    return ranked(other.where(F.col("score") >= factor * F.col("others")), [by], top).select(by, "rank", "word", "score", F.col("others").alias("best_other"))


def occurrences(words: DataFrame, keys: list[str]) -> DataFrame:
    """Inverted index: how often each word is in each block."""
    return words.groupBy("word", *keys).agg(_times(words))


def keyword_blocks(index: DataFrame, scores: DataFrame, keys: list[str], part=None) -> DataFrame:
    """A row a word: ``rank``, ``score``, ``total_count`` and ``occurrences`` (structs of the block and the count, in order).

    With ``part``, a column of the index such as a range of its blocks, a row a
    word and part, so that no row grows with the corpus.
    """
    by = ["word"] if part is None else ["word", "part"]
    rows = index if part is None else index.withColumn("part", part)
    found = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*keys, "count"))).alias("occurrences"))
    totals = index.groupBy("word").agg(F.sum("count").alias("total_count"))
    return scores.select("word", "rank", "score").join(totals, "word").join(found, "word")


def block_keywords(keywords: DataFrame, key: str) -> DataFrame:
    """The inverse of `keyword_blocks`: the words of each block by rank."""
    flat = keywords.select("word", "rank", F.explode("occurrences").alias("o")).select(F.col(f"o.{key}").alias(key), "rank", "word")
    return flat.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("keywords"))


def bottom_frequent(scored: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent words, ranked anew by rising score."""
    most = scored.orderBy(F.desc("count"), "word").limit(n)
    return most.withColumn("bottom_rank", F.row_number().over(W.orderBy("score", "word")))  # n rows


def keyword_gaps(top: DataFrame, covered: DataFrame) -> DataFrame:
    """Words of ``top`` none of whose variants is a variant of a covered word."""
    spread = top.select("word", F.explode(T.variants("word")).alias("form"))
    known = covered.select(F.explode(T.variants("word")).alias("form")).distinct()
    met = spread.join(known, "form", "left_semi").select("word").distinct()
    return top.join(met, "word", "left_anti")


#: Bytes of Parquet whose phrases one task counts.
PHRASE_TASK_BYTES = 6_000_000


def ngrams(blocks: DataFrame, keys: list[str], text: str = "text", longest: int = fixed.PHRASE_MAX_WORDS) -> DataFrame:
    """Runs of 2 to ``longest`` formula words, each once a block."""
    words = blocks.select(*keys, T.formula_words(text).alias("w"))

    def of(n: int):
        first = F.slice("w", F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(0)))
        return F.transform(first, lambda x, i: F.concat_ws(" ", x, *(F.get("w", i + k) for k in range(1, n))))

    return words.select(*keys, F.explode(F.array_distinct(F.concat(*map(of, range(2, longest + 1))))).alias("phrase"))


def phrases(blocks: DataFrame, keys: list[str], min_df: int = fixed.PHRASE_MIN_DF) -> DataFrame:
    """Phrases in ``min_df`` blocks or more, those dropped that are part of a longer phrase which qualifies.

    Dominated phrases are found by an equi-join with the shorter runs of each
    qualified phrase, in place of comparing all pairs of phrases. Blocks are
    dealt to tasks so small that the phrases of one, nearly all of them new, fit
    its memory, and the phrases that qualify are written once.
    """
    good = ngrams(dealt(blocks, keys, PHRASE_TASK_BYTES), keys).groupBy("phrase").agg(F.count("*").alias("df")).where(F.col("df") >= min_df)
    good = staged(good.withColumn("n_words", F.size(F.split("phrase", " "))))
    w = F.split("phrase", " ")
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(w) - 1)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - n + 1)), lambda i: F.array_join(F.slice(w, i, n), " "))))
    inside = good.where("n_words > 2").select(F.explode(parts).alias("phrase")).distinct()
    return good.join(inside, "phrase", "left_anti")


def block_df(blocks: DataFrame, block: str, words: DataFrame) -> DataFrame:
    """In how many blocks each word is."""
    return words.select(block, "word").distinct().groupBy("word").agg(F.count("*").alias("df"))


def keyword_scores(words: DataFrame, block: str, min_df: int = 2, min_idf: float = 3.5, top: int = 600) -> DataFrame:
    """Words by (df / N) x idf, of those rare enough and in enough blocks."""
    kept = _idf(words, block).where((F.col("df") >= min_df) & (F.col("idf") >= min_idf))
    return kept.select("word", "df", "idf", F.round(F.col("df") / F.col("n_docs") * F.col("idf"), 9).alias("score")).orderBy(F.desc("score"), "word").limit(top)


def cooccurrence(source: DataFrame, target: DataFrame, pair: str, max_df: int) -> DataFrame:
    """Keywords of a pair's target side with the tokens of its source side, each pair shared out among its source tokens.

    ``source`` is ``(pair, token)``, ``target`` ``(pair, keyword)``; tokens in more
    than ``max_df`` pairs don't count, nor do pairs without a keyword.
    """
    src, tgt = source.distinct(), target.distinct()
    rare = src.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") <= max_df).select("token")
    src = src.join(rare, "token", "left_semi").join(tgt.select(pair).distinct(), pair, "left_semi")
    share = src.groupBy(pair).agg((1.0 / F.count("*")).alias("weight"))
    joined = tgt.join(src, pair).join(share, pair)
    return joined.groupBy("keyword", "token").agg(F.count("*").alias("raw"), F.round(F.sum("weight"), 9).alias("weighted"))


def glossary_top(pairs: DataFrame, key: str = "keyword", item: str = "token", min_count: int = fixed.PAIR_MIN_COUNT, min_score: float = fixed.PAIR_MIN_SCORE, top: int = fixed.PAIRS_PER_KEYWORD) -> DataFrame:
    """The best tokens of each keyword that are paired often and strongly enough."""
    kept = pairs.where((F.col("raw") >= min_count) & (F.col("weighted") >= min_score))
    order = W.partitionBy(key).orderBy(F.desc("weighted"), item)
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def focused_keywords(source: DataFrame, target: DataFrame, pair: str, focus: list[str], min_df: int = 2) -> DataFrame:
    """Keywords of the pairs whose source side has a token of a family, with their pairs counted."""
    hit = source.where(F.col("token").isin(focus)).select(pair).distinct()
    return target.join(hit, pair, "left_semi").distinct().groupBy("keyword").agg(F.count("*").alias("df")).where(F.col("df") >= min_df)


def first_examples(source: DataFrame, texts: DataFrame, pair: str, order: str) -> DataFrame:
    """``at``, the first place in order of a token's pairs that have a text row, and ``example``, the first text there is.

    Places are chosen first, without the texts, and a text is joined only to the tokens that it is the example of.
    """
    places = texts.select(pair, F.col(order).alias("_at"), F.when(F.col("text").isNotNull(), F.col(order)).alias("_from"))
    first = source.select("token", pair).hint("merge").join(places, pair).groupBy("token").agg(F.min("_at").alias("at"), F.min_by(pair, "_from").alias("_pair"), F.min("_from").alias("_from"))
    shown = texts.where("text is not null").select(F.col(pair).alias("_pair"), F.col(order).alias("_from"), F.col("text").alias("example"))
    return first.hint("merge").join(shown, ["_pair", "_from"], "left").groupBy("token", "at").agg(F.min("example").alias("example")).select("token", "example", "at")


def combine_glossaries(raw: DataFrame) -> DataFrame:
    """``(keyword, rendering, source, freq, pos)``: frequencies added up by normal form; the first spelling is shown."""
    norm = raw.withColumn("form", T.rendering("rendering"))
    return norm.groupBy("keyword", "form", "source").agg(F.sum("freq").alias("freq"), F.min_by("rendering", "pos").alias("display"))


def variation(renderings: DataFrame, key: str = "keyword") -> DataFrame:
    """Of each keyword the total, the largest and second frequency, and 1 - largest / total."""
    order = F.sort_array(F.collect_list("freq"), asc=False)
    out = renderings.groupBy(key).agg(F.sum("freq").alias("total"), order.alias("f"))
    second = F.when(F.size("f") > 1, F.element_at("f", 2)).otherwise(0)
    return out.select(key, "total", F.element_at("f", 1).alias("largest"), second.alias("second"), F.round(1 - F.element_at("f", 1) / F.col("total"), 6).alias("variation"))


def contested(renderings: DataFrame, key: str = "keyword", total: int = fixed.MIN_TOTAL, second: int = fixed.MIN_SECOND, least: float = fixed.MIN_VARIATION) -> DataFrame:
    """Keywords with no settled rendering, most varied first."""
    v = variation(renderings, key)
    return v.where((F.col("total") >= total) & (F.col("second") >= second) & (F.col("variation") >= least)).orderBy(F.desc("variation"), key)


def lemma_renderings(glosses: DataFrame, min_freq: int = 1) -> DataFrame:
    """``(block_id, lemma, rendering)``: distinct blocks of each lemma and rendering, and the first of them in natural order."""
    kept = glosses.withColumn("lemma", T.lemma("lemma")).where(~T.degenerate("lemma"))
    kept = kept.withColumn("rendering", T.rendering("rendering"))
    return kept.groupBy("lemma", "rendering").agg(F.count_distinct("block_id").alias("blocks"), F.min_by("block_id", T.suffixed_key("block_id")).alias("first_block")).where(F.col("blocks") >= min_freq)


def keyword_features(docs: DataFrame, key: str, text: str = "text", sentence: str = r"[.!?\n]+") -> DataFrame:
    """Statistics of each word of a text, by which it may be a keyword: ``(key, word, tf, score)``, lower scores for better words.

    The published measure for single documents: how often a word is
    capitalised or an acronym, how early its sentences stand, how often it is
    there against the mean and spread of the text's content words, how many
    different words stand beside it, and in how many sentences it is. A text's
    words are counted in its own row, which ``key`` tells apart, without a
    shuffle, and many texts of a bounded number of words at once.
    """
    forms = docs.where(F.col(text).isNotNull()).select(key, F.transform(F.split(text, sentence), lambda s: F.regexp_extract_all(s, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("forms"))

    def marks(form: Column) -> Column:
        """1 for an acronym, 2 for a capital, 4 for a content word, added up."""
        word, first = F.lower(form), F.substring(form, 1, 1)
        upper = (F.upper(form) == form) & (F.length(form) > 1)
        bit = lambda test, n: F.when(test, n).otherwise(0)
        return bit(upper & ~F.rlike(form, F.lit(r"^\p{N}+$")), 1) + bit((F.upper(first) == first) & (F.lower(first) != first) & ~upper, 2) + bit((F.length(word) > 2) & ~word.isin(fixed.STOPWORDS), 4)

    flat = forms.select(key, F.flatten("forms").alias("form"), F.flatten(F.transform("forms", lambda s, i: F.array_repeat(i, F.size(s)))).alias("sent"))
    listed = flat.where(F.size("form") > 0).select(key, F.transform("form", F.lower).alias("word"), F.transform("form", marks).alias("marks"), "sent")

    kind = K.StructType([K.StructField(key, docs.schema[key].dataType), *K._parse_datatype_string(features.SCHEMA).fields])
    made = to_arrow_schema(kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in features.chunks(batch.column("word").value_lengths().to_numpy(zero_copy_only=False)):
                part = batch.slice(start, end - start)
                at, columns = features.word_features(*(part.column(c) for c in ("word", "sent", "marks")))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([part.column(key).take(pa.array(at)), *columns], made, strict=True)], schema=made)

    x = listed.mapInArrow(count, kind)
    share = lambda kinds, n: F.when(F.col(n) > 0, F.col(kinds) / F.col(n)).otherwise(0.0)
    x = x.withColumns({"rel": 1 + (share("kinds_before", "n_before") + share("kinds_after", "n_after")) * F.col("tf") / F.col("most"), "place": F.log(F.log(3 + F.col("middle"))), "case": F.greatest("acronyms", "capitals") / (1 + F.log("tf"))})
    norm = F.col("tf") / (F.coalesce("mean", F.lit(0.0)) + F.coalesce("spread", F.lit(0.0)))
    score = F.col("rel") * F.col("place") / (F.col("case") + norm / F.col("rel") + F.col("in_sents") / F.col("sents") / F.col("rel"))
    return x.select(key, "word", "tf", F.round(score, 6).alias("score"))


def best_keywords(features: DataFrame, key: str, most: float = 0.3, top: int | None = None) -> DataFrame:
    """Words that score ``most`` or less, ranked; the first ``top`` of each text where that is asked."""
    w = W.partitionBy(key).orderBy("score", "word")
    out = features.where(F.col("score") <= most).withColumn("rank", F.row_number().over(w))
    return out.where(F.col("rank") <= top) if top else out


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.explode(T.english_tokens(text)).alias("word")).groupBy("word").agg(F.count("*").alias("count"))


def dominant_style(docs: DataFrame, spaced: str, closed: str, text: str = "text") -> DataFrame:
    """Which of two patterns a corpus has more of; the closed one where they tie."""
    sums = docs.agg(F.coalesce(F.sum(F.regexp_count(text, F.lit(spaced))), F.lit(0)).alias("n_spaced"), F.coalesce(F.sum(F.regexp_count(text, F.lit(closed))), F.lit(0)).alias("n_closed"))
    return sums.withColumn("style", F.when(F.col("n_spaced") > F.col("n_closed"), "spaced").otherwise("closed"))


def evidence_ratio(terms: DataFrame, verses: DataFrame) -> DataFrame:
    """``(term, rendering, verse_id)`` and ``(verse_id, text)``: the share of a term's verses with a text that has its rendering.

    The terms of a verse go to its text together, which is lower-cased once and not once a term.
    """
    own = terms.where("verse_id is not null").groupBy("verse_id").agg(F.collect_list(F.struct("term", "rendering")).alias("_terms"))
    joined = verses.where(F.col("text").isNotNull()).join(own, "verse_id")
    asked = lambda low: F.transform("_terms", lambda t: F.struct(t["term"].alias("term"), t["rendering"].alias("rendering"), F.contains(low, F.lower(t["rendering"])).cast("int").alias("_hit")))
    hit = F.col("_hit")
    return joined.select(F.inline(T.let(F.lower("text"), asked))).groupBy("term", "rendering").agg(F.count("*").alias("verses"), F.sum(hit).alias("hits")).withColumn("ratio", F.round(F.col("hits") / F.col("verses"), 6))


def multilingual(terms: DataFrame, languages: list[str]) -> DataFrame:
    """``(term, lang, rendering, pos)``: one row a term in order of first sight, a dash where a language has none, and whether scopes differ."""
    first = terms.groupBy("term").agg(F.min("pos").alias("pos"), (F.count_distinct("scope") > 1).alias("scopes_differ"))
    wide = terms.groupBy("term").pivot("lang", languages).agg(F.min_by("rendering", "pos")).fillna("—")
    return first.join(wide, "term")


def perplexity(logs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """10 to the power of minus the mean log probability of a document's tokens."""
    return logs.groupBy(doc).agg(F.sum("n").alias("n_tokens"), F.round(F.pow(F.lit(10.0), -F.sum(F.col("n") * F.col("log10_p")) / F.sum("n")), 6).alias("perplexity"))


def bigrams(docs: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """``(doc, pair, n)``: how often a text has a word after another, as ``prev word``, counted in its own row; the first is after ``<s>``."""
    pairs = T.let(T.english_tokens(text), lambda w: F.transform(w, lambda x, i: F.concat_ws(" ", F.when(i == 0, "<s>").otherwise(F.get(w, i - 1)), x)))
    return docs.select(doc, F.inline(runs(pairs))).select(doc, F.col("word").alias("pair"), F.col("count").alias("n"))


def pair_logs(own: DataFrame, doc: str) -> DataFrame:
    """``(doc, n, log10_p)`` of the rows of `bigrams`, which are read twice: the log probability of a word after the one before, by add-one estimates."""
    two = staged(own.groupBy("pair").agg(F.sum("n").alias("n2")))
    prev, word = F.substring_index("pair", " ", 1), F.substring_index("pair", " ", -1)
    one = two.groupBy(prev.alias("prev")).agg(F.sum("n2").alias("n1"))
    size = two.agg(F.count_distinct(word).alias("v"))
    table = two.withColumn("prev", prev).join(one, "prev").crossJoin(F.broadcast(size)).select("pair", F.log10((F.col("n2") + 1) / (F.col("n1") + F.col("v"))).alias("log10_p"))
    return own.join(table, "pair").select(doc, "n", "log10_p")


def bigram_logs(words: DataFrame, doc: str, pos: str) -> DataFrame:
    """``(doc, n, log10_p)``: how often a document has a pair of words, and the log probability of the second after the first, by add-one estimates from the same corpus.

    Pairs are counted in their documents first, so a pair that is everywhere is
    joined once a document and not once a token.
    """
    ahead = W.partitionBy(doc).orderBy(pos)
    pairs = words.withColumn("prev", F.coalesce(F.lag("word").over(ahead), F.lit("<s>")))
    own = staged(pairs.groupBy(doc, "prev", "word").agg(F.count("*").alias("n")))
    two = own.groupBy("prev", "word").agg(F.sum("n").alias("n2"))
    one = own.groupBy("prev").agg(F.sum("n").alias("n1"))
    size = own.agg(F.count_distinct("word").alias("v"))
    table = two.join(one, "prev").crossJoin(F.broadcast(size)).select("prev", "word", F.log10((F.col("n2") + 1) / (F.col("n1") + F.col("v"))).alias("log10_p"))
    return own.join(table, ["prev", "word"]).select(doc, "n", "log10_p")
