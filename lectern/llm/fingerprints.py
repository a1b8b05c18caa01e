"""Document fingerprints by closed syncmers, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.staging import staged, table

#: Pieces in a k-mer and in its inner substrings.
PIECES, INNER = 9, 2
#: Inner substrings in a k-mer, a power of two, and ends added on each side of a text.
MANY, ENDS = PIECES - INNER + 1, PIECES - 2
#: A word is cut into pieces of up to so many characters from its start on.
PIECE = 4
#: From this character on in a run without spaces each is a piece by itself.
RUN = 32
#: Letters of scripts that put no spaces between words, each a piece by itself.
UNSPACED = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
PER_BUCKET = 2_000
_TOP = 2 ** 31 - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pieces(text: Column) -> Column:
    """The pieces of a text, by one rule at every length.

    Words are cut from their start on into four characters each; a letter of a
    script without spaces, and every character beyond the 32nd of a run without
    spaces, is a piece by itself, so an insertion moves no cut further on.
    """
    spaced = F.when(F.rlike(text, F.lit(rf"\S{{{RUN + 1}}}")), F.regexp_replace(text, rf"(?<=\S{{{RUN}}})\S", " $0")).otherwise(text)
    mixed = F.regexp_extract_all(spaced, F.lit(rf"[{UNSPACED}]|[^\s{UNSPACED}]{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.rlike(text, F.lit(f"[{UNSPACED}]")), mixed).otherwise(F.regexp_extract_all(spaced, F.lit(rf"\S{{1,{PIECE}}}"), F.lit(0)))


def _least_ahead(values: Column) -> Column:
    """The least of each value and the ``MANY - 1`` after it, by doubling the stretch that is looked at (fewer values at the end)."""
    ahead = lambda v, n: F.transform(v, lambda x, i: F.least(x, F.get(v, i + n)))

    def doubled(v: Column, n: int) -> Column:
        return v if n == MANY else let(ahead(v, n), lambda w: doubled(w, 2 * n))

    return doubled(values, 1)


def packed_anchors(text: Column) -> Column:
    """The closed syncmers of a text in its order, each ``hash * 2 ** 32 + pos + ENDS`` as one ``long``.

    The text's pieces stand between ends of ``ENDS`` marks. A k-mer is an anchor
    if the least hash of its inner pairs of pieces is that of its first or last
    pair; pairs of marks have the greatest. Of any ``PIECES - INNER`` k-mers in
    a row one is an anchor, so every text with a piece has one; a text of white
    space alone is an anchor as a whole.
    """
    mark = lambda n: F.hash(F.lit(n))
    marks = F.array_repeat(F.lit(_TOP), ENDS - 1)

    def pairs(h: Column) -> Column:
        n = F.size(h)
        own = F.transform(h, lambda x, i: F.when(i == n - 1, F.hash(x, mark(2))).otherwise(F.hash(x, h[i + 1])))
        return F.concat(marks, F.array(F.hash(mark(1), h[0])), own, marks)

    def chosen(p: Column) -> Column:
        return let(_least_ahead(p), lambda least: _anchored(p, least))

    def _anchored(p: Column, least: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(p) - MANY), lambda i: F.least(p[i], p[i + MANY - 1]) <= least[i])
        covered = [*range(0, MANY, INNER), *([MANY - 1] if (MANY - 1) % INNER else [])]
        return F.transform(at, lambda i: F.shiftleft(F.hash(*(p[i + j] for j in covered)).cast("long"), 32) + i)

    found = let(F.transform(pieces(text), lambda w: F.hash(w)), lambda h: F.when(F.size(h) > 0, let(pairs(h), chosen)))
    blank = F.array(F.shiftleft(F.hash(text).cast("long"), 32))
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(F.coalesce(found, blank))


def unpacked(found: Column) -> Column:
    """``array<struct<pos, hash>>``; ``pos`` counts pieces, and is below 0 for an anchor that begins before the text's first."""
    return F.transform(found, lambda x: F.struct((x.bitwiseAND(F.lit(0xFFFFFFFF)) - ENDS).cast("int").alias("pos"), F.shiftright(x, 32).cast("int").alias("hash")))


def anchors(text: Column) -> Column:
    """`packed_anchors`, `unpacked`."""
    return unpacked(packed_anchors(text))


def matches(a: Column, b: Column) -> Column:
    """``array<struct<pos_a, pos_b>>`` of two arrays of packed anchors: where the anchors of ``a``, each at its first place, stand first in ``b``; by rising ``pos_a``.

    Both sides are sorted by hash, side and place as one array of numbers, where an anchor of
    both stands beside its match, so the work grows as that of a sort.
    """
    side = 2 ** 31
    low = lambda x: x.bitwiseAND(F.lit(side - 1))
    same = lambda x, y: F.shiftright(x, 32) == F.shiftright(y, 32)
    both = lambda: F.sort_array(F.concat(a, F.transform(b, lambda x: x + F.lit(side))))
    of_b = lambda x: x.bitwiseAND(F.lit(side)) != 0

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | ~same(x, s[i - 1]) | (of_b(x) & ~of_b(s[i - 1])))

    def beside(s: Column) -> Column:
        hit = F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda i: of_b(s[i]) & same(s[i], s[i - 1]))
        return F.array_sort(F.transform(hit, lambda i: F.struct((low(s[i - 1]) - ENDS).cast("int").alias("pos_a"), (low(s[i]) - ENDS).cast("int").alias("pos_b"))))

    none = F.array().cast("array<struct<pos_a:int,pos_b:int>>")
    return F.when((F.size(a) == 0) | (F.size(b) == 0), none).otherwise(let(let(both(), firsts), lambda s: F.when(F.size(s) < 2, none).otherwise(beside(s))))


def _distinct(a: Column) -> Column:
    return let(F.sort_array(a), lambda s: F.size(F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, 32) != F.shiftright(s[i - 1], 32)))))


def likeness(a: Column, b: Column) -> Column:
    """Twice the anchors that stand in place in both, by the distinct anchors of both; 1 for two empty texts, 0 for one.

    A `matches` entry stands in place if its displacement is that of the entry
    before or after it, or none, or that of the texts' ends; an anchor that the
    texts have at places unrelated to their neighbours' says nothing.
    """
    def held(m: Column) -> Column:
        shift = lambda i: m[i]["pos_b"] - m[i]["pos_a"]
        end = F.greatest(F.element_at(b, -1).bitwiseAND(F.lit(2 ** 31 - 1)), F.lit(0)) - F.greatest(F.element_at(a, -1).bitwiseAND(F.lit(2 ** 31 - 1)), F.lit(0))
        last = F.size(m) - 1
        stands = lambda i: (shift(i) == 0) | (shift(i) == end) | ((i > 0) & (shift(i) == shift(F.greatest(i - 1, F.lit(0))))) | ((i < last) & (shift(i) == shift(F.least(i + 1, last))))
        return F.when(F.size(m) == 0, F.lit(0)).otherwise(F.size(F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands)))

    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(2.0 * let(matches(a, b), held) / (_distinct(a) + _distinct(b)))


def written(found: Column) -> Column:
    """The hashes of packed anchors in text order, eight hex digits each."""
    return F.array_join(F.transform(found, lambda x: F.substring(F.hex(F.shiftrightunsigned(x, 32) + F.lit(1 << 32)), -8, 8)), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``n_chars`` and ``anchors`` (``array<struct<pos, hash>>``) of every document.

    Takes ``doc_id`` and ``text``; other columns are ignored. Equal texts have
    equal anchors. A null text is taken as empty, and an empty one has no
    anchors; every other text has one at least. Repeated rows stay; an empty
    table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), anchors(F.col("text")).alias("anchors"))


def with_next(docs: DataFrame, columns: list[str], made: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``next_<column>`` of the next document by rising ``doc_id``; the first follows the last, rows of one id follow each other.

    ``made`` are columns to add to the rows first, once they are dealt out, so that they are not shuffled.

    Rows go to ranges of ids of about ``PER_BUCKET`` rows, and the first row of
    each range also to the range before, so the order costs one shuffle and no
    task sees all rows. A null id comes before all others.
    """
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(-2 ** 63).cast("long"))
    n, low, high = docs.agg(F.count("*"), F.min(key), F.max(key)).first()
    buckets = max(1, n // PER_BUCKET)
    width = max(1, -(-((high or 0) - (low or 0) + 1) // buckets))
    whole = lambda n: F.lit(str(n)).cast("decimal(20,0)")  # noqa: E731  ids may span more than a long holds
    place = F.floor((key.cast("decimal(20,0)") - whole(low or 0)) / whole(width)).cast("long")
    counts = staged(docs.select(place.alias("bucket"), key.alias("key")).groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("head")))
    if (counts.agg(F.max("n")).first()[0] or 0) > 8 * PER_BUCKET:  # ids that are far from evenly spread
        bounds = sorted(set(docs.select(key.cast("double").alias("key")).approxQuantile("key", [i / min(buckets, 2000) for i in range(1, min(buckets, 2000))], 0.0005)))
        place = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= key.cast("double"))).cast("long")
        counts = staged(docs.select(place.alias("bucket"), key.alias("key")).groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("head")))
    before = F.coalesce(F.lag("bucket").over(W.orderBy("bucket")), F.lit(None).cast("long"))  # one row a range
    last = counts.agg(F.max("bucket")).first()[0]
    heads = staged(counts.select("head", F.coalesce(before, F.lit(last).cast("long")).alias("to")))
    rows = docs.withColumn("_key", key)
    tails = rows.join(heads, rows["_key"] == heads["head"]).drop("head").withColumnRenamed("to", "_bucket").withColumn("_tail", F.lit(1))
    both = rows.withColumn("_bucket", place).withColumn("_tail", F.lit(0)).unionByName(tails).repartition("_bucket").withColumns(made or {})
    window = W.partitionBy("_bucket").orderBy("_tail", "_key")
    ahead = both.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
    return ahead.where("_tail = 0").drop("_bucket", "_tail", "_key")


def op7_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(docs, ["text", "own"], {"own": packed_anchors(F.col("text"))})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = pairs.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    found = pairs.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "own", packed_anchors(F.col("edited")).alias("changed"), F.col("next_own").alias("next"))
    return found.select("doc_id", "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"), written(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
