"""MinHash near-de-duplication by improved consistent weighted sampling."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textkit
from lectern.llm.components import components
from lectern.llm.staging import prepare, staged, table

BANDS, ROWS = 10, 3
THRESHOLD = 0.8
#: A word in fewer than this share of the documents has the largest inverse document frequency.
RARE = 1e-3
TOP = 1.5
#: Up to so many documents of a bucket outside its largest class are compared with every other one pair by pair; more, in blocks.
DIRECT = 40
#: Documents and characters in a block, about.
BLOCK_DOCS, BLOCK_CHARS = 128, 2_000_000
_POOL = 1 << 16


@cache
def _pools() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return tuple(x.astype(np.float32) for x in (rng.gamma(2, 1, _POOL), np.log(rng.gamma(2, 1, _POOL)), rng.random(_POOL)))


@cache
def _odd(n: int) -> np.ndarray:
    return textkit.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(7919)) | np.uint64(1)


def weighted_sample(items: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """``n`` consistent samples of a weighted set; two sets agree in one with the probability of their weighted Jaccard similarity.

    For each draw: r, c ~ Gamma(2, 1), b ~ U(0, 1) by item and draw, t = floor(ln w / r + b),
    and the item with the least ln c - r (t - b) - r is taken, with its t.
    """
    r_pool, c_pool, b_pool = _pools()
    odd, log_w = _odd(n)[:, None], np.log(weights).astype(np.float32)
    best = np.full(n, np.inf, np.float32)
    out = np.zeros(n, np.uint64)
    low = np.uint64(0xFFFF)
    for at in range(0, len(items), 4096):
        x = items[None, at:at + 4096] * odd
        r = r_pool[x >> np.uint64(48)]
        c = c_pool[(x >> np.uint64(32)) & low]
        b = b_pool[(x >> np.uint64(16)) & low]
        t = np.floor(log_w[None, at:at + 4096] / r + b)
        a = c - r * (t - b + 1)
        k = a.argmin(axis=1)
        row = np.arange(n)
        least = a[row, k]
        better = least < best
        best = np.where(better, least, best)
        chosen = textkit.mix(items[at:at + 4096][k] ^ (t[row, k].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        out = np.where(better, chosen, out)
    return out


class Idf:
    """Inverse document frequency of words, smoothed: 1 for a word in every document up to ``TOP`` for one in a share of ``RARE`` or less.

    The range is narrow on purpose: with raw logarithms the words of a text that is copied
    thousands of times become light beside the few words its copies change,
    and copies of the largest groups would no longer be alike.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def __call__(self, hashed: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(hashed), TOP, np.float32)
        at = np.minimum(np.searchsorted(self.keys, hashed), len(self.keys) - 1)
        return np.where(self.keys[at] == hashed, self.values[at], np.float32(TOP))


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for _, run in textkit.chunks(pdf["text"]):
            w = textkit.words(run)
            if not len(w.hash):
                continue
            order = np.lexsort((w.hash, w.doc))
            h, d = w.hash[order], w.doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            keys, n = np.unique(h[new], return_counts=True)
            yield pd.DataFrame({"word": keys.view(np.int64), "n": n})


def word_idf(docs: DataFrame, total: int) -> Idf:
    """Counts the documents of every word in all documents; keeps those of words in a share of ``RARE`` or more.

    Such words number at most (distinct words of a mean document) / RARE,
    whatever the size of the corpus.
    """
    counts = docs.mapInPandas(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    least = max(1, int(np.ceil(RARE * total)))
    rows = counts.where(F.col("n") >= least).toPandas()
    keys = rows["word"].to_numpy(np.int64).view(np.uint64)
    share = rows["n"].to_numpy(float) / max(1, total)
    order = np.argsort(keys)
    return Idf(keys[order], (1 + (TOP - 1) * np.log(1 / np.clip(share, RARE, 1)) / np.log(1 / RARE)).astype(np.float32)[order])


def weighted_sets(texts: list[str], idf: Idf) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct shingles of each text, rising, and their weights: (1 + ln of the count) times the mean over the words."""
    w = textkit.words(texts)
    hashed, doc, first = textkit.shingles(w, len(texts))
    value = np.concatenate(([0.0], np.cumsum(idf(w.hash), dtype=np.float64)))
    last = np.minimum(first + textkit.SHINGLE_WORDS, w.bounds[doc + 1])
    weight = (value[last] - value[first]) / np.maximum(1, last - first)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        items, inverse = np.unique(hashed[at[i]:at[i + 1]], return_inverse=True)
        times = np.bincount(inverse, minlength=len(items))
        mean = np.bincount(inverse, weight[at[i]:at[i + 1]], len(items)) / np.maximum(1, times)
        out.append((items, np.round(mean * (1 + np.log(np.maximum(1, times))), 5)))
    return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total > 0 else 0.0


def _signer(idf):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = idf.value
        for pdf in batches:
            for at, run in textkit.chunks(pdf["text"]):
                bands = []
                for items, w in weighted_sets(run, weights):
                    if not len(items):
                        bands.append([])
                        continue
                    s = weighted_sample(items, w, BANDS * ROWS).reshape(BANDS, ROWS)
                    key = np.arange(1, BANDS + 1, dtype=np.uint64)
                    for k in range(ROWS):
                        key = textkit.mix(key * np.uint64(31) + s[:, k])
                    bands.append(key.view(np.int64).tolist())
                part = pdf.iloc[at:at + len(run)]
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "sha": part["sha"].array, "bands": bands})
    return sign


def _verifier(idf, threshold):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = idf.value
        for pdf in batches:
            left = list(textkit.chunks(pdf["text_a"]))
            sets_a = [x for _, run in left for x in weighted_sets(run, weights)]
            sets_b = [x for _, run in textkit.chunks(pdf["text_b"]) for x in weighted_sets(run, weights)]
            j = np.array([weighted_jaccard(x, y) for x, y in zip(sets_a, sets_b, strict=True)])
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "similarity": j})[j >= threshold]
    return verify


def _similar(pairs: DataFrame, docs: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are alike enough.

    The joins with texts are merged at every size: a broadcast of the ids while
    they are few would only hide what the join costs once they are not.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = staged(docs.join(wanted.hint("merge"), docs.doc_id == wanted.id, "left_semi").select("doc_id", "text"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")
    return staged(both.mapInPandas(_verifier(idf, threshold), "a long, b long, similarity double"))


def _across(idf, threshold):
    """Compares the documents of two blocks of a bucket (of one, where both are the same) that are of different classes.

    A pair that shares a band before this one is compared there.
    """
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        low, high, band = pdf["low"].iloc[0], pdf["high"].iloc[0], pdf["band"].iloc[0]
        pdf = pdf.sort_values("block", kind="stable")
        sets = [x for _, run in textkit.chunks(pdf["text"]) for x in weighted_sets(run, idf.value)]
        ids, block, cls = (pdf[c].to_numpy() for c in ("doc_id", "block", "class"))
        before = np.array(pdf["bands"].tolist(), dtype=np.int64)[:, :band]
        vocabulary, at = np.unique(np.concatenate([x for x, _ in sets]), return_inverse=True)
        weight = np.concatenate([w for _, w in sets])
        starts = np.concatenate(([0], np.cumsum([len(x) for x, _ in sets])))
        total = np.add.reduceat(weight, starts[:-1])
        own = np.zeros(len(vocabulary))
        out = []
        for i in np.flatnonzero(block == low):
            first = i + 1 if low == high else int(np.searchsorted(block, high))
            wanted = first + np.flatnonzero((cls[first:] != cls[i]) & ~(before[first:] == before[i]).any(axis=1))
            if not len(wanted):
                continue
            mine = slice(starts[i], starts[i + 1])
            own[at[mine]] = weight[mine]
            shared = np.add.reduceat(np.minimum(own[at[starts[first]:]], weight[starts[first]:]), starts[first:-1] - starts[first])[wanted - first]
            own[at[mine]] = 0
            for j in wanted[shared >= (threshold - 1e-9) * (total[i] + total[wanted] - shared)]:
                similarity = weighted_jaccard(sets[i], sets[j])
                if similarity >= threshold:
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j]), similarity))
        return pd.DataFrame(out, columns=["a", "b", "similarity"]).astype({"a": "int64", "b": "int64", "similarity": "float64"})
    return compare


def _similar_across(crowded: DataFrame, classes: DataFrame, signed: DataFrame, docs: DataFrame, idf, threshold: float) -> DataFrame:
    """All pairs of different classes of the buckets ``(band, key, doc_id)`` whose texts are alike enough.

    The documents outside a bucket's largest class, and those inside it, are dealt into blocks;
    each block of the first is compared with itself and all others.
    """
    known = crowded.join(classes, crowded.doc_id == classes.node, "left").select("band", "key", "doc_id", F.coalesce("component", "doc_id").alias("class"))
    ids = known.select(F.col("doc_id").alias("id")).distinct()
    rows = docs.join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "text", F.length("text").alias("size"))
    texts = staged(rows.join(signed.select("doc_id", "bands").hint("merge"), "doc_id"))
    known = staged(known.join(texts.select("doc_id", "size").hint("merge"), "doc_id"))
    per_class = known.groupBy("band", "key", "class").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    buckets = per_class.groupBy("band", "key").agg(F.max(F.struct("n", "class", "size")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("classes")).where("classes > 1")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK_DOCS), F.ceil(size / BLOCK_CHARS)).cast("int")
    buckets = staged(buckets.select("band", "key", F.col("most.class").alias("largest"), blocks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("outside"), blocks(F.col("most.n"), F.col("most.size")).alias("inside")))
    of = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    is_in = F.col("class") == F.col("largest")
    placed = known.join(buckets, ["band", "key"]).withColumn("block", F.when(is_in, F.col("outside") + of(F.col("inside"))).otherwise(of(F.col("outside"))))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(is_in, F.col("outside")).otherwise(F.col("outside") + F.col("inside")) - 1)))
    dealt = staged(spread.select("band", "key", "doc_id", "class", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
    return staged(dealt.join(texts.select("doc_id", "text", "bands").hint("merge"), "doc_id").groupBy("band", "key", "low", "high").applyInPandas(_across(idf, threshold), "a long, b long, similarity double"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Groups documents whose five-word shingle sets, weighted by TF-IDF, have a weighted Jaccard similarity of ``threshold`` or more.

    Takes ``doc_id`` (unique; rows without one are left out) and ``text``; other columns are ignored.
    Returns one row per document: ``doc_id``, ``rep_id`` (the smallest id with the
    same text), ``class_id`` (the smallest id linked to it, directly or through
    others), ``n_links`` (verified links of ``rep_id``), ``class_size`` and
    ``keep`` (true for one document of each class).

    Copies are represented by their smallest id. In each band's bucket all
    representatives are compared with the smallest one; where a bucket still
    holds several classes, documents outside its largest class are compared with
    all of the bucket; where they are many, those that share a second band are
    tied first, and the classes that are left are compared in blocks. What is joined by a text or class is written first, so that Spark
    can split the join of one that has many documents. A null text is like no other; texts without words, the empty one
    among them, are alike only where they are equal. Empty input gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    total = docs.count()
    idf = spark.sparkContext.broadcast(word_idf(docs.select("text"), total))
    sha = F.coalesce(F.unhex(F.sha2(F.col("text"), 256)), F.concat(F.lit(b"null"), F.col("doc_id").cast("string").cast("binary")))
    signed = staged(docs.withColumn("sha", sha).mapInPandas(_signer(idf), "doc_id long, sha binary, bands array<long>"))
    first = staged(signed.groupBy("sha").agg(F.min("doc_id").alias("rep_id")))
    reps = staged(signed.join(first, "sha").where("doc_id = rep_id").select("doc_id", F.posexplode("bands").alias("band", "key")))
    sizes = staged(reps.groupBy("band", "key").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")).where("n > 1"))
    shared = staged(reps.join(sizes.select("band", "key", "leader"), ["band", "key"]))
    stars = staged(shared.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = _similar(stars, docs, idf, threshold)
    classes = staged(components(links))
    known, open_rows = _open(shared, classes)
    rest = staged(_second_round(known, open_rows).join(stars, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        links = staged(links.union(_similar(rest, docs, idf, threshold)))
        classes = staged(components(links))
    crowded = open_rows.where(F.col("outside") > DIRECT).select("band", "key", "doc_id")
    if not crowded.isEmpty():
        links = staged(links.union(_similar_across(crowded, classes, signed, docs, idf, threshold)))
        classes = staged(components(links))
    n_links = links.select(F.explode(F.array("a", "b")).alias("rep_id")).groupBy("rep_id").agg(F.count("*").alias("n_links"))
    tied = staged(first.join(classes, first.rep_id == classes.node, "left").join(n_links, "rep_id", "left").select(
        "sha", "rep_id", F.coalesce("component", "rep_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    members = staged(signed.select("doc_id", "sha").join(tied, "sha").drop("sha"))
    count = staged(members.groupBy("class_id").agg(F.count("*").alias("class_size")))
    return members.join(count, "class_id").select("doc_id", "rep_id", "class_id", "n_links", "class_size", (F.col("doc_id") == F.col("class_id")).alias("keep"))


def _open(shared: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all buckets with their class, and those of buckets of several classes with the largest and the number outside it."""
    known = staged(shared.join(classes, shared.doc_id == classes.node, "left").select("band", "key", "doc_id", F.coalesce("component", "doc_id").alias("class")))
    per_class = known.groupBy("band", "key", "class").agg(F.count("*").alias("n"))
    buckets = per_class.groupBy("band", "key").agg(F.sum("n").alias("n"), F.max_by("class", F.struct("n", "class")).alias("largest"), F.max("n").alias("most"), F.count("*").alias("classes")).where("classes > 1")
    buckets = staged(buckets.withColumn("outside", F.col("n") - F.col("most")).drop("classes", "most", "n"))
    return known, staged(known.join(buckets, ["band", "key"]))


def _unresolved(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of different classes in a bucket that the comparison with its leader left open; of crowded buckets, a first choice."""
    return _second_round(*_open(shared, classes))


def _second_round(known: DataFrame, open_rows: DataFrame) -> DataFrame:
    few = open_rows.where(F.col("outside") <= DIRECT)
    outside = few.where(F.col("class") != F.col("largest")).select("band", "key", F.col("doc_id").alias("x"), F.col("class").alias("class_x"))
    inside = few.select("band", "key", F.col("doc_id").alias("y"), F.col("class").alias("class_y"))
    pairs = outside.join(inside, ["band", "key"]).where("class_x <> class_y")
    many = open_rows.where(F.col("outside") > DIRECT).select("band", "key", "doc_id", "class")
    second = known.select(F.col("band").alias("band_2"), F.col("key").alias("key_2"), "doc_id")
    finer = staged(many.join(second, "doc_id").where("band <> band_2"))
    lead = finer.groupBy("band", "key", "band_2", "key_2").agg(F.min(F.struct("doc_id", "class")).alias("lead"), F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("band", "key", "band_2", "key_2", F.col("lead.doc_id").alias("x"), F.col("lead.class").alias("class_x"))
    stars = staged(lead).join(finer, ["band", "key", "band_2", "key_2"]).where("class_x <> class").select("x", F.col("doc_id").alias("y"))
    both = pairs.select("x", "y").union(stars)
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
