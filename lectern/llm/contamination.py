"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textkit
from lectern.llm.staging import buckets_for, prepare, running_total, staged, table

THRESHOLD = 0.8
#: Least hashes of a longer test item's sketch that any document over the threshold must have.
SKETCH = 24
#: Test items are searched for in blocks of about so many characters, so what is sent to executors has a fixed bound.
BLOCK_CHARS = 40_000_000


def size_class(shingles: int) -> int:
    """The partition of an item by size: the whole part of log2 of its shingles."""
    return max(0, int(shingles).bit_length() - 1)


def sketch_length(size: int, threshold: float) -> int:
    """Hashes kept of an item, by its size class.

    As many as may be missing from a document over the threshold for the
    largest item of the class, and ``SKETCH`` more, so that those needed are
    never fewer than ``SKETCH`` or, for a short item, all that must be there.
    """
    return int(np.floor((1 - threshold) * (2 ** (size_class(size) + 1) - 1) + 1e-9)) + SKETCH


@dataclass
class Index:
    """The items of a block: exact shingle sets, and the sketches of their size classes."""

    ids: np.ndarray
    sizes: np.ndarray
    words: np.ndarray  # words in a shingle of the item: 5, or all words of a shorter item
    sets: np.ndarray  # shingles of item i, rising: sets[at[i]:at[i + 1]]
    at: np.ndarray
    sketch: np.ndarray  # every (sketch hash, item), by hash
    sketch_item: np.ndarray
    needed: np.ndarray  # sketch hashes that a document needs to be verified, by item


def build_index(ids: list[int], texts: list[str], threshold: float) -> Index:
    w = textkit.words(texts)
    hashed, doc, _ = textkit.shingles(w, len(texts))
    order = np.lexsort((hashed, doc))
    hashed, doc = hashed[order], doc[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (doc[1:] != doc[:-1])
    hashed, doc = hashed[new], doc[new]
    sizes = np.bincount(doc, minlength=len(texts))
    at = np.concatenate(([0], np.cumsum(sizes)))
    keep = np.array([min(int(n), sketch_length(n, threshold)) for n in sizes], np.int64)
    # at least threshold x size of the item's shingles are in a document that has it, so at most the rest of its sketch is missing
    needed = np.maximum(1, keep - np.floor(sizes * (1 - threshold) + 1e-9).astype(np.int64))
    rank = np.arange(len(hashed)) - at[doc]
    kept = rank < keep[doc]  # the hashes are mixed, so the least are a MinHash sketch
    sketch, item = hashed[kept], doc[kept]
    order = np.argsort(sketch, kind="stable")
    return Index(np.array(ids, np.int64), sizes, np.minimum(np.diff(w.bounds), textkit.SHINGLE_WORDS), hashed, at, sketch[order], item[order], needed)


def find_items(index: Index, texts: list[str], threshold: float) -> list[tuple[int, int, int, int]]:
    """(text, item, shared shingles, item's shingles) of each pair with enough containment."""
    if not len(index.sketch):
        return []
    w = textkit.words(texts)
    found: list[tuple[int, int, int, int]] = []
    for size in sorted(set(index.words.tolist()) - {0}):
        if size == textkit.SHINGLE_WORDS:
            hashed, doc, _ = textkit.shingles(w, len(texts))
        else:
            hashed, doc = grams(w, size)
        left, right = np.searchsorted(index.sketch, hashed), np.searchsorted(index.sketch, hashed, side="right")
        hit = np.flatnonzero(right > left)
        if not len(hit):
            continue
        _, once = np.unique(np.stack((doc[hit].astype(np.uint64), hashed[hit])), axis=1, return_index=True)
        hit = hit[once]
        times = right[hit] - left[hit]
        place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(left[hit], times)
        code = np.repeat(doc[hit], times) * len(index.ids) + index.sketch_item[place]
        pairs, hits = np.unique(code, return_counts=True)
        i, k = pairs // len(index.ids), pairs % len(index.ids)
        near = (index.words[k] == size) & (hits >= index.needed[k])
        i, k = i[near], k[near]
        lo, hi = np.searchsorted(doc, i), np.searchsorted(doc, i, side="right")
        own, of = np.zeros(0, np.uint64), -1
        for text, item, a, b in zip(i.tolist(), k.tolist(), lo, hi, strict=True):
            if text != of:
                own, of = np.unique(hashed[a:b]), text
            want = index.sets[index.at[item]:index.at[item + 1]]
            at = np.minimum(np.searchsorted(own, want), len(own) - 1)
            shared = int((own[at] == want).sum())
            if shared >= threshold * index.sizes[item] - 1e-9:
                found.append((text, item, shared, int(index.sizes[item])))
    return found


def grams(w: textkit.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of fewer than five words, hashed as the only shingle of an item that short."""
    n = len(w.hash)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    odd = textkit.mix(np.arange(1, textkit.SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)
    whole = n - size + 1
    total = w.hash[:whole] * odd[0]
    for i in range(1, size):
        total = total + w.hash[i:whole + i] * odd[i]
    inside = w.doc[:whole] == w.doc[size - 1:]
    return textkit.mix(total[inside] ^ np.uint64(size)), w.doc[:whole][inside]


def _searcher(index, threshold):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf["doc_id"].to_numpy()
            for at, run in textkit.chunks(pdf["text"]):
                found = find_items(index.value, run, threshold)
                if found:
                    i, k, shared, size = (np.array(x) for x in zip(*found, strict=True))
                    yield pd.DataFrame({"doc_id": ids[at + i], "item_id": index.value.ids[k], "shared": shared, "item_shingles": size, "containment": shared / size})
    return search


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a document and a test item of whose five-word shingles it holds ``threshold`` or more.

    Takes ``doc_id``, ``text`` and ``item_id``, ``text``; other columns are ignored.
    Returns ``doc_id``, ``item_id``, ``shared``, ``item_shingles``, ``containment``.

    Items are partitioned by size (powers of two of their shingles), and each
    keeps a bottom sketch as long as its class needs. A document is far longer
    than an item, and a sketch of it would keep none of a short item's
    shingles, so it is probed with all of its own. One with as many hashes of
    an item's sketch as any document over the threshold must have is verified
    against the item's exact shingle set, so no pair is lost at any size.

    Items are sent in blocks of bounded size, cut by a running total, so an id
    that many items have fills no block beyond it; each block reads the
    documents once. An item of fewer than five words has one shingle of all its
    words. Null or wordless texts, on either side, match nothing, nor do rows
    without an id. Repeated items each match; a repeated document matches once
    a row. Empty tables give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null and item_id is not null")
    size = F.length("text").cast("long") + 100
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    blocks = max(1, -(-chars // BLOCK_CHARS))
    if blocks > 1:
        ranked = running_total(items, [], ["text", "item_id"], "before", buckets_for(n, per_bucket=2_000), size)
        items = staged(ranked.withColumn("block", F.floor(F.col("before") / BLOCK_CHARS)).drop("before"))
    out = None
    for block in range(blocks):
        rows = (items.where(F.col("block") == block) if blocks > 1 else items).toPandas()
        index = spark.sparkContext.broadcast(build_index(rows["item_id"].tolist(), rows["text"].tolist(), threshold))
        part = docs.mapInPandas(_searcher(index, threshold), "doc_id long, item_id long, shared long, item_shingles long, containment double")
        out = part if out is None else out.union(part)
    return out


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
