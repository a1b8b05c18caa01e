"""Hard negatives by product quantisation: bounds from lookup tables choose the rows whose inner product is computed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lectern.llm.staging import fresh_path, prepare, staged, table

#: Rows that the code books are made of, at most; they are taken by a hash of their id.
SAMPLE = 4096
WIDTH, WORDS, STEPS = 2, 256, 6
#: Anchors in a block (what is broadcast), anchors whose lookup tables are held at once, rows and pairs that are scored at once.
BLOCK, TABLES, ROWS, PAIRS = 8192, 128, 8192, 1 << 16
#: Whole-number components from here on might give products that no long holds.
LARGEST = 1 << 24
#: What rounding may take from a bound, as a share of the lengths.
ROUNDING = 1e-5
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
NONE = -(1 << 62)
FOUND = "anchor_id long, slot int, other_id long, score long"


@dataclass
class Books:
    """Code words of each pair of components: an array of pairs x words x 2."""

    words: np.ndarray

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.words)), np.uint8)
        for m, words in enumerate(self.words):
            part = x[:, m * WIDTH:(m + 1) * WIDTH].astype(np.float32)
            out[:, m] = np.argmin((words ** 2).sum(axis=1) - 2 * part @ words.T, axis=1)
        return out

    def residuals(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The length of what the code words leave of each row, and what rounding may add to a score."""
        near = np.concatenate([words[codes[:, m]] for m, words in enumerate(self.words)], axis=1).astype(float)
        return np.linalg.norm(x - near, axis=1) + ROUNDING * (np.linalg.norm(near, axis=1) + np.linalg.norm(x, axis=1)) + ROUNDING

    def tables(self, anchors: np.ndarray) -> np.ndarray:
        """Products of the code words with some anchors: pairs x words x anchors."""
        return np.matmul(self.words, anchors.T.reshape(len(self.words), WIDTH, len(anchors)).astype(np.float32))


def train(rows: np.ndarray, dimensions: int) -> Books:
    """Code books by a few rounds of k-means in each pair of components, from a fixed start."""
    m = max(1, -(-dimensions // WIDTH))
    if not len(rows):
        return Books(np.zeros((m, 1, WIDTH), np.float32))
    rng, books = np.random.default_rng(11), []
    for k in range(m):
        part = rows[:, k * WIDTH:(k + 1) * WIDTH].astype(np.float32)
        words = part[rng.permutation(len(part))[:WORDS]].copy()
        for _ in range(STEPS):
            near = np.argmin((words ** 2).sum(axis=1) - 2 * part @ words.T, axis=1)
            n = np.bincount(near, minlength=len(words))
            for w in range(WIDTH):
                words[:, w] = np.where(n, np.bincount(near, part[:, w], len(words)) / np.maximum(n, 1), words[:, w])
        books.append(np.pad(words, ((0, min(WORDS, len(part)) - len(words)), (0, 0))))
    return Books(np.stack(books))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Lists as rows of whole numbers, zeros where a list is shorter."""
    ends = np.asarray(column.offsets).astype(np.int64)
    sizes, flat = np.diff(ends), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dimensions), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = flat
    return out


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together to tables of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _coder(books, dimensions: int, most: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches, ROWS):
            x, ids = matrix(t["v"].chunk(0), dimensions), t["vec_id"].to_numpy()
            same = np.column_stack([t["label"].to_numpy(), x])
            order = np.lexsort((ids, *same.T))
            first = np.append(True, (same[order][1:] != same[order][:-1]).any(axis=1))
            at = np.arange(len(order))
            kept = np.sort(order[at - np.maximum.accumulate(np.where(first, at, 0)) < most])
            codes = books.value.codes(x[kept])
            columns = [t["vec_id"].chunk(0).take(pa.array(kept)), t["label"].chunk(0).take(pa.array(kept)), t["v"].chunk(0).take(pa.array(kept)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(books.value.residuals(x[kept], codes))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "codes", "residual"])
    return code


@dataclass
class Best:
    """The ``k`` best rows of each of ``n`` slots so far: larger scores first, then smaller ids."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, n: int, k: int) -> Best:
        return cls(np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max))

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k, touched = self.scores.shape[1], np.unique(slots)
        s = np.concatenate([slots, np.repeat(touched, k)])
        v, i = np.concatenate([scores, self.scores[touched].ravel()]), np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((i, -v, s))
        s, v, i = s[order], v[order], i[order]
        rank = np.arange(len(s)) - np.searchsorted(s, s)
        s, v, i, rank = s[rank < k], v[rank < k], i[rank < k], rank[rank < k]
        self.scores[s, rank], self.ids[s, rank] = v, i


@dataclass
class Search:
    """A block of anchors, and for each a number of windows of scores in which its best rows are wanted."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same_label: bool
    k: int


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row."""
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k] if values.shape[1] >= k else np.full(len(values), -np.inf)


def scan(search: Search, books: Books, best: Best, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, codes: np.ndarray, residual: np.ndarray) -> int:
    """Adds some rows to the best of each window, and returns how many inner products that took.

    A row's score lies within the residual's length times the anchor's of what
    the lookup tables give. So a row is passed over if at most a score below the
    window, or below ``k`` rows that stand in it for certain, or at least one
    above it, is possible.
    """
    windows, computed = search.low.shape[1], 0
    for a in range(0, len(search.ids), TABLES):
        part = slice(a, min(a + TABLES, len(search.ids)))
        anchors = search.x[part]
        tables = books.tables(anchors)
        looked = np.zeros((len(ids), len(anchors)), np.float32)
        for m in range(len(tables)):
            looked += tables[m][codes[:, m]]
        looked = np.ascontiguousarray(looked.T).astype(float)
        spread = np.linalg.norm(anchors, axis=1)[:, None] * residual[None]
        lower, upper = looked - spread, looked + spread
        allowed = ((search.labels[part, None] == labels[None]) == search.same_label) & (search.ids[part, None] != ids[None])
        wanted = np.zeros(allowed.shape, bool)
        for w in range(windows):
            low, high = search.low[part, w].astype(float)[:, None], search.high[part, w].astype(float)[:, None]
            slots = np.arange(part.start, part.stop) * windows + w
            sure = allowed & (lower >= low + ROUNDING * np.abs(low)) & (upper <= high - ROUNDING * np.abs(high))
            least = np.maximum(kth(np.where(sure, lower, -np.inf), search.k), best.scores[slots, -1])[:, None]
            least = np.maximum(least, low)
            wanted |= allowed & (upper >= least - ROUNDING * np.abs(least)) & (lower <= high + ROUNDING * np.abs(high))
        of, at = np.nonzero(wanted)
        for i in range(0, len(of), PAIRS):
            anchor, row = of[i:i + PAIRS] + a, at[i:i + PAIRS]
            score = np.einsum("ij,ij->i", search.x[anchor], x[row])
            for w in range(windows):
                inside = (score >= search.low[anchor, w]) & (score <= search.high[anchor, w])
                if inside.any():
                    best.add(anchor[inside] * windows + w, score[inside], ids[row[inside]])
        computed += len(of)
    return computed


def _searcher(search, books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, m = search.value, len(books.value.words)
        windows = s.low.shape[1]
        best = Best.of(len(s.ids) * windows, s.k)
        for t in blocks(batches, ROWS):
            x = matrix(t["v"].chunk(0), s.x.shape[1])
            codes = np.frombuffer(b"".join(t["codes"].to_pylist()), np.uint8).reshape(len(t), m)
            scan(s, books.value, best, t["vec_id"].to_numpy(), t["label"].to_numpy(), x, codes, t["residual"].to_numpy())
        slot, rank = np.nonzero(best.scores > NONE)
        for i in range(0, len(slot), PAIRS):
            at = slot[i:i + PAIRS], rank[i:i + PAIRS]
            yield pa.RecordBatch.from_arrays([pa.array(s.ids[at[0] // windows]), pa.array((at[0] % windows).astype(np.int32)), pa.array(best.ids[at]), pa.array(best.scores[at])], ["anchor_id", "slot", "other_id", "score"])
    return run


def first_rows(index: DataFrame, search: Search, books) -> DataFrame:
    """``anchor_id``, ``slot``, ``other_id``, ``score`` and ``rank`` of the first rows of each window; each task gives its own first ones."""
    sent = index.sparkSession.sparkContext.broadcast(search)
    found = index.mapInArrow(_searcher(sent, books), FOUND)
    order = W.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= search.k)


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``label`` and ``v``, the components times ``scale`` as whole numbers, of rows with an id, a label and finite components."""
    sound = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) * scale < LARGEST, F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    known = vectors.where("vec_id is not null and label is not null and embedding is not null").where(sound)
    return known.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))


def hard_negatives(vectors: DataFrame, is_anchor: Column | Callable[[Column], Column], positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = 256, sample: int = SAMPLE) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of its label, the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` per cent of the positive's.

    Takes ``vec_id``, ``embedding`` and ``label``; other columns are ignored.
    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score``. A score is the inner product of
    the components times ``scale``, rounded down; missing components of the
    shorter vector count as 0. Larger scores come first, ties by the smaller id.

    Left out are rows without an id, a label or a vector, with a null or
    non-finite component, or one whose whole number is ``LARGEST`` or more (its
    products may fit no long). Of rows that share an id the least label and
    vector counts. An empty table, or one without anchors, gives no rows.

    Code books are made of at most ``sample`` rows; all rows are coded, and the
    length of what the code leaves is stored with them. Of equal vectors of one
    label in a batch those with the smallest ids are stored, as many as any
    anchor may return. Anchors are taken in blocks of at most ``BLOCK`` by id,
    and each block looks at all coded rows twice: for positives, then within the
    windows that these give. Every row whose bounds reach a window is scored by
    whole numbers, so nothing depends on the code books but time.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = staged(whole_vectors(vectors, scale))
    if not rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        rows = staged(rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*"))
    dimensions = -(-(rows.agg(F.max(F.size("v"))).first()[0] or 1) // WIDTH) * WIDTH
    known = rows.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    books = spark.sparkContext.broadcast(train(matrix(known["v"].combine_chunks(), dimensions) if len(known) else np.zeros((0, dimensions)), dimensions))
    index = staged(rows.mapInArrow(_coder(books, dimensions, max(positives + 1, negatives)), "vec_id long, label long, v array<int>, codes binary, residual double"))
    anchors = staged(rows.where(is_anchor(F.col("vec_id")) if callable(is_anchor) else is_anchor))
    out, last = fresh_path(spark, "negatives"), None
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    while True:
        page = (anchors if last is None else anchors.where(F.col("vec_id") > last)).orderBy("vec_id").limit(BLOCK).toArrow()
        if not len(page):
            return spark.read.schema(schema).parquet(out)
        ids, labels, x = page["vec_id"].to_numpy(), page["label"].to_numpy(), matrix(page["v"].combine_chunks(), dimensions)
        last = int(ids[-1])
        every = np.full((len(ids), 1), NONE), np.full((len(ids), 1), -NONE)
        near = first_rows(index, Search(ids, labels, x, *every, True, positives), books).select("anchor_id", "rank", "other_id", "score").toPandas()
        blank = np.zeros((len(ids), positives), np.int64)
        at = np.searchsorted(ids, near["anchor_id"].to_numpy()), near["rank"].to_numpy() - 1
        score, lows, highs = blank.copy(), blank + 1, blank.copy()
        score[at] = near["score"]
        lows[at], highs[at] = -((-low * score[at]) // 100), (high * score[at]) // 100
        found = first_rows(index, Search(ids, labels, x, lows, highs, False, negatives), books)
        given = spark.createDataFrame(pd.DataFrame({"anchor_id": near["anchor_id"], "slot": (near["rank"] - 1).astype("int32"), "positive_id": near["other_id"], "positive_score": near["score"]}), "anchor_id long, slot int, positive_id long, positive_score long")
        found.join(given, ["anchor_id", "slot"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)


def op11_quantised_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the first five positives of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    changed = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(changed, lambda vec_id: vec_id % 50 == 0)


SQL = """with v as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score from v a, v b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, other_id as positive_id, score as positive_score from (select *, row_number() over (partition by anchor_id order by score desc, other_id) as k from s where same) where k <= 5),
n as (select p.*, other_id as negative_id, score as negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::int as rank
  from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3"""
