"""Quality scores by nearest-neighbour votes among labelled documents in a latent-semantic space."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textkit
from lectern.llm.staging import as_ddl, map_rows, prepare, table, whole_numbers

#: Labelled documents that the model is made of, at most; they are taken by a hash of their id.
SAMPLE = 4000
DIMENSIONS, NEIGHBOURS, SHARPNESS = 48, 25, 8.0
CUT = 0.3
_CLASSES = 16
_GRAMS = _CLASSES ** 3
_STEPS = 12
FEATURES = _GRAMS + 3 * _STEPS


@cache
def _class_table() -> np.ndarray:
    """A class for each code point: line feed, space, lower, upper, digit, five single marks, kinds of punctuation and letters."""
    out = np.full(0x32000, 14, np.uint8)
    single = {"\n": 0, " ": 1, "\t": 1, ".": 5, ",": 6, "!": 7, "|": 8, "?": 9}
    for i in range(len(out)):
        c = chr(i)
        kind = unicodedata.category(c)
        out[i] = single.get(c, {"Ll": 2, "Lu": 3, "Nd": 4, "Zs": 1, "Sm": 10, "Sc": 10, "Sk": 10, "So": 10, "Po": 10, "Ps": 11, "Pe": 11, "Pd": 13, "Pi": 13, "Pf": 13, "Pc": 13}.get(kind, 12 if kind[0] in "LM" else 14))
    return out


def _steps(share: np.ndarray) -> np.ndarray:
    """A share as nested steps, so that near shares have near vectors."""
    return (share[:, None] * _STEPS > np.arange(_STEPS)[None]).astype(np.float32)


def counts(texts: list[str]) -> np.ndarray:
    """A row for each text: damped counts of three character classes in a row, of length 1; and steps for how words and lines repeat and for capitals."""
    codes, offsets = textkit.code_points(texts)
    table = _class_table()
    kinds = table[np.minimum(codes, len(table) - 1)].astype(np.int32)
    out = np.zeros((len(texts), FEATURES), np.float32)
    w = textkit.words(texts)
    again = np.zeros(len(texts), np.float32)
    if len(w.hash) > 1:
        same = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
        again = np.bincount(w.doc[1:][same], minlength=len(texts)) / np.maximum(1, np.diff(w.bounds))
    capitals, lines = np.zeros(len(texts), np.float32), np.zeros(len(texts), np.float32)
    for i, t in enumerate(texts):
        k = kinds[offsets[i]:offsets[i + 1] - 1]
        if len(k) > 2:
            grams = np.bincount((k[:-2] * _CLASSES + k[1:-1]) * _CLASSES + k[2:], minlength=_GRAMS)
            out[i, :_GRAMS] = np.log1p(grams * (1000.0 / len(k)))
        seen = np.bincount(k, minlength=_CLASSES)
        capitals[i] = seen[3] / max(1, seen[2] + seen[3])
        parts = [x for x in t.split("\n") if x.strip()]
        lines[i] = 1 - len(set(parts)) / len(parts) if parts else 0
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    out /= np.where(norm > 0, norm, 1)
    for j, share in enumerate((again, lines, capitals)):
        out[:, _GRAMS + j * _STEPS:_GRAMS + (j + 1) * _STEPS] = _steps(share) * np.float32(0.1)
    return out


@dataclass
class Model:
    """Weights of features, their projection, and the labelled documents' unit vectors and labels."""

    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def place(self, rows: np.ndarray) -> np.ndarray:
        x = (rows * self.weight) @ self.axes
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(norm > 0, norm, 1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled documents, weighted by a power of their cosine; the share of label 1 where none is near."""
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        cosines = self.place(rows) @ self.vectors.T
        near = np.argpartition(cosines, len(self.labels) - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(float) ** SHARPNESS
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.clip(np.where(total > 1e-12, votes / np.where(total > 0, total, 1), self.prior), 0, 1)


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Weights by inverse document frequency, axes by a truncated singular value decomposition with a fixed start."""
    if not len(labels):
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    found = (rows > 0).sum(axis=0)
    weight = np.log((1 + len(rows)) / (1 + found)).astype(np.float32) + 1
    x = rows * weight
    rng = np.random.default_rng(8)
    basis = rng.standard_normal((FEATURES, min(DIMENSIONS + 16, len(rows)))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    axes = (basis @ right.T)[:, :DIMENSIONS].astype(np.float32)
    model = Model(weight, axes, np.zeros((0, 1), np.float32), labels.astype(float), float(labels.mean()))
    model.vectors = model.place(rows).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _vectoriser(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at, run in textkit.chunks(pdf["text"]):
            part = pdf.iloc[at:at + len(run)]
            yield pd.DataFrame({"doc_id": part["doc_id"].array, "quality": part["quality"].array, "vector": [r.tobytes() for r in counts(run).astype(np.float16)]})


def _scorer(model):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [np.zeros(0)] + [model.value.score(counts(run)) for _, run in textkit.chunks(pdf["text"])]
            yield pdf.drop(columns="text").assign(score=np.concatenate(found))
    return score


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` labelled documents that are not held out, taken by a hash of their id.

    Labels that are null, or whose document is not there, are passed over; of
    several for a document the least counts.
    """
    prepare(docs.sparkSession)
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = texts.mapInPandas(_vectoriser, "doc_id long, quality int, vector binary").toPandas()
    rows = rows.sort_values(["doc_id", "vector"], kind="stable").drop_duplicates("doc_id")
    vectors = np.stack([np.frombuffer(v, np.float16) for v in rows["vector"]]).astype(np.float32) if len(rows) else np.zeros((0, FEATURES), np.float32)
    return fit(vectors, rows["quality"].to_numpy(float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``docs``.

    Takes ``doc_id`` and ``text``; other columns are ignored, and only the text
    is scored. A null text is scored as an empty one, which is like no labelled
    document and gets the share of label 1; without labels all get 0.5. Equal
    texts have equal scores. Repeated rows stay; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark, rows=128)
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, _scorer(sent), "doc_id long, score double")


def good(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score ``cut`` or more."""
    spark = docs.sparkSession
    prepare(spark, rows=128)
    sent = spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [np.zeros(0)] + [sent.value.score(counts(run)) for _, run in textkit.chunks(pdf["text"])]
            yield pdf[np.concatenate(found) >= cut]

    return map_rows(docs, keep, as_ddl(docs), whole_numbers(docs))


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
