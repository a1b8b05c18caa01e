"""The corpus pipeline: quality, near duplicates, test leakage, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import contamination, near_dup, packing, personal_data, quality
from lectern.llm.staging import staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; rows without an id or text are scored as others are."""
    return quality.good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of exact and near copies; of rows with one id, one. Rows without an id are in no group, and stay."""
    kept = staged(near_dup.near_duplicates(docs).where("keep").select("doc_id"))
    once = docs.join(kept, docs.doc_id == kept.doc_id, "left_semi")
    repeated = not kept.groupBy("doc_id").count().where("count > 1").isEmpty()
    once = once.dropDuplicates(["doc_id"]) if repeated else once
    return once.union(docs.where("doc_id is null"))


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; rows without an id can't be told apart, and stay."""
    found = contamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(staged(found.select("doc_id").distinct()), "doc_id", "left_anti")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind, and their length as it then is."""
    return personal_data.redact(docs).selectExpr(*(f"cast(length(text) as {t}) as n_chars" if c == "n_chars" else f"`{c}`" for c, t in docs.dtypes))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's token ids goes."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_test_items),
    ("personal_data", without_personal_data),
    ("packing", packed),
]
#: None of the stages can be said in SQL; `tests/llm` has their brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs)
    return docs
