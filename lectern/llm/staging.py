"""Lineage cuts and distributed ranks shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lectern.sources.stage import fresh_path, ship, small, staged, sweep

__all__ = ["as_ddl", "buckets_for", "fresh_path", "map_rows", "prepare", "running_total", "staged", "sweep", "table", "whole_numbers"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder. One in fewer files than there are cores is dealt out first, as a file of one row group is one task."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if small(df, cores) else df


def prepare(spark: SparkSession, rows: int = 500) -> None:
    """Sends this package to the executors, once a context, and bounds the rows in an Arrow batch so that long texts fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    ship(spark)


def map_rows(df: DataFrame, f, schema: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``mapInPandas`` that keeps whole-number keys whole: a null among them would make pandas turn all into floats.

    ``f`` gets the keys as text, and gives them back as text where ``schema`` has them.
    """
    ids = [c for c in keys if c in df.columns]
    wanted = StructType.fromDDL(schema)
    given = StructType([StructField(x.name, StringType()) if x.name in ids else x for x in wanted.fields])
    out = df.withColumns({c: F.col(c).cast("long").cast("string") for c in ids}).mapInPandas(f, given)
    return out.select(*(F.col(x.name).cast(x.dataType).alias(x.name) if x.name in ids else x.name for x in wanted.fields))


def whole_numbers(df: DataFrame) -> tuple[str, ...]:
    return tuple(c for c, kind in df.dtypes if kind in ("tinyint", "smallint", "int", "bigint"))


def as_ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` {kind}" for c, kind in df.dtypes)


def buckets_for(rows: int, per_bucket: int = 20_000, least: int = 16) -> int:
    return max(least, -(-rows // per_bucket))


def running_total(df: DataFrame, keys: list[str], order: list[str], out: str, buckets: int,
                  value: Column | None = None, bucket: Column | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` (1 where none) over the rows of the same keys that come before.

    The order is by ``bucket`` (a hash of ``order`` where none is given), then
    by ``order``. A window runs inside a key's bucket only, and a second one
    over the totals of buckets, so no task sees all rows of a key.
    """
    value = F.lit(1).cast("long") if value is None else value
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int") if bucket is None else bucket
    df = df.withColumn("_bucket", bucket).withColumn("_value", value)
    by = [*keys, "_bucket"]
    totals = df.groupBy(*by).agg(F.sum("_value").alias("_total"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(*(F.col(k).alias(f"_k_{k}") for k in by), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_bucket") == F.col("_k__bucket")]
    joined = local.join(starts, same)
    return joined.withColumn(out, F.col("_start") + F.col("_local")).drop("_bucket", "_value", "_local", "_start", *(f"_k_{k}" for k in by))
