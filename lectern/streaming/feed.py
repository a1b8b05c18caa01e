"""Streams of messages: watermarks, ledgers, resumable state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as K
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lectern.functions import fixed


def messages(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    """New files of a folder as a stream; the checkpoint keeps what has been read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def deduplicated(stream: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """Each id once. Messages later than the watermark are dropped, and ids are forgotten after it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, by: list[str], size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return stream.withWatermark(ts, late).groupBy(window, *by).agg(F.count("*").alias("n"))


def since(df: DataFrame, ts: str, first: str, end: str) -> DataFrame:
    """Rows from a time up to, not with, another: a filter that reaches the scan."""
    return df.where((F.col(ts) >= F.lit(first).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))


def paged(fetch: Callable[[object], list[dict]], after, pages: int = 20, key: str = "id", ts: str = "ts") -> list[dict]:
    """Rows of a service that gives them page by page, the newest first: those from a time on.

    ``fetch`` gets the last key of the page before, none at first. Pages are asked
    for until one is empty or ends before the time, or until there were ``pages``.
    """
    out: list[dict] = []
    last = None
    for _ in range(pages):
        page = fetch(last)
        out += [m for m in page if m[ts] >= after]
        if not page or page[-1][ts] < after:
            break
        last = page[-1][key]
    return out


def _stitch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    author, at, unit = state.get if state.exists else (None, None, 0)
    rows = []
    for pdf in batches:
        for m in pdf.sort_values(["ts", "id"]).itertuples():
            seconds = m.ts.timestamp()
            if author != m.author or at is None or seconds - at > fixed.STITCH_SECONDS:
                unit += 1
            author, at = m.author, seconds
            rows.append((*key, m.id, m.author, unit))
    state.update((author, at, unit))
    yield pd.DataFrame(rows, columns=["channel", "id", "author", "unit"])


def stitched(stream: DataFrame) -> DataFrame:
    """Units of messages ``(channel, id, author, ts)`` by channel, as they come in; the state of a channel is its last message."""
    return stream.groupBy("channel").applyInPandasWithState(_stitch, "channel string, id long, author string, unit long", "author string, at double, unit long", "append", GroupStateTimeout.NoTimeout)


def pending(rows: DataFrame, ledger: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows that a ledger doesn't have yet; all of them where that is forced."""
    return rows if force else rows.join(ledger.select(key).distinct(), key, "left_anti")


#: Buckets of a ledger. Fixed when a ledger is begun; each has a file a batch until it is compacted.
BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _written(spark: SparkSession, path: str, schema: K.StructType) -> DataFrame | None:
    """A ledger's files with the columns asked for, so that no file is opened for its schema; nothing where there is no ledger yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def known(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame | None:
    """Keys that a ledger has, as far as ``rows`` may hold them: of the buckets of their keys, what lies between the least and the greatest of them.

    The buckets are folders and the range goes to the statistics of the files,
    so a batch of ids above all earlier ones reads no row of the ledger.
    """
    marks = rows.where(F.col(key).isNotNull()).groupBy(_bucket(key, buckets)).agg(F.min(key).alias("least"), F.max(key).alias("most")).collect()  # at most a row a bucket
    schema = K.StructType([K.StructField(key, rows.schema[key].dataType), K.StructField("bucket", K.IntegerType())])
    done = _written(rows.sparkSession, path, schema)
    if done is None or not marks:
        return None if done is None else done.where("false")
    return done.where(F.col("bucket").isin([m["bucket"] for m in marks]) & F.col(key).between(F.lit(min(m["least"] for m in marks)), F.lit(max(m["most"] for m in marks))))


def into_ledger(stream: DataFrame, path: str, key: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] = lambda df: df, buckets: int = BUCKETS):
    """Appends what a ledger doesn't have, batch by batch, to its buckets by a hash of the key.

    A batch that is run again, as when a run ends between the write and the
    checkpoint's commit, adds nothing. Rows without a key can't be told apart,
    and are left out.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = batch.where(F.col(key).isNotNull()).dropDuplicates([key]).persist()
        try:
            done = known(rows, path, key, buckets)
            fresh = work(rows if done is None else rows.join(done, [key], "left_anti"))
            fresh = fresh.withColumns({"batch": F.lit(number), "bucket": _bucket(key, buckets)})
            fresh.repartition("bucket").sortWithinPartitions("bucket", key).write.mode("append").partitionBy("bucket").parquet(path)
        finally:
            rows.unpersist()
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A ledger's rows, each key once, the one of its first batch: repeats stand there only where a compaction was cut off."""
    rows = spark.read.parquet(path)
    first = rows.groupBy("bucket", key).agg(F.min_by(F.struct(*(c for c in rows.columns if c not in (key, "bucket"))), "batch").alias("r"))
    return first.select(key, "r.*", "bucket")


def compacted(spark: SparkSession, path: str, key: str, most: int = 8) -> int:
    """Makes one sorted file of each bucket that has more than ``most``; returns how many buckets.

    The new file is written before the old ones go, so nothing is lost at any
    point; what is twice in between, `ledger` and `into_ledger` don't count.
    No batch may run meanwhile.
    """
    rows = spark.read.parquet(path)
    held = rows.select("bucket", F.input_file_name().alias("file")).distinct()
    full = held.groupBy("bucket").agg(F.collect_list("file").alias("files")).where(F.size("files") > most).collect()  # names of files of full buckets
    if full:
        once = ledger(spark, path, key).where(F.col("bucket").isin([r["bucket"] for r in full])).select(*rows.columns)
        once.repartition("bucket").sortWithinPartitions("bucket", key).write.mode("append").partitionBy("bucket").parquet(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in (f for r in full for f in r["files"]):
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name))
            p.getFileSystem(conf).delete(p, False)
        spark.catalog.refreshByPath(path)
    return len(full)


def last_ids(df: DataFrame, channel: str, key: str) -> DataFrame:
    """The watermark of each channel: its last id."""
    return df.groupBy(channel).agg(F.max(key).alias("last_id"))


def after(df: DataFrame, marks: DataFrame, channel: str, key: str) -> DataFrame:
    """Rows after their channel's watermark."""
    return df.join(marks, channel, "left").where(F.col("last_id").isNull() | (F.col(key) > F.col("last_id"))).drop("last_id")
