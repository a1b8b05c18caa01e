"""The ledger: replays, runs cut off, what a batch reads, compaction."""

from __future__ import annotations

import contextlib
import io
from pathlib import Path

import pytest

from lectern.streaming import feed

SCHEMA = "id long, v string"


def put(spark, path, ids):
    spark.createDataFrame([(i, f"v{i}") for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, src, out, checkpoint, **more):
    feed.into_ledger(feed.messages(spark, src, SCHEMA), out, "id", checkpoint, buckets=4, **more).awaitTermination()


def ids(spark, out):
    return sorted(r["id"] for r in spark.read.parquet(out).collect())


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")


def test_a_run_cut_off_before_its_checkpoint(spark, paths):
    src, out, check = paths
    put(spark, src, [1, 2, 2, None, 3])
    run(spark, src, out, check)
    assert ids(spark, out) == [1, 2, 3]
    for commit in Path(check, "commits").iterdir():  # as it is when a run ends between the write and the commit
        commit.unlink()
    seen = []
    run(spark, src, out, check, work=lambda df: seen.append(df.count()) or df)
    assert ids(spark, out) == [1, 2, 3] and seen == [0]


def test_a_run_cut_off_in_its_work(spark, paths):
    src, out, check = paths
    put(spark, src, [1, 2])

    def fails(df):
        raise RuntimeError("stop")
    with pytest.raises(Exception, match="stop"):
        run(spark, src, out, check, work=fails)
    run(spark, src, out, check)
    assert ids(spark, out) == [1, 2]


def test_what_a_batch_reads(spark, paths):
    src, out, check = paths
    put(spark, src, range(100))
    run(spark, src, out, check)
    new = spark.createDataFrame([(7, "x")], SCHEMA)
    found, shown = feed.known(new, out, "id", 4), io.StringIO()
    with contextlib.redirect_stdout(shown):
        found.explain("formatted")
    assert [r["id"] for r in found.collect()] == [7]
    assert "PartitionFilters: [isnotnull(bucket" in shown.getvalue() and "GreaterThanOrEqual(id,7), LessThanOrEqual(id,7)" in shown.getvalue() and "ReadSchema: struct<id:bigint>" in shown.getvalue()
    assert len({r["bucket"] for r in found.select("bucket").collect()}) == 1
    assert feed.known(new.limit(0), out, "id", 4).count() == 0 and feed.known(new, out + "-none", "id", 4) is None


def test_compaction(spark, paths):
    src, out, check = paths
    for n in range(3):
        put(spark, src, range(n * 20, n * 20 + 20))
        run(spark, src, out, check)
    names = set(Path(out).rglob("*.parquet"))
    assert len(names) == 12
    before = sorted((r["id"], r["v"], r["batch"]) for r in spark.read.parquet(out).collect())
    assert feed.compacted(spark, out, "id", most=2) == 4 and feed.compacted(spark, out, "id", most=2) == 0
    assert len(list(Path(out).rglob("*.parquet"))) == 4
    assert sorted((r["id"], r["v"], r["batch"]) for r in spark.read.parquet(out).collect()) == before
    spark.read.parquet(out).where("bucket = 0").write.mode("append").partitionBy("bucket").parquet(out)  # cut off before the old files went
    assert spark.read.parquet(out).count() > 60 and sorted((r["id"], r["v"], r["batch"]) for r in feed.ledger(spark, out, "id").collect()) == before
    run(spark, src, out, check + "2")
    assert feed.compacted(spark, out, "id", most=1) == 1 and sorted((r["id"], r["v"], r["batch"]) for r in spark.read.parquet(out).collect()) == before
