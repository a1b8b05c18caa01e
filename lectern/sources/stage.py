"""Tables written once to the folder that all executors share, so that what follows reads them and not their sources again."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset: the warehouse's on a cluster, as it is shared too, and a temporary one in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        local = re.match(r"local(\[|$)", spark.sparkContext.master)
        found = "file://" + tempfile.mkdtemp(prefix="lectern-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/lectern-stage"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    What follows reads files that every executor sees, so a lost executor
    costs a re-read of its split and not of the job so far.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> int:
    """Deletes what `staged` has written for this application; for a caller who has saved the results. Returns how many tables went."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, which `sweep` deletes too."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def put(spark: SparkSession, path: str, content: bytes) -> str:
    """Writes one small file by the file system of its path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(content))
    out.close()
    return path


def small(df: DataFrame, cores: int, bytes_a_core: int = 64_000_000) -> bool:
    """Whether a table is of fewer files than cores, and of so few bytes that dealing its rows out costs little; the files of a large one are not listed."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < cores * bytes_a_core and len(df.inputFiles()) < cores


def dealt(df: DataFrame, keys: list[str], bytes_a_task: int) -> DataFrame:
    """``df`` dealt out by its keys to tasks of about so many bytes by the plan's estimate (of a scan, those of its files), and to all cores at least; a plan that knows no size (it then tells of exabytes) to all cores."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = 0 if size >= 1 << 50 else -(-size // bytes_a_task)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, tasks), *keys)


def tasks_for(df: DataFrame, rows_a_task: int) -> int:
    """Tasks of about so many rows of a table whose rows are cheap to count, and as many as a shuffle has at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_a_task))


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a context: Arrow functions of the library are read there by name. Needless where it is installed on them."""
    sc = spark.sparkContext
    if getattr(sc, "_lectern_sent", None):
        return
    package = Path(__file__).resolve().parents[1]
    base = tempfile.mkdtemp(prefix="lectern-code-")  # on the driver alone; executors fetch the archive from it
    root = os.path.join(base, "tree")
    shutil.copytree(package, os.path.join(root, package.name), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(base, f"{package.name}_code"), "zip", root))
    shutil.rmtree(root)
    sc._lectern_sent = True
