"""Clustering of vectors by Sort-means: centroids are scanned in order of their distance from the last one."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.staging import prepare, staged, table

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
#: Whole-number components from here on might give distances that no long holds.
LARGEST = 1 << 26
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def nearest(x: np.ndarray, last: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smallest number of equals, and its squared distance.

    A row starts from its last centroid, and looks at the others in order of
    their distance from that one, until one stands strictly beyond twice the
    row's own distance from it: that one and all after it are further off.
    Squares are compared, so the bound is exact.
    """
    between = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2)
    own = ((x - centroids[last]) ** 2).sum(axis=1)
    best, distance = last.astype(np.int64), own.copy()
    for start in range(len(centroids)):
        rows = np.flatnonzero(last == start)
        for other in np.lexsort((np.arange(len(centroids)), between[start])):
            rows = rows[between[start, other] <= 4 * own[rows]]
            if not len(rows):
                break
            d = ((x[rows] - centroids[other]) ** 2).sum(axis=1)
            better = (d < distance[rows]) | ((d == distance[rows]) & (other < best[rows]))
            best[rows[better]], distance[rows[better]] = other, d[better]
    return best, distance


def _assigner(centroids: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column("v")
            x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(b), centroids.shape[1])
            best, distance = nearest(x, b.column("cluster").to_numpy(zero_copy_only=False), centroids)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), vectors, pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "v", "cluster", "distance"])
    return assign


def whole_vectors(vectors: DataFrame, scale: int, dimensions: int) -> DataFrame:
    """``vec_id`` and ``v``, the vector's components times ``scale`` as whole numbers, of rows that have ``dimensions`` finite ones."""
    sound = F.coalesce((F.size("embedding") == dimensions) & F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) * scale < LARGEST, F.lit(False))), F.lit(False))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def sort_means(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dimensions: int = DIMENSIONS) -> DataFrame:
    """Assigns every vector to one of ``clusters`` centroids after ``rounds`` rounds; returns the columns of `RESULT`.

    Takes ``vec_id`` and ``embedding``; other columns are ignored. Rows whose
    vector is null, of another size, or has a null or non-finite component are
    left out, and so are those with a component whose whole number is ``LARGEST``
    or more, whose distance may fit no long. A vector without an id is clustered,
    but is no first centroid; repeated rows count each; with fewer vectors than
    clusters all of them are first centroids; an empty table gives no rows.

    Each round is one pass over the vectors with their last centroid, written to
    the shared folder, and one aggregation of sums by centroid; the driver sees
    the centroids only. An inertia that no long holds is null.
    """
    spark = vectors.sparkSession
    prepare(spark)
    state = staged(whole_vectors(vectors, scale, dimensions).withColumn("cluster", F.lit(0)))
    first = state.where("vec_id is not null").orderBy(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256), "v").limit(clusters).select("v").collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = [list(r["v"]) for r in first]
    for left in range(rounds, -1, -1):
        state = staged(state.mapInArrow(_assigner(np.array(centroids, dtype=np.int64)), "vec_id long, v array<int>, cluster int, distance long"))
        if left:
            for r in state.groupBy("cluster").agg(F.count("*"), *(F.sum(F.col("v")[i]) for i in range(dimensions))).collect():
                centroids[r[0]] = [total // r[1] for total in r[2:]]
    inertia = dict(state.groupBy("cluster").agg(F.try_sum("distance")).collect())
    by_cluster = lambda values, kind: F.get(F.lit(values) if all(v is not None for v in values) else F.array(*map(F.lit, values)), F.col("cluster")).cast(kind)
    return state.select(
        "vec_id", "cluster", "distance",
        by_cluster([inertia.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(None if None in inertia.values() or sum(inertia.values()) >> 63 else sum(inertia.values())).cast("long").alias("inertia"),
        by_cluster([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids], "string").alias("centroid_sha256"),
    )


def op12_sort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 clusters of all vectors of 64 components after three rounds."""
    return sort_means(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    square = "(list_dot_product(a.v, a.v) - 2 * list_dot_product(a.v, c.v) + list_dot_product(c.v, c.v))::bigint"
    steps = [
        f"kept as materialized (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v from embeddings"
        f" where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"c0 as materialized (select row_number() over (order by h, v) - 1 as c, v from (select sha256('1:' || vec_id) as h, v from kept where vec_id is not null order by h, v limit {CLUSTERS}))",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"a{k} as materialized (select r, c, d from (select a.r, c.c, {square} as d, row_number() over (partition by a.r order by {square}, c.c) as place from kept a, c{k} c) where place = 1)")
        if k < ROUNDS:
            steps.append(f"s{k} as (select c, i, sum(v[i])::bigint as s, count(*)::bigint as n from a{k} join kept using (r), unnest(range(1, {DIMENSIONS + 1})) as t(i) group by c, i)")
            steps.append(f"n{k} as (select c, list(((s - ((s % n) + n) % n) // n)::double order by i) as v from s{k} group by c)")
            steps.append(f"c{k + 1} as materialized (select c0.c, coalesce(n.v, o.v) as v from c0 join c{k} o using (c) left join n{k} n using (c))")
    return f"""with {', '.join(steps)}
select vec_id, a.c::int as cluster, d as distance, sum(d) over (partition by a.c)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: x::bigint), ',')) as centroid_sha256
from a{ROUNDS} a join kept using (r) join c{ROUNDS} c using (c)"""


SQL = _sql()
