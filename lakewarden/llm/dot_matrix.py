"""Exact integer k-means that keeps every vector's dot products with all centroids.

A vector's squared distance to a centroid is its own norm, less twice their dot product, plus the
centroid's norm. The dot products are a column of the vectors' table. When centroids move, each one
changes by a sparse integer vector, and only the products with its nonzero components are added; a
centroid that stays costs nothing. Then the nearest centroid is found anew from the column. All
numbers are integers, so the result does not depend on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.staging import discard, staged_at

CENTROIDS = 16
ROUNDS = 3
SIZE = 64
SCALE = 64
#: Components beyond this have squared distances that no long holds.
LARGEST = 1 << 27
BATCH = 8192


def whole_components(vector: Column, size: int, scale: int) -> Column:
    """floor(scale * x) of each component; null unless there are ``size`` sound ones within LARGEST."""
    wide = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / scale))
    return F.when((F.size(vector) == size) & sound, wide.cast("array<int>"))


def starting_centroids(rows: DataFrame, count: int, seed: int) -> np.ndarray:
    """Components of the ``count`` rows with the least sha256 of ``seed:vec_id``; rows of one id by their components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").select(order.alias("h"), "q").orderBy("h", "q").limit(count).collect()
    return np.array([r["q"] for r in first], np.int64)


def products(q: np.ndarray, change: np.ndarray) -> np.ndarray:
    """What a change of the centroids adds to the dot products: only its nonzero components are looked at."""
    out = np.zeros((len(q), len(change)), np.int64)
    for k, row in enumerate(change):
        at = np.flatnonzero(row)
        if len(at):
            out[:, k] = q[:, at] @ row[at]
    return out


def assigned(rows: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """Rows (vec_id, q, dots) with the dots moved on by the change, and the nearest of the centroids as cluster and distance."""
    norms = (centroids * centroids).sum(axis=1)

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                q = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, -1)
                dots = products(q, change)
                held = part.column(2).flatten().to_numpy(zero_copy_only=False)
                if len(held):
                    dots += held.reshape(dots.shape)
                apart = (q * q).sum(axis=1)[:, None] - 2 * dots + norms
                nearest = apart.argmin(axis=1)  # the first of equal ones
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(norms))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, pa.array(dots.ravel())), pa.array(nearest, pa.int32()),
                     pa.array(apart[np.arange(len(q)), nearest])], ["vec_id", "q", "dots", "cluster", "distance"])

    return rows.select("vec_id", "q", "dots").mapInArrow(update, "vec_id long, q array<int>, dots array<long>, cluster int, distance long")


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid with vectors at the floor of their mean, the others as they are.

    A task sends one row per cluster and component; as many come back in all.
    """
    count, size = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, size + 1), np.int64)  # the last column counts vectors
        for batch in batches:
            cluster = batch.column(0).to_numpy(zero_copy_only=False)
            q = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(cluster), size)
            for k in np.unique(cluster):
                mine = q[cluster == k]
                total[k, :size] += mine.sum(axis=0)
                total[k, size] += len(mine)
        at, of = np.meshgrid(np.arange(size + 1), np.flatnonzero(total[:, size]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(of.ravel(), pa.int32()), pa.array(at.ravel(), pa.int32()), pa.array(total[of.ravel(), at.ravel()])], ["cluster", "at", "s"])

    sums = rows.select("cluster", "q").mapInArrow(add, "cluster int, at int, s long").groupBy("cluster", "at").agg(F.sum("s").alias("s"))
    grid = np.zeros((count, size + 1), np.int64)
    for r in sums.collect():
        grid[r["cluster"], r["at"]] = r["s"]
    held = grid[:, size] > 0
    out = centroids.copy()
    out[held] = grid[held, :size] // grid[held, size:]
    return out


def clustered(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = 1) -> DataFrame:
    """One row per kept row of (vec_id, embedding): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid.

    Kept are vectors of ``size`` components, none null or non-finite, or so large that squared distances
    do not fit a long (from 2**27 / scale on). With fewer rows than centroids each row starts one. Rows of a null
    vec_id are clustered but start no centroid; where no row has an id, there is no result. Rows of one vec_id are
    vectors of their own. An empty frame gives an empty one; other columns are ignored. Each round is a
    table in the shared folder, and the one before it goes.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_components(F.col("embedding"), size, scale).alias("q"))
    rows, path = staged_at(rows.where("q is not null").withColumn("dots", F.array().cast("array<long>")), "vectors")
    centroids = starting_centroids(rows, count, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    change = centroids
    for done in range(rounds + 1):
        if change.any() or not done:  # without a change the table holds already
            old = path
            rows, path = staged_at(assigned(rows, change, centroids), "dot-products")
            discard(spark, old)
        if done < rounds:
            after = moved(rows, centroids)
            change, centroids = after - centroids, after
    totals = {r["cluster"]: r["t"] for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("t")).collect()}
    of = lambda values, kind: F.array(*(F.lit(v) for v in values)).cast(f"array<{kind}>")[F.col("cluster")]
    texts = [",".join(map(str, c)) for c in centroids.tolist()]
    return rows.select(
        "vec_id", "cluster", "distance", of([int(totals.get(k, 0)) for k in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(int(sum(totals.values()))).cast("long").alias("inertia"),
        of([hashlib.sha256(t.encode()).hexdigest() for t in texts], "string").alias("centroid_sha256"),
        F.split(of(texts, "string"), ",").cast("array<long>").alias("centroid"))


def oracle(count: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = 1) -> str:
    """The same as plain SQL over ``embeddings``, all distances anew in every round."""
    steps = [f"""v as materialized (select vec_id, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as q from embeddings
  where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {size}),
c0 as materialized (select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as cluster, q as c from v order by cluster limit {count})"""]
    apart = f"list_sum(list_transform(range(1, {size + 1}), lambda i: (q[i] - c[i]) * (q[i] - c[i])))"
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (select vec_id, any_value(q) as q, min(d) as distance, arg_min(cluster, d * 1024 + cluster) as cluster
  from (select vec_id, q, cluster, cast({apart} as bigint) as d from v, c{r}) group by vec_id)""")
        if r < rounds:
            steps.append(f"""m{r} as (select cluster, i, cast(sum(x) as bigint) as s, count(*) as n from
  (select cluster, unnest(q) as x, unnest(range(1, {size + 1})) as i from a{r}) group by cluster, i),
c{r + 1} as materialized (select c{r}.cluster, coalesce(f.c, c{r}.c) as c from c{r} left join
  (select cluster, list((s - ((s % n) + n) % n) // n order by i) as c from m{r} group by cluster) f on f.cluster = c{r}.cluster)""")
    last = f"a{rounds}", f"c{rounds}"
    return f"""with {", ".join(steps)}
select vec_id, cast({last[0]}.cluster as int) as cluster, distance, cast(sum(distance) over (partition by {last[0]}.cluster) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from {last[0]} join {last[1]} on {last[0]}.cluster = {last[1]}.cluster"""
