"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on many random directions. Two vectors collide on a direction if one
lies in a window centred on the other; pairs that collide on enough directions are verified by
their cosine. Window and count are calibrated so that a pair at the threshold passes with the wanted
probability. Vectors are sorted by one of the projections and cut into blocks of equal size, and
only blocks whose ranges come within the greatest possible distance of a linked pair meet. In many
dimensions these are nearly all blocks, so nearly all pairs of a label are counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.graph import components
from lakewarden.llm.order import rank_within
from lakewarden.llm.staging import staged

DIRECTIONS = 32
THRESHOLD = 0.98
MISS = 1e-6
BLOCK = 512
SEED = 20


@lru_cache(maxsize=64)
def directions(size: int, count: int = DIRECTIONS, seed: int = SEED) -> np.ndarray:
    """Unit vectors, one per column, the same wherever they are made."""
    drawn = np.random.default_rng([seed, size]).standard_normal((size, count))
    return drawn / np.maximum(np.linalg.norm(drawn, axis=0), 1e-300)


def calibrate(size: int, threshold: float, count: int = DIRECTIONS, miss: float = MISS) -> tuple[float, int]:
    """Half width of the window, and the collisions that a pair at the threshold reaches but for a chance of ``miss``.

    Its difference has the length sqrt(2 - 2 * threshold); in many dimensions a random direction
    sees it as nearly normal. In few dimensions the window is that whole length, which is certain.
    """
    far = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    if size < 16:
        return far, count
    width = min(far, 3 * far / math.sqrt(size))
    p = math.erf(width * math.sqrt(size) / far / math.sqrt(2))
    tail, need = 0.0, count + 1
    for k in range(count + 1):
        tail += math.comb(count, k) * p ** k * (1 - p) ** (count - k)
        if tail > miss:
            need = k
            break
    return width, need


def collisions(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """How many projections of each row of a and each row of b lie within the width."""
    counts = np.zeros((len(a), len(b)), np.uint8 if a.shape[1] < 256 else np.uint16)
    for j in range(a.shape[1]):
        counts += np.abs(a[:, j, None] - b[None, :, j]) <= width
    return counts


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of unit vectors x and y that pass the count and the cosine in double precision."""
    size = x.shape[1]
    width, need = calibrate(size, threshold)
    r = directions(size)
    i, j = np.nonzero(collisions((x @ r).astype(np.float32), (y @ r).astype(np.float32), np.float32(width + 1e-6)) >= need)
    keep = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
    return i[keep], j[keep]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least row number that each of n rows reaches by the links i, j."""
    up = np.arange(n)
    while True:
        least = up.copy()
        np.minimum.at(least, i, up[j])
        np.minimum.at(least, j, up[i])
        least = least[least]
        if (least == up).all():
            return up
        up = least


def _block_links(key: tuple, table: pa.Table, threshold: float) -> pa.Table:
    table = table.sort_by("rep")
    reps, copies, side = (table.column(c).to_numpy() for c in ("rep", "copies", "side"))
    x = np.array(table.column("vector").to_pylist(), np.float64).reshape(len(reps), -1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(b):
        i, j = linked(x[a], x[b], threshold)
        i, j = a[i], b[j]
    else:
        i, j = linked(x, x, threshold)
        i, j = i[i < j], j[i < j]
    found = np.bincount(i, copies[j], len(reps)) + np.bincount(j, copies[i], len(reps))
    roots = _roots(len(reps), i, j)
    keep = np.flatnonzero(found > 0)
    return pa.table({"rep": reps[keep], "links": found[keep].astype(np.int64), "root": reps[roots[keep]]})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per row of (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors of one label are compared. Null labels, null or zero vectors and vectors with null
    or non-finite components link with nothing; vectors of different lengths do not link. Equal
    vectors are one node with a number of copies, so copies are never paired. n_links counts other
    rows. An empty frame gives an empty one; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector"))
    largest = F.aggregate("vector", F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))
    sound = F.coalesce(
        F.col("label").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & (largest > 0), F.lit(False))
    scaled = F.when(sound, F.transform("vector", lambda v: v / largest + 0.0))
    rows = rows.select("vec_id", "label", scaled.alias("vector"))
    rows = rows.withColumn("_same", F.when(F.col("vector").isNotNull(), F.sha2(F.concat_ws(":", F.col("label").cast("string"), F.to_json("vector")), 256)))
    rows = staged(rows, "vectors")
    valid = rows.where("_same is not null")
    classes = valid.groupBy("_same").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = valid.join(classes, "_same").where("vec_id = rep").select(
        "_same", "rep", "copies", "label", "vector").dropDuplicates(["rep", "_same"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for v in batch.column("vector").to_pylist():
                v = np.array(v)
                at.append(float(directions(len(v), 1)[:, 0] @ v / np.linalg.norm(v)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.float64())], [*batch.schema.names, "at"])

    placed = reps.withColumn("_set", F.concat_ws(":", F.col("label").cast("string"), F.size("vector").cast("string")))
    placed = placed.mapInArrow(place, "_same string, rep long, copies long, label " + dict(vectors.dtypes)["label"] + ", vector array<double>, _set string, at double")
    placed = staged(placed.withColumn("_key", F.floor(F.col("at") * (1 << 24)).cast("long")), "placed")
    ranked = rank_within(placed, "_set", "_key", "_rank", ("at", "rep"))
    ranked = staged(ranked.select("_set", "rep", "copies", "vector", "at", F.floor(F.col("_rank") / block).cast("long").alias("block")), "blocks")
    spans = ranked.groupBy("_set", "block").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    far = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    left, right = spans.alias("l"), spans.alias("r")
    meets = left.join(right, (F.col("l._set") == F.col("r._set")) & (F.col("l.block") <= F.col("r.block")) & (F.col("r.low") - F.col("l.high") <= far))
    meets = meets.select(F.col("l._set").alias("_set"), F.col("l.block").alias("i"), F.col("r.block").alias("j"))
    sides = meets.select("_set", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionAll(
        meets.where("i < j").select("_set", "i", "j", F.col("j").alias("block"), F.lit(1).alias("side")))
    pairs = ranked.join(sides, ["_set", "block"]).select("_set", "i", "j", "side", "rep", "copies", "vector")
    found = pairs.groupBy("_set", "i", "j").applyInArrow(
        lambda key, table: _block_links(key, table, threshold), "rep long, links long, root long")
    found = staged(found, "links")
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = classes.join(links, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left").select(
        "_same", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    return rows.join(classes, "_same", "left").select(
        "vec_id", (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component", "vec_id")).alias("kept"))
