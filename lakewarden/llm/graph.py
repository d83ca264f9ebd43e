"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.staging import staged


def _towards_least(edges: DataFrame) -> DataFrame:
    """For rows (u, v): each u with the least of its v and itself, joined back; a hub's rows are pre-aggregated."""
    least = edges.groupBy("u").agg(F.min("v").alias("_least")).select("u", F.least("u", "_least").alias("_least"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _towards_least(both).where("v > u").select(F.col("v").alias("u"), F.col("_least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = _towards_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    moved = down.select(F.col("v").alias("u"), F.col("_least").alias("v"))
    return moved.unionAll(down.select("u", F.col("_least").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of integer edges (u, v) that has a smaller node in its component.

    component is the least node reachable; nodes that are least themselves have no row. Repeated
    edges and loops do no harm; no edges give no rows. Each round is staged, so a lost executor
    costs one re-read.
    """
    now = staged(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        now = staged(_small_star(_large_star(now)), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = tuple(seen)
