"""Running totals and ranks over an order of all rows, without a window over all rows in one task.

Rows are cut into ranges of the order by a sample of its keys, so ranges are about equal in rows
whatever the keys are (dense, hashed, null, repeated). Sums per range are added up, one row per
range. The cut rows are staged, so a range stays what it is when a task runs again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakewarden.llm.staging import staged

#: Accuracy of the cuts of id_blocks, as the part of all rows by which a block may be off, and most blocks.
CUT_ERROR, MOST_BLOCKS = 20_000, 4096


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The frame with ``_row`` and ``_part``, its range in the order; equal keys are told apart by _row, so no range is full of one key."""
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    return staged(rows.repartitionByRange(*order, F.col("_row")).withColumn("_part", F.spark_partition_id()), "ranges")


def _order(key: str, ties: tuple[str, ...], nulls_last: bool = False) -> list[Column]:
    first = F.col(key).asc_nulls_last() if nulls_last else F.col(key).asc_nulls_first()
    return [first, *(F.col(t).asc_nulls_first() for t in ties)]


def running_total(df: DataFrame, key: str, value: str, out: str, ties: tuple[str, ...] = (), nulls_last: bool = False) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in the order of key, then ties.

    Null values count 0; null keys come first, or last if asked. Rows equal in all of these are in any order. The frame
    is read twice: stage it if it is costly.
    """
    order = _order(key, ties, nulls_last)
    rows = in_ranges(df, order)
    one = F.coalesce(F.col(value), F.lit(0)).cast("long")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    bases = rows.groupBy("_part").agg(F.sum(one).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy("_part").orderBy(*order, "_row").rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum(one).over(inside), F.lit(0)))
    return local.join(F.broadcast(bases), "_part").withColumn(out, F.col("_base") + F.col("_local")).drop("_part", "_row", "_base", "_local")


def rank_within(df: DataFrame, group: str, key: str, out: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Add ``out``: place from 0 among the rows of the same group, in the order of key, then ties.

    A group may hold most rows: it is ranked by ranges, and the ranges' counts are added up. Rows of a null group go.
    """
    order = _order(key, ties)
    rows = in_ranges(df, [F.col(group), *order])
    counts = rows.groupBy(group, "_part").count()
    bases = counts.withColumn("_base", F.coalesce(F.sum("count").over(
        W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    local = rows.withColumn("_local", F.row_number().over(W.partitionBy(group, "_part").orderBy(*order, "_row")) - 1)
    return local.join(bases.select(group, "_part", "_base"), [group, "_part"]).withColumn(
        out, F.col("_base") + F.col("_local")).drop("_part", "_row", "_base", "_local")


def id_blocks(ids: DataFrame, key: str, rows: int) -> tuple[Column, int]:
    """A column that gives the block of an integer key, from 0 in ascending order, and the number of blocks.

    The cuts are quantiles of the keys, about one for so many rows; they are read back, so they are the same in
    every use. Keys should not repeat much, as equal keys share a block; null keys are in block 0.
    """
    count = ids.count()
    wanted = min(MOST_BLOCKS, -(-count // rows))
    if wanted < 2:
        return F.lit(0), 1
    shares = [k / wanted for k in range(1, wanted)]
    found = ids.agg(F.percentile_approx(key, shares, max(CUT_ERROR, 20 * wanted)).alias("c")).first()["c"] or []
    cuts = sorted(set(found))
    run = max(1, int(len(cuts) ** 0.5))
    runs = [cuts[k:k + run] for k in range(0, len(cuts), run)]
    if not runs:
        return F.lit(0), 1
    numbers = lambda values: "array(" + ", ".join(f"{v}L" if v > -(1 << 63) else "cast('-9223372036854775808' as bigint)" for v in values) + ")"
    key_sql = f"`{key}`"
    heads = numbers(r[0] for r in runs)
    before = f"size(filter({heads}, c -> c <= {key_sql}))"
    inner = f"size(filter(element_at(array({', '.join(map(numbers, runs))}), {before}), c -> c <= {key_sql}))"
    # A key below all cuts, or null, is in the first block; the runs before the key's own are whole.
    return F.expr(f"case when {key_sql} is null or {before} = 0 then 0 else ({before} - 1) * {run} + {inner} end"), len(cuts) + 1
