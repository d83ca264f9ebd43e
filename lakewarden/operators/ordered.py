"""Previous-row lookups that stay parallel inside one hot group.

A plain lag() sorts each group in one task. Here every group is cut into chunks along its own
order and lag() runs per chunk. Only the first row of a chunk is then still without its
previous row, which is the last row of the chunk before: those edge rows, two per chunk, are
looked up among themselves. The result is the same as lag() over the whole group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

CHUNKS_PER_PARTITION = 2
BROADCAST_CUTS = 100_000


def _with_chunks(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``_chunk``, the number of cuts at or before a row in its group.

    The cuts are rows that a hash of their key picks, a few for each shuffle partition, so a chunk
    follows from the data alone and is the same whenever a task is run again. They are kept in runs of
    about the square root of their number: a row is compared with the first of each run, then
    with the cuts of one.
    """
    wanted = CHUNKS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = F.greatest(F.lit(1), F.floor(df.select(F.count(F.lit(1))).scalar() / wanted)).cast("bigint")
    at = F.struct(*[F.col(c) for c in order])
    picked = df.filter(F.pmod(F.xxhash64(*group, *order), every) == 0)
    cuts = picked.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], at.alias("_at"))
    cuts = cuts.groupBy(*[f"_g{i}" for i in range(len(group))]).agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))
    cuts = cuts.withColumn("_run", F.ceil(F.sqrt(F.size("_cuts"))).cast("int"))
    starts = F.sequence(F.lit(1), F.size("_cuts"), F.col("_run"))
    cuts = cuts.withColumn("_runs", F.transform(starts, lambda i: F.slice("_cuts", i, F.col("_run")))).drop("_cuts")
    cuts = cuts.withColumn("_heads", F.transform("_runs", lambda r: r[0]))
    same: list[Column] = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    # A tiny frame picks every row; a larger one about `wanted` of them.
    cuts = F.broadcast(cuts) if wanted <= BROADCAST_CUTS else cuts
    joined = df.join(cuts, reduce(lambda a, b: a & b, same), "left")
    joined = joined.withColumn("_before", F.size(F.filter("_heads", lambda c: c <= at)) - 1)  # runs that end before the row's own
    inside = F.size(F.filter(F.get("_runs", F.col("_before")), lambda c: c <= at))
    chunk = F.when(F.coalesce(F.col("_before"), F.lit(-1)) < 0, 0).otherwise(F.col("_before") * F.col("_run") + inside)
    return joined.withColumn("_chunk", chunk).drop("_run", "_runs", "_heads", "_before", *[f"_g{i}" for i in range(len(group))])


def previous_row(df: DataFrame, group: list[str], order: list[str], values: dict[str, str],
                 chunk: str | None = None) -> DataFrame:
    """Add the value of the previous row in each group under a new name.

    ``values`` maps new names to the columns looked up; ``order`` must be total inside a group.
    ``chunk`` is an expression that does not decrease along ``order`` (a month of a timestamp,
    say) for data known to be even over it; without one, chunks of about equal size are cut from
    the data, however many rows a group, a day or a start position holds. Rows are shuffled once;
    there are two edge rows per group and chunk, so the lookup among them is small.
    """
    cut = _with_chunks(df, group, order) if chunk is None else df.withColumn("_chunk", F.expr(chunk))
    inside = W.partitionBy(*group, "_chunk").orderBy(*order)
    looked = cut.withColumns({
        **{new: F.lag(src).over(inside) for new, src in values.items()},
        "_first": F.lag(F.lit(True)).over(inside).isNull(),
        "_last": F.lead(F.lit(True)).over(inside).isNull(),
    })
    out = [*df.columns, *values]
    within = looked.filter(~F.col("_first")).select(*out)
    edges = looked.filter(F.col("_first") | F.col("_last")).drop(*values)
    over = W.partitionBy(*group).orderBy(*order)
    across = edges.withColumns({new: F.lag(src).over(over) for new, src in values.items()})
    return within.unionByName(across.filter(F.col("_first")).select(*out))
