"""Mixing documents to target weights by iterative proportional fitting.

Token counts are summed into cells of all dimensions; the cells are raked to each dimension's target
shares in turn until all hold. A document's chance is its cell's factor over the greatest factor,
so the expected tokens of the sample have the target shares. The draw is a hash of doc_id.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakewarden.llm.staging import discard, staged, staged_at, whole_text

DIMENSIONS = ("source", "lang", "topic")
#: Default targets are the present shares to this power.
SOFTENING = 0.95
TOLERANCE = 1e-6
SWEEPS = 400
SWEEPS_STAGED = 2
#: Deviations that shrink by less than this no longer come down.
STALLED = 0.999
CELLS_A_TASK = 20_000
SEED = 41
NULL = "∅"


def word_count(text: Column) -> Column:
    """Tokens of a text as blank-separated words."""
    return F.size(F.split(F.trim(F.translate(text, "\n\t\r", "   ")), " +")).cast("long")


def register_of(text: Column) -> Column:
    """A stand-in topic where documents carry none: the length of their words on average."""
    letters = F.length(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    mean = letters / F.greatest(F.length(text) - letters + 1, F.lit(1))
    return F.when(mean < 4.6, "terse").when(mean < 5.2, "plain").when(mean < 6.2, "wordy").otherwise("dense")


def softened(cells: DataFrame, dimension: str, exponent: float = SOFTENING) -> DataFrame:
    """Target shares proportional to a power below 1 of the present ones, which lifts small categories."""
    now = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0")
    total = now.agg(F.sum(F.pow("t", F.lit(exponent)))).first()[0] or 1.0
    return now.select(dimension, (F.pow("t", F.lit(exponent)) / total).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> tuple[DataFrame, float]:
    """Cells (dimensions, tokens) with ``weight``, whose sums have the target shares per dimension, and how far off the worst category is.

    Categories without a target get no weight; targets without cells are left out and the others
    scaled up. Cells without tokens stay at 0. It ends when no category is off by more than the
    tolerance (as a part of its target), when a sweep brings no category nearer, as for targets that no weights can meet, or
    after the sweeps: what is returned tells.
    """
    sums = cells.agg(F.sum("tokens"), F.count("*")).first()
    total, parts = sums[0] or 0, 1 + sums[1] // CELLS_A_TASK
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for name, shares in targets.items():
        held = shares.join(cells.where("tokens > 0").select(name).distinct(), name, "left_semi")
        shares_sum = held.agg(F.sum("share")).first()[0] or 1.0
        now = now.join(held.select(name, (F.col("share") / shares_sum * total).alias(f"_want_{name}")), name, "left")
    # From here on every row carries its goals: a sweep is one window over the summed cells per dimension.
    now, path = staged_at(now.coalesce(parts), "cells")
    worst = float("inf")
    for _ in range(0, sweeps, SWEEPS_STAGED):
        now = now.coalesce(1) if parts == 1 else now  # few cells are in one task as it is, and need no shuffle for each dimension
        for _ in range(SWEEPS_STAGED):
            for name in targets:
                reached = F.sum("weight").over(W.partitionBy(name))
                factor = F.coalesce(F.col(f"_want_{name}") / F.nullif(reached, F.lit(0.0)), F.lit(0.0))
                now = now.withColumn(f"_factor_{name}", factor).withColumn("weight", F.col("weight") * F.col(f"_factor_{name}"))
        before = path
        now, path = staged_at(now.coalesce(parts), "cells")
        discard(cells.sparkSession, before)
        off = [F.when(F.col(f"_factor_{n}") > 0, F.abs(F.col(f"_factor_{n}") - 1)).otherwise(F.lit(0.0)) for n in targets]
        last, worst = worst, now.agg(F.max(F.greatest(*off, F.lit(0.0)))).first()[0] or 0.0
        if worst <= tolerance or worst > STALLED * last:
            break
    return now.select(*cells.columns, "weight"), worst


def draw(key: Column, seed: int = SEED) -> Column:
    """A number from 0 to below 1 that the key alone decides."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, topic: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """Rows of docs with n_tokens, topic, weight, probability, kept and deviation added; no row is left out.

    deviation is the part by which the worst category misses its target; beyond TOLERANCE the targets are not met.

    Null categories are one category of their own. A document without tokens has its cell's chance.
    Rows of one doc_id are drawn alike; a null doc_id is one key. Without targets, every dimension is
    softened. Existing columns of these names are replaced.
    """
    text = whole_text()
    topic = register_of(text) if topic is None else topic
    tokens = F.when(F.trim(text) == "", 0).otherwise(word_count(text)) if tokens is None else tokens
    marked = docs.drop("n_tokens", "topic", "weight", "probability", "kept", "deviation").withColumns({"n_tokens": tokens.cast("long"), "topic": topic})
    keys = {f"_{d}": F.coalesce(F.col(d).cast("string"), F.lit(NULL)) for d in DIMENSIONS}
    cells = marked.select(*(k.alias(d) for d, k in zip(DIMENSIONS, keys.values(), strict=True)), "n_tokens").groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    cells = staged(cells, "cells")
    raked, off = rake(cells, targets or {d: softened(cells, d) for d in DIMENSIONS})
    if off > TOLERANCE:
        warnings.warn(f"no weights meet the targets: a category is off by {off:.2g} of its share", stacklevel=2)
    factor = F.coalesce(F.col("weight") / F.nullif(F.col("tokens").cast("double"), F.lit(0.0)), F.lit(1.0))
    raked = staged(raked.select(*(F.col(d).alias(f"_{d}") for d in DIMENSIONS), factor.alias("weight")), "factors")
    most = raked.agg(F.max("weight")).first()[0] or 1.0
    same = reduce(lambda a, b: a & b, (keys[f"_{d}"] == F.col(f"_{d}") for d in DIMENSIONS))
    joined = marked.join(raked, same).drop(*keys)
    chance = F.col("weight") / F.lit(most)
    return joined.withColumns({"probability": chance, "kept": draw(F.col("doc_id")) < chance, "deviation": F.lit(off)})
