"""Hard negatives by threshold joins in the manner of L2AP.

Anchors are stated queries. Blocks of them are joined with all rows above a score threshold each:

1. Dimensions are ordered by their energy over all rows. The inverted index of a block of rows
   omits, for each row, the longest run of last dimensions whose norm, times the largest norm of an
   anchor, stays below every threshold: a pair that reaches its threshold shares an indexed one.
2. Partial scores are accumulated over the indexed dimensions, a few at a time. A pair goes when its
   partial score plus the product of both remaining norms cannot reach the threshold.
3. What is left is finished with the dimensions that were not indexed, in whole numbers.

An anchor first joins rows of its own label for its positives, then rows of other labels for the
windows below each positive. Thresholds begin where few rows are expected; an anchor whose windows
are not full comes again with a lower one, at last with that of the window's end or none at all.
Every threshold gives right results; a poor first guess only costs another round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakewarden.llm.staging import discard, staged, staged_at

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A window holds scores of 80 % to 100 % of the positive's.
WINDOW = (80, 100)
ANCHORS = 1024
ROWS = 4096
TILE = 256
CHUNK = 16
HELD = 200_000
#: Rows expected above a first threshold, and how many times more above each further one.
EXPECTED, WIDER = 40, 8
#: Scores of so many anchors and rows, chosen by hash, tell where thresholds begin; results do not depend on them.
PILOT = (64, 4096)
#: Rows of a squared norm from here on have scores that no long holds.
LARGEST = 2.0 ** 62


def mining_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, q) of the rows that take part: label moved on where vec_id is divisible by 7, components floor(scale * x)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)) & (F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x * scale * scale) < LARGEST)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(sound)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", moved.alias("label"),
                       F.transform("v", lambda x: F.floor(x * scale)).cast("array<int>").alias("q"))


def dimension_order(rows: DataFrame) -> np.ndarray:
    """Positions by falling energy over all rows; one row per position and task is added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0)
        for batch in batches:
            for grid, _ in by_size(batch.column(0)):
                energy = (grid.astype(np.float64) ** 2).sum(axis=0)
                total = np.concatenate([total, np.zeros(max(len(energy) - len(total), 0))])
                total[:len(energy)] += energy
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["at", "energy"])

    found = rows.select("q").mapInArrow(add, "at int, energy double").groupBy("at").agg(F.sum("energy").alias("energy")).collect()
    return np.array([r["at"] for r in sorted(found, key=lambda r: (-r["energy"], r["at"]))], np.int64)


def by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of each length as one grid, and the places of their rows."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield flat[(ends[at] - size)[:, None] + np.arange(size)], at


def suffix_norms(grid: np.ndarray) -> np.ndarray:
    """Norm of each row from every dimension on, a hair too large; the last column is 0."""
    squares = np.zeros((len(grid), grid.shape[1] + 1))
    squares[:, :-1] = np.cumsum(grid[:, ::-1].astype(np.float64) ** 2, axis=1)[:, ::-1]
    return np.sqrt(squares) * (1 + 1e-9)


def threshold_join(a: np.ndarray, x: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of all pairs of rows of the whole-number grids a and x whose inner product is at least ``least[i]``."""
    na, nx, size = len(a), len(x), a.shape[1]
    ra, rx = suffix_norms(a), suffix_norms(x)
    # exact in doubles, else in longs
    kind = np.float64 if not size or float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * size < 2 ** 53 else np.int64
    a, x = a.astype(kind), x.astype(kind)
    reach = ra[:, 0]
    need = np.where(least > 0, least / np.maximum(reach, 1e-300), -1.0).min(initial=np.inf)
    indexed = (rx[:, :size] >= need).sum(axis=1)  # dimensions up to here; norms fall along a row
    order = np.argsort(-indexed, kind="stable")
    x, rx, indexed = x[order], rx[order], indexed[order]
    postings = np.where(np.arange(size) < indexed[:, None], x, 0)
    partial = np.zeros((na, nx), kind)
    alive = np.ones((na, nx), bool) if need <= 0 else np.zeros((na, nx), bool)
    for first in range(0, size, CHUNK):
        last = min(first + CHUNK, size)
        active = int(np.searchsorted(-indexed, -first))  # rows with an indexed dimension from here on
        if not active:
            break
        partial[:, :active] += a[:, first:last] @ postings[:active, first:last].T
        seen = np.minimum(indexed, last)
        alive = partial + ra[:, seen] * rx[np.arange(nx), seen] >= least[:, None]
        if np.count_nonzero(alive) * 8 < alive.size:
            break
    i, j = np.nonzero(alive)
    score = np.empty(len(i), np.int64)
    for at in range(0, len(i), HELD):
        part = slice(at, at + HELD)
        score[part] = np.einsum("ij,ij->i", a[i[part]], x[j[part]])
    keep = score >= least[i]
    return i[keep], order[j[keep]], score[keep]


@dataclass
class Block:
    """Some anchors and the windows to fill for each: scores from low to high, of rows with the same label or of others."""

    row: np.ndarray
    label: np.ndarray
    q: list[np.ndarray]
    least: np.ndarray  # no row below it is looked for
    own: np.ndarray  # place of a window's anchor in the block
    low: np.ndarray
    high: np.ndarray
    same: bool

    def only(self, keep: np.ndarray) -> Block:
        place = np.cumsum(keep) - 1
        held = keep[self.own]
        return replace(self, row=self.row[keep], label=self.label[keep], q=[v for v, k in zip(self.q, keep, strict=True) if k], least=self.least[keep],
                       own=place[self.own[held]], low=self.low[held], high=self.high[held])


def first_of_each(window: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` hits of every window: higher scores, then smaller ids."""
    order = np.lexsort((row, vec_id, -score, window))
    sorted_window = window[order]
    starts = np.searchsorted(sorted_window, sorted_window)
    return order[np.arange(len(order)) - starts < count]


def fill(rows: DataFrame, block: Block, order: np.ndarray, count: int) -> DataFrame:
    """(window, rank, vec_id, score): the first ``count`` rows of every window of the block with scores from ``least`` on."""
    held = rows.sparkSession.sparkContext.broadcast(block)  # at most ANCHORS anchors or about that
    span = np.searchsorted(block.own, np.arange(len(block.row) + 1))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = held.value
        sizes = np.array([len(v) for v in b.q])
        grids = {}
        for s in np.unique(sizes):
            at = np.flatnonzero(sizes == s)
            grids[int(s)] = np.array([b.q[k] for k in at], np.int64).reshape(len(at), -1)[:, order[order < s]], at
        found, n = [], 0

        def best() -> list[np.ndarray]:
            hits = [np.concatenate(c) for c in zip(*found, strict=True)]
            first = first_of_each(*hits, count)
            return [c[first] for c in hits]

        for batch in batches:
            number, vec_id, label = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for grid, places in by_size(batch.column(3)):
                anchors = grids.get(grid.shape[1])
                if anchors is None:
                    continue
                grid = grid[:, order[order < grid.shape[1]]].astype(np.int64)
                for at in range(0, len(grid), ROWS):
                    here = places[at:at + ROWS]
                    for first in range(0, len(anchors[0]), TILE):
                        mine = anchors[1][first:first + TILE]
                        i, j, score = threshold_join(anchors[0][first:first + TILE], grid[at:at + ROWS], b.least[mine])
                        i, j = mine[i], here[j]
                        fits = ((b.label[i] == label[j]) == b.same) & (b.row[i] != number[j])
                        i, j, score = i[fits], j[fits], score[fits]
                        times = span[i + 1] - span[i]
                        of = np.repeat(np.arange(len(i)), times)
                        window = span[i][of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
                        inside = (score[of] >= b.low[window]) & (score[of] <= b.high[window])
                        window, of = window[inside], of[inside]
                        found.append([window, score[of], vec_id[j[of]], number[j[of]]])
                        n += len(window)
                        if n > HELD:
                            found = [best()]
                            n = len(found[0][0])
        if n:
            window, score, vec_id, number = best()
            yield pa.RecordBatch.from_arrays([pa.array(window, pa.int32()), pa.array(score, pa.int64()), pa.array(vec_id, pa.int64()), pa.array(number, pa.int64())],
                                             ["window", "score", "vec_id", "row"])

    hits = rows.select("row", "vec_id", "label", "q").mapInArrow(join, "window int, score long, vec_id long, row long")
    rank = F.row_number().over(W.partitionBy("window").orderBy(F.desc("score"), "vec_id", "row"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= count).select("window", "rank", "vec_id", "score")


class Levels:
    """Where thresholds begin: scores, over the anchor's norm, that so many rows of a number of rows are expected to reach."""

    def __init__(self, anchors: DataFrame, rows: DataFrame):
        few = [[np.array(r["q"], np.float64) for r in df.orderBy(F.xxhash64("row")).limit(n).select("q").collect()] for df, n in zip((anchors, rows), PILOT, strict=True)]
        scores = [a @ x / max(float(np.linalg.norm(a)), 1e-300) for a in few[0] for x in few[1] if len(a) == len(x)]
        self.scores = np.sort(np.array(scores, np.float64))

    def above(self, value: np.ndarray) -> np.ndarray:
        """Share of the scores that reach a value."""
        return 1 - np.searchsorted(self.scores, value) / max(len(self.scores), 1)

    def at(self, share: np.ndarray) -> np.ndarray:
        """The value that such a share reaches; minus infinity where all rows are wanted."""
        if not len(self.scores):
            return np.full(len(share), -np.inf)
        place = np.clip(np.floor(len(self.scores) * (1 - share)), 0, len(self.scores) - 1).astype(np.int64)
        return np.where(share >= 1, -np.inf, self.scores[place])


def _least(levels: Levels, wanted: np.ndarray, among: np.ndarray, norms: np.ndarray, floor: np.ndarray) -> np.ndarray:
    return np.maximum(levels.at(wanted / np.maximum(among, 1)) * np.maximum(norms, 1e-300), floor)


def _filled(found: DataFrame, windows: int) -> np.ndarray:
    """Rows found for each window of a block."""
    out = np.zeros(windows, np.int64)
    for r in found.groupBy("window").count().collect():
        out[r["window"]] = r["count"]
    return out


def positives_of(rows: DataFrame, block: Block, peers: np.ndarray, norms: np.ndarray, levels: Levels, order: np.ndarray, count: int) -> dict[int, list]:
    """The first ``count`` other rows of every anchor's label, as (vec_id, score) in order, by the anchor's place in the block."""
    out: dict[int, list] = {}
    todo, step = np.arange(len(block.row)), 0
    while len(todo):
        least = _least(levels, np.full(len(todo), float(EXPECTED * WIDER ** step)), peers[todo], norms[todo], np.full(len(todo), -np.inf))
        keep = np.zeros(len(block.row), bool)
        keep[todo] = True
        part = replace(block.only(keep), least=least)
        hits: dict[int, list] = {}
        for r in fill(rows, part, order, count).orderBy("window", "rank").collect():  # at most count rows an anchor
            hits.setdefault(r["window"], []).append((r["vec_id"], r["score"]))
        done = np.array([len(hits.get(k, ())) == count or least[k] == -np.inf for k in range(len(todo))])
        out.update({int(todo[k]): hits.get(k, []) for k in np.flatnonzero(done)})
        todo, step = todo[~done], step + 1
    return out


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = WINDOW, scale: int = SCALE, anchors_a_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from rows (vec_id, embedding, label).

    Rows without vec_id, label or vector, with null or non-finite components, or with a squared norm of 2**62 or more
    take no part. Vectors of different lengths have no score. Each row of a repeated vec_id is a row and, where
    that is divisible by ``every``, an anchor of its own. A positive of a negative score has no negatives, one of 0 those of
    0. An empty frame gives an empty one; other columns are ignored. Blocks of anchors are taken in turn,
    so the broadcast block is bounded however many anchors there are.
    """
    spark = vectors.sparkSession
    rows = staged(mining_rows(vectors, scale), "mining-rows")
    sizes = rows.groupBy("label", F.size("q").alias("size")).count()
    peers = sizes.withColumn("others", F.sum("count").over(W.partitionBy("size")) - F.col("count")).withColumnRenamed("count", "peers")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("size", F.size("q")).join(peers, ["label", "size"])
    anchors = staged(anchors, "anchors")
    blocks = -(-anchors.count() // anchors_a_block)
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1))))
    order, levels = dimension_order(rows), Levels(anchors, rows)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    paths = []
    for k in range(blocks):
        held = sorted(anchors.where(F.col("block") == k).collect(), key=lambda r: r["row"])  # about ANCHORS rows
        if not held:
            continue
        number = np.arange(len(held))
        near = np.array([r["peers"] for r in held], np.float64)
        far = np.array([r["others"] for r in held], np.float64)
        q = [np.array(r["q"], np.int64) for r in held]
        norms = np.array([np.linalg.norm(v.astype(np.float64)) for v in q])
        nothing = np.full(len(held), np.iinfo(np.int64).min)
        block = Block(np.array([r["row"] for r in held]), np.array([r["label"] for r in held]), q, nothing.astype(np.float64), number, nothing,
                      np.full(len(held), np.iinfo(np.int64).max), True)
        found = positives_of(rows, block, near, norms, levels, order, positives)
        own, kept = [], []
        for a in range(len(held)):
            for vec_id, score in found[a]:
                low = -(-window[0] * score // window[1])
                if low <= score:  # not so for negative scores
                    own.append(a)
                    kept.append((held[a]["vec_id"], vec_id, score, low))
        paths += _windows_filled(rows, replace(block, own=np.array(own, np.int64), low=np.array([p[3] for p in kept], np.int64), high=np.array([p[2] for p in kept], np.int64), same=False),
                                 kept, far, norms, levels, order, negatives)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _windows_filled(rows: DataFrame, block: Block, kept: list[tuple], others: np.ndarray, norms: np.ndarray, levels: Levels, order: np.ndarray, count: int) -> list[str]:
    """Tables of the negatives in every window (anchor_id, positive_id, positive_score, low) of the block."""
    spark, paths, step = rows.sparkSession, [], 0
    at = np.arange(len(block.own))
    while len(at):
        mine = np.unique(block.own[at])
        keep = np.zeros(len(block.row), bool)
        keep[mine] = True
        part = block.only(keep)
        floor, lowest = np.full(len(mine), np.inf), np.full(len(mine), np.inf)
        np.minimum.at(floor, part.own, part.low.astype(np.float64))
        np.minimum.at(lowest, part.own, part.high.astype(np.float64))
        # as many rows as lie above the lowest positive, and some more
        wanted = levels.above(lowest / np.maximum(norms[mine], 1e-300)) * others[mine] + EXPECTED * WIDER ** step
        part = replace(part, least=_least(levels, wanted, others[mine], norms[mine], floor))
        result, path = staged_at(fill(rows, part, order, count), "windows")
        n = _filled(result, len(part.own))
        open_anchor = np.zeros(len(mine), bool)
        np.logical_or.at(open_anchor, part.own, (n < count) & (part.least[part.own] > part.low))
        told = spark.createDataFrame([(w, *map(int, kept[k][:3])) for w, k in enumerate(at.tolist()) if not open_anchor[part.own[w]]],
                                     "window int, anchor_id long, positive_id long, positive_score long")  # windows of one block
        done = result.join(F.broadcast(told), "window").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        paths.append(staged_at(done, "hard-negatives")[1])
        discard(spark, path)
        at, step = at[open_anchor[part.own]], step + 1
    return paths


def oracle(every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: int = SCALE) -> str:
    """The same as plain SQL over ``embeddings``: every anchor against every row."""
    return f"""with v as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor({scale} * cast(x as double))) as q from embeddings
  where label is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as materialized (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.q, b.q) as bigint) as score
  from v a, v b where a.vec_id % {every} = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {positives})
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as int) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not same and {window[0]} * positive_score <= {window[1]} * score and score <= positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) <= {negatives}"""
