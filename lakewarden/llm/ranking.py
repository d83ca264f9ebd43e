"""Document quality by Bradley-Terry ranking of preference pairs.

Each pair prefers a document labelled 1 to one labelled 0; the chance that it wins is the logistic
of the difference of their scores, and a score is linear in features of the text alone. Scores are
cut at a quantile of the training scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ("words", "lines", "word_chars", "distinct", "repeats", "same_lines", "upper", "digits", "blanks", "exclaims",
            "bars", "marks", "stops", "dashes", "wide", "entropy", "short", "capitalised", "marked_words")
SAMPLE_ROWS = 20_000
PAIRS_PER_LOSER = 40
CUT = 0.7

UPPER = np.arange(ord("A"), ord("Z") + 1)
LETTERS = np.concatenate([UPPER, UPPER + 32])
MARKS = np.frombuffer(b"#$%&*@^~<>{}[]\\/=+_", np.uint8)


def features_of(text: str | None) -> list[float]:
    """Features of one whole text; an empty or null one has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256).astype(np.float64)
    size = raw.sum()
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    letters = max(raw[LETTERS].sum(), 1.0)
    share = raw[raw > 0] / size
    root = lambda part, whole: float(np.sqrt(part / whole))
    return [
        float(np.log1p(len(words))), float(np.log1p(len(lines))), sum(map(len, words)) / n, len(set(words)) / n ** 0.8,
        root(sum(map(eq, words, words[1:])), n), root(len(lines) - len(set(lines)), len(lines)), root(raw[UPPER].sum(), letters),
        root(raw[48:58].sum(), size), raw[32] / size, root(raw[33], size), root(raw[124], size), root(raw[MARKS].sum(), size),
        root(raw[46] + raw[44], size), root(raw[45], size), root(raw[128:].sum(), size), float(-(share * np.log2(share)).sum()),
        sum(len(w) <= 2 for w in words) / n, sum(w[0].isupper() for w in words) / n, root(sum(not w[-1].isalnum() for w in words), n),
    ]


def held_out() -> Column:
    """Rows that no fit may see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Ranking:
    """score = logistic(weights . features - threshold), moved so that the threshold scores CUT."""

    weights: tuple[float, ...]
    threshold: float

    def scores(self, texts) -> np.ndarray:
        raw = np.array([features_of(t) for t in texts]).reshape(-1, len(FEATURES)) @ np.array(self.weights) - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30) - np.log(CUT / (1 - CUT))))


def score_of(model: Ranking):
    """A column function that scores texts in one pass; null texts score as empty ones."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(t.as_py() for t in texts), pa.float64())

    return score


def fit_pairs(grid: np.ndarray, labels: np.ndarray, seed: int = 7, penalty: float = 1e-3) -> Ranking:
    """Newton steps on the logistic loss of feature differences of (winner, loser) pairs.

    Every loser meets PAIRS_PER_LOSER drawn winners. The threshold is the quantile of the training
    scores that splits the labels best (mean of both classes' hit rates). Without both labels, all
    documents score CUT.
    """
    wins, loses = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(wins) or not len(loses):
        return Ranking((0.0,) * grid.shape[1], 0.0)
    scale = np.maximum(grid.std(axis=0), 1e-9)
    rng = np.random.default_rng(seed)
    lost = np.repeat(loses, PAIRS_PER_LOSER)
    gaps = (grid[rng.choice(wins, len(lost))] - grid[lost]) / scale
    beta = np.zeros(grid.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(gaps @ beta, -30, 30)))
        slope = gaps.T @ (1 - p) / len(gaps) - penalty * beta
        curve = (gaps * (p * (1 - p))[:, None]).T @ gaps / len(gaps) + penalty * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    weights = beta / scale
    raw = grid @ weights
    cuts = np.quantile(raw, np.linspace(0, 1, 401))
    hit = [(raw[wins] >= c).mean() + (raw[loses] < c).mean() for c in cuts]
    best = np.flatnonzero(np.isclose(hit, max(hit)))
    return Ranking(tuple(map(float, weights)), float((cuts[best[0]] + cuts[best[-1]]) / 2))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ranking:
    """Fit on at most ``sample_rows`` labelled rows that are not held out, chosen by a hash of doc_id.

    Repeated labels of a document count once; a document with both labels, other values or a null is
    left out. The sample is a bounded number of ids, so it is broadcast, and only its texts are read
    into features.
    """
    marks = labels.where(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.avg("quality").alias("_mark")).where("_mark in (0, 1)")
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "_mark", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = np.array([features_of(v.as_py()) for v in batch.column(2)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in grid.T)], ["doc_id", "_mark", *FEATURES])

    kind = dict(docs.dtypes)["doc_id"]
    sample = rows.mapInArrow(make, ", ".join([f"doc_id {kind}", "_mark double", *(f"{f} double" for f in FEATURES)])).toPandas()
    sample = sample.sort_values(["doc_id", *FEATURES])  # the same fit whatever order tasks end in
    return fit_pairs(sample[list(FEATURES)].to_numpy(np.float64), sample["_mark"].to_numpy(np.int64))


def scored(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    score = docs.select("doc_id", held_out().alias("held_out"), score_of(model)(F.col("text")).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
