"""Clustering, hard negatives and importance rules against plain versions."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import dot_matrix, hard_negatives, importance

DDL = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def whole(vector, scale):
    return [math.floor(scale * float(np.float32(x))) for x in vector]


def sound(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def plain_clusters(rows, count, rounds, size, seed=1):
    kept = [(r[0], whole(r[1], 64)) for r in rows if sound(r[1]) and len(r[1]) == size]
    starts = sorted(((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None))[:count]
    centroids = [q for _, q in starts]
    apart = lambda q, c: sum((x - y) ** 2 for x, y in zip(q, c, strict=True))
    for step in range(rounds + 1):
        of = [min(range(len(centroids)), key=lambda k: (apart(q, centroids[k]), k)) for _, q in kept]
        if step < rounds:
            for k in range(len(centroids)):
                mine = [q for (_, q), c in zip(kept, of, strict=True) if c == k]
                if mine:
                    centroids[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    distance = [apart(q, centroids[c]) for (_, q), c in zip(kept, of, strict=True)]
    inertia = [sum(d for d, c in zip(distance, of, strict=True) if c == k) for k in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(distance), names[c]) for (i, _), c, d in zip(kept, of, distance, strict=True)), key=str)


def clustered(spark, rows, **options):
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "'x' as q", "1 as cluster").repartition(3)
    return sorted((tuple(r)[:6] for r in dot_matrix.clustered(df, **options).collect()), key=str)


@pytest.mark.parametrize("count, rounds", [(1, 3), (4, 0), (5, 3)])
def test_clusters(spark, count, rounds):
    rng = np.random.default_rng(count)
    vectors = rng.normal(0, 1, (120, 6)).round(2)
    vectors[60:90] = vectors[0]  # a cluster of equal vectors
    rows = [(k, v.tolist(), 0) for k, v in enumerate(vectors)]
    rows += [(7, vectors[7].tolist(), 1), (None, vectors[3].tolist(), None), (200, None, 1), (201, [1.0] * 5, 1), (202, [None] + [1.0] * 5, 1),
             (203, [NAN] + [1.0] * 5, 1), (204, [INF] + [1.0] * 5, 1), (205, [], 1)]
    assert clustered(spark, rows, count=count, rounds=rounds, size=6) == plain_clusters(rows, count, rounds, 6)


def test_clusters_of_few_rows(spark):
    assert clustered(spark, []) == []
    two = [(1, [0.5] * 64, 0), (2, [-0.5] * 64, 0)]
    assert clustered(spark, two) == plain_clusters(two, 16, 3, 64)
    assert clustered(spark, [(None, [0.5] * 64, 0)]) == []
    far = [*two, (3, [2.0 ** 22] + [0.0] * 63, 0)]  # distances of the last one do not fit a long
    assert clustered(spark, far) == clustered(spark, two)
    near = [(1, [2.0 ** 20] * 64, 0), (2, [-(2.0 ** 20)] * 64, 0)]
    assert clustered(spark, near) == plain_clusters(near, 16, 3, 64)


def test_dot_products_follow_changes():
    rng = np.random.default_rng(2)
    q, old, new = (rng.integers(-50, 50, (n, 8)) for n in (30, 4, 4))
    new[2] = old[2]
    new[1, 3:] = old[1, 3:]
    assert (q @ old.T + dot_matrix.products(q, new - old) == q @ new.T).all()


def plain_negatives(rows, every, positives, negatives, low, high):
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and sound(v):
            kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, whole(v, 256)))
    out = []
    for a, (i, label, q) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, w, strict=True)), j, m) for b, (j, m, w) in enumerate(kept) if b != a and len(w) == len(q))
        for minus, j, _ in [r for r in scored if r[2] == label][:positives]:
            window = [r for r in scored if r[2] != label and low * -minus <= high * -r[0] <= high * -minus]
            out += [(i, j, rank + 1, k, -minus, -s) for rank, (s, k, _) in enumerate(window[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "'x' as row", "1 as score").repartition(3)
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(df, **options).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives(spark, seed, monkeypatch):
    monkeypatch.setattr(hard_negatives, "EXPECTED", 2)  # so that thresholds must be lowered
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.3, (150, 20))
    vectors[40:80] = vectors[10] + rng.normal(0, 0.01, (40, 20))  # a group of near copies
    vectors[100:110] = vectors[100]  # ties
    rows = [(k, v.tolist(), int(rng.integers(0, 3))) for k, v in enumerate(vectors)]
    rows += [(10, vectors[10].tolist(), 1), (20, vectors[41].tolist(), 2), (None, vectors[5].tolist(), 1), (300, None, 1), (310, [1.0, None], 1), (320, [NAN] * 20, 1),
             (330, vectors[3].tolist(), None), (340, [0.5] * 3, 1), (341, [0.4] * 3, 2), (342, [0.4] * 3, 1), (350, [0.0] * 20, 0), (360, [], 1), (361, [], 1), (362, [], 2)]
    got = mined(spark, rows, every=10, anchors_a_block=4)
    assert got == plain_negatives(rows, 10, 5, 5, 80, 100) and len(got) > 100


def test_hard_negatives_of_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 0)]) == []
    rows = [(100, [1.0], 0), (101, [1.0], 0), (102, [1.0], 1), (103, [-1.0], 1), (105, [0.8], 1)]
    assert mined(spark, rows) == plain_negatives(rows, 100, 5, 5, 80, 100) != []


@pytest.mark.parametrize("largest", [3, 1 << 30])
def test_threshold_join_loses_no_pair(largest):
    rng = np.random.default_rng(largest)
    a, x = rng.integers(-largest, largest, (9, 37)), rng.integers(-largest, largest, (50, 37))
    x[:, 20:] //= 7
    x[7] = 0
    scores = a @ x.T if largest < 10 else (a.astype(object) @ x.T.astype(object)).astype(np.int64)
    for least in (np.quantile(scores, [0.5] * 9), np.quantile(scores, np.linspace(0.5, 1, 9)), np.full(9, -np.inf), scores.max(axis=1).astype(float)):
        i, j, s = hard_negatives.threshold_join(a, x, least)
        want = {(i, j): scores[i, j] for i, j in zip(*np.nonzero(scores >= least[:, None]), strict=True)}
        assert dict(zip(zip(i, j, strict=True), s, strict=True)) == want


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    again = {k + m for k, w in enumerate(windows) if windows.count(w) > 1 for m in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def plain_grams(text, buckets):
    found = [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return [h % buckets for h in found] + [(a * 69069 + b * 31 + 7) % buckets for a, b in zip(found, found[1:], strict=False)]


TEXTS = ["a b c a b c", "x\xa0y é日 \x0b z\x1cq # *$", "one\n two\none\n\n \t\none \r\n two", "", None, " \n ", "w", "w w", "w w w w", "é" * 70000,
         " ".join(f"t{k % 61}" for k in range(200)), " ".join(f"<{k}>" for k in range(200)), "\n".join(["same line of five words"] * 30)]


def test_importance_rules(spark):
    rng = np.random.default_rng(3)
    good = [f"g{k}" for k in range(40)]
    texts = TEXTS + [" ".join(rng.choice(good, 80)) for _ in range(60)] + [" ".join(rng.choice([f"b{k}" for k in range(40)], 80)) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(13, texts[14]), (None, texts[15])]
    labels = [(k, 1) for k in range(13, 50)] + [(k, 0) for k in range(73, 80)] + [(20, 1), (21, 0), (22, None), (None, 1), (999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as n_words", "1 as kept").repartition(3)
    buckets = 1 << 12
    got = importance.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int"), buckets).collect()
    trusted = {k for k, _ in labels if k is not None} - {21, 22, *range(73, 80)}
    raw, target = np.ones(buckets), np.ones(buckets)
    for k, t in rows:
        counts = np.bincount(plain_grams(t, buckets), minlength=buckets)
        raw += counts
        target += counts if k in trusted else 0
    weight = np.rint(1e6 * (np.log(target / target.sum()) - np.log(raw / raw.sum())))
    want = []
    for k, t in rows:
        base, grams = plain_base(t), plain_grams(t, buckets)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        score = weight[grams].sum() / len(grams) / 1e6 if grams else 0.0
        want.append((k, *base, failed, round(score, 9), not failed and bool(weight[grams].sum() >= -100_000 * len(grams))))
    mine = [(*tuple(r)[:7], round(r["score"], 9), r["kept"]) for r in got]
    assert sorted(mine, key=str) == sorted(want, key=str)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert set(range(23, 73)) <= kept and not kept & set(range(73, 103))


def test_importance_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert importance.judged(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0
    row = importance.judged(spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(60)))], "doc_id long, text string"), none).first()
    assert row["n_words"] == 60 and not row["base_failed"]


def test_words_of_long_texts_and_full_caches(monkeypatch):
    data = " ".join(f"w{k}" for k in range(5000)).encode() + b"\n" + b"x" * 1000
    want = importance.word_hashes(data)
    monkeypatch.setattr(importance, "SLICE_BYTES", 97)
    monkeypatch.setattr(importance, "CACHED_WORDS", 5)
    assert (importance.word_hashes(data) == want).all() and len(want) == 5001


def test_likely_passes_all_that_are_there(spark):
    df = spark.range(5000).selectExpr("id", "'t' as text")
    wanted = spark.range(0, 5000, 7).unionAll(spark.sql("select cast(null as long)"))
    got = {r["id"] for r in importance.likely(df, wanted, "id").collect()}
    assert got >= set(range(0, 5000, 7)) and len(got) < 800
    assert importance.likely(df, wanted.where(F.lit(False)), "id").count() == 0
