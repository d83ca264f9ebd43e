"""The stages of the corpus pipeline on a small corpus, each against what it should keep."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lakewarden.llm import raking, ranking, sigtree

pytest.importorskip("public_tokenizers")
DDL = "doc_id long, text string, lang string, source string, n_chars int, score string, kept string, n_removed string, weight string"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    words = [f"word{k}" for k in range(500)]
    base = [" ".join(rng.choice(words, 60)) for _ in range(50)]
    shared = " ".join(rng.choice(words, 55))
    texts = [t.capitalize() + "." for t in base] + [f"{shared}\n{base[k][::-1]}" for k in range(10)] + [base[0].capitalize() + ".", base[1].capitalize() + " more."]
    texts += [" ".join(["JUNK!!"] * 50) + f" {k}" for k in range(20)] + [None, "", "x"]
    rows = [(k, t, "en" if k % 3 else None, f"src{k % 4}", None if t is None else len(t), *["extra"] * 4) for k, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DDL).write.parquet(f"{path}/documents.parquet")
    labels = [(k, 1) for k in range(50)] + [(k, 0) for k in range(62, 80)] + [(None, 1), (3, None)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def plain_mixture(docs):
    """Draw and chance of every document, from numpy's own fit of the token cells to the softened shares."""
    text = F.coalesce("text", F.lit(""))
    tokens = F.when(F.trim(text) == "", 0).otherwise(F.size(F.split(F.trim(text), "[ \\n\\t\\r]+")))
    rows = docs.select("doc_id", *[F.coalesce(c, F.lit("none")).alias(c) for c in ("source", "lang")], raking.register_of(text).alias("topic"), tokens.alias("n"),
                       raking.draw(F.col("doc_id")).alias("u")).toPandas()
    dims = ["source", "lang", "topic"]
    cells = rows.groupby(dims).n.sum().astype(float)
    weight, total = cells.copy(), cells.sum()
    for _ in range(2000):
        for d in dims:
            share = cells.groupby(level=d).sum()
            share = share[share > 0] ** raking.SOFTENING
            factor = share / share.sum() * total / weight.groupby(level=d).sum()
            weight = weight * factor.reindex(weight.index.get_level_values(d)).fillna(0).to_numpy()
    chance = (weight / cells.where(cells > 0)).fillna(1.0)
    chance = chance / chance.max()
    return {r.doc_id: (r.u, chance[(r.source, r.lang, r.topic)]) for r in rows.itertuples()}


def test_stages_in_turn(spark, sf_dir, tmp_path):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        seen.append((docs, spark.read.parquet(f"{tmp_path}/{k}")))
        docs = seen[-1][1]
        assert name and (k == 4 or docs.columns == columns)
        assert k == 4 or docs.where("kept <> 'extra' or n_removed <> 'extra' or weight <> 'extra' or score <> 'extra'").count() == 0
    before, after = seen[0]
    model = ranking.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = [r["doc_id"] for r in before.collect() if model.scores([r["text"]])[0] >= ranking.CUT]
    assert ids(after) == sorted(kept) and set(range(50)) <= set(kept) and not set(range(62, 82)) & set(kept)
    before, after = seen[1]
    texts = {r["doc_id"]: r for r in after.collect()}
    assert 60 not in texts  # an exact copy of document 0 has nothing left
    assert texts[50]["text"].count("\n") == 1 and all(texts[k]["text"].count("\n") == 0 for k in range(51, 60) if k in texts)
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in texts.values())
    before, after = seen[2]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect() if r["doc_id"] is not None)
    sets = {k: set(sigtree.shingles(t, 5).tolist()) for k, t in rows}
    gone = {b for b in sets for a in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert ids(after) == sorted(set(sets) - gone) and 61 in gone
    before, after = seen[3]
    chances = plain_mixture(before)
    sure = {k for k, (u, p) in chances.items() if u < p - 1e-5}
    assert sure <= set(ids(after)) <= {k for k, (u, p) in chances.items() if u < p + 1e-5} and len(sure) > 0.5 * len(chances)
    before, after = seen[4]
    assert set(ids(after)) == set(ids(before))
    room = after.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert room <= 2048 and after.count() == before.count()


def test_rows_with_null_or_repeated_ids_are_documents_of_their_own(spark, sf_dir):
    rng = np.random.default_rng(3)
    a, b, c, d = (" ".join(rng.choice([f"word{k}" for k in range(500)], 40)) for _ in range(4))
    rows = [(5, a), (5, a), (5, b), (None, a), (None, c), (None, c), (2, d), (9, d)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars int").repartition(3)
    want = sorted([(5, a), (5, b), (-1, c), (2, d)])
    for stage in (pipeline.near_duplicates, pipeline.line_dedup):
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in got.collect()) == want


def test_run_returns_what_the_last_stage_does(spark, sf_dir):
    rows = pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset", "ids_crc32"} <= set(rows.columns) and rows.count() > 20


def test_stages_on_no_rows(spark, sf_dir):
    docs = spark.createDataFrame([], DDL)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
