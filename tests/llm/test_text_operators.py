"""Fingerprints, line runs, ranking, raking, fixity and the pipeline on small fixtures."""

import hashlib
import math
import re
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import imatch, line_runs, merkle, order, queries, raking, ranking
from lakewarden.llm.staging import shared_folder

DDL = "doc_id long, text string"


def test_edited_text_and_fingerprints(spark):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(rng.choice(words, 150)) for _ in range(60)]
    rows = [(k * 300, t) for k, t in enumerate(texts)] + [(90_000, texts[3]), (90_001, None), (90_002, ""), (90_003, "é" * 5), (90_004, texts[5][:-1])]
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(spark.createDataFrame(rows, DDL).selectExpr("*", "'x' as term").repartition(4)).collect()}
    down = sorted(rows, reverse=True)
    for k, (key, text) in enumerate(down):
        text, other = text or "", down[(k + 1) % len(down)][1] or ""
        cut = len(text) // 2
        assert got[key]["n_chars"] == len(text)
        assert got[key]["edited_sha256"] == hashlib.sha256((text[:len(text) - cut] + other[:cut]).encode()).hexdigest()
        assert 0 <= got[key]["near_edited"] <= 1 and 0 <= got[key]["near_next"] <= 1
    assert got[900]["fingerprint"] == got[90_000]["fingerprint"] and got[90_001]["fingerprint"] == got[90_002]["fingerprint"]
    assert len({r["fingerprint"] for r in got.values()}) == len({t or "" for _, t in rows})
    mean = lambda c: np.mean([got[k * 300][c] for k in range(60)])
    assert mean("near_edited") > mean("near_next") + 0.1
    assert got[90_002]["near_next"] == 1.0  # two empty texts


def test_fingerprints_of_few_rows(spark):
    assert imatch.edited_fingerprints(spark.createDataFrame([], DDL)).count() == 0
    one = imatch.edited_fingerprints(spark.createDataFrame([(5, "abcd")], DDL)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    assert imatch.edited_fingerprints(spark.createDataFrame([(5, "a b"), (5, "a b"), (None, "c")], DDL)).count() == 3


def test_every_term_of_the_band_is_in_a_fingerprint(spark):
    number = imatch.lexicon_of(F.col("id"))
    held = dict(spark.range(imatch.SLOTS).groupBy(number.alias("n")).count().collect())
    assert sorted(held) == list(range(imatch.COUNT)) and sum(held.values()) == imatch.SLOTS
    # two rows share each word t<k>, which alone is in the band; "all" is above it, u<k> below
    rows = [(k, f"all t{k // 2} u{k}") for k in range(80)]
    got = {r["doc_id"]: r["fingerprint"].split(".")[:imatch.COUNT] for r in imatch.edited_fingerprints(spark.createDataFrame(rows, DDL)).collect()}
    assert all(sum(x != imatch.NONE for x in f) == 1 for f in got.values())
    assert len({tuple(f) for f in got.values()}) == 40 and all(got[k] == got[k + 1] for k in range(0, 80, 2))


def kept_lines(rows, least):
    """Lines that stay: every run that is in an earlier place too goes, whatever its length in lines.

    Blank lines go only with the shortest runs around them.
    """
    bodies, runs = {}, []
    for key, text in rows:
        lines = (text or "").split("\n")
        bodies[key] = lines
        full = [k for k, x in enumerate(lines) if x.strip(" ")]
        size = [len(lines[k].strip(" ").split(" ")) for k in full]
        for i in range(len(full)):
            for j in range(i, len(full)):
                total = sum(size[i:j + 1])
                if total >= least:
                    short = total - size[i] < least or total - size[j] < least
                    runs.append((tuple(lines[k] for k in full[i:j + 1]), (key, full[i]), range(full[i], full[j] + 1) if short else full[i:j + 1]))
    first = {}
    for run, place, _ in runs:
        first[run] = min(first.get(run, place), place)
    gone = {(place[0], k) for run, place, inside in runs if first[run] < place for k in inside}
    return {key: [x for k, x in enumerate(lines) if (key, k) not in gone] for key, lines in bodies.items()}


@pytest.mark.parametrize("least", [1, 4, 6])
def test_line_runs(spark, least):
    rng = np.random.default_rng(least)
    pool = ["a b", "c", "d e f", "", "  ", "g h i j k l m", "n", "o p q"]
    rows = [(k, "\n".join(rng.choice(pool, rng.integers(1, 14)))) for k in range(40)] + [(50, None), (51, ""), (52, "a b\r"), (53, "g h i j k l m\n" * 5)]
    docs = spark.createDataFrame(rows, DDL).selectExpr("*", "1 as spans", "'x' as n", "2 as first").repartition(3)
    got = {r["doc_id"]: r for r in line_runs.without_repeats(docs, least).collect()}
    want = kept_lines(rows, least)
    for key, text in rows:
        assert got[key]["text"] == (None if text is None else "\n".join(want[key])), key
        assert got[key]["n_removed"] == (0 if text is None else len(text.split("\n")) - len(want[key]))
        assert got[key]["n"] == "x"


def test_line_runs_edges(spark):
    assert line_runs.without_repeats(spark.createDataFrame([], DDL)).count() == 0
    line = "many words " * 20
    rows = line_runs.without_repeats(spark.createDataFrame([(None, line), (1, line), (2, line)], DDL)).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {1: line, 2: "", None: ""}


def test_ranking_held_out(spark):
    rng = np.random.default_rng(6)
    good = [" ".join(rng.choice(["tree", "river", "house", "green", "under", "walks"], 40)) + "." for _ in range(120)]
    bad = [" ".join([str(rng.choice(["TREE!!", "RIVER!!", "x$$$"]))] * 40) for _ in range(40)]
    rows = list(enumerate(good + bad + ["", None]))
    labels = [(k, int(k < 120)) for k, _ in rows[:160]] + [(0, 1), (3, 0), (5, None), (999, 1)]
    docs = spark.createDataFrame(rows, DDL).withColumn("_mark", F.lit("x"))
    model = ranking.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = ranking.scored(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 160]
    assert held and np.mean([r["predicted"] == (r["doc_id"] < 120) for r in held]) > 0.95
    none = ranking.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert {r["predicted"] for r in ranking.scored(docs, none).collect()} == {1}
    assert ranking.scored(docs.where("false"), model).count() == 0


def test_raking_meets_its_targets(spark):
    rng = np.random.default_rng(9)
    rows = [(k, "word " * int(rng.integers(0, 30)), str(rng.choice(["a", "b", "c"], p=[.7, .2, .1])), [None, "en", "de"][int(rng.integers(0, 3))]) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("weight", F.lit("x"))
    topic = F.when(F.col("doc_id") % 5 == 0, "t").otherwise("u")
    share = lambda d, name: spark.createDataFrame(list(d.items()), f"{name} string, share double")
    targets = {"source": share({"a": .4, "b": .3, "c": .3, "absent": .5}, "source"), "lang": share({"en": .5, "de": .3, raking.NULL: .2}, "lang"), "topic": share({"t": .3, "u": .7}, "topic")}
    got = raking.mixed(docs, targets, topic).toPandas()
    assert len(got) == 600 and got.probability.between(0, 1).all() and np.isclose(got.probability.max(), 1)
    for name, want in (("source", {"a": .4, "b": .3, "c": .3}), ("topic", {"t": .3, "u": .7})):
        tokens = (got.n_tokens * got.weight).groupby(got[name]).sum() / (got.n_tokens * got.weight).sum()
        assert all(abs(tokens[k] - v) < 2e-6 for k, v in want.items())
    assert (got.deviation <= raking.TOLERANCE).all()
    assert abs(got.kept.sum() - got.probability.sum()) < 60
    # numpy's own fit of the same table
    cells = got.assign(lang=got.lang.fillna(raking.NULL)).groupby(["source", "lang", "topic"]).n_tokens.sum()
    cube = cells.unstack(fill_value=0).stack().astype(float)
    want = {"source": {"a": .4, "b": .3, "c": .3}, "lang": {"en": .5, "de": .3, raking.NULL: .2}, "topic": {"t": .3, "u": .7}}
    for _ in range(200):
        for level, goal in want.items():
            cube = cube * (cube.groupby(level=level).sum() ** -1 * np.array([goal[k] for k in sorted(goal)]) * cells.sum()).reindex(cube.index.get_level_values(level)).to_numpy()
    mine = got.assign(lang=got.lang.fillna(raking.NULL)).groupby(["source", "lang", "topic"]).weight.first() * cells
    assert np.allclose(mine, cube.reindex(mine.index), rtol=1e-4)


def test_targets_that_no_weights_meet(spark):
    rows = [(k, "w " * 10, "ab"[k % 2], "xy"[k % 2]) for k in range(40)]
    share = lambda d, name: spark.createDataFrame(list(d.items()), f"{name} string, share double")
    targets = {"source": share({"a": .9, "b": .1}, "source"), "lang": share({"x": .1, "y": .9}, "lang"), "topic": share({"t": 1.0}, "topic")}
    with pytest.warns(UserWarning, match="no weights meet"):
        got = raking.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), targets, F.lit("t")).toPandas()
    assert (got.deviation > 0.5).all() and len(got) == 40


def test_raking_edges(spark):
    ddl = "doc_id long, text string, source string, lang string"
    assert raking.mixed(spark.createDataFrame([], ddl)).count() == 0
    rows = raking.mixed(spark.createDataFrame([(1, None, None, None), (None, "", "a", "b")], ddl)).collect()
    assert {r["n_tokens"] for r in rows} == {0} and all(r["kept"] for r in rows)


def test_merkle_finds_every_damage(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAF_BYTES", 64)
    monkeypatch.setattr(merkle, "FANOUT", 2)
    pages = spark.createDataFrame([(k, f"http://x/{k}", "body" * (k % 9)) for k in range(80)] + [(None, None, None)], "page_id long, url string, html string")
    index = merkle.record_index(pages, "page_id", merkle.warc_record(F.col("url"), F.col("html"))).cache()
    rows = sorted((tuple(r) for r in index.collect()), key=lambda r: r[1])
    assert [r[1] for r in rows] == list(np.cumsum([0] + [r[2] for r in rows])[:-1]) and rows[0][0] is None
    assert merkle.damaged(index, index).count() == 0
    other = index.where("key is null or key <> 7").withColumn("digest", F.when(F.col("key").isin(3, 50), "bad").otherwise(F.col("digest")))
    other = other.unionAll(spark.createDataFrame([(900, 123_456, 5, "new")], other.schema))
    found = {(r["key"], r["status"]) for r in merkle.damaged(index, other).collect()}
    assert found == {(3, "changed"), (50, "changed"), (7, "missing"), (900, "extra")}
    status = {r["key"]: r["status"] for r in merkle.audit(index, other).collect()}
    assert len(status) == 81 and status[3] == "changed" and status[7] == "missing" and status[None] == "intact"
    empty = index.where("false")
    assert merkle.damaged(empty, empty).count() == 0 and merkle.damaged(index, empty).count() == 81


def test_audit_query_with_null_and_repeated_ids(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    one = [(k, f"http://x/{k}", f"<p>{'body' * (k % 9)}") for k in (*range(40), 997 + 3, 997 + 5, 997 + 7)]
    rows = one + [(None, "http://n", "<p>1"), (None, "http://m", "<p>2")] + [(k, u, h) for k in (3, 5, 7, 9) for u, h in ((f"http://y/{k}", "<p>abc"), (f"http://y/{k}", "abc<p>"), (f"http://z/{k}", "abcdef"))]
    rows += [(11, one[11][1], one[11][2])]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = con.execute(queries.ORACLE["op1_merkle_audit"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op1_merkle_audit"](spark, str(tmp_path)).collect()]
    told = lambda found: sorted(((-1 if r[0] is None else r[0], *r[2:]) for r in found))
    assert told(got) == told(want) and {"intact", "changed", "missing"} == {r[4] for r in got}
    single = lambda found: {r[0]: r[1] for r in found if r[0] is not None and r[0] not in (3, 5, 7, 9, 11)}
    assert single(got) == single(want) and min(r[1] for r in got if r[0] is None) == max(r[1] + r[2] for r in got if r[0] is not None)


def test_audit_tells_extra_records(spark):
    pages = [(k, f"http://x/{k}", "b" * k) for k in range(5)] + [(2, "http://x/2", "other"), (None, "u", "n")]
    index = lambda rows: merkle.record_index(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", merkle.warc_record(F.col("url"), F.col("html"))).cache()
    ours = index(pages)
    more = index(pages + [(9, "http://x/9", "new"), (None, "v", "n"), (4, "http://x/4", "bbbb")])
    got = merkle.audit(ours, merkle.placed(ours, more), extra=True).collect()
    assert sorted(-1 if r["key"] is None else r["key"] for r in got if r["status"] == "extra") == [-1, 4, 9] and len(got) == 10
    assert {r["key"] for r in got if r["status"] == "intact"} >= {0, 1, 2, 3, 4}


def test_running_totals_and_ranks(spark):
    rows = [(k * 700 - 5000, k % 7, "g" if k % 3 else "h") for k in range(300)] + [(None, 4, "g"), (2001, None, None)]
    df = spark.createDataFrame(rows, "id long, v long, g string").repartition(5)
    got = {r["id"]: r["t"] for r in order.running_total(df, "id", "v", "t", ("g",)).collect()}
    total, want = 0, {}
    for key, v, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want[key], total = total, total + (v or 0)
    assert got == want
    ranked = order.rank_within(df.where("g is not null"), "g", "id", "r").collect()
    for g in ("g", "h"):
        mine = sorted((r for r in ranked if r["g"] == g), key=lambda r: (r["id"] is not None, r["id"] or 0))
        assert [r["r"] for r in mine] == list(range(len(mine)))


def test_totals_over_ids_that_are_hashes_or_repeat(spark):
    """No range holds much more than its part of the rows, whatever the ids."""
    n = 100_000
    ids = spark.range(n).selectExpr("case id % 3 when 0 then 7 when 1 then null else xxhash64(id) end as id", "1 as v", "0 as g").repartition(8)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = order.in_ranges(ids, [F.col("id").asc_nulls_first()])
        assert rows.groupBy("_part").count().agg(F.max("count")).first()[0] < 3 * n / int(parts)
        got = order.running_total(ids, "id", "v", "t")
        assert got.agg(F.countDistinct("t"), F.min("t"), F.max("t")).first() == (n, 0, n - 1)
        assert got.where("t < 33333").agg(F.count("id")).first()[0] == 0
        ranks = order.rank_within(ids, "g", "id", "t")
        assert ranks.agg(F.countDistinct("t"), F.min("t"), F.max("t")).first() == (n, 0, n - 1)
        block, blocks = order.id_blocks(ids.where("id % 3 <> 7"), "id", 1000)
        sizes = spark.range(n).selectExpr("xxhash64(id) as id").groupBy(block.alias("b")).count().orderBy("b").collect()
        assert max(r["b"] for r in sizes) < blocks <= n // 1000 and max(r["count"] for r in sizes) < 4 * n / blocks
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_blocks_follow_the_ids(spark):
    ids = spark.createDataFrame([(k * k * (-1) ** k,) for k in range(3000)], "id long")
    block, blocks = order.id_blocks(ids, "id", 100)
    rows = ids.select("id", block.alias("b")).orderBy("id").collect()
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows) and rows[0]["b"] == 0 and rows[-1]["b"] == blocks - 1 and blocks > 20
    assert spark.createDataFrame([(None,)], "id long").select(block.alias("b")).first()["b"] == 0
    assert order.id_blocks(ids.limit(5), "id", 100)[1] == 1


def plain_fingerprints(rows):
    """Fingerprints and likenesses of (id, text) in descending id, with the library's term hashes looked up by a function."""
    n = len(rows)
    words = lambda t: {w for w in re.split(r"[\s!-/:-@\[-`{-~]+", t.lower()) if w}
    down = sorted(rows, reverse=True)
    df = {}
    for _, t in rows:
        for w in words(t):
            df[w] = df.get(w, 0) + 1
    share = lambda w: math.log(n / df[w]) / math.log(n) if n > 1 and df.get(w) else 2
    kept = lambda t: frozenset(w for w in words(t) if imatch.BAND[0] <= share(w) <= imatch.BAND[1])
    out = {}
    for k, (key, text) in enumerate(down):
        after = down[(k + 1) % n][1]
        cut = len(text) // 2
        out[key] = kept(text), kept(text[:len(text) - cut] + after[:cut]), kept(after), words(text), words(text[:len(text) - cut] + after[:cut]), words(after)
    return out


@pytest.mark.parametrize("seed, size", [(1, 60), (2, 2), (3, 1)])
def test_fingerprints_against_a_plain_version(spark, seed, size, monkeypatch):
    monkeypatch.setattr(imatch, "NEIGHBOUR_ROWS", 7)
    rng = np.random.default_rng(seed)
    pool = ["The", "the", "a,", "b.", "cd", "cde", "e!", "Fg", "x-y", "zz", "\n", "é", "#"] + [f"w{k}" for k in range(80)]
    rows = [(int(k), "".join(w + rng.choice([" ", "", "  "], p=[.8, .1, .1]) for w in rng.choice(pool, rng.integers(0, 40)))) for k in rng.choice(10**6, size, False)]
    rows[-1] = (rows[-1][0], rows[0][1])
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(spark.createDataFrame(rows, DDL).repartition(3)).collect()}
    want = plain_fingerprints(rows)
    every = sorted({w for sets in want.values() for s in sets for w in s})
    number = {r["w"]: (r["l"], r["h"]) for r in spark.createDataFrame([(w,) for w in every], "w string").select(
        "w", imatch.lexicon_of(F.xxhash64("w")).alias("l"), F.xxhash64("w").alias("h")).collect()}

    def by_lexicon(terms):
        out = {}
        for w in terms:
            out.setdefault(number[w][0], set()).add(w)
        return out

    def like(a, b, whole_a, whole_b):
        a, b = by_lexicon(a), by_lexicon(b)
        both = set(a) | set(b)
        return sum(a.get(k) == b.get(k) for k in both) / len(both) if both else float(whole_a == whole_b)

    marks = {}
    for key, (own, edit, after, own_all, edit_all, after_all) in want.items():
        r = got[key]
        assert r["near_edited"] == pytest.approx(like(own, edit, own_all, edit_all)) and r["near_next"] == pytest.approx(like(own, after, own_all, after_all))
        for terms, text in ((own, r["fingerprint"]), (edit, r["edited_fingerprint"])):
            parts = text.split(".")[:imatch.COUNT]
            held = by_lexicon(terms)
            assert {k for k, x in enumerate(parts) if x != imatch.NONE} == set(held)
            for k, s in held.items():
                assert marks.setdefault((k, parts[k]), s) == s  # one hash, one set of terms
    assert len(got) == len(rows)


def test_shared_folder_is_the_one_named():
    session = SimpleNamespace(conf={"spark.checkpoint.dir": "file:///some/shared/"})
    assert shared_folder(session) == "file:///some/shared"
    cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=dict))
    with pytest.raises(RuntimeError):
        shared_folder(cluster)


def test_few_cells_are_raked_without_a_shuffle(spark, monkeypatch):
    """Cells that one task holds are summed in it: no sweep deals them out, whatever the number of shuffle partitions."""
    cells = spark.createDataFrame([(a, b, 1 + 7 * k % 11) for k, (a, b) in enumerate((a, b) for a in "xyz" for b in "uvw")], "source string, lang string, tokens long")
    plans = []
    plain = raking.staged_at
    monkeypatch.setattr(raking, "staged_at", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name))
    targets = {"source": spark.createDataFrame([("x", 0.5), ("y", 0.25), ("z", 0.25)], "source string, share double"),
               "lang": spark.createDataFrame([("u", 0.2), ("v", 0.3), ("w", 0.5)], "lang string, share double")}
    raked, off = raking.rake(cells, targets)
    assert off <= raking.TOLERANCE
    sweeps = [p for p in plans if "Window" in p]
    assert sweeps and not any("Exchange" in p for p in sweeps)
    total = sum(r["tokens"] for r in raked.collect())
    for name, shares in targets.items():
        want = {r[name]: r["share"] * total for r in shares.collect()}
        got = {r[name]: r["w"] for r in raked.groupBy(name).agg(F.sum("weight").alias("w")).collect()}
        assert got == pytest.approx(want, rel=1e-5)
    empty, _ = raking.rake(cells.limit(0), targets)
    assert empty.count() == 0
    monkeypatch.setattr(raking, "CELLS_A_TASK", 2)
    more, _ = raking.rake(cells, targets)
    assert {(r["source"], r["lang"]): r["weight"] for r in more.collect()} == pytest.approx({(r["source"], r["lang"]): r["weight"] for r in raked.collect()})
