"""Operators on pairs against brute force."""

import hashlib
import os
import random
import re

import numpy as np
import pytest

from lakewarden.llm import graph, projections, sigtree, suffix_sample
from lakewarden.llm.staging import shared_folder

DDL = "doc_id long, text string"


def roots(n, links):
    up = list(range(n))
    for a, b in links:
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    return [find(x) for x in range(n)]


def corpus(seed, copies=25):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 120))) for _ in range(8)]
    texts = list(base)
    for b in base:
        for _ in range(copies // 8 + 3):
            w = b.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [" ".join(rng.choice(words) for _ in range(40)) + " " + passage + " " + rng.choice(words) for _ in range(30)]
    texts += ["", None, "one", "ONE", "one two", "a b c d", "A\tB\x0bC\nD", "É é", base[0], base[0].upper()]
    rng.shuffle(texts)
    return list(enumerate(texts))


def linked_documents(rows, n, num, den):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k:k + n]) for k in range(max(len(words) - n, 0) + 1)} if words else set())
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return [len(s) for s in sets], roots(len(rows), links)


def test_tables_of_tokens_and_sets_do_not_stay(spark):
    """What no later step reads is gone from the shared folder, and tokens are shuffled once to be counted."""
    folder = os.path.join(shared_folder(spark), "staged")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rows = corpus(5)
    got = {r["doc_id"]: r["component_id"] for r in sigtree.jaccard_groups(spark.createDataFrame(rows, DDL)).collect()}
    assert [got[k] for k, _ in rows] == linked_documents(rows, 4, 85, 100)[1]
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert "open" in left and not left & {"prefixes", "shared", "sets"}


def test_repeated_values():
    held = [np.array([1, 2, 3], np.uint64), np.array([2, 3, 2**63 + 5], np.uint64), np.array([3, 2**63 + 5], np.uint64)]
    values, counts = sigtree._repeated(list(held), 2)
    assert list(values) == [2, 3, 2**63 + 5] and list(counts) == [2, 3, 2]
    assert [len(x) for x in sigtree._repeated(list(held), 4)] == [0, 0] == [len(x) for x in sigtree._repeated([np.zeros(0, np.uint64)], 4)]


@pytest.mark.parametrize("n,num,den,block,dense", [(4, 85, 100, 256, 512), (5, 80, 100, 8, 3), (4, 85, 100, 8, 12)])
def test_jaccard_groups(spark, n, num, den, block, dense, monkeypatch):
    monkeypatch.setattr(sigtree, "LEAVES", 3)
    monkeypatch.setattr(sigtree, "DENSE", dense)
    monkeypatch.setattr(sigtree, "PAIRS_A_MEMBER", 1 if dense == 12 else 8)
    monkeypatch.setattr(sigtree, "MOST_PAIRS", 5 if dense == 12 else 20_000)
    rows = corpus(n)
    sizes, groups = linked_documents(rows, n, num, den)
    docs = spark.createDataFrame(rows, DDL).selectExpr("*", "'x' as bits", "1 as size", "2 as token").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in sigtree.jaccard_groups(docs, n, num, den, block).collect()}
    assert got == {k: (sizes[k], groups[k]) for k, _ in rows}


def test_jaccard_edges(spark):
    assert sigtree.jaccard_groups(spark.createDataFrame([], DDL)).count() == 0
    rows = [(None, "a b c d e"), (3, "a b c d e"), (9, "a b c d e"), (9, "a b c d e"), (4, None)]
    got = sorted((tuple(r) for r in sigtree.jaccard_groups(spark.createDataFrame(rows, DDL)).collect()), key=str)
    assert got == sorted([(None, 2, 3), (3, 2, 3), (9, 2, 3), (9, 2, 3), (4, 0, 4)], key=str)
    rows = [(None, "a b c d e"), (None, "f g h i"), (None, "A B C D E"), (9, "x y z w v"), (9, "x y z w"), (9, "f g h i")]
    got = sorted((tuple(r) for r in sigtree.jaccard_groups(spark.createDataFrame(rows, DDL).coalesce(1)).collect()), key=str)
    assert got == sorted([(None, 2, None), (None, 1, 9), (None, 2, None), (9, 2, 9), (9, 1, 9), (9, 1, 9)], key=str)


def test_documents_alike_by_chance_send_no_pairs(spark, monkeypatch):
    rng, rows = random.Random(3), []
    for k in range(240):
        rows.append((k, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(150, 185)))))
    rows += [(240 + k, t[:-2] + " z") for k, (_, t) in enumerate(rows[:40])]
    sent, plain = {}, sigtree.staged

    def kept(df, name):
        sent.setdefault(name, []).append((out := plain(df, name)).count())
        return out

    monkeypatch.setattr(sigtree, "staged", kept)
    got = {r["doc_id"]: r["component_id"] for r in sigtree.jaccard_groups(spark.createDataFrame(rows, DDL), 3).collect()}
    assert [got[k] for k in range(len(rows))] == linked_documents(rows, 3, 85, 100)[1]
    assert got[240] == 0 and sent["dense"] == [0] and sent["met"][0] <= 2 * len(rows)


@pytest.mark.parametrize("num, den", [(85, 100), (80, 100), (1, 2)])
def test_bounds_of_a_lead_never_lose_a_pair(num, den, monkeypatch):
    rng = np.random.default_rng(7)
    words = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2)
    common, sets = np.sort(words[:300]), []
    for size in (3, 8, 30, 100, 400, 900, 1800, 6000):
        of = rng.choice(words[:max(500, 2 * size)], size, replace=False)
        for part in (0, 0.02, 0.05, 0.08, 0.15, 0.3):
            sets.append(np.unique(np.concatenate([of[rng.random(size) >= part], rng.choice(words, int(rng.integers(0, size // 10 + 2)))])))
    members = []
    for k, held in enumerate(sets):
        prefix, steps = sigtree.prefix_and_steps(held, common, num, den)
        members.append((k, k, len(held), sigtree.bitmap(prefix, sigtree.bits_for(len(prefix))), sigtree.steps_below(steps), prefix.tolist()))
    found = []
    for pairs in (1, 32, 1 << 40):
        monkeypatch.setattr(sigtree, "BLOCK_PAIRS", pairs)
        found.append(sigtree.lead_pairs(members, num, den, 1 << 40))
    assert found[0] == found[1] == found[2]
    linked = 0
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            same = len(np.intersect1d(sets[a], sets[b]))
            if den * same >= num * (len(sets[a]) + len(sets[b]) - same):
                linked += 1
                (_, _, x, _, below_x, px), (_, _, y, _, below_y, py) = members[a], members[b]
                assert found[0][a, b] == len(set(px) & set(py)) >= sigtree.least_shared(x, y, below_x, below_y, num, den)
    assert linked > 8


def test_tree_bound_never_loses_a_pair():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, rng.integers(5, 90)).astype(np.uint64)) for _ in range(30)]
    sets += [np.unique(np.concatenate([s[rng.random(len(s)) > 0.05], rng.integers(0, 2**63, 2).astype(np.uint64)])) for s in sets]
    none = np.zeros(0, np.uint64)
    tree = sigtree.Tree(list(range(60)), list(range(60)), [len(s) for s in sets],
                        [int.from_bytes(sigtree.bitmap(sigtree.prefix_of(s, none, 85, 100)), "big") for s in sets])
    found = set(sigtree.tree_pairs(tree, tree, 85, 100))
    links = {(a, b) for b in range(60) for a in range(b) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert links and links <= found and len(found) < 60 * 59 / 4
    side = lambda ks: [(k, k, sets[k]) for k in ks]
    forest = sigtree.dense_links([side(range(60))], 85, 100)
    assert set(forest) <= links and roots(60, forest) == roots(60, links)
    across = sigtree.dense_links([side(range(30)), side(range(30, 60))], 85, 100)
    assert set(across) <= links and roots(60, across) == roots(60, [(a, b) for a, b in links if a < 30 <= b])


def removed(rows, size=200):
    raws = [(t or "").encode() for _, t in rows]
    counts = {}
    for b in raws:
        for p in range(len(b) - size + 1):
            counts[b[p:p + size]] = counts.get(b[p:p + size], 0) + 1
    out = {}
    for (key, _), b in zip(rows, raws, strict=True):
        gone = [False] * len(b)
        for p in range(len(b) - size + 1):
            if counts[b[p:p + size]] > 1:
                gone[p:p + size] = [True] * size
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[key] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes(spark, seed):
    rng = random.Random(seed)
    alphabet = "ab é" if seed == 1 else "abcdefghij "
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [make(n) for n in (199, 200, 201, 215, 260, 700)]
    texts = [make(rng.randint(0, 300)) + rng.choice(shared) + make(rng.randint(0, 300)) + rng.choice(shared)[rng.randint(0, 40):] for _ in range(25)]
    texts += ["a" * 900, "ab" * 450, "a" * 199, "b" * 200, "b" * 200, "", None, texts[0], texts[0] + "x", make(4000) * 2, shared[5] * 3]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, DDL).selectExpr("*", "'x' as gram", "0 as at").repartition(4)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest())
           for r in suffix_sample.without_repeats(docs).collect()}
    assert got == removed(rows)


def test_slices_cut_blocks_only_where_they_meet(monkeypatch):
    raw = np.random.default_rng(1).integers(97, 100, 5000).astype(np.uint8).tobytes()
    whole = [np.repeat(x, n) for x, n in ((c, suffix_sample.blocks(raw)[1]) for c in suffix_sample.blocks(raw))]
    monkeypatch.setattr(suffix_sample, "SLICE_BYTES", 1000)
    at, n, lead, gram = suffix_sample.blocks(raw)
    assert n.sum() == len(raw) - 199 and (np.repeat(gram, n) == whole[3]).all() and len(at) > 5
    assert (np.repeat(at + lead, n) == suffix_sample_places(raw)).all()


def suffix_sample_places(raw):
    """The sampled position of every window, found by looking at each of its grams."""
    h = suffix_sample.gram_hashes(raw) & ~suffix_sample.PLACE
    width = suffix_sample.LENGTH - suffix_sample.GRAM + 1
    return np.array([p + int(np.argmin(h[p:p + width])) for p in range(len(raw) - suffix_sample.LENGTH + 1)])


def test_repeated_bytes_edges(spark):
    assert suffix_sample.without_repeats(spark.createDataFrame([], DDL)).count() == 0
    rng = random.Random(4)
    text = "".join(rng.choice("abc ") for _ in range(500))
    rows = [tuple(r) for r in suffix_sample.without_repeats(spark.createDataFrame([(None, text), (1, text)], DDL)).select("doc_id", "n_removed").collect()]
    assert sorted(rows, key=str) == [(1, 500), (None, 500)]


def vectors():
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 64))
    near = base[rng.integers(0, 40, 120)] + rng.standard_normal((120, 64)) * rng.choice([0.05, 0.12, 0.14, 0.2], (120, 1))
    rows = [(k, [float(x) for x in v], int(k % 3 > 0)) for k, v in enumerate(np.concatenate([base, near]).astype(np.float32))]
    n = len(rows)
    odd = [[0.0] * 64, None, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [], [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + k, v, 0) for k, v in enumerate(odd)]
    rows += [(n + 20, rows[0][1], None), (n + 21, rows[0][1], 0), (n + 22, rows[0][1], 0), (n + 23, [2 * x for x in rows[0][1]], 0)]
    return rows


@pytest.mark.parametrize("block", [512, 16])
def test_near_vectors(spark, block):
    rows = vectors()
    sound = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = []
    for a in sound:
        for b in sound:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links.append((a, b))
    groups = roots(len(rows), links)
    want = {rows[k][0]: (sum(k in link for link in links), rows[groups[k]][0]) for k in range(len(rows))}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as rep", "'x' as block").repartition(6)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in projections.near_duplicates(df, block=block).collect()}
    assert len(links) > 50 and got == want
    assert projections.near_duplicates(df.where("false")).count() == 0


def test_calibration_recall():
    rng = np.random.default_rng(2)
    width, need = projections.calibrate(64, 0.98)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal(x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    r = projections.directions(64)
    assert ((np.abs(x @ r - y @ r) <= width).sum(axis=1) >= need).mean() > 0.999
    far = (np.abs(x @ r - np.roll(x, 1, axis=0) @ r) <= width).sum(axis=1) >= need
    assert far.mean() < 0.01


@pytest.mark.parametrize("links", [[], [(1, 1)], [(1, 2), (2, 1), (2, 3), (9, 8)], [(k, k + 1) for k in range(70)], [(100, k) for k in range(1, 60)]])
def test_components(spark, links):
    nodes = sorted({x for link in links for x in link})
    place = {x: k for k, x in enumerate(nodes)}
    groups = roots(len(nodes), [(place[a], place[b]) for a, b in links])
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: nodes[groups[place[x]]] for x in nodes if groups[place[x]] != place[x]}
