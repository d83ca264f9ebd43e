"""Best-fit packing against packing the pieces one by one, and the written token blocks."""

import random
import zlib

import numpy as np
import pytest

from lakewarden.llm import bestfit, pfor

pytest.importorskip("public_tokenizers")
from lakewarden.llm.tokens import Encoder, word_vocabulary  # noqa: E402

HARD = [(1, "a b c"), (2, None), (3, ""), (4, "word " * 5000), (5, "word " * 5000), (6, "\x01 é!"), (None, "no id"), (7, "x" * 3000), (7, "x" * 3000)]
DDL = "doc_id long, text string"


def one_by_one(lengths, capacity):
    """Bins of best-fit decreasing, each piece into the tightest open bin."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(best := min(fits))
        else:
            best = capacity
        rooms.append(best - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.6 else rng.choice([3, 7]) for _ in range(400)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    fill = {}
    ranks = {n: set() for n in counts}
    for n, low, high, first, each, offset in bestfit.plan(counts, capacity):
        for rank in range(low, high):
            ranks[n].add(rank)
            fill.setdefault(first + (rank - low) // each, []).append((offset + (rank - low) % each * n, n))
    assert all(ranks[n] == set(range(c)) for n, c in counts.items())
    for places in fill.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end = offset + n
        assert end <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in fill.values()) == one_by_one(lengths, capacity)


def test_tree_finds_the_tightest():
    tree = bestfit.CapacityTree(20)
    for room in (3, 9, 14):
        tree.add(room, room, room + 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 9, 10, 14, 15, 20)] == [3, 3, 9, 9, 14, 14, None, None]


def test_packed_documents(spark):
    docs = spark.createDataFrame(HARD, DDL).selectExpr("*", "'other' as length", "1 as piece")
    rows = bestfit.packed_documents(docs, word_vocabulary(), capacity=256).collect()
    ids = {}
    encode = Encoder(word_vocabulary()).encode
    for key, text in HARD:
        ids.setdefault(key, []).append(np.append(encode(text), 0).astype("<u4"))
    assert len(rows) == sum(-(-len(i) // 256) for many in ids.values() for i in many)
    places = {}
    for r in rows:
        part = ids[r["doc_id"]][0][r["start"]:r["start"] + r["length"]]
        assert r["start"] == r["piece"] * 256 and r["ids_crc32"] == zlib.crc32(part.tobytes()) and len(part) == r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for many in places.values():
        assert [o for o, _ in sorted(many)] == list(np.cumsum([0] + [n for _, n in sorted(many)])[:-1])


def test_packing_of_nothing_and_bad_lengths(spark):
    assert bestfit.packed_documents(spark.createDataFrame([], DDL), word_vocabulary()).count() == 0
    with pytest.raises(ValueError):
        bestfit.best_fit_pack(spark.createDataFrame([(1, 0, 0)], "doc_id long, piece int, length int"))


def test_blocks_round_trip():
    rng = np.random.default_rng(5)
    documents = [rng.integers(0, 49_408, n).astype(np.uint32) for n in (0, 1, 127, 128, 129, 1000)]
    documents += [np.full(300, 7, np.uint32), np.array([0, 2**32 - 1, 5], np.uint32), np.append(np.arange(200), 2**31).astype(np.uint32)]
    for percentile in (0.01, 0.5, 0.9, 1.0):
        written = pfor.encode_documents(documents, percentile)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(documents, pfor.decode_documents(written), strict=True))
    assert len(pfor.encode_documents([np.append(np.zeros(127, np.uint32), 2**31)])[0]) < 40  # one exception, no wide block
    with pytest.raises(ValueError):
        pfor.decode_documents([b"other" + bytes(20)])


def test_token_table(spark, tmp_path):
    docs = spark.createDataFrame(HARD, DDL).repartition(3)
    path = str(tmp_path / "table")
    pfor.write_token_table(docs, path, word_vocabulary())
    encode = Encoder(word_vocabulary()).encode
    want, start = [], 0
    for key, text in sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.append(encode(text), 2).astype("<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in pfor.token_places(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    pfor.write_token_table(spark.createDataFrame([], DDL), str(tmp_path / "none"), word_vocabulary())
    assert pfor.token_places(spark, str(tmp_path / "none")).count() == 0
