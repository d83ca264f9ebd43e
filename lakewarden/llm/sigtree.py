"""Exact Jaccard join of word n-gram sets with signature trees.

1. A set's prefix is its first ``size - need + 1`` shingles in one fixed order, ``need`` being the
   least overlap of a linked pair. Linked pairs share a prefix shingle, so the documents of one
   prefix shingle are the leaves of one tree. Shingles of at least COMMON of all documents come
   last in the order, which keeps them out of most prefixes.
2. Every leaf has a bitmap of its prefix, and the number of its shingles below fixed places of the
   order; every node the OR of its leaves' bitmaps and their range of sizes. Large trees are cut into
   blocks along the sizes; pairs of blocks are pruned by Spark, and pairs of nodes inside a task, by
   the greatest overlap that bitmaps, sizes and places allow, so that documents which share shingles
   by chance send no pairs on.
3. Surviving pairs of documents are counted over their shared prefix shingles, which bounds their
   overlap again. What is left is bounded by whole sets at 16 bits a shingle, then verified on the
   whole sets.

Documents are first linked to the hub of each shingle with which they share much; trees whose
documents are one component by then have nothing more to tell and are skipped. Equal sets are one
node throughout.

Documents that gather around one least document (its lead) in great numbers, or with many candidates for
each of them, send no pairs on: their whole sets come to the trees, which then hold bitmaps of whole
sets, pairs are verified where they meet, and a union-find skips pairs of one component. Such a
cluster sends one link a document.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.graph import components
from lakewarden.llm.order import rank_within
from lakewarden.llm.rows import rows_apart
from lakewarden.llm.staging import discard, staged, staged_at

BITS, MOST_BITS = 512, 4096
LEAVES = 64
BLOCK_PAIRS = 32
CUTS = 16
COMMON = 0.001
LOCAL_COMMON = 4
CACHED_WORDS = 200_000
WANTED_BITS = 1 << 23
HUB_ROUNDS = 1
HELD_PAIRS = 200_000
DENSE = 20_000
PAIRS_A_MEMBER = 8
MOST_PAIRS = 20_000
DENSE_BLOCK = 512
WHOLE_BITS = 2048


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_WORDS = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; shorter texts are one shingle, wordless ones none.

    A-Z is lower-cased; words are runs of anything but blanks, tabs, line and page breaks.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k])
    return np.unique(out)


def need_overlap(size: int, num: int, den: int) -> int:
    """Least overlap that a set of this size has with any set at a similarity of num/den."""
    return -(-size * num // den)


def prefix_of(values: np.ndarray, common: np.ndarray, num: int, den: int) -> np.ndarray:
    """The prefix of a sorted set: rare shingles first, then common ones, both in hash order."""
    return prefix_and_steps(values, common, num, den)[0]


def prefix_and_steps(values: np.ndarray, common: np.ndarray, num: int, den: int) -> tuple[np.ndarray, bytes]:
    """The prefix of a sorted set, and how many rare shingles lie between one cut and the next.

    Cuts are fixed hashes, the same for all sets; there is a step for each that the prefix reaches, that is, has all
    the set's rare shingles below it. Steps over 255 are given as 255: counts are never too large.
    """
    if not len(values):
        return values, b""
    take = len(values) - need_overlap(len(values), num, den) + 1
    rare = len(values)
    if len(common):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        often = common[at] == values
        values = np.concatenate([values[~often], values[often]])
        rare -= int(often.sum())
    width = min((1 << 64) - 1, (1 << 64) * 5 * (den - num) // (4 * den)) // CUTS  # a prefix of rare shingles ends near the last cut but two
    below = np.searchsorted(values[:rare], np.arange(1, CUTS + 1, dtype=np.uint64) * np.uint64(width))
    below = below[below <= take]
    return values[:take], np.minimum(np.diff(below, prepend=0), 255).astype(np.uint8).tobytes()


def steps_below(steps: bytes) -> list[int]:
    """Rare shingles below each cut that is reached, after a 0 for no cut."""
    return list(accumulate(steps, initial=0))


def bitmap(values: np.ndarray, size: int = BITS) -> bytes:
    bits = np.zeros(size, np.uint8)
    bits[(values % np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def bits_for(shingles_in: int) -> int:
    """Size of the bitmap of so many shingles: four bits a shingle, in powers of two from BITS to MOST_BITS."""
    return min(MOST_BITS, max(BITS, 1 << (4 * shingles_in - 1).bit_length()))


def folded(bits: bytes, width: int) -> int:
    """A bitmap as a number, of so many bytes: the halves of a larger one fall on each other."""
    found, now = int.from_bytes(bits, "big"), len(bits)
    while now > width:
        now //= 2
        found = found >> 8 * now | found & (1 << 8 * now) - 1
    return found


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _repeated(held: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that are in the arrays so often at least, sorted, and how often; the list is emptied, as it is sorted in one copy."""
    values = np.concatenate(held)
    held.clear()
    values.sort()
    found = np.unique(values[least - 1:][values[least - 1:] == values[:len(values) - least + 1]])
    return found, np.searchsorted(values, found, "right") - np.searchsorted(values, found, "left")


def _summaries(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, size and digest of each set; the first row of a batch also lists the batch's common shingles."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, held = [], [], []
            for value in batch.column(1):
                found = shingles(value.as_py(), n)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                held.append(found)
            often: list = [None] * len(sizes)
            if sizes:
                values, counts = _repeated(held, LOCAL_COMMON)
                often[0] = [{"shingle": int(v), "count": int(c)} for v, c in zip(values.view(np.int64), counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(often, pa.list_(pa.struct([("shingle", pa.int64()), ("count", pa.int64())])))],
                ["doc_id", "size", "digest", "often"])

    return _texts(docs).mapInArrow(make, "doc_id long, size int, digest binary, often array<struct<shingle:long,count:long>>")


def _common(summaries: DataFrame) -> np.ndarray:
    """Shingles of at least COMMON of all documents, sorted: at most the mean size / COMMON of them, however many documents."""
    floor = max(16, int(summaries.count() * COMMON))
    seen = summaries.where("often is not null").select(F.explode("often").alias("o")).select("o.*")
    rows = seen.groupBy("shingle").agg(F.sum("count").alias("n")).where(F.col("n") >= floor).select("shingle").toPandas()
    return np.sort(rows["shingle"].to_numpy(np.int64).view(np.uint64))


def _prefixes(docs: DataFrame, n: int, num: int, den: int, common) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = common.value
        for batch in batches:
            keys, found, bits, steps = [], [], [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                prefix, below = prefix_and_steps(shingles(value.as_py(), n), often, num, den)
                keys.append(key)
                found.append(prefix.view(np.int64).copy())  # a slice would hold the whole set
                bits.append(bitmap(prefix, bits_for(len(prefix))))
                steps.append(below)
            offsets = np.cumsum([0, *map(len, found)])
            values = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), pa.array(bits, pa.binary()), pa.array(steps, pa.binary())],
                ["doc_id", "prefix", "bits", "steps"])

    return _texts(docs).mapInArrow(make, "doc_id long, prefix array<long>, bits binary, steps binary")


def _sets(docs: DataFrame, wanted: DataFrame, n: int, kind: str) -> tuple[DataFrame, str]:
    """doc_id and whole set of the wanted documents, in numbers of the kind, and the folder they are staged in.

    A bitmap of fixed size spares the tasks most others.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(WANTED_BITS))
    parts = wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()  # at most WANTED_BITS / 8 bytes
    held = {r["k"]: bytes(r["m"]) for r in parts}
    marks = docs.sparkSession.sparkContext.broadcast(held)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = marks.value
        for batch in batches:
            keys, sets = [], []
            for key, at, bucket, bit in zip(batch.column(0).to_pylist(), range(batch.num_rows), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                found = maps.get(bucket)
                if found is not None and found[bit >> 3] >> (bit & 7) & 1:
                    keys.append(key)
                    sets.append(np.sort(shingles(batch.column(1)[at].as_py(), n).astype(kind)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "set"])

    marked = _texts(docs).select("doc_id", "text", F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("b"))
    found = marked.mapInArrow(make, "doc_id long, set binary").join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return staged_at(found, "sets")


def _in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted lists; equal numbers inside a list only add to it."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _passing(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int, kind: str) -> DataFrame:
    """The pairs (a, b) whose sets in that kind of numbers reach the similarity; shorter numbers never lose a pair."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets, folder = _sets(docs, wanted, n, kind)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind)
                same = _in_common(a, b)
                keep.append(den * same >= num * (len(a) + len(b) - same))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    passing = staged(both.mapInArrow(check, "a long, b long"), "passing")
    discard(docs.sparkSession, folder)
    return passing


def _verified(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity: few come through 16 bits a shingle that do not."""
    likely = _passing(staged(pairs, "pairs"), docs, n, num, den, "<u2")
    return _passing(likely, docs, n, num, den, "<u8")


def beyond_prefix(size: Column, num: int, den: int) -> Column:
    """Shingles of a set that are not in its prefix."""
    return F.ceil(size * num / F.lit(float(den)) - 1e-9) - 1


def least_shared(x: int, y: int, below_x: list[int], below_y: list[int], num: int, den: int) -> int:
    """Least number of shingles that the prefixes of linked sets of these sizes share, as their sizes and cuts tell.

    Beyond the prefixes the overlap is at most what the larger set keeps there; beyond a cut that both prefixes
    reach, at most what either set has there.
    """
    cut = min(len(below_x), len(below_y)) - 1
    outside = min(need_overlap(max(x, y), num, den) - 1, x - below_x[cut], y - below_y[cut])
    return -(-num * (x + y) // (num + den)) - outside


class Tree:
    """Leaves sorted by size under nodes of LEAVES; a node has the OR of bitmaps and the range of sizes."""

    def __init__(self, reps: list[int], comps: list[int], sizes: list[int], bits: list[int], below: list[list[int]] | None = None):
        order = sorted(range(len(reps)), key=lambda k: (sizes[k], reps[k]))
        self.leaves = [(reps[k], comps[k], sizes[k], bits[k], bits[k].bit_count()) for k in order]
        self.below = [below[k] for k in order] if below else [[0]] * len(order)
        self.root = self._node(0, len(order))
        self._columns: tuple | None = None

    def _node(self, first: int, last: int) -> tuple:
        """(first, last, OR of bitmaps, least and largest size, fewest bits, children)"""
        if last - first <= LEAVES:
            kids, ors = (), 0
            for leaf in self.leaves[first:last]:
                ors |= leaf[3]
            few = min(leaf[4] for leaf in self.leaves[first:last])
        else:
            middle = (first + last) // 2
            kids = (self._node(first, middle), self._node(middle, last))
            ors, few = kids[0][2] | kids[1][2], min(kids[0][5], kids[1][5])
        return first, last, ors, self.leaves[first][2], self.leaves[last - 1][2], few, kids

    def columns(self) -> tuple[np.ndarray, ...]:
        """Of the leaves: size, bits set, bitmap in words, cuts reached, rare shingles below each cut (0 for those not reached)."""
        if self._columns is None:
            words = max(1, -(-max(leaf[3].bit_length() for leaf in self.leaves) // 64))
            bits = np.frombuffer(b"".join(leaf[3].to_bytes(8 * words, "little") for leaf in self.leaves), "<u8").reshape(-1, words)
            below = np.zeros((len(self.leaves), CUTS + 1), np.int64)
            for row, found in zip(below, self.below, strict=True):
                row[:len(found)] = found
            self._columns = (np.array([leaf[2] for leaf in self.leaves], np.int64), np.array([leaf[4] for leaf in self.leaves], np.int64),
                             bits, np.array([len(found) - 1 for found in self.below]), below)
        return self._columns


def possible_leaves(one: Tree, two: Tree, x: tuple, y: tuple, num: int, den: int, whole: bool) -> Iterator[tuple[int, int]]:
    """Places (k, m) of the leaves under nodes x and y of the trees that may be linked; of one node, those with k < m."""
    (sx, cx, bx, rx, tx), (sy, cy, by, ry, ty) = ([c[node[0]:node[1]] for c in tree.columns()] for tree, node in ((one, x), (two, y)))
    a, b = np.nonzero(den * np.minimum(sx[:, None], sy[None, :]) >= num * np.maximum(sx[:, None], sy[None, :]))
    if one is two and x is y:
        a, b = a[a < b], b[a < b]
    words = min(bx.shape[1], by.shape[1])  # what is beyond is not set in one of them
    shared = np.zeros(len(a), np.int64)
    for w in range(words):
        shared += np.bitwise_count(bx[a, w] & by[b, w])
    sa, sb = sx[a], sy[b]
    if whole:
        room = np.minimum((sx - cx)[a], (sy - cy)[b])
    else:
        spare = [s + (-s * num // den) + 1 - c for s, c in ((sx, cx), (sy, cy))]
        cut = np.minimum(rx[a], ry[b])
        outside = np.minimum(-(-np.maximum(sa, sb) * num // den) - 1, np.minimum(sa - tx[a, cut], sb - ty[b, cut]))
        room = np.minimum(spare[0][a], spare[1][b]) + outside
    fits = (num + den) * (shared + room) >= num * (sa + sb)
    yield from zip((a[fits] + x[0]).tolist(), (b[fits] + y[0]).tolist(), strict=True)


def tree_pairs(one: Tree, two: Tree, num: int, den: int, whole: bool = False, apart: Callable[[int, int], bool] = operator.ne) -> Iterator[tuple[int, int]]:
    """Pairs (a, b), a < b, that may be linked and whose components are apart, by a dual traversal of both trees.

    Overlap beyond the prefixes is bounded as in least_shared; overlap inside is at most
    the bits in common plus the prefix shingles of either set that fell on a bit already set. Bitmaps of ``whole`` sets
    leave nothing beyond, and the shingles of a set that fell on a set bit are its size less its bits.
    """

    def possible(x: tuple, y: tuple) -> bool:
        if den * min(x[4], y[4]) < num * max(x[3], y[3]):
            return False
        shared = (x[2] & y[2]).bit_count()
        if whole:
            return (num + den) * (shared + min(x[4] - x[5], y[4] - y[5])) >= num * (x[3] + y[3])
        # greatest prefix size - bits: shingles that fell on a set bit
        rest = min(node[4] - need_overlap(node[4], num, den) + 1 - node[5] for node in (x, y))
        outside = need_overlap(max(x[4], y[4]), num, den) - 1
        return (num + den) * (shared + rest + outside) >= num * (x[3] + y[3])

    def leaf_pairs(x: tuple, y: tuple) -> Iterator[tuple[int, int]]:
        if (x[1] - x[0]) * (y[1] - y[0]) >= BLOCK_PAIRS:
            yield from possible_leaves(one, two, x, y, num, den, whole)
            return
        for k in range(x[0], x[1]):
            a = one.leaves[k]
            for m in range(max(y[0], k + 1) if same else y[0], y[1]):
                b = two.leaves[m]
                if possible((0, 1, a[3], a[2], a[2], a[4]), (0, 1, b[3], b[2], b[2], b[4])):
                    least = 0 if whole else least_shared(a[2], b[2], one.below[k], two.below[m], num, den)
                    spare = min(leaf[2] - need_overlap(leaf[2], num, den) + 1 - leaf[4] for leaf in (a, b))
                    if whole or (a[3] & b[3]).bit_count() + spare >= least:
                        yield k, m

    same = one is two
    todo = [(one.root, two.root)]
    while todo:
        x, y = todo.pop()
        if not possible(x, y):
            continue
        if not x[6] and not y[6]:
            for k, m in leaf_pairs(x, y):
                a, b = one.leaves[k], two.leaves[m]
                if apart(a[1], b[1]):
                    yield (a[0], b[0]) if a[0] < b[0] else (b[0], a[0])
        elif same and x is y:
            todo += [(x[6][0], x[6][0]), (x[6][0], x[6][1]), (x[6][1], x[6][1])]
        elif x[6] and (not y[6] or x[1] - x[0] >= y[1] - y[0]):
            todo += [(kid, y) for kid in x[6]]
        else:
            todo += [(x, kid) for kid in y[6]]


class Forest:
    """Union-find over the components of some documents."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(above, above)
            x = above
        return x

    def apart(self, x: int, y: int) -> bool:
        return self.root(x) != self.root(y)

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def dense_links(sides: list[list[tuple]], num: int, den: int) -> list[tuple[int, int]]:
    """Links (a, b) that join the components of documents (rep, comp, set) of one block, or of two: a forest of verified pairs."""
    sets = {rep: held for side in sides for rep, _, held in side}
    comps = {rep: comp for side in sides for rep, comp, _ in side}
    trees = [Tree([r[0] for r in side], [r[1] for r in side], [len(r[2]) for r in side],
                  [int.from_bytes(bitmap(r[2], WHOLE_BITS), "big") for r in side]) for side in sides]
    forest, links = Forest(), []
    for a, b in tree_pairs(trees[0], trees[-1], num, den, True, forest.apart):
        same = _in_common(sets[a], sets[b])
        if den * same >= num * (len(sets[a]) + len(sets[b]) - same):
            forest.join(comps[a], comps[b])
            links.append((a, b))
    return links


def _dense_join(members: DataFrame, docs: DataFrame, n: int, num: int, den: int, block: int) -> DataFrame:
    """Links (a, b) inside each lead of members (lead, rep, comp, size), whose documents are dealt out in blocks by size."""
    sets, folder = _sets(docs, members.select(F.col("rep").alias("doc_id")).distinct(), n, "<u8")
    rows = _blocks(members, "lead", num, den, block).join(sets.withColumnRenamed("doc_id", "rep"), "rep")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, ([], [])
        for batch in batches:
            for lead, i, j, side, rep, comp, held in zip(*(batch.column(k).to_pylist() for k in range(6)), batch.column(6), strict=True):
                if (lead, i, j) != now:
                    yield _edges(dense_links([s for s in sides if s], num, den) if now else [])
                    now, sides = (lead, i, j), ([], [])
                sides[side].append((rep, comp, np.frombuffer(held.as_py(), "<u8")))
        yield _edges(dense_links([s for s in sides if s], num, den) if now else [])

    dealt = rows.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
    links = staged(dealt.select("lead", "i", "j", "side", "rep", "comp", "set").mapInArrow(join, "a long, b long"), "dense-links")
    discard(docs.sparkSession, folder)
    return links


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])


def lead_pairs(members: list[tuple], num: int, den: int, most: int) -> Counter:
    """Pairs (a, b) of members (rep, comp, size, bits, below, tokens) that may be linked, with the tokens they share; a few more than ``most`` at most.

    A tree is a token, or all members where these have fewer pairs than all tokens together. Bitmaps are of several
    sizes: members of one size are a tree, and the larger ones near them in size meet it folded.
    """
    trees: dict[int, list[tuple]] = {}
    for member in members:
        for token in member[5]:
            trees.setdefault(token, []).append(member)
    met, groups, held = Counter(), list(trees.values()), None
    if len(members) * (len(members) - 1) <= sum(len(g) * (len(g) - 1) for g in groups):
        groups, held = [members], {m[0]: set(m[5]) for m in members}
    for group in groups:
        for one, two in _sized_trees(group, num, den) if len(group) > 1 else ():
            for a, b in tree_pairs(one, two, num, den):
                if shared := len(held[a] & held[b]) if held else 1:
                    met[a, b] += shared
                    if len(met) > most:
                        return met
    return met


def _sized_trees(group: list[tuple], num: int, den: int) -> Iterator[tuple[Tree, Tree]]:
    """Pairs of trees in which all pairs of the group that are near in size meet once, with bitmaps of one size."""
    sides: dict[int, list[tuple]] = {}
    for member in group:
        sides.setdefault(len(member[3]), []).append(member)
    make = lambda side, width: Tree([m[0] for m in side], [m[1] for m in side], [m[2] for m in side], [folded(m[3], width) for m in side], [m[4] for m in side])
    for width, side in sides.items():
        one, largest = make(side, width), max(m[2] for m in side)
        yield one, one
        if over := [m for other, found in sides.items() if other > width for m in found if den * largest >= num * m[2]]:
            yield one, make(over, width)


def _tree_join(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b, n, least) of rows (lead, rep, comp, size, tokens, bits, steps), n being the tokens they share.

    Tokens of one lead, the least document that has them, are in much the same documents and meet in one task,
    where their pairs are counted before they are sent on. A lead with more than PAIRS_A_MEMBER pairs for
    each of its documents sends none of them but itself: a row with a null b. ``least`` is the n of linked documents.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, members = None, []
        out: list[tuple] = []

        def close_lead() -> None:
            room = PAIRS_A_MEMBER * len(members)
            met = lead_pairs(members, num, den, max(room, MOST_PAIRS))
            if len(met) > room:
                out.append((lead, None, 0, 0))
                return
            of = {m[0]: m for m in members}
            out.extend((a, b, n, least_shared(of[a][2], of[b][2], of[a][4], of[b][4], num, den)) for (a, b), n in met.items())

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for now, rep, comp, size, tokens, bits, steps in zip(*columns, strict=True):
                if now != lead:
                    if len(members) > 1:
                        close_lead()
                    lead, members = now, []
                members.append((rep, comp, size, bits, steps_below(steps), tokens))
                if len(out) > HELD_PAIRS:
                    yield _counted(out)
                    out.clear()
        if len(members) > 1:
            close_lead()
        yield _counted(out)

    dealt = rows.repartition("lead").sortWithinPartitions("lead")
    return dealt.select("lead", "rep", "comp", "size", "tokens", "bits", "steps").mapInArrow(join, "a long, b long, n long, least long")


def _counted(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n", "least"])


def jaccard_groups(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, block: int = DENSE_BLOCK) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    Two documents link when den * intersection >= num * union of their n-word shingle sets;
    component_id is the least doc_id reachable. Documents without words link with nothing. Rows of one
    doc_id, or of a null one, are documents of their own; null is the greatest doc_id. An empty frame gives an
    empty one; other columns are ignored.
    """
    rows, told_apart = rows_apart(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    groups = _groups(rows, n, num, den, block)
    if not told_apart:
        return groups
    names = rows.select("doc_id", "_given_id")
    groups = groups.join(names, "doc_id").join(names.select(F.col("doc_id").alias("component_id"), F.col("_given_id").alias("_least")), "component_id")
    return groups.select(F.col("_given_id").alias("doc_id"), "n_shingles", F.col("_least").alias("component_id"))


def _groups(docs: DataFrame, n: int, num: int, den: int, block: int) -> DataFrame:
    spark = docs.sparkSession
    summaries = staged(_summaries(docs, n), "summaries")
    common = spark.sparkContext.broadcast(_common(summaries))
    nodes = summaries.select("doc_id", "size", "digest")
    classes = staged(nodes.where("size > 0").groupBy("digest", "size").agg(F.min("doc_id").alias("rep")), "classes")
    prefixes = _prefixes(docs, n, num, den, common).join(classes.select(F.col("rep").alias("doc_id"), "size"), "doc_id")
    prefixes, prefixes_at = staged_at(prefixes, "prefixes")

    # most tokens are in one document only: they are shuffled once, and go where they are counted
    tokens = prefixes.select(F.explode("prefix").alias("token"), F.col("doc_id").alias("rep"), "size")
    shared, shared_at = staged_at(tokens.withColumn("n", F.count("*").over(Window.partitionBy("token"))).where("n > 1"), "shared")
    leaves = staged(prefixes.select(F.col("doc_id").alias("rep"), "bits", "steps"), "leaves")
    discard(spark, prefixes_at)
    links, open_rows = None, shared.withColumn("comp", F.col("rep"))
    for _ in range(HUB_ROUNDS):
        found = _verified(_hub_pairs(open_rows, num, den), docs, n, num, den)
        links = found if links is None else staged(links.unionAll(found), "hub-links")
        open_rows = _marked(shared, links)
    spans = open_rows.groupBy("token").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high"), F.min("rep").alias("lead")).where("_low < _high").select("token", "lead")
    open_rows = staged(open_rows.join(spans, "token"), "open")
    discard(spark, shared_at)
    # trees too large for a task, if there are any
    large = staged(open_rows.where(F.col("n") > DENSE).select("lead").distinct(), "large")
    sparse = open_rows if large.isEmpty() else open_rows.join(large, "lead", "left_anti")
    # a document and its bitmap are sent to a lead once, with all their tokens there
    members = sparse.repartition("rep").groupBy("rep", "lead").agg(F.first("comp").alias("comp"), F.first("size").alias("size"), F.collect_list("token").alias("tokens"))
    met = staged(_tree_join(members.join(leaves, "rep"), num, den), "met")
    dense = staged(large.unionAll(met.where("b is null").select("a")), "dense")
    pairs = met.where("b is not null").groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("least").alias("least"))
    pairs = pairs.where("n >= least").select("a", "b")
    links = links.unionAll(_verified(pairs, docs, n, num, den))
    if not dense.isEmpty():
        members = open_rows.join(dense, "lead", "left_semi").groupBy("lead", "rep").agg(F.first("comp").alias("comp"), F.first("size").alias("size"))
        links = links.unionAll(_dense_join(staged(members, "members"), docs, n, num, den, block))
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    classes = classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        "digest", "size", F.coalesce("component", "rep").alias("_component"))
    return nodes.join(classes, ["digest", "size"], "left").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), F.coalesce("_component", "doc_id").alias("component_id"))


def _hub_pairs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of each document and the hub of a shingle, where they share much of a prefix and not yet a component.

    The hub of a shingle is the document that shares its prefix most widely: among edited copies, the original.
    """
    reach = rows.groupBy("rep").agg(F.sum("n").alias("reach"))
    hubs = rows.join(reach, "rep").groupBy("token").agg(
        F.max_by("rep", "reach").alias("hub"), F.min("comp").alias("_low"), F.max("comp").alias("_high")).where("_low < _high").select("token", "hub")
    near = rows.join(hubs, "token").where("rep <> hub").groupBy("rep", "hub", "size", "comp").count()
    near = near.where(F.col("count") >= 0.3 * (F.col("size") - beyond_prefix(F.col("size"), num, den)))
    other = rows.select(F.col("rep").alias("hub"), F.col("comp").alias("_comp")).distinct()
    near = near.join(other, "hub").where("comp <> _comp")
    return near.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def _marked(shared: DataFrame, links: DataFrame) -> DataFrame:
    """The rows with their documents' components so far."""
    known = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return staged(shared.join(known, F.col("rep") == F.col("node"), "left").select(
        "token", "rep", "size", "n", F.coalesce("component", "rep").alias("comp")), "marked")


def _blocks(rows: DataFrame, group: str, num: int, den: int, block: int) -> DataFrame:
    """Rows of each group as (i, j, side): pairs of blocks along the sizes that may hold a link."""
    ranked = rank_within(rows, group, "size", "_rank", ("rep",))
    ranked = staged(ranked.withColumn("block", F.floor(F.col("_rank") / block).cast("int")).drop("_rank"), "blocks")
    spans = ranked.groupBy(group, "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    left, right = spans.alias("l"), spans.alias("r")
    meets = left.join(right, (F.col(f"l.{group}") == F.col(f"r.{group}")) & (F.col("l.block") <= F.col("r.block"))
                      & (F.col("l.high") * den >= F.col("r.low") * num)).select(
        F.col(f"l.{group}").alias(group), F.col("l.block").alias("i"), F.col("r.block").alias("j"))
    sides = meets.select("*", F.col("i").alias("block"), F.lit(0).alias("side")).unionAll(
        meets.where("i < j").select("*", F.col("j").alias("block"), F.lit(1).alias("side")))
    return ranked.join(sides, [group, "block"])
