"""Removal of byte strings that also start elsewhere, by grouping a sample of all suffixes by hash.

This replaces the difference-cover algorithm: nothing is sorted, named by rank, recursed on or merged.
A difference cover samples positions so that any two suffixes meet the sample at one and the same
distance. Here the sample is taken by content: of every LENGTH-byte window, the position whose
GRAM-byte string has the least hash. Equal windows have their sampled position at the same place, so
only suffixes that begin with the same sampled gram need to be compared, and one in about 70 is
sampled instead of two in three. Windows with one sampled position follow each other and make a
block, which is named by its content.

1. Grams that occur once end there. Blocks of equal names repeat as a whole.
2. Where blocks of a gram differ, one of each name goes on with its bytes, in steps of STRIDE windows.
   The bytes that all windows of a step share are its core, all their bytes together its hull. Cores
   that occur once end there, and steps of equal hulls repeat as a whole.
3. Where steps of a core differ, the windows of one step of each hull are compared in full.

Each comparison brings equal prefixes together by a 128-bit key of gram and content, sampled suffixes
first and the others at their distance from these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.rows import rows_apart
from lakewarden.llm.staging import staged

LENGTH = 200
GRAM = 32
STRIDE = 16
SLICE_BYTES = 1 << 22
PLACE = np.uint64((1 << 24) - 1)
WIDE = "cast(9223372036854775808 as decimal(38,0))"


def gram_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each position on."""
    bytes_ = np.frombuffer(raw, np.uint8)
    eights = np.lib.stride_tricks.sliding_window_view(bytes_, 8).copy().view("<u8").ravel()
    n = len(raw) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for k in range(0, GRAM, 8):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (eights[k:k + n] ^ (eights[k:k + n] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(27))


def blocks(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, distance from the first window to the sampled position, gram hash) of each block.

    Long texts go through slices that overlap by a window, so blocks may be cut where slices meet.
    """
    parts = []
    for start in range(0, max(len(raw) - LENGTH + 1, 0), SLICE_BYTES):
        part = raw[start:start + SLICE_BYTES + LENGTH - 1]
        h = gram_hashes(part)
        width = LENGTH - GRAM + 1
        least, step = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < width:
            least = np.minimum(least[:step - width], least[width - step:])
        at = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        parts.append((first + start, np.diff(first, append=len(at)), at[first] - first, h[at[first]].view(np.int64)))
    if not parts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _key(raw: memoryview, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(raw, seed) - (1 << 63)


def _blocks_of(docs: DataFrame) -> DataFrame:
    """One row per block: doc_id, at, n (windows), lead, gram, name."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, total = [], 0
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                at, n, lead, gram = blocks(raw)
                view = memoryview(raw)
                names = np.fromiter((_key(view[a:b], 0) for a, b in zip(at.tolist(), (at + n + LENGTH - 1).tolist(), strict=True)), np.int64, len(at))
                held.append((np.full(len(at), key), at, n, lead, gram, names))
                total += len(at)
                if total > 50_000:
                    yield _columns(held)
                    held, total = [], 0
            if held:
                yield _columns(held)

    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(cut, "doc_id long, at long, n int, lead int, gram long, name long")


def _columns(held: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    columns = [pa.array(np.concatenate(c).astype(k.to_pandas_dtype())) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "at", "n", "lead", "gram", "name"])


def _bytes_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted blocks (doc_id, at, n, lead, gram) with their bytes."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n", "lead", "gram")).alias("blocks"))
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(lists, "doc_id").select("doc_id", "text", "blocks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for key, value, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                raw = value.as_py().encode("utf-8", "surrogatepass")
                for b in found.as_py():
                    for column, x in zip(out, (key, b["at"], b["n"], b["lead"], b["gram"], raw[b["at"]:b["at"] + b["n"] + LENGTH - 1]), strict=True):
                        column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "at", "n", "lead", "gram", "raw"])

    return held.mapInArrow(cut, "doc_id long, at long, n int, lead int, gram long, raw binary")


def strides(n: int, lead: int) -> range:
    """Numbers of the groups of windows, by their distance to the sampled position, in a block."""
    return range((lead - n + 1) // STRIDE, lead // STRIDE + 1)


def _steps(variants: DataFrame) -> DataFrame:
    """One row per step of each block: doc_id, step (packed at and j), gram, core, hull."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, at, n, lead, gram, raw in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                view = memoryview(raw)
                for j in strides(n, lead):
                    start = lead - STRIDE * j  # of the core: the window of least distance begins there
                    last = min(STRIDE * j + STRIDE - 1, lead)
                    first = max(STRIDE * j, lead - n + 1)
                    hull = view[lead - last:lead - first + LENGTH]
                    row = (key, at * 64 + j, gram, _key(view[start:start + LENGTH - STRIDE + 1], j), _key(hull, (last - STRIDE * j) * STRIDE + first - STRIDE * j))
                    for column, x in zip(out, row, strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "step", "gram", "core", "hull"])

    return variants.mapInArrow(cut, "doc_id long, step long, gram long, core long, hull long")


def _windows(variants: DataFrame) -> DataFrame:
    """Every window of the wanted strides (column js): doc_id, p, gram, key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places, grams, keys = [], [], [], []
            for key, at, n, lead, gram, raw, js in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                view = memoryview(raw)
                for j in js:
                    for d in range(max(STRIDE * j, lead - n + 1), min(STRIDE * j + STRIDE - 1, lead) + 1):
                        docs.append(key)
                        places.append(at + lead - d)
                        grams.append(gram)
                        keys.append(_key(view[lead - d:lead - d + LENGTH], d))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(places, pa.int64()), pa.array(grams, pa.int64()), pa.array(keys, pa.int64())], ["doc_id", "p", "gram", "key"])

    return variants.mapInArrow(cut, "doc_id long, p long, gram long, key long")


def _packed(at, n, lead):
    """Place, windows and distance of a block in one number, in the order of places below 2**44."""
    return at * (1 << 18) + n * (1 << 9) + lead


def _unpacked(column: str) -> list:
    c = F.col(column)
    return [F.shiftright(c, 18).alias("at"), (F.shiftright(c, 9) % 512).cast("int").alias("n"), (c % 512).cast("int").alias("lead")]


def _sorted_out(rows: DataFrame, outer: list[str], inner: str, place: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Split rows (doc_id, place, outer, inner) by what else begins with the same outer key.

    First the rows (doc_id, place) whose inner key occurs again; then, for outer keys with different
    inner keys, the first row of each: (doc_id, place, outer).
    """
    often = rows.groupBy(*outer).agg(F.count("*").alias("times")).where("times > 1").select(*outer)
    again = staged(rows.join(often, outer), name)
    wide = F.expr(f"cast(cast(doc_id as decimal(20,0)) * {WIDE} + {place} as decimal(38,0))")
    classes = staged(again.groupBy(*outer, inner).agg(F.count("*").alias("times"), F.min(wide).alias("wide")), f"{name}-classes")
    equal = again.join(classes.where("times > 1").select(*outer, inner), [*outer, inner]).select("doc_id", place)
    mixed = classes.groupBy(*outer).count().where("count > 1").select(*outer)
    first = classes.join(mixed, outer).select(*outer, "wide", F.expr(f"cast(pmod(wide, {WIDE}) as long)").alias(place))
    return equal, first.select(F.expr(f"(wide - {place}) div {WIDE}").cast("long").alias("doc_id"), place, *outer)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans (doc_id, first, last) of byte places covered by windows that also start elsewhere; they may overlap."""
    rows = _blocks_of(docs).select("doc_id", _packed(F.col("at"), F.col("n"), F.col("lead")).alias("block"), "gram", "name")
    whole, chosen = _sorted_out(rows, ["gram"], "name", "block", "blocks")
    whole = whole.select("doc_id", *_unpacked("block")).select("doc_id", F.col("at").alias("first"), (F.col("at") + F.col("n") + LENGTH - 2).alias("last"))
    variants = staged(_bytes_of(docs, chosen.select("doc_id", *_unpacked("block"), "gram")), "variants")
    steps, open_ = _sorted_out(_steps(variants), ["gram", "core"], "hull", "step", "steps")
    at_j = [F.shiftright("step", 6).alias("at"), (F.col("step") % 64).cast("int").alias("j")]
    sizes = variants.select("doc_id", "at", "n", "lead")
    far = F.least(F.col("j") * STRIDE + STRIDE - 1, F.col("lead"))
    near = F.greatest(F.col("j") * STRIDE, F.col("lead") - F.col("n") + 1)
    steps = steps.select("doc_id", *at_j).join(sizes, ["doc_id", "at"]).select(
        "doc_id", (F.col("at") + F.col("lead") - far).alias("first"), (F.col("at") + F.col("lead") - near + LENGTH - 1).alias("last"))
    lists = open_.select("doc_id", *at_j).groupBy("doc_id", "at").agg(F.collect_set("j").alias("js"))
    windows = _windows(variants.join(lists, ["doc_id", "at"]).select("doc_id", "at", "n", "lead", "gram", "raw", "js"))
    windows = staged(windows, "windows")
    equal = windows.groupBy("gram", "key").agg(F.count("*").alias("times")).where("times > 1").select("gram", "key")
    single = windows.join(equal, ["gram", "key"]).select("doc_id", F.col("p").alias("first"), (F.col("p") + LENGTH - 1).alias("last"))
    return whole.unionAll(steps).unionAll(single)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_bytes, n_removed, n_spans and the kept bytes.

    Every byte goes that lies in a LENGTH-byte string which also starts at any other place. A null
    text is empty; texts below LENGTH bytes stay whole. Rows of one doc_id, or of a null one, are documents of
    their own. An empty frame gives an empty one; other columns are ignored.
    """
    rows, apart = rows_apart(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    kept = _without_repeats(rows)
    return kept.join(rows.select("doc_id", "_given_id"), "doc_id").drop("doc_id").withColumnRenamed("_given_id", "doc_id").select("doc_id", *kept.columns[1:]) if apart else kept


def _without_repeats(docs: DataFrame) -> DataFrame:
    spans = staged(repeated_spans(docs).groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, value, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                stays, runs = raw, 0
                if found.is_valid and len(raw):
                    edges = np.zeros(len(raw) + 1, np.int64)
                    values = found.values
                    np.add.at(edges, np.minimum(values.field("first").to_numpy(), len(raw)), 1)
                    np.add.at(edges, np.minimum(values.field("last").to_numpy() + 1, len(raw)), -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    stays = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                for column, x in zip(out, (key, len(raw), len(raw) - len(stays), runs, stays), strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return texts.mapInArrow(keep, RESULT)

