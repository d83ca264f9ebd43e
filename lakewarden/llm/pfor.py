"""Token ids in patched frame-of-reference blocks.

A document's ids are cut into blocks of 128. A block keeps its least id, the other ids as
differences packed at the bit width of a chosen percentile of them, and a list of the exceptions
that need more bits. Every document begins with an index of where its blocks start.

Layout of one document, all numbers little-endian: magic b"PFB1", u32 number of ids, u32 number of
blocks, u32 start of each block; each block is u32 least id, u8 width, u8 exceptions, u8 ids, then
the packed bits, then u8 place and u32 difference of each exception. The documents are rows of a
Parquet table whose parts hold them in ascending doc_id order, so files split and are written and
read by Spark alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.order import id_blocks, running_total
from lakewarden.llm.rows import rows_apart
from lakewarden.llm.staging import staged
from lakewarden.llm.tokens import encoder

MAGIC = int.from_bytes(b"PFB1", "little")
BLOCK = 128
PERCENTILE = 0.9
HEADER = 7
HELD_IDS = 1 << 20
ROWS_A_FILE = 8192


def _spread(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each size in turn."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that a number below 2**32 needs; 0 needs none."""
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1).astype(np.float64))) + 1, 0).astype(np.int64)


def encode_documents(documents: list[np.ndarray], percentile: float = PERCENTILE) -> list[bytes]:
    """The bytes of each document; all their blocks are worked on at once."""
    lengths = np.array([len(d) for d in documents], np.int64)
    blocks = -(-lengths // BLOCK)
    n = int(blocks.sum())
    of = np.repeat(np.arange(len(documents)), blocks)
    counts = np.minimum(BLOCK, np.repeat(lengths, blocks) - _spread(blocks) * BLOCK)
    grid = np.full((n, BLOCK), 0xFFFFFFFF, np.uint32)
    inside = np.arange(BLOCK) < counts[:, None]
    grid[inside] = np.concatenate(documents) if n else np.zeros(0, np.uint32)
    least = grid.min(axis=1) if n else np.zeros(0, np.uint32)
    above = np.where(inside, grid - least[:, None], np.uint32(0))
    place = np.maximum(np.ceil(percentile * counts).astype(np.int64), 1) - 1
    at_percentile = np.zeros(n, np.uint32)
    for count in np.unique(counts):
        rows = np.flatnonzero(counts == count)
        at_percentile[rows] = np.partition(above[rows, :count], place[rows[0]], axis=1)[:, place[rows[0]]]
    widths = _bits(at_percentile)
    odd = inside & (above > ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None])
    exceptions = odd.sum(axis=1)
    packed = -(-counts * widths // 8)
    sizes = HEADER + packed + 5 * exceptions
    doc_sizes = 12 + 4 * blocks + np.bincount(of, sizes, len(documents)).astype(np.int64)
    doc_starts = np.cumsum(doc_sizes) - doc_sizes
    before = np.cumsum(sizes) - sizes
    first = np.cumsum(blocks) - blocks
    inner = before - (before[first[of]] if n else 0) + 12 + 4 * np.repeat(blocks, blocks)
    starts = doc_starts[of] + inner
    out = np.zeros(int(doc_sizes.sum()), np.uint8)

    def put(at: np.ndarray, values: np.ndarray, width: int) -> None:
        if len(at):
            out[at[:, None] + np.arange(width)] = np.asarray(values).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]

    put(doc_starts, np.full(len(documents), MAGIC), 4)
    put(doc_starts + 4, lengths, 4)
    put(doc_starts + 8, blocks, 4)
    put(doc_starts[of] + 12 + 4 * _spread(blocks), inner, 4)
    put(starts, least, 4)
    put(starts + 4, widths, 1)
    put(starts + 5, exceptions, 1)
    put(starts + 6, counts, 1)
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        low = np.ascontiguousarray((above[rows] & np.uint32((1 << int(width)) - 1)).T).astype(np.uint64)
        words = np.zeros((2 * int(width), len(rows)), np.uint64)
        for j in range(BLOCK):
            word, shift = divmod(j * int(width), 64)
            words[word] |= low[j] << np.uint64(shift)
            if shift + width > 64:
                words[word + 1] |= low[j] >> np.uint64(64 - shift)
        held = np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(rows), -1)
        keep = np.arange(held.shape[1]) < packed[rows][:, None]
        out[(starts[rows][:, None] + HEADER + np.arange(held.shape[1]))[keep]] = held[keep]
    row, place = np.nonzero(odd)
    at = (starts + HEADER + packed)[row] + 5 * _spread(exceptions)
    put(at, place, 1)
    put(at + 1, above[row, place], 4)
    whole = out.tobytes()
    return [whole[s:s + z] for s, z in zip(doc_starts.tolist(), doc_sizes.tolist(), strict=True)]


def decode_documents(documents: list[bytes]) -> list[np.ndarray]:
    """The ids of each document, found through its index of block starts."""
    data = np.frombuffer(b"".join(documents) + bytes(16 * 32 + 8), np.uint8)
    doc_sizes = np.array([len(d) for d in documents], np.int64)
    doc_starts = np.cumsum(doc_sizes) - doc_sizes

    def get(at: np.ndarray, width: int) -> np.ndarray:
        raw = np.zeros((len(at), 4), np.uint8)
        raw[:, :width] = data[at[:, None] + np.arange(width)]
        return raw.view("<u4").ravel().astype(np.int64)

    if (get(doc_starts, 4) != MAGIC).any():
        raise ValueError("not a document of this format")
    lengths, blocks = get(doc_starts + 4, 4), get(doc_starts + 8, 4)
    of = np.repeat(np.arange(len(documents)), blocks)
    starts = doc_starts[of] + get(doc_starts[of] + 12 + 4 * _spread(blocks), 4)
    least, widths, exceptions, counts = get(starts, 4), get(starts + 4, 1), get(starts + 5, 1), get(starts + 6, 1)
    grid = np.zeros((len(starts), BLOCK), np.uint64)
    for width in np.unique(widths[widths > 0]):
        rows, mask = np.flatnonzero(widths == width), np.uint64((1 << int(width)) - 1)
        words = data[starts[rows][:, None] + HEADER + np.arange(16 * int(width))].view("<u8").astype(np.uint64)
        words = np.ascontiguousarray(words.T)
        values = np.zeros((BLOCK, len(rows)), np.uint64)
        for j in range(BLOCK):
            word, shift = divmod(j * int(width), 64)
            values[j] = words[word] >> np.uint64(shift)
            if shift + width > 64:
                values[j] |= words[word + 1] << np.uint64(64 - shift)
        grid[rows] = (values & mask).T
    row = np.repeat(np.arange(len(starts)), exceptions)
    at = (starts + HEADER + -(-counts * widths // 8))[row] + 5 * _spread(exceptions)
    grid[row, get(at, 1)] = get(at + 1, 4).astype(np.uint64)
    grid += least.astype(np.uint64)[:, None]
    ids = grid[np.arange(BLOCK) < counts[:, None]].astype(np.uint32)
    return np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []


def write_token_table(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, percentile: float = PERCENTILE) -> None:
    """Write doc_id and data of every document, ascending, to a new Parquet folder at ``path``.

    Texts are encoded where they are read; the packed bytes are then dealt out by ranges of doc_id, which quantiles of
    the ids cut. A null or empty text has end_id alone. A null doc_id comes last; rows with equal doc_id
    follow each other. An empty frame writes an empty table.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary).encode_column
        for batch in batches:
            at, held, total = 0, [], 0
            for ids in ids_of(batch.column(2)):
                held.append(np.append(ids, np.uint32(end_id)))
                total += len(held[-1])
                if total > HELD_IDS:
                    yield _packed_rows(batch, at, held, percentile)
                    at, held, total = at + len(held), [], 0
            if held:
                yield _packed_rows(batch, at, held, percentile)

    rows, _ = rows_apart(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    part, parts = id_blocks(rows, "doc_id", ROWS_A_FILE)
    packed = rows.select("doc_id", "_given_id", "text").withColumn("_part", part).select("doc_id", "_given_id", "text", "_part").mapInArrow(
        encode, "doc_id long, _given_id long, data binary, _part int")
    packed.repartitionById(parts, F.col("_part")).sortWithinPartitions("doc_id").select(F.col("_given_id").alias("doc_id"), "data").write.parquet(path)


def _packed_rows(batch: pa.RecordBatch, at: int, documents: list[np.ndarray], percentile: float) -> pa.RecordBatch:
    here = batch.slice(at, len(documents))
    return pa.RecordBatch.from_arrays(
        [here.column(0), here.column(1), pa.array(encode_documents(documents, percentile), pa.binary()), here.column(3).cast(pa.int32())], ["doc_id", "_given_id", "data", "_part"])


def _rows(keys: list, values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.binary())], ["doc_id", "data"])


def read_token_table(spark, path: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every document in the table at ``path``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(values):
                to, size = at, 0
                while to < len(values) and (to == at or size + len(values[to]) <= 2 * HELD_IDS):
                    size += len(values[to])
                    to += 1
                yield _rows(keys[at:to], [d.astype("<u4").tobytes() for d in decode_documents(values[at:to])])
                at = to

    table = spark.read.schema("doc_id long, data binary").parquet(path)
    return table.mapInArrow(decode, "doc_id long, data binary").withColumnRenamed("data", "ids")


def token_places(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a written table."""
    read = read_token_table(spark, path).select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    placed = running_total(staged(read, "token-places"), "doc_id", "n_tokens", "start", ("ids_crc32",))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")
