"""Best-fit decreasing packing of token sequences.

Best-fit decreasing depends on lengths alone, so it is planned on the counts per length (at most
``capacity`` rows, whatever the corpus) and carried out by the executors: pieces of a length are
ranked, and each rank's bin follows from the plan by arithmetic. The plan is that of placing the
pieces one by one, longest first, each into the tightest open bin that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.order import rank_within
from lakewarden.llm.staging import staged
from lakewarden.llm.tokens import encoder

CAPACITY = 2048
BROADCAST_ROWS = 300_000
HELD_TOKENS = 1 << 19


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which of them have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)
        self.bins: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, capacity: int) -> None:
        at = self.size + capacity
        self.open[at] = int(bool(self.bins.get(capacity)))
        while at > 1:
            at >>= 1
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def add(self, capacity: int, first: int, last: int) -> None:
        """Bins first..last-1 have this much room."""
        if first < last and capacity > 0:
            self.bins.setdefault(capacity, []).append((first, last))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        found = self.bins[capacity].pop()
        self._mark(capacity)
        return found

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open bin that holds the length, in logarithmic time."""
        at = self.size + length
        if self.open[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, bin_from, per_bin, offset).

    Pieces of that length ranked rank_from..rank_to-1 go to bins from bin_from on, per_bin to a
    bin, side by side from the offset. A bin holds at most about sqrt(2 * capacity) different
    lengths and a length leaves at most two new kinds of bins, which bounds the rows by the capacity.
    """
    tree, bins, rows = CapacityTree(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            each = (capacity if room is None else room) // length
            if room is None:
                room, first, last = capacity, bins, bins + -(-left // each)
                bins = last
            else:
                first, last = tree.take(room)
            whole = min(last - first, left // each)
            if whole:
                rows.append((length, rank, rank + whole * each, first, each, capacity - room))
                tree.add(room - each * length, first, first + whole)
                rank, left, first = rank + whole * each, left - whole * each, first + whole
            if left and first < last:
                rows.append((length, rank, rank + left, first, left, capacity - room))
                tree.add(room - left * length, first, first + 1)
                rank, left, first = rank + left, 0, first + 1
            tree.add(room, first, last)
    return rows


def best_fit_pack(pieces: DataFrame, key: str = "doc_id", ties: tuple[str, ...] = ("piece",), capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of 1..capacity.

    All other columns are kept. An empty frame gives an empty one; equal rows are separate pieces
    and each gets its own place. Lengths that are null, below 1 or above the capacity are an error.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most one row per length
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError("piece lengths must be from 1 to the capacity")
    rows = plan(counts, capacity)
    steps = spark.createDataFrame(rows, "length int, _from long, _to long, _bin long, _each long, _at long")
    ranked = rank_within(pieces, "length", key, "_rank", ties)
    steps = F.broadcast(steps) if len(rows) <= BROADCAST_ROWS else steps
    placed = ranked.join(steps, (ranked["length"] == steps["length"]) & F.col("_rank").between(F.col("_from"), F.col("_to") - 1)).drop(steps["length"])
    inside = F.col("_rank") - F.col("_from")
    return placed.withColumn("sequence_id", F.col("_bin") + F.floor(inside / F.col("_each"))).withColumn(
        "offset", F.col("_at") + (inside % F.col("_each")) * F.col("length")).drop("_rank", "_from", "_to", "_bin", "_each", "_at")


PIECES = "doc_id long, piece int, start long, length int, ids binary"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document: its ids, then end_id.

    Only longer documents are cut. ids holds little-endian unsigned 32-bit numbers. A null or
    empty text is one piece with end_id alone; a null doc_id stays null.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_column
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            held = 0
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text")), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    for column, x in zip(rows, (doc_id, piece, start, len(part), part.tobytes()), strict=True):
                        column.append(x)
                    held += len(part)
                if held > HELD_TOKENS:
                    yield _pieces(rows)
                    rows, held = [[], [], [], [], []], 0
            if rows[0]:
                yield _pieces(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def _pieces(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"])


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Where each piece of each document goes, with a checksum of its ids in their place."""
    pieces = token_pieces(docs, vocabulary, capacity, end_id).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return best_fit_pack(staged(pieces, "pieces"), ties=("piece", "ids_crc32"), capacity=capacity).withColumn(
        "length", F.col("length").cast("long"))
