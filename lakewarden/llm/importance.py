"""Quality rules by hashed n-gram importance: how much better a trusted corpus explains a text than all text does.

Words and pairs of neighbouring words are hashed into buckets. Two multinomials over the buckets are
counted, one from the trusted documents and one from all documents, each with one pseudo-count a
bucket. A document's score is the mean over its n-grams of the logarithm of their ratio, so long and
short texts compare. Weights are whole millionths, which makes a score exact whatever the order of
its terms, and every document is judged by the same fixed threshold: nothing is drawn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
#: A document stays if the trusted corpus explains an n-gram at most a tenth of a nat worse than all text does.
THRESHOLD = -0.1
LEAST_WORDS = 50
#: A pair of words goes to (first * PAIR[0] + second * PAIR[1] + PAIR[2]) mod BUCKETS.
PAIR = (69069, 31, 7)
UNIT = 1_000_000
CACHED_WORDS = 500_000
SLICE_BYTES = 1 << 22
HELD_WORDS = 1 << 18
MARK_BITS = 1 << 26
BLANKS = (9, 10, 11, 12, 13, 32)
SYMBOLS = tuple(b"#*$%&|<>")


class _WordHash(dict):
    """First eight bytes of a word's MD5, looked up; a full cache starts anew."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = int.from_bytes(hashlib.md5(word).digest()[:8], "big")
        return found


_WORDS = _WordHash()


def word_hashes(data: bytes) -> np.ndarray:
    """Hash of each word between blanks; long texts are split slice by slice."""
    parts, at = [], 0
    while len(data) - at > SLICE_BYTES:
        to = at + SLICE_BYTES
        while to < len(data) and data[to] not in BLANKS:
            to += 1
        words = data[at:to].split()
        parts.append(np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words)))
        at = to
    words = data[at:].split()
    parts.append(np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words)))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def _grouped(batch: pa.RecordBatch, column: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Texts of a batch in groups of bounded size: their bytes, the hashes of all their words, and words per text."""
    held: list[bytes] = []
    hashes: list[np.ndarray] = []
    total = 0
    for value in batch.column(column):
        text = value.as_py()
        held.append(text.encode("utf-8", "surrogatepass") if text else b"")
        hashes.append(word_hashes(held[-1]))
        total += len(hashes[-1])
        if total > HELD_WORDS:
            yield held, np.concatenate(hashes), np.array([len(h) for h in hashes])
            held, hashes, total = [], [], 0
    if held:
        yield held, np.concatenate(hashes), np.array([len(h) for h in hashes])


def buckets_of(hashes: np.ndarray, sizes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every word, bucket of every pair of neighbours, and which words begin a pair in their text."""
    word = (hashes >> np.uint64(36)).astype(np.int64)
    inner = np.ones(max(len(word) - 1, 0), bool)
    ends = np.cumsum(sizes)[:-1]
    inner[ends[(ends > 0) & (ends < len(word))] - 1] = False
    pair = (word[:-1] * PAIR[0] + word[1:] * PAIR[1] + PAIR[2]) % buckets
    return word % buckets, pair, inner


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over the n-grams of all texts; a task sends each of its buckets once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, hashes, sizes in _grouped(batch, 0):
                word, pair, inner = buckets_of(hashes, sizes, buckets)
                seen += np.bincount(word, minlength=buckets) + np.bincount(pair[inner], minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at])], ["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def likely(df: DataFrame, ids: DataFrame, key: str, bits: int = MARK_BITS) -> DataFrame:
    """Rows whose key may be among the ids (one column of that name): all that are, and few others.

    The marks are at most bits / 8 bytes however many ids there are, so they are broadcast; what passes is to
    be joined exactly. Texts of other rows need not be shuffled for that join.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    marks = ids.where(F.col(key).isNotNull()).select(place.alias("_p")).groupBy(F.bitmap_bucket_number("_p").alias("_k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_marks"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_marks"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn("_k", F.bitmap_bucket_number(place)).join(F.broadcast(marks), "_k")
    return joined.where(F.getbit(byte, (bit % 8).cast("int")) == 1).drop("_k", "_marks")


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of the documents labelled 1 and never otherwise, each row of such a doc_id.

    The exact join is an inner one with distinct ids: a semi-join would be moved below the marks and shuffle all texts.
    """
    good = labels.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("least"), F.max("quality").alias("most")).where("least = 1 and most = 1").select("doc_id")
    return likely(docs.select("doc_id", "text"), good, "doc_id").join(good.hint("merge"), "doc_id").select("text")


def weights(target: DataFrame, raw: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Millionths of the logarithm of each bucket's share in the target over its share in all text; one row a bucket is collected."""
    both = target.select("bucket", F.col("n").alias("t"), F.lit(0).cast("long").alias("r")).unionAll(
        raw.select("bucket", F.lit(0).cast("long"), "n")).groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("r").alias("r")).toPandas()
    grid = np.ones((2, buckets))
    grid[:, both["bucket"].to_numpy(np.int64)] += both[["t", "r"]].to_numpy(np.float64).T
    return np.rint(UNIT * (np.log(grid[0] / grid[0].sum()) - np.log(grid[1] / grid[1].sum()))).astype(np.int64)


def repeated_words(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text how many of its words lie in a window of three that is found twice or more in it."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    flags = np.zeros(len(hashes), bool)
    if len(hashes) > 2:
        with np.errstate(over="ignore"):
            window = hashes[:-2] * np.uint64(0x9E3779B97F4A7C15)
            window = ((window ^ (window >> np.uint64(29))) + hashes[1:-1]) * np.uint64(0xBF58476D1CE4E5B9)
            window = ((window ^ (window >> np.uint64(32))) + hashes[2:] + text[:-2].astype(np.uint64)) * np.uint64(0x94D049BB133111EB)
        whole = np.flatnonzero(text[:-2] == text[2:])
        order = whole[np.argsort(window[whole], kind="stable")]
        same = (window[order[1:]] == window[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        at = np.concatenate([order[1:][same], order[:-1][same]])
        for k in range(3):
            flags[at + k] = True
    return np.bincount(text, flags, len(sizes)).astype(np.int64)


FOUND = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "score_units")


def measured(held: list[bytes], hashes: np.ndarray, sizes: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """The columns FOUND of some texts."""
    chars, symbols, lines = (np.zeros(len(held), np.int64) for _ in range(3))
    for k, data in enumerate(held):
        raw = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        chars[k] = len(data) - raw[128:192].sum() - raw[list(BLANKS)].sum()
        symbols[k] = raw[list(SYMBOLS)].sum()
        full = [x for x in data.split(b"\n") if x.strip()]
        lines[k] = len(full) - len(set(full))
    text = np.repeat(np.arange(len(sizes)), sizes)
    word, pair, inner = buckets_of(hashes, sizes, len(weight))
    score = np.zeros(len(sizes), np.int64)
    np.add.at(score, text, weight[word])
    np.add.at(score, text[:-1][inner], weight[pair[inner]])
    return [sizes, chars, symbols, lines, repeated_words(hashes, sizes), np.maximum(2 * sizes - 1, 0), score]


def scored(docs: DataFrame, weight: np.ndarray, threshold: float = THRESHOLD, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept of every row."""
    model = docs.sparkSession.sparkContext.broadcast(weight)  # one number a bucket

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for held, hashes, sizes in _grouped(batch, 1):
                found = measured(held, hashes, sizes, model.value)
                keys = batch.column(0).slice(at, len(held))
                at += len(held)
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.int64()) for c in found)], ["doc_id", *FOUND])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text").mapInArrow(judge, ", ".join([f"doc_id {kind}", *(f"{c} long" for c in FOUND)]))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    line = F.lit(round(threshold * UNIT)).cast("long") * F.col("n_grams")
    return rows.select(
        "doc_id", *FOUND[:5], failed.alias("base_failed"),
        (F.coalesce(F.col("score_units").cast("double") / F.nullif(F.col("n_grams").cast("double"), F.lit(0.0)), F.lit(0.0)) / UNIT).alias("score"),
        (~failed & (F.col("score_units") >= line)).alias("kept"))


def judged(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD, learn: Column | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): the base counts, base_failed, score and kept.

    Trusted are the documents labelled 1; ``learn`` picks the labels to use (all). A null or empty text has no
    words and fails the base rules with a score of 0. Rows of one doc_id, or of a null one, are judged each by
    its own text; all of a trusted doc_id are trusted. Without trusted documents all buckets have nearly one weight,
    by the pseudo-counts alone. An empty frame gives an empty one; other columns are ignored.
    """
    labels = labels if learn is None else labels.where(learn)
    weight = weights(bucket_counts(trusted(docs, labels), buckets), bucket_counts(docs, buckets), buckets)
    return scored(docs, weight, threshold)


def oracle(buckets: int = BUCKETS, threshold: float = THRESHOLD, least_words: int = LEAST_WORDS) -> str:
    """The same as plain SQL over ``documents`` and ``labels``."""
    return rf"""with d as materialized (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
w as materialized (select doc_id, unnest(w) as w, unnest(range(1, len(w) + 1)) as i from d),
h as materialized (select doc_id, i, w, lead(w) over p as w2, lead(w, 2) over p as w3, cast('0x' || substr(md5(w), 1, 7) as bigint) as h,
  lead(cast('0x' || substr(md5(w), 1, 7) as bigint)) over p as h2 from w window p as (partition by doc_id order by i)),
g as materialized (select doc_id, h % {buckets} as b from h union all
  select doc_id, (h * {PAIR[0]} + h2 * {PAIR[1]} + {PAIR[2]}) % {buckets} from h where h2 is not null),
good as (select doc_id from labels group by doc_id having min(coalesce(quality, 0)) = 1 and max(quality) = 1),
n as (select b, count(*) as r, count(*) filter (where doc_id in (select doc_id from good)) as t from g group by b),
s as (select sum(t) + {buckets} as tt, sum(r) + {buckets} as rr from n),
m as materialized (select b, cast(round({UNIT} * (ln((t + 1) / tt) - ln((r + 1) / rr))) as bigint) as m from n, s),
score as (select doc_id, cast(sum(m) as bigint) as units, count(*) as n_grams from g join m using (b) group by doc_id),
win as (select doc_id, i, count(*) over (partition by doc_id, w, w2, w3) as c from h where w3 is not null),
rep as (select doc_id, count(distinct j) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as j from win where c > 1) group by doc_id),
l as (select doc_id, line, count(*) - 1 as again from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id, line),
dup as (select doc_id, cast(sum(again) as bigint) as n_dup_lines from l group by doc_id),
base as (select doc_id, cast(len(w) as bigint) as n_words, cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
  cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(units, 0) as units, coalesce(n_grams, 0) as n_grams
  from d left join rep using (doc_id) left join dup using (doc_id) left join score using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {least_words} or 100 * n_repeat_words > 50 * n_words as base_failed,
  coalesce(cast(units as double) / nullif(cast(n_grams as double), 0), 0) / {UNIT}.0 as score,
  not (n_words < {least_words} or 100 * n_repeat_words > 50 * n_words) and units >= {round(threshold * UNIT)} * n_grams as kept
from base"""
