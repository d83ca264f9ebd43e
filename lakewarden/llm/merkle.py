"""Fixity of archive replicas by Merkle trees over records and ordered offset ranges.

A leaf of the tree is a range of LEAF_BYTES of the archive: the hash of the digests of the records
that begin in it, in order. FANOUT neighbouring ranges make a node above. Replicas are compared at
the root, and only the children of nodes that differ are looked at below, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakewarden.llm.order import running_total
from lakewarden.llm.staging import staged

LEAF_BYTES = 1 << 16
FANOUT = 16


def warc_record(url: Column, body: Column) -> Column:
    """Bytes of a response record, as text; nulls are empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def record_index(records: DataFrame, key: str, record: Column, place: Column | None = None, nulls_last: bool = False) -> DataFrame:
    """Key, offset, length and SHA-256 of each record, in the order of the integer key.

    Rows of one key follow each other by place, else by digest; a null key comes first unless nulls_last.
    """
    digest = F.sha2(record, 256)
    found = records.select(F.col(key).cast("long").alias("key"), F.octet_length(record).cast("long").alias("length"), digest.alias("digest"),
                           *([] if place is None else [place.alias("place")]))
    found = staged(found, "records")
    index = running_total(found, "key", "length", "offset", ("digest",) if place is None else ("place", "digest")).select("key", "offset", "length", "digest")
    if not nulls_last:
        return index
    null, rest = (found.where(c).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] for c in ("key is null", "key is not null"))
    return index.withColumn("offset", F.col("offset") + F.when(F.col("key").isNull(), rest).otherwise(-null))


def placed(index: DataFrame, replica: DataFrame) -> DataFrame:
    """The replica's own index (see record_index) with the offsets of the original archive.

    A record belongs to the record of the same key, nulls equal, and the same place among those of the key.
    Records beyond these are extra and stand behind the original's end, as far as they are into the replica.
    """
    nth = F.row_number().over(W.partitionBy("key").orderBy("offset"))
    end = index.agg(F.coalesce(F.max(F.col("offset") + F.col("length")), F.lit(0))).first()[0]
    ours = index.select(F.col("key").alias("_key"), F.col("offset").alias("_offset"), nth.alias("_nth"))
    own = replica.withColumn("nth", nth)
    joined = own.join(ours, F.col("key").eqNullSafe(F.col("_key")) & (F.col("nth") == F.col("_nth")), "left")
    return joined.select("key", F.coalesce("_offset", F.col("offset") + end).alias("offset"), "length", "digest")


def _folded(nodes: DataFrame) -> DataFrame:
    """Hash of each node's children (child, hash), at most FANOUT or the records of one range."""
    return nodes.groupBy("node").agg(F.sha2(F.concat_ws("\n", F.transform(
        F.sort_array(F.collect_list(F.struct("child", "hash"))), lambda c: F.concat_ws(" ", c["child"].cast("string"), c["hash"]))), 256).alias("hash"))


def tree(index: DataFrame, top: int) -> list[DataFrame]:
    """Levels of (node, hash): ranges of LEAF_BYTES first, the root last at level ``top``. No records, no nodes."""
    leaf = index.select(F.floor(F.col("offset") / LEAF_BYTES).cast("long").alias("node"), F.col("offset").alias("child"),
                        F.concat_ws(" ", F.coalesce(F.col("key").cast("string"), F.lit("")), "length", "digest").alias("hash"))
    levels = [staged(_folded(leaf), "merkle")]
    for _ in range(top):
        up = levels[-1].select(F.floor(F.col("node") / FANOUT).cast("long").alias("node"), F.col("node").alias("child"), "hash")
        levels.append(staged(_folded(up), "merkle"))
    return levels


def depth(*indexes: DataFrame) -> int:
    """Levels above the ranges until one node spans the longest archive."""
    ends = [i.agg(F.max("offset")).first()[0] or 0 for i in indexes]
    top, nodes = 0, max(ends) // LEAF_BYTES + 1
    while nodes > 1:
        top, nodes = top + 1, -(-nodes // FANOUT)
    return top


def damaged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records of two indexes that differ: key, offset and status changed, missing or extra (in right).

    Both indexes give offsets in the original archive. Several records of one key and offset count as
    one place, which is changed if their digests differ in any way. Equal archives give no rows.
    """
    top = depth(left, right)
    ours, theirs = tree(left, top), tree(right, top)
    open_nodes = None
    for level in range(top, -1, -1):
        a, b = ours[level].withColumnRenamed("hash", "a"), theirs[level].withColumnRenamed("hash", "b")
        if open_nodes is not None:
            parent = F.floor(F.col("node") / FANOUT).cast("long")
            a, b = (x.withColumn("up", parent).join(open_nodes, "up", "left_semi").drop("up") for x in (a, b))
        differing = a.join(b, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")
        open_nodes = staged(differing.withColumnRenamed("node", "up"), "differing")
    ranged = [x.withColumn("up", F.floor(F.col("offset") / LEAF_BYTES).cast("long")).join(open_nodes, "up", "left_semi").groupBy("key", "offset").agg(
        F.sort_array(F.collect_list(F.concat_ws(" ", "length", "digest"))).alias(name)) for x, name in ((left, "a"), (right, "b"))]
    a, b = ranged
    b = b.select(F.col("key").alias("_key"), F.col("offset").alias("_offset"), "b")
    both = a.join(b, F.col("key").eqNullSafe(F.col("_key")) & (F.col("offset") == F.col("_offset")), "full_outer")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") != F.col("b"), "changed")
    return both.withColumn("status", status).where("status is not null").select(
        F.when(F.col("a").isNull(), F.col("_key")).otherwise(F.col("key")).alias("key"), F.coalesce("offset", "_offset").alias("offset"), "status")


def audit(index: DataFrame, replica: DataFrame, extra: bool = False) -> DataFrame:
    """Every record of the index with its status in the replica: intact, changed or missing; with extra, also the replica's extra ones."""
    found = staged(damaged(index, replica).select(F.col("key").alias("_key"), F.col("offset").alias("_offset"), "status"), "damaged")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("offset") == F.col("_offset"))
    out = index.join(found, same, "left").select("key", "offset", "length", "digest", F.coalesce("status", F.lit("intact")).alias("status"))
    if not extra:
        return out
    return out.unionAll(replica.join(found.where("status = 'extra'"), same).select("key", "offset", "length", "digest", "status"))
