"""The registered queries of the training-data operators, one opN_ each, with SQL where it can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm import suffix_sample
from lakewarden.llm.bestfit import packed_documents
from lakewarden.llm.dot_matrix import clustered
from lakewarden.llm.dot_matrix import oracle as clusters_sql
from lakewarden.llm.hard_negatives import hard_negatives
from lakewarden.llm.hard_negatives import oracle as hard_negatives_sql
from lakewarden.llm.imatch import edited_fingerprints
from lakewarden.llm.importance import judged
from lakewarden.llm.importance import oracle as importance_sql
from lakewarden.llm.line_runs import oracle as line_runs_sql
from lakewarden.llm.line_runs import without_repeats
from lakewarden.llm.merkle import audit, placed, record_index, warc_record
from lakewarden.llm.pfor import token_places, write_token_table
from lakewarden.llm.projections import near_duplicates
from lakewarden.llm.ranking import fit, scored
from lakewarden.llm.raking import TOLERANCE, mixed
from lakewarden.llm.sigtree import jaccard_groups
from lakewarden.llm.staging import documents, shared_folder, ship, staged
from lakewarden.llm.tokens import word_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of at most 2048 tokens, from best-fit decreasing over the whole corpus."""
    return packed_documents(documents(spark, sf_dir, "doc_id", "text"), word_vocabulary())


@query
def op5_pairwise_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, from preference pairs of the labelled ones."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")))


@query
def op8_frame_of_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written in blocks and read back."""
    path = f"{shared_folder(spark)}/token-table-{uuid.uuid4().hex}"
    write_token_table(documents(spark, sf_dir, "doc_id", "text"), path, word_vocabulary())
    return token_places(spark, path)


@query
def op10_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and keeper of every vector among those of its label."""
    return near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@query
def op9_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under the 4-word Jaccard join at 0.85."""
    return jaccard_groups(documents(spark, sf_dir, "doc_id", "text"))


@query
def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return edited_fingerprints(documents(spark, sf_dir, "doc_id", "text"))


@query
def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the later copies of repeated runs of lines."""
    kept = without_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op6_line_runs"] = line_runs_sql()


@query
def op7_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated weight, chance and draw of every document."""
    rows = mixed(documents(spark, sf_dir, "doc_id", "text", "source", "lang"))
    return rows.select("doc_id", "n_tokens", "topic", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "kept", (F.col("deviation") <= TOLERANCE).alias("met"))


#: The second replica: the same pages with some records cut short, altered or lost, told by page_id.
DAMAGED = {"html": "case page_id % 997 when 3 then substr(html, 1, length(html) // 2) when 5 then replace(html, '<p>', '<P>') else html end"}


@query
def op1_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status in a damaged replica of every page's record, at its place in the archive, and the replica's extra records."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").select("page_id", "url", "html")
    index = staged(record_index(pages, "page_id", warc_record(F.col("url"), F.col("html")), nulls_last=True), "index")
    # the replica keeps the archive's order: records of one page_id follow each other by the digests before the damage
    replica = pages.where("not (page_id % 997 <=> 7)").withColumn("place", F.sha2(warc_record(F.col("url"), F.col("html")), 256))
    replica = replica.withColumn("html", F.expr(DAMAGED["html"].replace("//", "div")))
    own = record_index(replica, "page_id", warc_record(F.col("url"), F.col("html")), F.col("place"), nulls_last=True)
    return audit(index, staged(placed(index, staged(own, "own")), "replica"), extra=True).select(
        F.col("key").alias("page_id"), "offset", "length", F.col("digest").alias("sha256"), "status")


ORACLE["op1_merkle_audit"] = f"""
with a as (select page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
             || chr(13) || chr(10) || 'Content-Length: ' as head, chr(13) || chr(10) || chr(13) || chr(10) as gap, coalesce(html, '') as html from pages),
b as (select page_id, head || strlen(html) || gap || html || gap as record,
             head || strlen(other) || gap || other || gap as replica
      from (select *, {DAMAGED["html"]} as other from a))
select page_id, cast(coalesce(sum(strlen(record)) over (order by page_id rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset",
       strlen(record) as length, sha256(record) as sha256,
       case when page_id % 997 = 7 then 'missing' when record = replica then 'intact' else 'changed' end as status
from b"""


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that also start elsewhere."""
    kept = suffix_sample.without_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_incremental_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every sound vector after three rounds from sixteen centroids."""
    return clustered(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")).drop("centroid")


ORACLE["op11_incremental_distances"] = clusters_sql()


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives in the window below each positive of every anchor."""
    return hard_negatives(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


ORACLE["op12_hard_negatives"] = hard_negatives_sql()


@query
def op13_importance_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, score and verdict of every document; trusted are those labelled 1."""
    return judged(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


ORACLE["op13_importance_rules"] = importance_sql()
