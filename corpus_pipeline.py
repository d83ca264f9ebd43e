"""A training corpus from raw documents: quality, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; what it returns is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of documents, with
n_chars following the text. Null texts count as empty; extra columns pass through all stages but the
last. The stages on pairs take rows without doc_id, or with a repeated one, as documents of their own,
in the order of doc_id (null last), then of a row key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm import line_runs, raking, ranking, sigtree
from lakewarden.llm.bestfit import packed_documents
from lakewarden.llm.rows import rows_apart
from lakewarden.llm.staging import documents, ship, staged
from lakewarden.llm.tokens import word_vocabulary


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents_stage(stage: Callable) -> Callable:
    """A stage that gets other columns than those of documents under names no operator uses, and returns all of them."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        away = {c: f"_extra_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(away), sf_dir)
        return out.select([away.get(c, c) for c in docs.columns]).withColumnsRenamed({v: k for k, v in away.items()})

    return run_stage


@documents_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise-ranking score reaches the cut; the fit sees labelled documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = ranking.fit(docs, labels)
    return docs.where(ranking.score_of(model)(F.col("text")) >= ranking.CUT)


@documents_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those of which nothing is left go."""
    kept = line_runs.without_repeats(docs)
    gone = (F.col("n_removed") > 0) & (F.trim(F.translate("text", "\n\t\r", "   ")) == "")
    return kept.where(~F.coalesce(gone, F.lit(False))).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


@documents_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group linked by 5-word shingles at a similarity of 0.8."""
    docs, _ = rows_apart(docs)
    groups = sigtree.jaccard_groups(docs, n=5, num=80, den=100)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(staged(gone, "copies"), "doc_id", "left_anti").drop("doc_id").withColumnRenamed("_given_id", "doc_id")


@documents_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose source, language and topic weights are flatter than the corpus's."""
    return raking.mixed(docs).where("kept")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the documents in sequences of 2048 tokens."""
    return packed_documents(docs, word_vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", best_fit_packing),
]

#: Model fits, raking and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
