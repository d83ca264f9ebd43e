"""Run records on storage: append, load, export, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.operators.history import export_fields, report_lines, run_totals

RECORD_DDL = (
    "run_id string, timestamp string, `table` string, scenario string, format string, validation_status string, "
    "evolution_type string, rows_total bigint, rows_valid bigint, duplicate_count bigint, "
    "null_violations map<string,double>, avg_null_pct double, profiling_ms double, slm_status string, "
    "slm_inference_ms double, quality_score double, issues array<string>, warnings array<string>"
)


#: Each record has a folder of its own; writing a load again replaces its record and no other.
RECORD_KEY = ["run_id", "scenario", "format", "table"]


def write_records(records: DataFrame, path: str) -> None:
    """Records in folders by run, scenario, format and table; only the folders they name are replaced."""
    (records.repartition(*RECORD_KEY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*RECORD_KEY).json(path))


def read_records(spark: SparkSession, path: str, with_summaries: bool = False, ordered: bool = False) -> DataFrame:
    """The whole history, sorted by time if asked. Files named like a summary and broken lines are left out.

    A filter on the record key only opens the folders it names.
    """
    fields = [f.name for f in spark.createDataFrame([], RECORD_DDL).schema.fields]
    df = spark.read.schema(RECORD_DDL).option("mode", "DROPMALFORMED").json(path)
    if not with_summaries:
        df = df.filter(~F.contains(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("summary")))
    df = df.select(*fields)
    return df.orderBy("timestamp", *RECORD_KEY) if ordered else df


def read_record_documents(spark: SparkSession, path: str) -> DataFrame:
    """Records kept as one JSON document per file: an object, or a list of objects."""
    df = (spark.read.schema(RECORD_DDL).option("multiLine", True).option("mode", "DROPMALFORMED").json(path))
    return (df.filter(~F.contains(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("summary")))
            .orderBy("timestamp"))


def export_records(records: DataFrame, path: str) -> None:
    export_fields(records).write.mode("overwrite").option("header", True).csv(path)


def write_report(records: DataFrame, path: str) -> None:
    """Report lines per table, and the totals of each run, as text."""
    totals = run_totals(records).select(F.format_string(
        "%s: mean score %s/100, tables %s, DLQ %s, WARNING %s, documented %s",
        "run_id", F.col("mean_score").cast("string"), "tables", "dlq", "warnings", "documented").alias("value"))
    lines = report_lines(records).select(F.col("line").alias("value"))
    lines.unionByName(totals).write.mode("overwrite").text(path)
