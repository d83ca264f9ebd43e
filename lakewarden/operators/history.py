"""Questions about the history of run records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakewarden.functions.codes import exit_code
from lakewarden.operators.ordered import previous_row

#: Runs of one table, scenario and format follow each other; formats of one run are not compared with one another.
SERIES = ["table", "scenario", "format"]
EXPORT_FIELDS = [
    "run_id", "timestamp", "table", "scenario", "validation_status", "evolution_type", "rows_total",
    "rows_valid", "duplicate_count", "avg_null_pct", "profiling_ms", "slm_status", "slm_inference_ms",
    "quality_score",
]


def select_records(records: DataFrame, table: str | None = None, scenario: str | None = None,
                   last_only: bool = False) -> DataFrame:
    out = records
    if table:
        out = out.filter(F.col("table") == table)
    if scenario:
        out = out.filter(F.col("scenario") == scenario)
    return latest(out) if last_only else out


def latest(records: DataFrame) -> DataFrame:
    """Most recent record of each series. A run has one record in a series, so the order is total. Ranked per task before the shuffle."""
    order = W.partitionBy(*SERIES).orderBy(F.desc("timestamp"), F.desc("run_id"))
    return records.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")


def _trend_mark(diff: Column) -> Column:
    return (F.when(diff.isNull(), F.lit("")).when(diff > 1, F.lit("(+)"))
            .when(diff < -1, F.lit("(-)")).otherwise(F.lit("(=)")))


def score_trend(records: DataFrame) -> DataFrame:
    """Last score of each series and its change from the run before.

    Only two records per series are needed, so the rank filter keeps two per task.
    """
    order = W.partitionBy(*SERIES).orderBy(F.desc("timestamp"), F.desc("run_id"))
    last_two = (records.select(*SERIES, "timestamp", "run_id", "quality_score", "validation_status")
                .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= 2))
    per_series = last_two.groupBy(*SERIES).agg(
        F.max(F.when(F.col("_n") == 1, F.col("quality_score"))).alias("last_score"),
        F.max(F.when(F.col("_n") == 2, F.col("quality_score"))).alias("previous_score"),
        F.max(F.when(F.col("_n") == 1, F.col("validation_status"))).alias("last_status"),
    )
    return per_series.withColumn("trend", _trend_mark(F.col("last_score") - F.col("previous_score")))


def score_evolution(records: DataFrame, chunk: str | None = None) -> DataFrame:
    """Every run of each series with the score before it and the trend mark.

    A series may hold most of the history, so the lookup runs over even cuts of it. A history
    that is even over time can be cut by ``chunk``, for instance "substring(timestamp, 1, 7)".
    """
    out = previous_row(records, SERIES, ["timestamp", "run_id"], {"previous_score": "quality_score"}, chunk)
    return out.withColumn("trend", _trend_mark(F.col("quality_score") - F.col("previous_score")))


def _tenths(score: str) -> Column:
    """Scores have one decimal; whole tenths add up exactly in any order."""
    return F.round(F.col(score) * 10).cast("bigint")


def _mean_of_tenths(total: Column, n: Column) -> Column:
    return F.floor(total.cast("double") / F.nullif(n, F.lit(0)) + F.lit(0.5)) / F.lit(10.0)


def run_totals(records: DataFrame) -> DataFrame:
    status = F.col("validation_status")
    return records.groupBy("run_id").agg(
        _mean_of_tenths(F.sum(_tenths("quality_score")), F.count(F.lit(1))).alias("mean_score"),
        F.count(F.lit(1)).alias("tables"),
        F.count_if(status == "DLQ").alias("dlq"),
        F.count_if(status == "WARNING").alias("warnings"),
        F.count_if(F.col("slm_status") == "SUCCESS").alias("documented"),
    )


def dashboard_totals(records: DataFrame) -> DataFrame:
    """Number of runs, number of records and mean score, from per-run partial sums."""
    per_run = records.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.sum(_tenths("quality_score")).alias("s"))
    return per_run.agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.coalesce(_mean_of_tenths(F.sum("s"), F.sum("n")), F.lit(0.0)).alias("mean_score"),
    )


def worst_exit_codes(records: DataFrame) -> DataFrame:
    return records.groupBy("run_id").agg(F.max(exit_code(F.col("validation_status"))).alias("exit_code"))


def problems(records: DataFrame) -> DataFrame:
    """Records with a failed or warning status, or with any issue or warning text."""
    return records.filter(
        F.col("validation_status").isin("DLQ", "WARNING")
        | (F.size("issues") > 0) | (F.size("warnings") > 0)
    )


def problem_lines(records: DataFrame) -> DataFrame:
    """One line per issue and warning of the problem records; draft warnings are left out."""
    shown = F.filter("warnings", lambda w: ~F.contains(w, F.lit("DRAFT")))
    lines = F.concat(
        F.transform("issues", lambda i: F.struct(F.lit("ERR").alias("severity"), i.alias("message"))),
        F.transform(shown, lambda w: F.struct(F.lit("WARN").alias("severity"), w.alias("message"))),
    )
    exploded = problems(records).select("run_id", "timestamp", *SERIES, "validation_status",
                                        F.explode_outer(lines).alias("line"))
    return exploded.select("run_id", "timestamp", *SERIES, "validation_status", "line.severity", "line.message")


def documentation_status(records: DataFrame) -> DataFrame:
    """How many series were documented, skipped or failed on their latest record."""
    state = F.col("slm_status")
    return latest(records.select(*SERIES, "timestamp", "run_id", "slm_status")).agg(
        F.count_if(state == "SUCCESS").alias("documented"),
        F.count_if(state == "SKIPPED").alias("skipped"),
        F.count_if(state == "ERROR").alias("failed"),
    )


def export_fields(records: DataFrame) -> DataFrame:
    return records.select(*EXPORT_FIELDS)


def report_lines(records: DataFrame) -> DataFrame:
    """One line of text per record: where, outcome, rows, share of nulls, duplicates and score."""
    line = F.format_string("%s/%s %s: score %s, rows %s of %s, nulls %s%%, duplicates %s",
                           F.col("table"), F.col("scenario"), F.coalesce("validation_status", F.lit("unknown")), F.col("quality_score").cast("string"),
                           F.col("rows_valid").cast("string"), F.col("rows_total").cast("string"), F.col("avg_null_pct").cast("string"), F.col("duplicate_count").cast("string"))
    return records.select("run_id", *SERIES, line.alias("line"))


def union_records(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
