"""Quality score and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakewarden.functions.numeric import round_sql
from lakewarden.functions.sqltext import literal

RECORD_FIELDS = [
    "run_id", "timestamp", "table", "scenario", "format", "validation_status", "evolution_type",
    "rows_total", "rows_valid", "duplicate_count", "null_violations", "avg_null_pct", "profiling_ms",
    "slm_status", "slm_inference_ms", "quality_score", "issues", "warnings",
]


def quality_score_sql(status: str, mean_null_pct: str, rows: str, dups: str, evolution: str) -> str:
    """0 to 100: 40 for status, 30 for nulls, 20 for duplicates, 10 for an unchanged schema.

    ``mean_null_pct`` is NULL when there is no profile, which earns nothing.
    """
    for_status = f"case {status} when 'PASS' then 40.0D when 'WARNING' then 25.0D else 0.0D end"
    for_nulls = f"if({mean_null_pct} is null, 0.0D, greatest(0.0D, 30.0D - {mean_null_pct}))"
    dup_pct = f"cast({dups} as double) / cast(greatest({rows}, 1) as double) * 100.0D"
    for_dups = f"greatest(0.0D, 20.0D - {dup_pct} * 10.0D)"
    for_schema = f"if({evolution} is null, 10.0D, 0.0D)"
    return round_sql(f"least({for_status} + {for_nulls} + {for_dups} + {for_schema}, 100.0D)", 1)


def mean_nulls(profiled: DataFrame, by: list[str]) -> DataFrame:
    """Mean of the column null percentages: one row per table.

    Percentages have two decimals; whole hundredths add up exactly in any order.
    """
    return profiled.groupBy(*by).agg(F.expr(
        "cast(sum(cast(round(null_pct * 100) as bigint)) as double) / count(null_pct) / 100.0D as mean_null_pct"))


def run_records(run_id: str, timestamp: str, results: DataFrame, profiled: DataFrame,
                documented: DataFrame | None = None, fmt: str = "csv", profiling_ms: float = 0.0) -> DataFrame:
    """One record per validation result.

    ``profiled`` holds (table, scenario, null_pct) of all profiled columns and ``documented``
    optionally (table, scenario, slm_status, slm_inference_ms). All sides have one row per
    table run, or are reduced to that before the join.
    """
    key = ["table", "scenario"]
    joined = results.join(mean_nulls(profiled, key), key, "left")
    if documented is not None:
        joined = joined.join(documented.select(*key, "slm_status", "slm_inference_ms"), key, "left")
    return _records(joined, literal(run_id), timestamp, fmt, profiling_ms, documented is not None)


def file_records(results: DataFrame, run_id: str, timestamp: str, fmt: str = "csv") -> DataFrame:
    """One record per file of validate_files(); its run id is the given one and a digest of the file's path.

    A file that failed is not profiled, so its nulls earn nothing.
    """
    hundredths = "aggregate(null_pcts, 0L, (s, p) -> s + cast(round(p * 100) as bigint))"
    scored = results.withColumn("mean_null_pct", F.expr(
        f"if(status = 'DLQ' or size(null_pcts) = 0, null, cast({hundredths} as double) / size(null_pcts) / 100.0D)"))
    return _records(scored, f"concat({literal(run_id)}, '-', substring(sha2(_file, 256), 1, 12))", timestamp, fmt, 0.0, False)


def _records(joined: DataFrame, run_id: str, timestamp: str, fmt: str, profiling_ms: float, slm: bool) -> DataFrame:
    score = quality_score_sql("status", "mean_null_pct", "rows_total", "duplicate_count", "evolution_type")
    return joined.selectExpr(
        f"{run_id} as run_id",
        f"{literal(timestamp)} as timestamp",
        "`table`", "scenario",
        f"{literal(fmt)} as format",
        "status as validation_status", "evolution_type", "rows_total", "rows_valid", "duplicate_count", "null_violations",
        f"coalesce({round_sql('mean_null_pct', 2)}, 0.0D) as avg_null_pct",
        f"{float(profiling_ms)}D as profiling_ms",
        f"coalesce({'slm_status' if slm else 'null'}, 'SKIPPED') as slm_status",
        f"coalesce({'slm_inference_ms' if slm else 'null'}, 0.0D) as slm_inference_ms",
        f"{score} as quality_score",
        "issues", "warnings",
    )
