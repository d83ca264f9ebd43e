"""Files that land together, each judged by its own header, routed and recorded by itself."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from lakewarden.contracts import Contract
from lakewarden.operators.checks import validate_files
from lakewarden.operators.score import file_records
from lakewarden.plans.layers import Lake, LoadKey, route_rows, stage
from lakewarden.sources.arrivals import FILE, headers, placed, records
from lakewarden.sources.records import write_records


def run_files(lines: DataFrame, lake: Lake, key: LoadKey, contract: Contract, timestamp: str, sep: str | None = None) -> DataFrame:
    """Judge, route and record the files of some lines (from file_lines); the result row of each file comes back.

    Bronze keeps the raw lines with their file. Rows of accepted files go to silver with the contract's
    columns by name and other columns in ``_extra``; rows of rejected files go to quarantine with the reasons.
    Headers and results are tables beside them, one row per file; nothing of a file passes the driver.
    """
    sep = sep or (contract.source or {}).get("delimiter") or ","
    kept = stage(placed(lines), lake, key)
    heads = stage(headers(kept, sep), lake, replace(key, table=f"{key.table}__headers"))
    rows = records(kept, heads, contract.column_names(), sep)
    results = stage(validate_files(rows, heads, contract, key.scenario), lake, replace(key, table=f"{key.table}__files"))
    route_rows(rows.join(results.select(FILE, F.col("status").alias("_status"), F.col("issues").alias("_issues")), FILE), lake, key)
    write_records(file_records(results, key.run_id, timestamp, key.fmt), lake.path("metrics"))
    return results
