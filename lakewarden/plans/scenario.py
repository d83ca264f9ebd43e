"""Run a set of tables through landing, checks, profile, routing and recording."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.contracts import Contract
from lakewarden.functions.codes import EXIT_CODES
from lakewarden.operators.checks import rejected, schema_evolution, validate, validate_with_facts
from lakewarden.operators.profile import FACTS_DDL, column_facts, documentation_summary, profile_with_top
from lakewarden.operators.score import run_records
from lakewarden.plans.layers import Lake, LoadKey, promote_load, quarantine_load, stage
from lakewarden.sources.records import RECORD_DDL, read_records, write_records


@dataclass(frozen=True)
class Load:
    """One table of a run: how to read it and what it must look like."""

    table: str
    read: Callable[[SparkSession], DataFrame]
    contract: Contract | Callable[[], Contract]
    fmt: str = "csv"


@dataclass
class Outcome:
    record: dict
    path: str | None = None
    profile: list = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return EXIT_CODES.get(self.record["validation_status"], 1)


def _profile_rows(spark: SparkSession, table: str, scenario: str, facts: list) -> DataFrame:
    rows = [(table, scenario, r["null_pct"]) for r in facts]
    return spark.createDataFrame(rows, "`table` string, scenario string, null_pct double")


def check_and_route(spark: SparkSession, lake: Lake, key: LoadKey, df: DataFrame, contract: Contract) -> tuple:
    """(result row, column facts, path, profiling ms) of a staged load; facts are empty for a rejected one."""
    facts, elapsed = [], 0.0
    if schema_evolution(contract, df.columns).breaking:
        row = validate(df, contract, key.scenario).first()
    else:
        started = time.perf_counter()
        facts = column_facts(df).collect()
        elapsed = round((time.perf_counter() - started) * 1000, 1)
        row = validate_with_facts(df, spark.createDataFrame(facts, FACTS_DDL), contract, key.scenario).first()
    if row["status"] == "DLQ":
        return row, [], quarantine_load(df, lake, key, row["issues"]), 0.0
    return row, facts, promote_load(df, lake, key), elapsed


def record_of(spark: SparkSession, key: LoadKey, timestamp: str, result: DataFrame, facts: list, elapsed: float) -> DataFrame:
    profiled = _profile_rows(spark, key.table, key.scenario, facts)
    return run_records(key.run_id, timestamp, result, profiled, fmt=key.fmt, profiling_ms=elapsed)


def run_load(spark: SparkSession, lake: Lake, load: Load, run_id: str, scenario: str = "baseline",
             timestamp: str | None = None) -> Outcome:
    """Validate, profile, route and record one load.

    A load that fails is quarantined and neither profiled nor promoted. A contract that is none and data that
    cannot be read are the load's own result: DLQ with the error as its issue. Any other error, such as a lost
    cluster or a full disk, says nothing about the load and is recorded as ERROR. What reaches the
    driver is one result row and one row per column.
    """
    timestamp = timestamp or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    key = LoadKey(load.table, run_id, scenario, load.fmt)
    facts, path, elapsed = [], None, 0.0
    step = "Invalid contract"
    try:
        contract = load.contract() if callable(load.contract) else load.contract
        step = "Unreadable data"
        df = stage(load.read(spark), lake, key)
        step = "Failed load"
        row, facts, path, elapsed = check_and_route(spark, lake, key, df, contract)
        result = spark.createDataFrame([row], validate_schema())
    except Exception as err:
        facts, path, elapsed = [], None, 0.0
        result = rejected(spark, load.table, f"{step}: {err}", scenario, "ERROR" if step == "Failed load" else "DLQ")
    record = record_of(spark, key, timestamp, result, facts, elapsed).first()
    return Outcome(record.asDict(recursive=True), path, facts)


def validate_schema() -> str:
    return ("`table` string, scenario string, status string, evolution_type string, issues array<string>, "
            "warnings array<string>, rows_total bigint, rows_valid bigint, null_violations map<string,double>, "
            "duplicate_count bigint")


def run_scenario(spark: SparkSession, lake: Lake, loads: list[Load], run_id: str, scenario: str = "baseline",
                 timestamp: str | None = None, parallel: int = 4) -> list[Outcome]:
    """All loads of a scenario; one failing load does not stop the others.

    Loads are submitted side by side so that a small table does not leave the cluster idle. Scenarios
    and formats of one run share its run id and keep apart by their own keys.
    """
    keys = [(one.table, one.fmt) for one in loads]
    if len(set(keys)) < len(keys):
        raise ValueError("a table is loaded twice in the same format")
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        outcomes = list(pool.map(lambda one: run_load(spark, lake, one, run_id, scenario, timestamp), loads))
    if outcomes:
        write_records(spark.createDataFrame([o.record for o in outcomes], RECORD_DDL), lake.path("metrics"))
    return outcomes


def run_matrix(spark: SparkSession, lake: Lake, scenarios: dict[str, list[Load]], run_id: str,
               timestamp: str | None = None, parallel: int = 4) -> list[Outcome]:
    """One run over scenarios, each with its loads in any formats, under one run id."""
    return [o for name, loads in scenarios.items() for o in run_scenario(spark, lake, loads, run_id, name, timestamp, parallel)]


def run_exit_code(outcomes: list[Outcome]) -> int:
    return max((o.exit_code for o in outcomes), default=0)


def consolidated(spark: SparkSession, lake: Lake, run_id: str) -> DataFrame:
    """All records of a run: read back from the one metrics table, no second copy."""
    return read_records(spark, lake.path("metrics")).filter(F.col("run_id") == run_id)


def document_load(df: DataFrame) -> DataFrame:
    """Summary per column for a documentation step."""
    return documentation_summary(profile_with_top(df))
