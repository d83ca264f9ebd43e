"""Onboarding of landing files: each file is taken in once, and a new table gets a draft contract.

The ledger has one row per file content that was taken in, by its digest, and tells what became of it.
A file that is delivered again, under whatever name, is no work.
"""

from __future__ import annotations

import re
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.contracts import Contract
from lakewarden.operators.govern import upsert
from lakewarden.operators.infer import draft_contract, without_contract
from lakewarden.plans.layers import Lake
from lakewarden.plans.scenario import Load, run_load
from lakewarden.sources.landing import EBCDIC_WARNING, file_summaries, read_bytes
from lakewarden.sources.reader import format_of, read_load, read_table
from lakewarden.sources.records import RECORD_DDL, write_records
from lakewarden.sources.registry import read_registry, registry_frame, row_contract, write_registry
from lakewarden.sources.tabular import detect_delimiter, read_lines, sniff_csv

LEDGER_DDL = "digest string, path string, `table` string, run_id string, outcome string"
AWAITING = "AWAITING_REVIEW"


def table_of(path: str) -> str:
    """Table name behind a file name: suffix and date or number at the end removed."""
    name = re.sub(r"\.[A-Za-z0-9]+$", "", path.rstrip("/").rsplit("/", 1)[-1])
    return re.sub(r"[-_.]?\d[\d_-]*$", "", name).lower() or name.lower()


def read_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_DDL).json(lake.path("metrics") + "-ledger")
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_DDL)


def new_files(spark: SparkSession, lake: Lake, path: str) -> DataFrame:
    """(path, digest, waiting) of files whose content has no outcome in the ledger, or waits for a contract; of equal files the first by name."""
    found = read_bytes(spark, path).select("path", F.sha2("content", 256).alias("digest")).groupBy("digest").agg(F.min("path").alias("path"))
    known = read_ledger(spark, lake).groupBy("digest").agg(F.bool_and(F.col("outcome") == AWAITING).alias("waiting"))
    joined = found.join(known, "digest", "left").where(F.coalesce("waiting", F.lit(True)))
    return joined.select("path", "digest", F.col("waiting").isNotNull().alias("waiting"))


def _draft(spark: SparkSession, path: str, table: str, encoding: str) -> Contract:
    """Draft contract of a file from what it shows itself."""
    kind = format_of(path)
    if kind != "csv":
        return draft_contract(read_table(spark, path, encoding=encoding if kind == "fixed" else None), table, fmt=kind, encoding=encoding)
    sep = detect_delimiter(read_lines(spark, path, encoding)).first()["delimiter"]
    return draft_contract(sniff_csv(spark, path, encoding), table, delimiter=sep, encoding=encoding)


def _read(spark: SparkSession, path: str, contract: Contract, encoding: str) -> DataFrame:
    if encoding == "ebcdic":
        raise ValueError(EBCDIC_WARNING)
    return read_load(spark, path, contract)


def onboard(spark: SparkSession, lake: Lake, landing: str, run_id: str, timestamp: str | None = None) -> DataFrame:
    """Take in the files of a landing folder that are new; the ledger's rows of this run come back.

    A table without a contract gets a draft, inferred from the first of its files, which waits for a person: the
    file stays in landing with the outcome AWAITING_REVIEW, as does every file of a table whose contract is still a
    draft. Once the contract is VALIDATED, the next run takes them in. A file of a table with a VALIDATED contract is
    read as that says, checked, routed and recorded under the run id and its digest. All new drafts are
    stored in one revision of the registry. What reaches the driver is one row per new file and per contract in question.
    """
    registry = lake.path("contracts")
    encodings = file_summaries(spark, landing).select("path", "encoding")
    found = new_files(spark, lake, landing).join(encodings, "path", "left").collect()
    files = sorted((r["path"], r["digest"], r["waiting"], r["encoding"] or "utf-8") for r in found)
    if not files:
        return spark.createDataFrame([], LEDGER_DDL)
    names = spark.createDataFrame([(t,) for t in sorted({table_of(f[0]) for f in files})], "`table` string")
    stored = read_registry(spark, registry)
    missing = {r["table"] for r in without_contract(names, stored).collect()}
    known = {r["table"]: row_contract(r) for r in stored.join(names, "table", "left_semi").collect()}
    drafts, rows, records = {}, [], []
    for path, digest, waiting, encoding in files:
        table = table_of(path)
        contract = known.get(table)
        if contract is None or not contract.is_validated():
            if table in missing and table not in drafts and encoding != "ebcdic":
                drafts[table] = _draft(spark, path, table, encoding)
            if not waiting:
                rows.append((digest, path, table, run_id, AWAITING))
            continue
        load = Load(table, lambda s, p=path, c=contract, e=encoding: _read(s, p, c, e), contract, format_of(path))
        done = run_load(spark, lake, load, f"{run_id}-{digest[:12]}", timestamp=timestamp)
        records.append(done.record)
        rows.append((digest, path, table, run_id, done.record["validation_status"]))
    if drafts:
        width = F.size("schema")
        incoming = registry_frame(spark, list(drafts.values())).withColumn("column_count", width)
        write_registry(upsert(stored.withColumn("column_count", width), incoming).drop("column_count"), registry)
    if records:
        write_records(spark.createDataFrame(records, RECORD_DDL), lake.path("metrics"))
    out = spark.createDataFrame(rows, LEDGER_DDL)
    done = [r for r in rows if r[4] != "ERROR"]  # what failed by an error of the run is tried again
    if done:
        # Last of all, so that a run that broke off is taken up again.
        spark.createDataFrame(done, LEDGER_DDL).coalesce(1).write.mode("append").json(lake.path("metrics") + "-ledger")
    return out
