"""Lake layers as path prefixes, and the routing of loads between them."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, functions as F

LAYERS = ("bronze", "silver", "gold", "quarantine", "contracts", "metrics", "reports")
COMMITS = "commits"
VERSION, EMPTY = "version", "none"
COMMIT_DDL = "`table` string, run_id string, scenario string, format string, at bigint, silver string, quarantine string"


@dataclass(frozen=True)
class Lake:
    """Any URI Spark can write to."""

    root: str

    def path(self, layer: str, table: str = "", run_id: str | None = None, scenario: str | None = None,
             fmt: str | None = None) -> str:
        """Folder of a layer, of a table in it, or of one load of that table.

        A load is told apart by run, scenario and format, so no two loads of a run share a folder.
        """
        if layer not in (*LAYERS, COMMITS):
            raise ValueError(f"unknown layer '{layer}', available: {', '.join(LAYERS)}")
        keys = (("run_id", run_id), ("scenario", scenario), ("format", fmt))
        return "/".join([self.root.rstrip("/"), layer, *filter(None, [table]), *(f"{k}={quote(v, safe='')}" for k, v in keys if v)])


@dataclass(frozen=True)
class LoadKey:
    """What tells one load of a lake from all others."""

    table: str
    run_id: str
    scenario: str = "baseline"
    fmt: str = "csv"

    def path(self, lake: Lake, layer: str) -> str:
        return lake.path(layer, self.table, self.run_id, self.scenario, self.fmt)


def stage(df: DataFrame, lake: Lake, key: LoadKey) -> DataFrame:
    """Parse a landing file once into columnar bronze, and go on from there.

    The checks, the profile and the routing then read only the columns they need, and a lost
    executor re-reads the stage instead of parsing the landing file again.
    """
    path = key.path(lake, "bronze")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _leave_only(spark, path: str, version: str | None) -> None:
    """Delete what a load's folder holds beside one version; nothing happens where there is no folder."""
    fs, at = _folder(spark, path)
    for child in fs.listStatus(at) if fs.exists(at) else []:
        if child.getPath().getName() != f"{VERSION}={version}":
            fs.delete(child.getPath(), True)


def _commit(spark, lake: Lake, key: LoadKey, versions: dict[str, str]) -> None:
    """One row that says where a load is from now on.

    It is one file in a folder of its own, so it is there whole or not at all, and loads that commit side by side do
    not meet.
    """
    row = (key.table, key.run_id, key.scenario, key.fmt, time.time_ns(), versions.get("silver"), versions.get("quarantine"))
    spark.createDataFrame([row], COMMIT_DDL).coalesce(1).write.json(f"{lake.path(COMMITS, key.table)}/{uuid.uuid4().hex}")


def _write_routes(lake: Lake, key: LoadKey, frames: dict[str, DataFrame]) -> dict[str, str]:
    """Write a load's rows to one layer or both: new versions first, then the commit, then earlier versions go.

    A crash in between leaves the load where the last commit says; read_route() and the next run see that.
    """
    spark = next(iter(frames.values())).sparkSession
    versions = {layer: uuid.uuid4().hex[:12] for layer in frames}
    for layer, df in frames.items():
        df.write.parquet(f"{key.path(lake, layer)}/{VERSION}={versions[layer]}")
    _commit(spark, lake, key, versions)
    for layer in ("silver", "quarantine"):
        folder, version = key.path(lake, layer), versions.get(layer)
        fs, at = _folder(spark, folder)
        if version is None and fs.exists(at):  # a folder that was left stays readable
            version = EMPTY
            next(iter(frames.values())).limit(0).write.mode("overwrite").parquet(f"{folder}/{VERSION}={EMPTY}")
        _leave_only(spark, folder, version)
    return {layer: f"{key.path(lake, layer)}/{VERSION}={v}" for layer, v in versions.items()}


def read_route(spark, lake: Lake, layer: str, table: str) -> DataFrame:
    """Rows of a table in silver or quarantine as last committed, with run_id, scenario and format, whatever else its folder holds."""
    by = ["run_id", "scenario", "format"]
    log = spark.read.schema(COMMIT_DDL).option("recursiveFileLookup", True).json(lake.path(COMMITS, table))
    newest = log.groupBy(*by).agg(F.max_by(layer, "at").alias("_version")).where(F.col("_version").isNotNull())
    rows = spark.read.parquet(lake.path(layer, table))
    # Names of folders may look like numbers; versions are told by the files' paths and the rest by the commit.
    told = rows.withColumn("_version", F.regexp_extract(F.col("_metadata.file_path"), f"/{VERSION}=([^/]*)/", 1)).drop(*by, VERSION)
    return told.join(newest, "_version").drop("_version")


def promote_load(df: DataFrame, lake: Lake, key: LoadKey) -> str:
    """Passing load to silver, replacing what that load had there or in quarantine."""
    return _write_routes(lake, key, {"silver": df})["silver"]


def quarantine_load(df: DataFrame, lake: Lake, key: LoadKey, issues: list[str]) -> str:
    """Whole load to quarantine with the reasons; bronze keeps its copy, silver loses an earlier one."""
    marked = df.withColumns({"_status": F.lit("DLQ"), "_issues": F.array(*[F.lit(i) for i in issues])})
    return _write_routes(lake, key, {"quarantine": marked})["quarantine"]


def route_rows(rows: DataFrame, lake: Lake, key: LoadKey) -> None:
    """Rows with a ``_status`` and ``_issues``: those of failed files to quarantine, the others to silver, in one commit."""
    failed = F.col("_status") == "DLQ"
    _write_routes(lake, key, {"silver": rows.where(~failed).drop("_status", "_issues"), "quarantine": rows.where(failed)})
