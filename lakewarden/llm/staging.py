"""Cutting lineage with tables in the shared folder, so that lost executors cost only a re-read."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="llm-")
    return _LOCAL[app]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors where their Python path does not lead to it already."""
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if str(root) in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] or app in _SHIPPED:
        return
    _SHIPPED.add(app)
    target = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "lakewarden.zip")  # the driver's own; Spark serves it
    with zipfile.ZipFile(target, "w") as z:
        for p in (root / "lakewarden").rglob("*.py"):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(target)


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write the frame as Parquet to a new folder of the shared place; the frame read back, and its folder.

    Shuffle files of what led to it are of no use then; Spark drops them when the driver's JVM has
    collected their last reference, which is asked for here rather than awaited.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), "staged", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame, written as Parquet to a new folder of the shared place and read back."""
    return staged_at(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no frame in use reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*columns) if columns else df


def whole_text(column: str = "text"):
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))
