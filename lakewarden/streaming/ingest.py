"""Incremental validated ingest of landing files."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from lakewarden.contracts import Contract
from lakewarden.plans.files import run_files
from lakewarden.plans.layers import Lake, LoadKey, stage
from lakewarden.plans.scenario import check_and_route, record_of, validate_schema
from lakewarden.sources.arrivals import FILE, file_lines
from lakewarden.sources.records import write_records


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def landing_stream(spark: SparkSession, path: str, columns: list[str] | T.StructType | None = None, fmt: str = "csv",
                   max_files: int | None = None, encoding: str | None = None, **options) -> DataFrame:
    """Files as they arrive: CSV as lines with their file, JSON Lines as strings, Parquet with its own schema.

    A CSV file says itself which columns it has, so none are given for it.
    """
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    if fmt == "csv":
        return file_lines(spark, path, encoding, stream=True, **options)
    schema = columns if isinstance(columns, T.StructType) else text_schema(columns or [])
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of a stream, kept beside its checkpoint, so that another checkpoint is another stream."""
    path = f"{checkpoint.rstrip('/')}-stream-id"
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException:
        found = uuid.uuid4().hex[:12]
        spark.createDataFrame([(found,)], "value string").coalesce(1).write.text(path)
        return found


def ingest(stream: DataFrame, contract: Contract, lake: Lake, checkpoint: str, scenario: str = "baseline",
           timestamp: str | None = None, fmt: str = "csv", sep: str | None = None) -> StreamingQuery:
    """Validate what each micro-batch brings, route it, and record it.

    CSV lines are judged file by file, each by its own header; other formats are one load per batch. The run
    id is the stream's id and the batch's number (and the file's), and every write replaces its own folder,
    so a batch that is replayed after a failure leaves no second copy and no two streams meet. Duplicate
    keys are looked for inside a file, or inside a batch where that is the load.
    """
    name = stream_id(stream.sparkSession, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = LoadKey(contract.table, f"{name}-{batch_id:08d}", scenario, fmt)
        at = timestamp or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        if FILE in batch.columns:
            run_files(batch, lake, key, contract, at, sep)
            return
        load = stage(batch, lake, key)
        row, facts, _, elapsed = check_and_route(spark, lake, key, load, contract)
        result = spark.createDataFrame([row], validate_schema())
        write_records(record_of(spark, key, at, result, facts, elapsed), lake.path("metrics"))

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
