"""Contract registry: contracts and their columns as two DataFrames.

``contracts`` has one row per contract, ``contract_columns`` one row per contract column.
Keeping the columns long (instead of an array per contract) lets checks on very many
contracts run as ordinary grouped jobs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakewarden.contracts import Contract

_S, _A = T.StringType(), T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


COLUMN_SCHEMA = _struct(
    name=_S, type=_S, nullable=T.BooleanType(), primary_key=T.BooleanType(), description=_S, sas_label=_S,
    regulatory_flags=_A, business_rules=_A,
)
CONTRACT_SCHEMA = _struct(
    table=_S, version=_S, description=_S, owner=_S, manifest_status=_S, validated_by=_S, validated_at=_S,
    source=_struct(system=_S, format=_S, encoding=_S, os=_S, delimiter=_S, update_frequency=_S, contact=_S),
    regulatory=_struct(tags=_A, data_classification=_S, retention_years=T.IntegerType()),
    steward=_struct(name=_S, email=_S),
    business_context=_S,
    tolerance=_struct(max_null_pct=T.DoubleType(), allow_duplicates=T.BooleanType()),
    dependencies=_A,
    sample_queries=T.ArrayType(_struct(description=_S, sql=_S)),
    schema=T.ArrayType(COLUMN_SCHEMA),
    layout=T.ArrayType(_struct(field=_S, start=T.IntegerType(), end=T.IntegerType(), dtype=_S)),
)

def _pick(raw: dict | None, schema: T.StructType) -> dict | None:
    if raw is None:
        return None
    return {f.name: None if raw.get(f.name) is None else
            (str(raw[f.name]) if isinstance(f.dataType, T.StringType) else raw[f.name]) for f in schema.fields}


def contract_row(contract: Contract) -> dict:
    """A contract as a row of the registry."""
    return {
        "table": contract.table, "version": contract.version, "description": contract.description,
        "owner": contract.owner, "manifest_status": contract.manifest_status,
        "validated_by": contract.validated_by,
        "validated_at": None if contract.validated_at is None else str(contract.validated_at),
        "source": _pick(contract.source, CONTRACT_SCHEMA["source"].dataType),
        "regulatory": _pick(contract.regulatory, CONTRACT_SCHEMA["regulatory"].dataType),
        "steward": _pick(contract.steward, CONTRACT_SCHEMA["steward"].dataType),
        "business_context": contract.business_context,
        "tolerance": {"max_null_pct": contract.max_null_pct, "allow_duplicates": contract.allow_duplicates},
        "dependencies": list(contract.dependencies),
        "sample_queries": [{"description": d, "sql": q} for d, q in contract.sample_queries],
        "schema": [{**asdict(c), "regulatory_flags": list(c.regulatory_flags),
                    "business_rules": list(c.business_rules)} for c in contract.columns],
        "layout": [_pick({"dtype": "string", **dict(f)}, CONTRACT_SCHEMA["layout"].dataType.elementType) for f in contract.layout] or None,
    }


def row_contract(row: T.Row) -> Contract:
    """A registry row as a contract."""
    return Contract.of({k: v for k, v in row.asDict(recursive=True).items() if v is not None})


def _parse_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Document text to JSON text of a registry row; Spark reads the JSON with the schema."""
    import yaml

    for batch in batches:
        errors, documents = [], []
        for text in batch["value"]:
            try:
                documents.append(json.dumps(contract_row(Contract.of(yaml.safe_load(text))), default=str))
                errors.append(None)
            except Exception as err:  # one bad document must not stop the others
                documents.append(None)
                errors.append(f"{type(err).__name__}: {err}")
        yield pd.DataFrame({"path": batch["path"], "load_error": errors, "document": documents})


def read_contract_files(spark: SparkSession, path: str) -> DataFrame:
    """Contract documents (YAML or JSON), one per file; a bad one has ``load_error`` set."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parsed = texts.mapInPandas(_parse_documents, "path string, load_error string, document string")
    return parsed.select("path", "load_error", F.from_json("document", CONTRACT_SCHEMA).alias("c")).select("path", "load_error", "c.*")


def load_contract(spark: SparkSession, path: str) -> Contract:
    row = read_contract_files(spark, path).first()
    if row is None or row["load_error"]:
        raise ValueError(f"invalid contract {path}: {row['load_error'] if row else 'no such file'}")
    return row_contract(row)


def registry_frame(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    return spark.createDataFrame([contract_row(c) for c in contracts], CONTRACT_SCHEMA)


def contract_columns(registry: DataFrame) -> DataFrame:
    """One row per contract column, in contract order."""
    exploded = registry.select("table", F.posexplode("schema").alias("pos", "c"))
    return exploded.select("table", "pos", "c.*")


def accessors(columns: DataFrame) -> DataFrame:
    """Per contract: number of columns, key, required and sensitive columns, documented columns.

    Counts only, so a contract of any width is one small group per task.
    """
    sensitive = F.coalesce(F.array_contains("regulatory_flags", "LGPD_SENSITIVE"), F.lit(False))
    return columns.groupBy("table").agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if("primary_key").alias("key_columns"),
        F.count_if(~F.col("nullable")).alias("required_columns"),
        F.count_if(sensitive).alias("sensitive_columns"),
        F.count_if(F.coalesce(F.col("description"), F.lit("")) != "").alias("documented_columns"),
    )


_REVISIONS = "revision bigint, contracts bigint"


def _revisions(spark: SparkSession, path: str) -> int | None:
    """Newest revision that was written whole; None where none was."""
    try:
        return spark.read.schema(_REVISIONS).json(f"{path.rstrip('/')}-revisions").agg(F.max("revision")).first()[0]
    except AnalysisException:
        return None


def write_registry(registry: DataFrame, path: str) -> None:
    """Store a registry as a new revision beside the earlier ones; readers take the newest.

    The frame may come from the registry read at the same path: nothing that it reads is replaced. A revision
    counts once a row beside the registry says so, so an empty one and one that was only half written are told apart.
    """
    spark = registry.sparkSession
    last = _revisions(spark, path)
    now = 0 if last is None else last + 1
    target = f"{path.rstrip('/')}/_revision={now}"
    registry.write.mode("overwrite").parquet(target)
    spark.read.schema(registry.schema).parquet(target).agg(F.lit(now).cast("bigint").alias("revision"), F.count(F.lit(1)).alias("contracts")).coalesce(1).write.mode(
        "append").json(f"{path.rstrip('/')}-revisions")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest stored registry; an empty one where none is stored."""
    last = _revisions(spark, path)
    if last is None:
        return registry_frame(spark, [])
    return spark.read.parquet(f"{path.rstrip('/')}/_revision={last}")
