"""Run the analytical queries kept in contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakewarden.contracts import Contract


def run_stored_queries(contract: Contract, df: DataFrame) -> dict[str, DataFrame]:
    """Every stored query of a contract against its table, lazily, by description."""
    df.createOrReplaceTempView(contract.table)
    return {description or sql: df.sparkSession.sql(sql) for description, sql in contract.sample_queries}
