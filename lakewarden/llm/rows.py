"""Documents by rows: ids that are null or repeated do not merge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.order import running_total
from lakewarden.llm.staging import staged


def rows_apart(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Docs with their doc_id as ``_given_id`` and a doc_id that is unique, not null and in the order of doc_id (null last), then of rows.

    Where doc_id is so already, it stays, and the second value is False.
    """
    shared = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if shared.isEmpty():
        return docs.withColumn("_given_id", F.col("doc_id")), False
    rows = staged(docs.withColumnRenamed("doc_id", "_given_id").withColumn("_place", F.monotonically_increasing_id()), "rows")
    numbers = running_total(rows.select("_given_id", "_place", F.lit(1).alias("_one")), "_given_id", "_one", "doc_id", ("_place",), nulls_last=True)
    return staged(rows.join(numbers.select("_place", F.col("doc_id").cast("long")), "_place").drop("_place"), "rows"), True
