"""Review of contracts: pending items, promotion, protected updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakewarden.contracts import VERSION_PATTERN
from lakewarden.functions.codes import catalog_key, catalog_type, clean_format
from lakewarden.functions.flags import regulatory_flags
from lakewarden.functions.naming import snake_case
from lakewarden.functions.text import TODO_MARKER, has_todo, is_unfilled

ROOT_FIELDS = ["description", "owner", "business_context"]
SOURCE_FIELDS = ["system", "os", "update_frequency", "contact"]
STEWARD_FIELDS = ["name", "email"]


def _found(condition: Column, name: Column | str, issue: str) -> Column:
    field = F.lit(name) if isinstance(name, str) else name
    return F.when(condition, F.struct(field.alias("field"), F.lit(issue).alias("issue")))


def pending_items(contracts: DataFrame, columns: DataFrame) -> DataFrame:
    """(table, field, issue) of everything that still blocks a promotion. No shuffle."""
    tags = F.col("regulatory.tags")
    root = [_found(is_unfilled(F.col(f)), f, "empty or marked as to do") for f in ROOT_FIELDS]
    root += [_found(has_todo(F.col(f"source.{f}")), f"source.{f}", "marked as to do") for f in SOURCE_FIELDS]
    root += [_found(is_unfilled(F.col(f"steward.{f}")), f"steward.{f}", "empty or marked as to do") for f in STEWARD_FIELDS]
    no_tags = F.coalesce(F.size(tags) == 0, F.lit(True)) | F.coalesce(
        F.exists(tags, lambda t: F.contains(t, F.lit(TODO_MARKER))), F.lit(False))
    root.append(_found(no_tags, "regulatory.tags", "tags not reviewed"))
    of_contract = contracts.select("table", F.inline(F.array(*root))).filter(F.col("field").isNotNull())
    of_columns = columns.filter(is_unfilled(F.col("description"))).select(
        "table",
        F.concat(F.lit("schema["), F.coalesce(F.col("name"), F.lit("?")), F.lit("].description")).alias("field"),
        F.lit("empty or marked as to do").alias("issue"),
    )
    return of_contract.unionByName(of_columns)


def review_warnings(contracts: DataFrame, columns: DataFrame) -> DataFrame:
    """(table, warning): worth fixing, but not blocking."""
    no_rules = columns.filter(F.coalesce(F.size("business_rules"), F.lit(0)) <= 0).select(
        "table", F.concat(F.lit("schema["), F.coalesce(F.col("name"), F.lit("?")),
                          F.lit("].business_rules is empty")).alias("warning"))
    no_queries = contracts.filter(F.coalesce(F.size("sample_queries"), F.lit(0)) <= 0).select(
        "table", F.lit("sample_queries is empty").alias("warning"))
    return no_rules.unionByName(no_queries)


def readiness(contracts: DataFrame, columns: DataFrame) -> DataFrame:
    """(table, pending, ready). Pending items are counted per task before the join."""
    counted = pending_items(contracts, columns).groupBy("table").agg(F.count(F.lit(1)).alias("pending"))
    joined = contracts.select("table").join(counted, "table", "left")
    pending = F.coalesce(F.col("pending"), F.lit(0))
    return joined.select("table", pending.alias("pending"), (pending == 0).alias("ready"))


def promote(contracts: DataFrame, columns: DataFrame, steward: str, at: str) -> DataFrame:
    """Contracts with nothing pending become VALIDATED by ``steward`` at ``at``; the rest stay."""
    counted = pending_items(contracts, columns).groupBy("table").agg(F.count(F.lit(1)).alias("_pending"))
    ready = F.col("_pending").isNull()
    joined = contracts.join(counted, "table", "left")
    changed = {
        "manifest_status": F.when(ready, F.lit("VALIDATED")).otherwise(F.col("manifest_status")),
        "validated_by": F.when(ready, F.lit(steward)).otherwise(F.col("validated_by")),
        "validated_at": F.when(ready, F.lit(at)).otherwise(F.col("validated_at")),
    }
    return joined.withColumns(changed).select(*contracts.columns)


def upsert_actions(registry: DataFrame, incoming: DataFrame, overwrite: bool = False,
                   width: str = "column_count") -> DataFrame:
    """What happens to each incoming contract: created, replaced, kept, drafted beside, superseded or rejected.

    ``incoming`` needs (table, version, <width> = number of columns). Of several complete contracts for
    one table the highest version counts, the others are superseded. A VALIDATED contract is never
    replaced, neither is a VALIDATED '<table>_draft': the successor of the former is stored as
    '<table>_draft', that of the latter is kept out.
    """
    status = registry.groupBy("table").agg(F.max(F.coalesce("manifest_status", F.lit("DRAFT"))).alias("_status"))
    current = status.select("table", F.col("_status").alias("current_status"))
    drafts = status.select(F.col("table").alias("_draft"), F.col("_status").alias("draft_status"))
    complete = (F.coalesce(F.col("table"), F.lit("")) != "") & F.col("version").isNotNull() & (F.coalesce(F.col(width), F.lit(0)) > 0)
    ordered = W.partitionBy("table").orderBy(F.col("_complete").desc(), F.transform(F.split("version", r"\."), lambda v: v.try_cast("int")).desc_nulls_last(), F.xxhash64(*incoming.columns))
    ranked = incoming.withColumn("_complete", complete).withColumn("_place", F.row_number().over(ordered))
    joined = ranked.join(current, "table", "left").join(drafts, F.concat("table", F.lit("_draft")) == F.col("_draft"), "left")
    action = (F.when(~F.col("_complete"), F.lit("rejected"))
              .when(F.col("_place") > 1, F.lit("superseded"))
              .when((F.col("current_status") == "VALIDATED") & F.coalesce(F.col("draft_status") == "VALIDATED", F.lit(False)), F.lit("kept"))
              .when(F.col("current_status") == "VALIDATED", F.lit("drafted"))
              .when(F.col("current_status").isNull(), F.lit("created"))
              .when(F.lit(overwrite), F.lit("replaced"))
              .otherwise(F.lit("kept")))
    target = F.when(action == "drafted", F.concat("table", F.lit("_draft"))).otherwise(F.col("table"))
    return joined.withColumns({"action": action, "target": target}).drop("current_status", "draft_status", "_draft", "_complete", "_place")


def upsert(registry: DataFrame, incoming: DataFrame, overwrite: bool = False, width: str = "column_count") -> DataFrame:
    """The registry after an upsert, with the same columns; ``incoming`` needs them too."""
    decided = upsert_actions(registry, incoming, overwrite, width)
    stored = decided.filter(F.col("action").isin("created", "replaced", "drafted"))
    kept = registry.join(stored.select(F.col("target").alias("table")), "table", "left_anti")
    added = stored.withColumn("table", F.col("target")).select(*registry.columns)
    return kept.select(*registry.columns).unionByName(added)


def version_is_valid(version: Column) -> Column:
    return F.coalesce(version.rlike(VERSION_PATTERN), F.lit(False))


def invalid_contracts(contracts: DataFrame) -> DataFrame:
    """(table, issue) of contracts that cannot be used for validation."""
    bad = (F.when(F.coalesce(F.col("table"), F.lit("")) == "", F.lit("table name missing"))
           .when(~version_is_valid(F.col("version")), F.lit("version is not three numbers")))
    return contracts.select("table", bad.alias("issue")).filter(F.col("issue").isNotNull())


def draft_notice(contracts: DataFrame) -> DataFrame:
    """Contracts that have not been validated; their loads carry a warning but keep their status."""
    return contracts.filter(F.coalesce("manifest_status", F.lit("DRAFT")) != "VALIDATED").select("table")


def catalog_columns(catalog: DataFrame, fix_datetime: bool = False) -> DataFrame:
    """Draft contract columns from a column catalog (table, pos, name, label, format, storage)."""
    # Name and format are cleaned in a step of their own: they feed several outputs each.
    named = catalog.withColumns({"name": snake_case(F.col("name")), "_clean": clean_format(F.col("format"))}).withColumn(
        "primary_key", catalog_key(F.col("pos"), F.col("name")))
    return named.select(
        "table", "pos", "name",
        catalog_type(F.col("_clean"), F.col("storage"), fix_datetime).alias("type"),
        (~F.col("primary_key")).alias("nullable"),
        "primary_key",
        F.coalesce(F.nullif("label", F.lit("")), F.concat(F.lit(f"{TODO_MARKER}: describe "), "name")).alias("description"),
        F.nullif("label", F.lit("")).alias("sas_label"),
        regulatory_flags(F.col("name"), F.col("label")).alias("regulatory_flags"),
        F.array().cast("array<string>").alias("business_rules"),
    )
