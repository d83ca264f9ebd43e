"""Validate a load against its contract.

Two passes over pruned columns: counters for required and key columns need no shuffle, and
the duplicate count shuffles nothing but the key. They meet as one row. When a profile is
wanted too, checks read the counters from its facts and only a composite key is scanned again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from lakewarden.contracts import Contract
from lakewarden.functions.coercion import fits_type_sql
from lakewarden.functions.numeric import percent_sql
from lakewarden.functions.sqltext import ident, literal, literals
from lakewarden.functions.text import is_blank_sql
from lakewarden.operators.values import text_sql

EXTRA_WARNING = "New columns detected (non-breaking)"
REQUIRED_ISSUE, KEY_ISSUE = "Required columns missing", "Primary key missing"
DRAFT_WARNING = "Contract is in DRAFT status: it has not been validated by a data steward"


@dataclass(frozen=True)
class Evolution:
    """What the column names alone say; data-driven key checks come on top."""

    issues: tuple[str, ...]
    missing: tuple[str, ...]
    extra: tuple[str, ...]

    @property
    def breaking(self) -> bool:
        return bool(self.issues)


def schema_evolution(contract: Contract, columns: list[str]) -> Evolution:
    present = set(columns)
    declared = set(contract.column_names())
    missing = tuple(c for c in contract.column_names() if c not in present)
    extra = tuple(sorted(present - declared))
    required = [c for c in contract.required() if c in missing]
    keys = [c for c in contract.primary_keys() if c in missing]
    if required:
        issues = (f"{REQUIRED_ISSUE}: {', '.join(required)}",)
    elif keys:
        issues = (f"{KEY_ISSUE}: {', '.join(keys)}",)
    else:
        issues = ()
    return Evolution(issues, missing, extra)


def schema_diff(declared: DataFrame, observed: DataFrame, name: str = "name") -> DataFrame:
    """Declared against observed column frames, one row per column with where it was seen.

    ``declared`` has (name, nullable, primary_key) of one contract, ``observed`` has (name).
    """
    seen = observed.groupBy(name).agg(F.count(F.lit(1)).alias("occurrences"))
    both = declared.join(seen, name, "full_outer")
    return both.select(
        name,
        F.when(F.col("nullable").isNull(), F.lit("extra"))
        .when(F.col("occurrences").isNull() & ~F.col("nullable"), F.lit("missing_required"))
        .when(F.col("occurrences").isNull() & F.col("primary_key"), F.lit("missing_key"))
        .when(F.col("occurrences").isNull(), F.lit("missing_optional"))
        .otherwise(F.lit("present")).alias("state"),
        F.coalesce(F.col("occurrences"), F.lit(0)).cast("bigint").alias("occurrences"),
    )


def duplicate_counts(df: DataFrame, key: list[str]) -> DataFrame:
    """rows_total and duplicate_count: rows beyond the first of each key, NULL keys equal.

    Grouping by the key itself pre-aggregates per task, so a key that repeats in a third of
    the rows costs one shuffled row per task.
    """
    per_key = df.groupBy(*[ident(c) for c in key]).agg(F.expr("count(1) as n"))
    return per_key.agg(F.expr("coalesce(sum(n), 0L) as rows_total"),
                       F.expr("coalesce(sum(n - 1), 0L) as duplicate_count"))


def drop_duplicates(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """First row of each key by an explicit order.

    The rank filter is applied per task before the shuffle (group limit), so repeats of a hot
    key never travel to one place.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def null_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, null_pct, null_count) of required columns that hold NULLs. No shuffle of data."""
    names = [c for c in contract.required() if c in df.columns]
    counted = df.agg(F.expr("count(1) as n"),
                     F.expr(f"array({', '.join(f'count_if({ident(c)} is null)' for c in names)}) as miss"))
    pairs = counted.selectExpr(
        "n", f"inline(transform({literals(names)}, (c, i) -> named_struct('column_name', c, 'null_count', miss[i])))")
    return (pairs.filter("null_count > 0")
            .selectExpr("column_name", f"{percent_sql('null_count', 'n')} as null_pct", "null_count"))


def _misfit_sql(df: DataFrame, name: str, contract_type: str) -> str:
    """Key value that cannot be read as its declared type; free when the column already has it."""
    dtype = df.schema[name].dataType
    native = {"integer": T.IntegralType, "float": T.NumericType, "boolean": T.BooleanType}.get(contract_type)
    if native is not None and isinstance(dtype, native):
        return "false"
    return f"not {fits_type_sql(text_sql(df, name), contract_type)}"


def _in_load(contract: Contract, columns: list[str]) -> tuple[list[str], list[str]]:
    return ([c for c in contract.required() if c in columns], [c for c in contract.primary_keys() if c in columns])


def _sum_up(frames: list[DataFrame], required: int, keys: int) -> DataFrame:
    """Add one-row counter frames: rows_total, duplicate_count, miss and bad arrays."""
    both = reduce(DataFrame.unionByName, frames)

    def each(name: str, n: int) -> str:
        return f"cast(array({', '.join(f'sum({name}[{i}])' for i in range(n))}) as array<bigint>) as {name}"

    return both.agg(*[F.expr(e) for e in (
        "sum(rows_total) as rows_total", "sum(duplicate_count) as duplicate_count",
        each("miss", required), each("bad", keys))])


def _zeros(n: int) -> str:
    return f"array_repeat(0L, {n})"


def _duplicate_frame(df: DataFrame, keys: list[str], required: int) -> DataFrame:
    return duplicate_counts(df, keys).selectExpr(
        "0L as rows_total", "duplicate_count", f"{_zeros(required)} as miss", f"{_zeros(len(keys))} as bad")


def _counters(df: DataFrame, contract: Contract) -> DataFrame:
    """One row of counters: a pass without shuffle, plus the key's own shuffle."""
    required, keys = _in_load(contract, df.columns)
    types = contract.types()
    miss = ", ".join(f"count_if({ident(c)} is null)" for c in required)
    bad = ", ".join(f"count_if({_misfit_sql(df, c, types[c])})" for c in keys)
    passed = df.agg(*[F.expr(e) for e in (
        "count(1) as rows_total", "sum(0L) as duplicate_count",
        f"cast(array({miss}) as array<bigint>) as miss", f"cast(array({bad}) as array<bigint>) as bad")])
    if not keys:
        return passed
    return _sum_up([passed, _duplicate_frame(df, keys, len(required))], len(required), len(keys))


def _counters_from_facts(df: DataFrame, facts: DataFrame, contract: Contract) -> DataFrame:
    """The same row from column facts (one row per column of df, so tiny)."""
    required, keys = _in_load(contract, df.columns)
    types = contract.types()

    def of(name: str, value: str) -> str:
        return f"coalesce(sum(if(column_name = {literal(name)}, {value}, 0)), 0L)"

    single = of(keys[0], "rows - unique_count - if(missing_count > 0, 1, 0)") if len(keys) == 1 else "sum(0L)"
    miss = ", ".join(of(c, "missing_count") for c in required)
    frames = [facts.agg(*[F.expr(e) for e in (
        "coalesce(max(rows), 0L) as rows_total", f"{single} as duplicate_count",
        f"cast(array({miss}) as array<bigint>) as miss")]).selectExpr("*", f"{_zeros(len(keys))} as bad")]
    misfits = [_misfit_sql(df, c, types[c]) for c in keys]
    if any(m not in ("false", "not true") for m in misfits):
        frames.append(df.agg(F.expr(f"cast(array({', '.join(f'count_if({m})' for m in misfits)}) as array<bigint>) as bad"))
                      .selectExpr("0L as rows_total", "0L as duplicate_count", f"{_zeros(len(required))} as miss", "bad"))
    if len(keys) > 1:
        frames.append(_duplicate_frame(df, keys, len(required)))
    return _sum_up(frames, len(required), len(keys)) if len(frames) > 1 else frames[0]


def _judge(counters: DataFrame, contract: Contract, evolution: Evolution, columns: list[str],
           scenario: str, enforce_null_tolerance: bool) -> DataFrame:
    """Turn the counter row into the result row of a load with these columns."""
    extra = f"{EXTRA_WARNING}: {', '.join(evolution.extra)}" if evolution.extra else None
    return _judged(counters, contract, *_in_load(contract, columns), literals(evolution.issues), literal(extra), scenario, enforce_null_tolerance)


def _judged(counters: DataFrame, contract: Contract, required: list[str], keys: list[str], schema_issues: str, extra: str,
            scenario: str, enforce_null_tolerance: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Turn counter rows into result rows, step by step over named columns.

    ``schema_issues`` (array) and ``extra`` (text or NULL) are SQL over the counter rows, and ``carry`` names
    columns of them that stay.
    """
    types = contract.types()
    bad_key = literals(f"Primary key '{c}' holds values that are not {types[c]}" for c in keys)
    issues = (f"if(size({schema_issues}) > 0, {schema_issues}, "
              f"slice(filter(transform({bad_key}, (m, i) -> if(bad[i] > 0, m, null)), m -> m is not null), 1, 1))")
    found = counters.selectExpr(
        *carry, "coalesce(rows_total, 0L) as rows_total", "coalesce(duplicate_count, 0L) as dups", f"{issues} as issues", f"{extra} as extra",
        f"filter(transform({literals(required)}, (c, i) -> named_struct('key', c, 'missing', miss[i])), s -> s.missing > 0) as nulls",
    ).selectExpr("*", "size(issues) > 0 as broken")
    no_map = "cast(map() as map<string,double>)"
    pct = percent_sql("s.missing", "rows_total")
    dup_rule = bool(keys) and not contract.allow_duplicates
    over = f"exists(map_values(null_violations), p -> p > {contract.max_null_pct}D)" if enforce_null_tolerance else "size(null_violations) > 0"
    judged = found.selectExpr(
        "*", f"if(broken, {no_map}, map_from_entries(transform(nulls, s -> named_struct('k', s.key, 'v', {pct})))) as null_violations",
    ).selectExpr("*", f"{over} as has_nulls", f"not broken and dups > 0 and {str(dup_rule).lower()} as has_dups")
    draft = None if contract.is_validated() else DRAFT_WARNING
    warnings = ", ".join([
        literal(draft),
        "if(broken, null, extra)",
        "if(has_nulls, concat('Nulls in required columns: ', array_join(map_keys(null_violations), ', ')), null)",
        f"if(has_dups, concat(cast(dups as string), ' duplicate rows (', cast({percent_sql('dups', 'rows_total', 1)} as string), '%)'), null)",
    ])
    return judged.selectExpr(
        *carry,
        f"{literal(contract.table)} as `table`",
        f"{literal(scenario)} as scenario",
        "case when broken then 'DLQ' when extra is not null or has_nulls or has_dups then 'WARNING' else 'PASS' end as status",
        "case when broken then 'BREAKING' when extra is not null then 'NON_BREAKING' end as evolution_type",
        "issues",
        f"array_compact(array({warnings})) as warnings",
        "rows_total",
        "if(broken, 0L, rows_total - dups) as rows_valid",
        "null_violations",
        "if(broken, 0L, dups) as duplicate_count",
    )


def validate_files(rows: DataFrame, heads: DataFrame, contract: Contract, scenario: str = "baseline", file: str = "_file",
                   extra: str = "_extra", corrupt: str = "_corrupt_record") -> DataFrame:
    """One result row per file, each judged by its own columns, with (_file, null_pcts) before the fields of a result.

    ``rows`` has the contract's columns as text, a map of other columns and the text of corrupt lines, and
    ``heads`` (_file, names). All counters of all files are made in one aggregation by file, one row per file and
    task; keys are looked for inside a file. ``null_pcts`` holds the percentage of blanks of each column of the file.
    """
    required, keys, declared = contract.required(), contract.primary_keys(), contract.column_names()
    types = contract.types()

    def each(tests: list[str]) -> str:
        return f"cast(array({', '.join(f'count_if({t})' for t in tests)}) as array<bigint>)"

    nulls, bad, blanks = [f"{ident(c)} is null" for c in required], [_misfit_sql(rows, c, types[c]) for c in keys], [is_blank_sql(ident(c)) for c in declared]
    counted = rows.groupBy(file).agg(*[F.expr(e) for e in (
        "count(1) as rows_total", f"{each(nulls)} as miss", f"{each(bad)} as bad", f"{each(blanks)} as blanks", f"count({ident(corrupt)}) as corrupt")])
    if keys:
        repeats = rows.groupBy(file, *[ident(c) for c in keys]).agg(F.expr("count(1) as n")).groupBy(file).agg(F.expr("sum(n - 1) as duplicate_count"))
        counted = counted.join(repeats, file, "left")
    else:
        counted = counted.withColumn("duplicate_count", F.lit(0).cast("bigint"))
    more = rows.select(file, F.explode(extra).alias("name", "value")).groupBy(file, "name").agg(F.expr(f"count_if({is_blank_sql('value')}) as b"))
    more = more.groupBy(file).agg(F.sort_array(F.collect_list(F.struct("name", "b"))).alias("_more"))  # one entry per column of a file
    names = heads.select(
        file, F.expr(f"filter({literals(required)}, c -> not array_contains(names, c))").alias("_lost"),
        F.expr(f"filter({literals(keys)}, c -> not array_contains(names, c))").alias("_lost_keys"),
        F.expr(f"array_sort(array_except(names, {literals(declared)}))").alias("_new"),
        F.expr(f"transform({literals(declared)}, c -> array_contains(names, c))").alias("_has"))
    whole = names.join(counted, file, "left").join(more, file, "left")
    # A file with a header alone has no counters.
    zeros = {"miss": len(required), "bad": len(keys), "blanks": len(declared)}
    whole = whole.withColumns({c: F.coalesce(c, F.expr(f"array_repeat(0L, {n})")) for c, n in zeros.items()}).withColumn("rows_total", F.coalesce("rows_total", F.lit(0)))
    whole = whole.withColumn("null_pcts", F.expr(
        f"concat(filter(zip_with(_has, blanks, (h, b) -> if(h, {percent_sql('b', 'rows_total')}, null)), p -> p is not null), "
        f"transform(coalesce(_more, cast(array() as array<struct<name:string,b:bigint>>)), s -> {percent_sql('s.b', 'rows_total')}))"))
    whole = whole.withColumn("lost", F.expr("size(_lost) + size(_lost_keys)"))
    issues = (f"case when size(_lost) > 0 then array(concat('{REQUIRED_ISSUE}: ', array_join(_lost, ', '))) "
              f"when size(_lost_keys) > 0 then array(concat('{KEY_ISSUE}: ', array_join(_lost_keys, ', '))) "
              "when corrupt > 0 then array(concat(cast(corrupt as string), ' of ', cast(rows_total as string), ' lines have too many fields or an open quote')) "
              "else cast(array() as array<string>) end")
    judged = _judged(whole, contract, required, keys, f"({issues})", f"if(size(_new) > 0, concat('{EXTRA_WARNING}: ', array_join(_new, ', ')), null)",
                     scenario, carry=(ident(file), "null_pcts", "corrupt", "lost"))
    # Damaged lines are no change of the schema.
    return judged.withColumn("evolution_type", F.when((F.col("corrupt") > 0) & (F.col("lost") == 0), F.lit(None)).otherwise(F.col("evolution_type"))).drop("corrupt", "lost")


def validate(df: DataFrame, contract: Contract, scenario: str = "baseline",
             enforce_null_tolerance: bool = False) -> DataFrame:
    """One result row for a load. Nothing runs until the row is asked for."""
    evolution = schema_evolution(contract, df.columns)
    if evolution.breaking:
        required, keys = _in_load(contract, df.columns)
        counters = df.agg(F.expr("count(1) as rows_total")).selectExpr(
            "rows_total", "0L as duplicate_count", f"{_zeros(len(required))} as miss", f"{_zeros(len(keys))} as bad")
    else:
        counters = _counters(df, contract)
    return _judge(counters, contract, evolution, df.columns, scenario, enforce_null_tolerance)


def validate_with_facts(df: DataFrame, facts: DataFrame, contract: Contract,
                        scenario: str = "baseline") -> DataFrame:
    """validate() for a load whose column_facts() are at hand."""
    evolution = schema_evolution(contract, df.columns)
    if evolution.breaking:
        return validate(df, contract, scenario)
    counters = _counters_from_facts(df, facts, contract)
    return _judge(counters, contract, evolution, df.columns, scenario, False)


def rejected(spark, table: str, issue: str, scenario: str = "baseline", status: str = "DLQ") -> DataFrame:
    """Result row of a load that could not be checked: unreadable data or an invalid contract; ERROR where the run itself failed."""
    return spark.range(1).selectExpr(
        f"{literal(table)} as `table`", f"{literal(scenario)} as scenario", f"{literal(status)} as status",
        "cast(null as string) as evolution_type", f"{literals([issue])} as issues",
        "cast(array() as array<string>) as warnings", "0L as rows_total", "0L as rows_valid",
        "cast(map() as map<string,double>) as null_violations", "0L as duplicate_count",
    )
