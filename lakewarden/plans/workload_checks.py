"""Registered queries: validation, duplicates, schema evolution, scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakewarden.contracts import Contract
from lakewarden.functions import numeric
from lakewarden.functions.coercion import fits_type_sql
from lakewarden.operators.checks import (
    drop_duplicates, duplicate_counts, null_violations, schema_diff, validate, validate_with_facts,
)
from lakewarden.operators.profile import column_facts
from lakewarden.operators.score import run_records
from lakewarden.plans.layers import Lake
from lakewarden.plans.scenario import Load, consolidated, run_matrix, run_scenario
from lakewarden.plans.workload import (
    COLUMNS, KEYS, percent_sql, register, round_sql, table, text_sql,
)
from lakewarden.session import shared_dir
from lakewarden.sources.nested import observed_keys

_TYPES = {"int": "integer", "double": "float", "text": "string", "time": "datetime"}


def contract_for(name: str, columns: list[tuple[str, str]] | None = None, key: list[str] | None = None,
                 optional: tuple[str, ...] = (), **extra) -> Contract:
    """Contract of an input table: every column required unless listed as optional."""
    key = key if key is not None else KEYS[name]
    return Contract.of({
        "table": name, "version": "1.0.0",
        "schema": [{"name": c, "type": _TYPES[k], "nullable": c in optional, "primary_key": c in key}
                   for c, k in columns or COLUMNS[name]],
        **extra,
    })


# Loads of customer and orders with one thing wrong each. (source columns as SQL expressions)
_CUSTOMER = {c: c for c, _ in COLUMNS["customer"]}
_ORDERS = {c: c for c, _ in COLUMNS["orders"]}
LOADS = {
    "baseline": ("customer", _CUSTOMER),
    "null_required": ("customer", {**_CUSTOMER, "c_mktsegment": "case when c_custkey % 13 = 0 then null else c_mktsegment end"}),
    "non_breaking": ("customer", {**_CUSTOMER, "c_manager": "case when c_custkey % 5 < 3 then null else c_name end"}),
    "breaking": ("customer", {k: v for k, v in _CUSTOMER.items() if k != "c_nationkey"}),
    "missing_key": ("customer", {k: v for k, v in _CUSTOMER.items() if k != "c_custkey"}),
    "repeated_keys": ("customer", {**_CUSTOMER, "c_custkey": "case when c_custkey % 3 = 0 then null else c_custkey % 1000 end"}),
    "bad_key": ("orders", {**_ORDERS, "o_orderkey": "case when o_orderkey = 3 then '<unknown>' else cast(o_orderkey as string) end"}),
    "text_key": ("orders", {**_ORDERS, "o_orderkey": "concat(' ', cast(o_orderkey as string), ' ')"}),
}

def flat(result: DataFrame) -> DataFrame:
    return result.selectExpr(
        "`table`", "scenario", "status", "evolution_type", "rows_total", "rows_valid", "duplicate_count",
        "cast(size(issues) as bigint) as issue_count", "cast(size(warnings) as bigint) as warning_count",
        "cast(size(null_violations) as bigint) as violation_count",
        "coalesce(array_max(map_values(null_violations)), 0.0D) as worst_null_pct",
    )


def validate_sql(contract: Contract, source: str, columns: list[str], scenario: str = "baseline",
                 text_keys: bool = False) -> str:
    """One flat result row as SQL."""
    missing = [c for c in contract.column_names() if c not in columns]
    hard = [c for c in missing if c in contract.required()] or [c for c in missing if c in contract.primary_keys()]
    extra = [c for c in columns if c not in contract.column_names()]
    required = [c for c in contract.required() if c in columns]
    keys = [c for c in contract.primary_keys() if c in columns]
    miss = [f"sum(case when {c} is null then 1 else 0 end) as m{i}" for i, c in enumerate(required)]
    bad = "0"
    if text_keys:
        bad = " + ".join(f"sum(case when {c} is not null and not regexp_matches(trim({c}), '^[+-]?[0-9]+$') then 1 else 0 end)"
                         for c in keys)
    dup = f"count(*) - count(distinct ({', '.join(keys)}, 0))" if keys else "0"
    counters = ", ".join([f"count(*) as n, {dup} as dup, {bad} as bad"] + miss)
    broken = "true" if hard else "bad > 0"
    pcts = [percent_sql(f"m{i}", "n") for i in range(len(required))]
    worst = f"greatest({', '.join(pcts)}, 0.0::double)" if pcts else "0.0::double"
    violations = " + ".join(f"(case when m{i} > 0 then 1 else 0 end)" for i in range(len(required))) or "0"
    draft = 0 if contract.is_validated() else 1
    dups_warn = "false" if contract.allow_duplicates or not keys else "dup > 0"
    evo = "'NON_BREAKING'" if extra else "null"
    return f"""
    select '{contract.table}' as "table", '{scenario}' as scenario,
           case when {broken} then 'DLQ' when {'true' if extra else 'false'} or ({violations}) > 0 or {dups_warn} then 'WARNING' else 'PASS' end as status,
           case when {broken} then 'BREAKING' else {evo} end as evolution_type,
           cast(n as bigint) as rows_total,
           cast(case when {broken} then 0 else n - dup end as bigint) as rows_valid,
           cast(case when {broken} then 0 else dup end as bigint) as duplicate_count,
           cast(case when {broken} then 1 else 0 end as bigint) as issue_count,
           cast({draft} + case when {broken} then 0 else {1 if extra else 0} + (case when ({violations}) > 0 then 1 else 0 end)
                + (case when {dups_warn} then 1 else 0 end) end as bigint) as warning_count,
           cast(case when {broken} then 0 else {violations} end as bigint) as violation_count,
           case when {broken} then 0.0::double else {worst} end as worst_null_pct
    from (select {counters} from {source} src) c"""


def mean_null_sql(source: str, columns: list[tuple[str, str]]) -> str:
    """Scalar subquery text: mean of the column null percentages."""
    parts = []
    for name, kind in columns:
        nulls = f"sum(case when {name} is null or trim({text_sql(name, kind)}) = '' then 1 else 0 end)"
        parts.append(f"select {percent_sql(nulls, 'count(*)')} as p from {source} src")
    return f"(select cast(sum(cast(round(p * 100) as bigint)) as double) / count(p) / 100.0::double from ({' union all '.join(parts)}) q)"


def score_sql(status: str, nulls: str, rows: str, dups: str, evolution: str) -> str:
    dup_pct = f"cast({dups} as double) / cast(greatest({rows}, 1) as double) * 100.0::double"
    total = f"""(case when {status} = 'PASS' then 40.0::double when {status} = 'WARNING' then 25.0::double else 0.0::double end)
        + (case when {nulls} is null then 0.0::double else greatest(0.0::double, 30.0::double - {nulls}) end)
        + greatest(0.0::double, 20.0::double - {dup_pct} * 10.0::double)
        + (case when {evolution} is null then 10.0::double else 0.0::double end)"""
    return round_sql(f"least({total}, 100.0::double)", 1)


def load_frame(spark, sf_dir: str, scenario: str) -> tuple[DataFrame, Contract]:
    name, columns = LOADS[scenario]
    return table(spark, sf_dir, name).selectExpr(*[f"{e} as {c}" for c, e in columns.items()]), contract_for(name)


def load_sql(scenario: str) -> tuple[str, Contract, list[str]]:
    name, columns = LOADS[scenario]
    return f"(select {', '.join(f'{e} as {c}' for c, e in columns.items())} from {name})", contract_for(name), list(columns)


_SCENARIO_SQL = " union all ".join(
    validate_sql(c, src, cols, s, text_keys=s in ("bad_key", "text_key"))
    for s, (src, c, cols) in ((s, load_sql(s)) for s in LOADS))


@register("validate_scenarios", _SCENARIO_SQL)
def validate_scenarios(spark, sf_dir):
    results = []
    for scenario in LOADS:
        df, contract = load_frame(spark, sf_dir, scenario)
        results.append(flat(validate(df, contract, scenario)))
    return reduce(DataFrame.unionByName, results)


_ALL_SQL = " union all ".join(validate_sql(contract_for(n), n, [c for c, _ in COLUMNS[n]]) for n in COLUMNS)


@register("validate_all", _ALL_SQL)
def validate_all(spark, sf_dir):
    results = [flat(validate(table(spark, sf_dir, n).select(*[c for c, _ in COLUMNS[n]]), contract_for(n))) for n in COLUMNS]
    return reduce(DataFrame.unionByName, results)


def _score_row_sql(base: str, source: str, columns: list[tuple[str, str]]) -> str:
    nulls = f"(case when status = 'DLQ' then null else {mean_null_sql(source, columns)} end)"
    return f"""
    select "table", scenario, status as validation_status, evolution_type, rows_total, rows_valid, duplicate_count,
           coalesce({round_sql('nulls', 2)}, 0.0::double) as avg_null_pct,
           {score_sql('status', 'nulls', 'rows_total', 'duplicate_count', 'evolution_type')} as quality_score
    from (select *, {nulls} as nulls from ({base}) b) s"""


def scorecard(df: DataFrame, contract: Contract, scenario: str = "baseline") -> DataFrame:
    """Validate, profile and score one table as one lazy plan."""
    facts = column_facts(df)
    result = validate_with_facts(df, facts, contract, scenario)
    profiled = facts.selectExpr(f"'{contract.table}' as `table`", f"'{scenario}' as scenario", "null_pct")
    records = run_records("run", "1970-01-01T00:00:00", result, profiled, fmt="parquet")
    return records.select("table", "scenario", "validation_status", "evolution_type", "rows_total", "rows_valid",
                          "duplicate_count", "avg_null_pct", "quality_score")


SCORED = list(COLUMNS)


def scorecard_all(spark, sf_dir):
    return reduce(DataFrame.unionByName, [
        scorecard(table(spark, sf_dir, n).select(*[c for c, _ in COLUMNS[n]]), contract_for(n)) for n in SCORED])


register("quality_score_all", " union all ".join(
    _score_row_sql(validate_sql(contract_for(n), n, [c for c, _ in COLUMNS[n]]), n, COLUMNS[n]) for n in SCORED))(scorecard_all)


@register("quality_score_lineitem", _score_row_sql(
    validate_sql(contract_for("lineitem"), "lineitem", [c for c, _ in COLUMNS["lineitem"]]), "lineitem", COLUMNS["lineitem"]))
def quality_score_lineitem(spark, sf_dir):
    return scorecard(table(spark, sf_dir, "lineitem"), contract_for("lineitem"))


_ROUTED = ["baseline", "null_required", "non_breaking", "breaking", "bad_key"]


def _kinds(scenario: str) -> list[tuple[str, str]]:
    name, columns = LOADS[scenario]
    kinds = dict(COLUMNS[name])
    return [(c, kinds[c] if columns[c] == c else "text") for c in columns]


@register("scenario_runs", " union all ".join(
    _score_row_sql(validate_sql(c, src, cols, s, text_keys=s == "bad_key"), src, _kinds(s))
    for s, (src, c, cols) in ((s, load_sql(s)) for s in _ROUTED)))
def scenario_runs(spark, sf_dir):
    """Stage, validate, profile, route and record; the answer is read back from the run records."""
    import uuid

    from lakewarden.sources.records import read_records
    lake = Lake(f"{shared_dir(spark)}/lake-{uuid.uuid4().hex}")
    for scenario in _ROUTED:
        name = LOADS[scenario][0]
        load = Load(name, lambda s, x=scenario: load_frame(s, sf_dir, x)[0], contract_for(name), "parquet")
        run_scenario(spark, lake, [load], "run", scenario, timestamp="1970-01-01T00:00:00")
    return read_records(spark, lake.path("metrics")).select(
        "table", "scenario", "validation_status", "evolution_type", "rows_total", "rows_valid", "duplicate_count",
        "avg_null_pct", "quality_score")


# One run over scenarios and formats under one run id.
_MATRIX = {"baseline": ("csv", "json", "fixed"), "breaking": ("csv", "json", "fixed"), "null_required": ("csv", "json"), "non_breaking": ("json", "csv")}
_WIDTHS = {"c_custkey": 12, "c_name": 30, "c_nationkey": 6, "c_acctbal": 16, "c_mktsegment": 16}


def _matrix_sql(scenario: str, fmt: str) -> str:
    source, contract, columns = load_sql(scenario)
    return f"""
    select 'matrix-7' as run_id, scenario, '{fmt}' as format, "table", status as validation_status, rows_total, rows_valid, duplicate_count,
           case when status = 'DLQ' then 0 else rows_total end as silver_rows, case when status = 'DLQ' then rows_total else 0 end as quarantine_rows
    from ({validate_sql(contract, source, columns, scenario)}) v"""


@register("scenario_matrix", " union all ".join(_matrix_sql(s, f) for s, formats in _MATRIX.items() for f in formats))
def scenario_matrix(spark, sf_dir):
    """Landing files of every scenario in every format through one run; rows are counted in the layers."""
    import uuid

    from lakewarden.plans.layers import read_route
    from lakewarden.operators.values import to_text
    from lakewarden.sources.fixed import layout_of
    from lakewarden.sources.reader import read_table, write_table

    root = f"{shared_dir(spark)}/matrix-{uuid.uuid4().hex}"
    lake = Lake(f"{root}/lake")
    scenarios = {}
    for scenario, formats in _MATRIX.items():
        df, contract = load_frame(spark, sf_dir, scenario)
        layout = layout_of([(c, _WIDTHS.get(c, 30), "string") for c in df.columns])
        loads = []
        for fmt in formats:
            path = f"{root}/landing/{scenario}.{'jsonl' if fmt == 'json' else fmt}"
            extra = {"layout": layout} if fmt == "fixed" else {}
            write_table(df if fmt == "json" else to_text(df), path, fmt, **extra)
            loads.append(Load("customer", lambda s, p=path, f=fmt, e=extra: read_table(s, p, f, **e), contract, fmt))
        scenarios[scenario] = loads
    # The same run twice: nothing is doubled.
    for _ in range(2):
        run_matrix(spark, lake, scenarios, "matrix-7", timestamp="1970-01-01T00:00:00")
    found = [read_route(spark, lake, layer, "customer").groupBy("scenario", "format").agg(
        *[(F.count(F.lit(1)) if layer == x else F.lit(0)).cast("bigint").alias(f"{x}_rows") for x in ("silver", "quarantine")]) for layer in ("silver", "quarantine")]
    rows = found[0].unionByName(found[1]).groupBy("scenario", "format").agg(*[F.sum(f"{x}_rows").alias(f"{x}_rows") for x in ("silver", "quarantine")])
    records = consolidated(spark, lake, "matrix-7").select(
        "run_id", "scenario", "format", "table", "validation_status", "rows_total", "rows_valid", "duplicate_count")
    return records.join(rows, ["scenario", "format"])


_NULL_CONTRACT = contract_for("orders")
_NULL_COLUMNS = {**_ORDERS, "o_orderpriority": "case when o_orderkey % 7 = 0 then null else o_orderpriority end",
                 "o_custkey": "case when o_orderkey % 100 = 1 then null else o_custkey end"}


@register("null_violations_orders", f"""
    select column_name, {percent_sql('m', 'n')} as null_pct, cast(m as bigint) as null_count from (
      select 'o_orderpriority' as column_name, count(*) as n, sum(case when o_orderkey % 7 = 0 then 1 else 0 end) as m from orders
      union all select 'o_custkey', count(*), sum(case when o_orderkey % 100 = 1 then 1 else 0 end) from orders
    ) c where m > 0""")
def null_violations_orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {c}" for c, e in _NULL_COLUMNS.items()])
    return null_violations(df, _NULL_CONTRACT)


@register("duplicate_keys_lineitem", f"""
    select cast(n as bigint) as rows_total, cast(dup as bigint) as duplicate_count, cast(n - dup as bigint) as rows_valid,
           {percent_sql('dup', 'n')} as duplicate_pct, dup > 0 as warns
    from (select count(*) as n, count(*) - count(distinct (l_orderkey, l_linenumber)) as dup from lineitem) c""")
def duplicate_keys_lineitem(spark, sf_dir):
    counts = duplicate_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return counts.selectExpr(
        "rows_total", "duplicate_count", "rows_total - duplicate_count as rows_valid",
        f"{numeric.percent_sql('duplicate_count', 'rows_total')} as duplicate_pct", "duplicate_count > 0 as warns")


_DEDUP_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@register("dedup_lineitem", f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
    from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(_DEDUP_ORDER)}) as rn
          from lineitem) r where rn = 1""")
def dedup_lineitem(spark, sf_dir):
    kept = drop_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _DEDUP_ORDER)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       "l_discount", "l_tax", "l_shipdate")


_COERCIONS = {
    "as_integer": ("integer", "case when o_orderkey % 1000 = 3 then '<unknown>' else cast(o_orderkey as string) end"),
    "as_float": ("float", "case when o_orderkey % 2 = 0 then concat(' ', cast(o_custkey as string), '.5e3') else 'inf' end"),
    "as_boolean": ("boolean", "case o_orderkey % 4 when 0 then 'Sim' when 1 then 'não' when 2 then ' TRUE ' else 'maybe' end"),
    "as_date": ("date", "case when o_orderkey % 2 = 0 then 'not a date' else null end"),
}
_COERCION_SQL = {
    "integer": "regexp_matches(trim(v), '^[+-]?[0-9]+$')",
    "float": r"regexp_matches(trim(v), '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') or lower(trim(v)) in ('inf', '+inf', '-inf', 'infinity', 'nan')",
    "boolean": "lower(trim(v)) in ('true','false','1','0','yes','no','sim','não','nao')",
    "date": "true",
}


@register("key_coercion_orders", " union all ".join(f"""
    select '{n}' as key_name, '{t}' as declared_type, bool_and(v is null or {_COERCION_SQL[t]}) as fits,
           cast(sum(case when v is null or {_COERCION_SQL[t]} then 0 else 1 end) as bigint) as misfits
    from (select {e} as v from orders) s""" for n, (t, e) in _COERCIONS.items()))
def key_coercion_orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {n}" for n, (_, e) in _COERCIONS.items()])
    one = df.agg(*[F.expr(f"count_if(not {fits_type_sql(n, t)}) as {n}") for n, (t, _) in _COERCIONS.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("key_name"), F.lit(t).alias("declared_type"), (F.col(n) == 0).alias("fits"),
                 F.col(n).alias("misfits")) for n, (t, _) in _COERCIONS.items()])))


# Records whose keys drift: the column names themselves are data here.
_DRIFT = """case when event_id % 5 = 0 then concat('{"k": ', cast(user_id as string), ', "novo": 1}')
                 when event_id % 7 = 0 then concat('{"k": ', cast(user_id as string), ', "event_type": "x"}') else props end"""


@register("schema_drift_events", f"""
    with seen as (select unnest(json_keys(doc)) as name from (select {_DRIFT} as doc from events) d),
         counted as (select name, count(*) as n from seen group by name),
         declared as (select column1 as name, column2 as nullable, column3 as primary_key
                      from (values ('k', false, true), ('event_type', true, false), ('valor', false, false), ('extra_id', true, true),
                                   ('obs', true, false)) v(column1, column2, column3))
    select coalesce(d.name, c.name) as name,
           case when d.name is null then 'extra' when c.name is null and not d.nullable then 'missing_required'
                when c.name is null and d.primary_key then 'missing_key' when c.name is null then 'missing_optional'
                else 'present' end as state,
           cast(coalesce(c.n, 0) as bigint) as occurrences
    from declared d full outer join counted c on d.name = c.name""")
def schema_drift_events(spark, sf_dir):
    docs = table(spark, sf_dir, "events").select(F.expr(_DRIFT).alias("doc"))
    keys = docs.select(F.explode(F.json_object_keys("doc")).alias("name"))
    declared = spark.createDataFrame(
        [("k", False, True), ("event_type", True, False), ("valor", False, False), ("extra_id", True, True), ("obs", True, False)],
        "name string, nullable boolean, primary_key boolean")
    return schema_diff(declared, keys)


@register("observed_keys_events", f"""
    select name, count(*) as occurrences from (select unnest(json_keys(doc)) as name
    from (select {_DRIFT} as doc from events) d) k group by name""")
def observed_keys_events(spark, sf_dir):
    docs = table(spark, sf_dir, "events").select(F.expr(_DRIFT).alias("doc"))
    return observed_keys(docs, "doc")
