"""Registered queries: contract review, promotion, upserts, stored queries, streaming ingest.

The registries are derived from the tables: every customer is a contract and every order a
column of its customer's contract, so the work grows with the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakewarden.contracts import Contract
from lakewarden.operators.govern import (
    draft_notice, invalid_contracts, pending_items, promote, readiness, review_warnings, upsert, upsert_actions,
)
from lakewarden.plans.layers import Lake
from lakewarden.plans.stored import run_stored_queries
from lakewarden.plans.workload import COLUMNS, register, table
from lakewarden.plans.workload_checks import contract_for, _score_row_sql, validate_sql
from lakewarden.session import shared_dir
from lakewarden.sources.records import read_records
from lakewarden.sources.registry import accessors
from lakewarden.streaming.ingest import ingest, landing_stream

# Contract fields as expressions over customer, the same text in both engines.
_FIELDS = {
    "t": "concat('tb_', cast(c_custkey as string))",
    "version": "case when c_custkey % 19 = 0 then '1.0' when c_custkey % 23 = 0 then '1.a.0' else concat('1.', cast(c_nationkey as string), '.0') end",
    "manifest_status": "case when c_custkey % 5 = 0 then 'VALIDATED' when c_custkey % 5 = 1 then null else 'DRAFT' end",
    "description": "case when c_custkey % 3 = 0 then concat('# TODO: describe ', c_name) when c_custkey % 7 = 0 then '' else c_name end",
    "owner": "case when c_custkey % 11 = 0 then null else c_mktsegment end",
    "business_context": "case when c_custkey % 2 = 0 then 'known' else 'text # TODO later' end",
    "s_system": "case when c_custkey % 4 = 0 then '# TODO: system' when c_custkey % 4 = 1 then null else 'CORE' end",
    "s_contact": "case when c_custkey % 6 = 0 then '# TODO' else 'a@b' end",
    "w_name": "case when c_custkey % 8 = 0 then null else 'Ana' end",
    "w_email": "case when c_custkey % 9 = 0 then '# TODO: email' else 'ana@b' end",
    "tag": "case when c_custkey % 10 = 0 then null when c_custkey % 10 = 1 then '# TODO: review tags' else 'LGPD' end",
    "query": "case when c_custkey % 3 = 1 then 'select 1' end",
}
# Contract columns over orders.
_COLUMN_FIELDS = {
    "t": "concat('tb_', cast(o_custkey as string))",
    "name": "concat('c_', cast(o_orderkey as string))",
    "description": "case when o_orderkey % 20 = 0 then '# TODO: describe' when o_orderkey % 31 = 0 then null else o_orderpriority end",
    "nullable": "o_orderkey % 2 = 0",
    "primary_key": "o_orderkey % 9 = 0",
    "flag": "case when o_orderkey % 6 = 0 then 'LGPD_SENSITIVE' when o_orderkey % 6 = 1 then 'SCR_CANDIDATE' end",
    "rule": "case when o_orderkey % 2 = 1 then 'rule' end",
}
_C = "(select " + ", ".join(f"{e} as {n}" for n, e in _FIELDS.items()) + " from customer)"
_K = "(select " + ", ".join(f"{e} as {n}" for n, e in _COLUMN_FIELDS.items()) + " from orders)"


def contracts(spark, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "customer").selectExpr(*[f"{e} as {n}" for n, e in _FIELDS.items()])
    return flat.selectExpr(
        "t as `table`", "version", "manifest_status", "cast(null as string) as validated_by", "cast(null as string) as validated_at",
        "description", "owner", "business_context",
        "named_struct('system', s_system, 'os', 'unix', 'update_frequency', 'daily', 'contact', s_contact) as source",
        "named_struct('name', w_name, 'email', w_email) as steward",
        "named_struct('tags', array_compact(array(tag))) as regulatory",
        "array_compact(array(query)) as sample_queries")


def columns(spark, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {n}" for n, e in _COLUMN_FIELDS.items()])
    return flat.selectExpr("t as `table`", "name", "description", "nullable", "primary_key",
                           "array_compact(array(flag)) as regulatory_flags", "array_compact(array(rule)) as business_rules")


def _todo(c: str) -> str:
    return f"coalesce(contains({c}, '# TODO'), false)"


def _unfilled(c: str) -> str:
    return f"(coalesce({c}, '') = '' or {_todo(c)})"


_PENDING = " union all ".join(
    [f"""select t as "table", '{f}' as field, 'empty or marked as to do' as issue from {_C} c where {_unfilled(f)}""" for f in ("description", "owner", "business_context")]
    + [f"""select t, 'source.{n}', 'marked as to do' from {_C} c where {_todo(c)}""" for n, c in (("system", "s_system"), ("contact", "s_contact"))]
    + [f"""select t, 'steward.{n}', 'empty or marked as to do' from {_C} c where {_unfilled(c)}""" for n, c in (("name", "w_name"), ("email", "w_email"))]
    + [f"""select t, 'regulatory.tags', 'tags not reviewed' from {_C} c where tag is null or {_todo('tag')}""",
       f"""select t, concat('schema[', name, '].description'), 'empty or marked as to do' from {_K} k where {_unfilled('description')}"""])
_READY = f"""(select c.t as "table", cast(coalesce(p.n, 0) as bigint) as pending, coalesce(p.n, 0) = 0 as ready
    from {_C} c left join (select "table", count(*) as n from ({_PENDING}) x group by 1) p on c.t = p."table")"""


@register("pending_items", _PENDING)
def pending_items_query(spark, sf_dir):
    return pending_items(contracts(spark, sf_dir), columns(spark, sf_dir))


@register("review_warnings", f"""
    select t as "table", concat('schema[', name, '].business_rules is empty') as warning from {_K} k where rule is null
    union all select t, 'sample_queries is empty' from {_C} c where query is null""")
def review_warnings_query(spark, sf_dir):
    return review_warnings(contracts(spark, sf_dir), columns(spark, sf_dir))


@register("contract_readiness", f"select * from {_READY} r")
def contract_readiness(spark, sf_dir):
    return readiness(contracts(spark, sf_dir), columns(spark, sf_dir))


@register("contract_promotion", f"""
    select c.t as "table", case when r.ready then 'VALIDATED' else c.manifest_status end as manifest_status,
           case when r.ready then 'Ana' end as validated_by, case when r.ready then '2024-01-01T00:00:00' end as validated_at, c.version
    from {_C} c join {_READY} r on c.t = r."table" """)
def contract_promotion(spark, sf_dir):
    done = promote(contracts(spark, sf_dir), columns(spark, sf_dir), "Ana", "2024-01-01T00:00:00")
    return done.select("table", "manifest_status", "validated_by", "validated_at", "version")


@register("contract_accessors", f"""
    select t as "table", count(*) as columns, cast(sum(case when primary_key then 1 else 0 end) as bigint) as key_columns,
           cast(sum(case when nullable then 0 else 1 end) as bigint) as required_columns,
           cast(sum(case when flag = 'LGPD_SENSITIVE' then 1 else 0 end) as bigint) as sensitive_columns,
           cast(sum(case when coalesce(description, '') <> '' then 1 else 0 end) as bigint) as documented_columns
    from {_K} k group by t""")
def contract_accessors(spark, sf_dir):
    return accessors(columns(spark, sf_dir))


@register("draft_notices", f"""select t as "table" from {_C} c where coalesce(manifest_status, 'DRAFT') <> 'VALIDATED' """)
def draft_notices(spark, sf_dir):
    return draft_notice(contracts(spark, sf_dir))


@register("invalid_contracts", f"""
    select t as "table", 'version is not three numbers' as issue from {_C} c where not regexp_matches(version, '^[0-9]+\\.[0-9]+\\.[0-9]+$')""")
def invalid_contracts_query(spark, sf_dir):
    return invalid_contracts(contracts(spark, sf_dir))


# New versions arrive for the customers that have orders, some of them incomplete.
_INCOMING = f"""(select t, version, columns, 'DRAFT' as manifest_status from (
    select concat('tb_', cast(o_custkey + 5 as varchar)) as t, concat('2.', cast(count(*) as varchar), '.0') as version,
           cast(case when (o_custkey + 5) % 13 = 0 then 0 else count(*) end as bigint) as columns
    from orders group by o_custkey) g)"""


def _upsert_sql(overwrite: bool) -> str:
    return f"""(select i.t, i.version, i.columns, i.manifest_status,
        case when i.columns = 0 then 'rejected' when r.status = 'VALIDATED' then 'drafted' when r.status is null then 'created'
             when {str(overwrite).lower()} then 'replaced' else 'kept' end as action,
        case when i.columns > 0 and r.status = 'VALIDATED' then concat(i.t, '_draft') else i.t end as target
        from {_INCOMING} i left join (select t, coalesce(manifest_status, 'DRAFT') as status from {_C} c) r on i.t = r.t)"""


def _incoming(spark, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per.selectExpr("concat('tb_', cast(o_custkey + 5 as string)) as `table`", "concat('2.', cast(n as string), '.0') as version",
                          "cast(if((o_custkey + 5) % 13 = 0, 0, n) as bigint) as column_count", "'DRAFT' as manifest_status")


@register("contract_upsert_actions", f"""
    select t as "table", version, columns as column_count, action, target from {_upsert_sql(False)} u""")
def contract_upsert_actions(spark, sf_dir):
    registry = contracts(spark, sf_dir).select("table", "version", "manifest_status")
    return upsert_actions(registry, _incoming(spark, sf_dir)).select("table", "version", "column_count", "action", "target")


@register("contract_upsert", f"""
    with u as (select * from {_upsert_sql(True)} x where action in ('created', 'replaced', 'drafted'))
    select t as "table", version, manifest_status from {_C} c where t not in (select target from u)
    union all select target, version, manifest_status from u""")
def contract_upsert(spark, sf_dir):
    registry = contracts(spark, sf_dir).select("table", "version", "manifest_status")
    return upsert(registry, _incoming(spark, sf_dir), overwrite=True)


# ---- stored queries -------------------------------------------------------------------------

# One contract per table with the analytical questions kept beside its columns.
_STORED = {
    "stored_segments": ("customer", "select c_mktsegment, count(*) as row_count from customer where c_acctbal > 0 group by c_mktsegment"),
    "stored_high_balance": ("customer", "select c_custkey, c_name, c_acctbal from customer where c_nationkey < 20 and c_acctbal > 5000"),
    "stored_volume_by_channel": ("orders", "select o_orderpriority, count(*) as row_count, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders group by o_orderpriority"),
    "stored_latest_flagged": ("orders", "select * from orders where o_orderstatus = 'P' order by o_orderdate desc, o_orderkey limit 100"),
    "stored_returned_by_line": ("lineitem", "select l_linestatus, count(*) as row_count from lineitem where l_returnflag = 'R' group by l_linestatus"),
    "stored_mean_usage": ("lineitem", "select l_linestatus, floor(avg(l_discount / nullif(l_quantity, 0)) * 1e8 + 0.5) / 1e8 as discount_per_unit from lineitem where l_returnflag = 'A' group by l_linestatus"),
}


def _stored_contract(name: str) -> Contract:
    return contract_for(name, sample_queries=[{"description": k, "sql": q} for k, (t, q) in _STORED.items() if t == name])


for _key, (_table, _sql) in _STORED.items():
    register(_key, _sql)(lambda spark, sf, k=_key, t=_table: run_stored_queries(_stored_contract(t), table(spark, sf, t))[k])


# ---- streaming ------------------------------------------------------------------------------


@register("stream_ingest_events", _score_row_sql(
    validate_sql(contract_for("events"), "events", [c for c, _ in COLUMNS["events"]]), "events", COLUMNS["events"]))
def stream_ingest_events(spark, sf_dir):
    """The events file arrives on the stream; the answer is its run record."""
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    lake = Lake(f"{root}/lake")
    source = table(spark, sf_dir, "events")
    stream = landing_stream(spark, sf_dir, source.schema, fmt="parquet", pathGlobFilter="events.parquet")
    query = ingest(stream, contract_for("events"), lake, f"{root}/checkpoint", timestamp="1970-01-01T00:00:00", fmt="parquet")
    query.awaitTermination()
    return read_records(spark, lake.path("metrics")).select(
        "table", "scenario", "validation_status", "evolution_type", "rows_total", "rows_valid", "duplicate_count",
        "avg_null_pct", "quality_score")


_STREAMED = ("events", "orders")


@register("stream_two_tables", " union all ".join(
    f"""select "table", rows_total, status as validation_status, cast({n} as bigint) as batches from (
    {validate_sql(contract_for(t), t, [c for c, _ in COLUMNS[t]])}) v""" for t, n in (("events", 2), ("orders", 2))))
def stream_two_tables(spark, sf_dir):
    """Two streams with two batches each into one lake: no record and no layer folder meets another."""
    root = f"{shared_dir(spark)}/streams-{uuid.uuid4().hex}"
    lake = Lake(f"{root}/lake")
    for name in _STREAMED:
        source, key = table(spark, sf_dir, name), COLUMNS[name][0][0]
        for part in (0, 1):
            source.filter(f"{key} % 2 = {part}").write.mode("append").parquet(f"{root}/landing-{name}")
            stream = landing_stream(spark, f"{root}/landing-{name}", source.schema, fmt="parquet")
            ingest(stream, contract_for(name), lake, f"{root}/checkpoint-{name}", timestamp="1970-01-01T00:00:00", fmt="parquet").awaitTermination()
    records = read_records(spark, lake.path("metrics"))
    silver = [spark.read.parquet(lake.path("silver", n)).agg(F.count(F.lit(1)).alias("silver")).select(F.lit(n).alias("table"), "silver") for n in _STREAMED]
    totals = records.groupBy("table").agg(F.sum("rows_total").alias("rows_total"), F.max("validation_status").alias("validation_status"), F.count(F.lit(1)).alias("batches"))
    # Rows that reached silver must be the rows recorded.
    return totals.join(silver[0].unionByName(silver[1]), "table").filter("silver = rows_total").drop("silver")
