"""Registered queries: run records and the questions asked of their history.

Every order stands for one run record, and every fourth order for one in each of three formats under one
run and time, so a handful of (table, scenario, format) series hold all rows: the series are as hot as they can be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakewarden.operators.history import (
    EXPORT_FIELDS, SERIES, dashboard_totals, documentation_status, export_fields, latest, problem_lines, report_lines,
    run_totals, score_evolution, score_trend, select_records, union_records, worst_exit_codes,
)
from lakewarden.operators.score import quality_score_sql
from lakewarden.plans.workload import register, table
from lakewarden.plans.workload_checks import score_sql

# Run record fields as expressions over orders, the same text in both engines.
_BASE = {
    "run_id": "concat('run-', lpad(cast(o_custkey as string), 9, '0'))",
    '"table"': "concat('tb_', o_orderstatus)",
    "scenario": "o_orderpriority",
    "timestamp": "concat(substr(cast(o_orderdate as string), 1, 10), 'T00:00:00.', lpad(cast(o_orderkey as string), 12, '0'))",
    "validation_status": "case when o_orderkey % 10 = 0 then 'DLQ' when o_orderkey % 10 < 4 then 'WARNING' when o_orderkey % 97 = 5 then 'ERROR' else 'PASS' end",
    "evolution_type": "case when o_orderkey % 10 = 0 then 'BREAKING' when o_orderkey % 20 = 1 then 'NON_BREAKING' end",
    "rows_total": "o_custkey + 1",
    "duplicate_count": "case when o_orderkey % 10 = 0 then 0 else o_orderkey % 5 end",
    "avg_null_pct": "(o_orderkey % 400) / 10.0 + k",
    "profiling_ms": "(o_orderkey % 1000) / 4.0",
    "slm_status": "case o_orderkey % 6 when 0 then 'SUCCESS' when 1 then 'ERROR' else 'SKIPPED' end",
    "slm_inference_ms": "case when o_orderkey % 6 = 0 then 32000.5 else 0.0 end",
    "issue": "case when o_orderkey % 10 = 0 then 'Required columns missing: c' end",
    "warning": "case when o_orderkey % 10 in (1, 2, 3) then 'Duplicate rows' when o_orderkey % 10 = 7 then 'Contract is in DRAFT status' end",
    "extra_warning": "case when o_orderkey % 20 = 1 then 'New columns detected' end",
}
_DOUBLES = ("avg_null_pct", "profiling_ms", "slm_inference_ms")
_LONGS = ("rows_total", "duplicate_count")


def _cast(name: str, expr: str) -> str:
    if name in _DOUBLES:
        return f"cast({expr} as double)"
    return f"cast({expr} as bigint)" if name in _LONGS else expr


_FORMATS = ("csv", "json", "fixed")
_FORMAT = "case k when 0 then 'csv' when 1 then 'json' else 'fixed' end"
_BASE_SQL = ("select " + ", ".join(f"{_cast(n, e)} as {n}" for n, e in _BASE.items()) + f", {_FORMAT} as format from orders, "
             "(select unnest([0, 1, 2]) as k) f where k = 0 or o_orderkey % 4 = 0")
RECORDS_SQL = f"""(select r.*, case when validation_status = 'DLQ' then 0 else rows_total - duplicate_count end as rows_valid,
    {score_sql('validation_status', "(case when validation_status = 'DLQ' then null else avg_null_pct end)", 'rows_total', 'duplicate_count', 'evolution_type')} as quality_score
    from ({_BASE_SQL}) r)"""


def records(spark, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("*", "explode(if(o_orderkey % 4 = 0, array(0, 1, 2), array(0))) as k")
    base = orders.selectExpr(*[f"{_cast(n, e)} as {n.replace(chr(34), '`')}" for n, e in _BASE.items()], f"{_FORMAT} as format")
    score = quality_score_sql("validation_status", "if(validation_status = 'DLQ', null, avg_null_pct)", "rows_total",
                              "duplicate_count", "evolution_type")
    return base.selectExpr(
        "*", "if(validation_status = 'DLQ', 0L, rows_total - duplicate_count) as rows_valid", f"{score} as quality_score",
        "array_compact(array(issue)) as issues", "array_compact(array(warning, extra_warning)) as warnings",
    ).drop("issue", "warning", "extra_warning")


_TREND = "case when {d} is null then '' when {d} > 1 then '(+)' when {d} < -1 then '(-)' else '(=)' end"
_LATEST_SQL = f"""(select * from (select *, row_number() over (partition by "table", scenario, format order by "timestamp" desc, run_id desc) as n
    from {RECORDS_SQL} r) x where n = 1)"""
_EXIT = "case validation_status when 'PASS' then 0 when 'SKIPPED' then 0 when 'WARNING' then 1 when 'DLQ' then 2 when 'ERROR' then 2 else 1 end"
_FIELDS = ", ".join('"table"' if f == "table" else '"timestamp"' if f == "timestamp" else f for f in EXPORT_FIELDS)


@register("run_records", f"select {_FIELDS} from {RECORDS_SQL} r")
def run_records(spark, sf_dir):
    return export_fields(records(spark, sf_dir))


@register("run_totals", f"""
    select run_id, floor(cast(sum(cast(round(quality_score * 10) as bigint)) as double) / count(*) + 0.5) / 10.0::double as mean_score,
           count(*) as tables, cast(sum(case when validation_status = 'DLQ' then 1 else 0 end) as bigint) as dlq,
           cast(sum(case when validation_status = 'WARNING' then 1 else 0 end) as bigint) as warnings,
           cast(sum(case when slm_status = 'SUCCESS' then 1 else 0 end) as bigint) as documented
    from {RECORDS_SQL} r group by run_id""")
def run_totals_query(spark, sf_dir):
    return run_totals(records(spark, sf_dir))


@register("dashboard_totals", f"""
    select count(distinct run_id) as runs, count(*) as records,
           floor(cast(sum(cast(round(quality_score * 10) as bigint)) as double) / count(*) + 0.5) / 10.0::double as mean_score
    from {RECORDS_SQL} r""")
def dashboard_totals_query(spark, sf_dir):
    return dashboard_totals(records(spark, sf_dir))


@register("worst_exit_codes", f"select run_id, max({_EXIT}) as exit_code from {RECORDS_SQL} r group by run_id")
def worst_exit_codes_query(spark, sf_dir):
    return worst_exit_codes(records(spark, sf_dir))


@register("score_trend", f"""
    select "table", scenario, format, last_score, previous_score, last_status, {_TREND.format(d='(last_score - previous_score)')} as trend
    from (select "table", scenario, format, max(case when n = 1 then quality_score end) as last_score,
                 max(case when n = 2 then quality_score end) as previous_score,
                 max(case when n = 1 then validation_status end) as last_status
          from (select *, row_number() over (partition by "table", scenario, format order by "timestamp" desc, run_id desc) as n
                from {RECORDS_SQL} r) x where n <= 2 group by 1, 2, 3) t""")
def score_trend_query(spark, sf_dir):
    return score_trend(records(spark, sf_dir))


@register("latest_runs", f"select {_FIELDS} from {_LATEST_SQL} r")
def latest_runs(spark, sf_dir):
    return export_fields(latest(records(spark, sf_dir)))


@register("score_evolution", f"""
    select "table", scenario, format, "timestamp", run_id, validation_status, quality_score, previous_score,
           {_TREND.format(d='(quality_score - previous_score)')} as trend
    from (select *, lag(quality_score) over (partition by "table", scenario, format order by "timestamp", run_id) as previous_score
          from {RECORDS_SQL} r) x""")
def score_evolution_query(spark, sf_dir):
    return score_evolution(records(spark, sf_dir)).select(
        *SERIES, "timestamp", "run_id", "validation_status", "quality_score", "previous_score", "trend")


@register("problem_lines", f"""
    with p as (select * from {RECORDS_SQL} r
               where validation_status in ('DLQ', 'WARNING') or issue is not null or warning is not null or extra_warning is not null),
         lines as (
           select run_id, "timestamp", format, 'ERR' as severity, issue as message from p where issue is not null
           union all select run_id, "timestamp", format, 'WARN', warning from p where warning is not null and warning not like '%DRAFT%'
           union all select run_id, "timestamp", format, 'WARN', extra_warning from p where extra_warning is not null)
    select p.run_id, p."timestamp", p."table", p.scenario, p.format, p.validation_status, l.severity, l.message
    from p left join lines l on p.run_id = l.run_id and p."timestamp" = l."timestamp" and p.format = l.format""")
def problem_lines_query(spark, sf_dir):
    return problem_lines(records(spark, sf_dir))


@register("documentation_status", f"""
    select cast(sum(case when slm_status = 'SUCCESS' then 1 else 0 end) as bigint) as documented,
           cast(sum(case when slm_status = 'SKIPPED' then 1 else 0 end) as bigint) as skipped,
           cast(sum(case when slm_status = 'ERROR' then 1 else 0 end) as bigint) as failed
    from {_LATEST_SQL} r""")
def documentation_status_query(spark, sf_dir):
    return documentation_status(records(spark, sf_dir))


@register("records_of_table", f"""
    select {_FIELDS} from {_LATEST_SQL} r where "table" = 'tb_F' and scenario = '1-URGENT'""")
def records_of_table(spark, sf_dir):
    return export_fields(select_records(records(spark, sf_dir), "tb_F", "1-URGENT", last_only=True))


@register("records_union", f"""
    select format, scenario, count(*) as records, cast(sum(rows_total) as bigint) as rows_total from {RECORDS_SQL} r group by format, scenario""")
def records_union(spark, sf_dir):
    """The histories of three formats, kept apart and put together again; one of them lacks a field."""
    base = records(spark, sf_dir)
    frames = [base.where(F.col("format") == f).drop(*(["slm_status"] if f == "fixed" else [])) for f in _FORMATS]
    return union_records(*frames).groupBy("format", "scenario").agg(
        F.count(F.lit(1)).alias("records"), F.sum("rows_total").alias("rows_total"))


@register("report_lines", f"""
    select run_id, "table", scenario, format, concat("table", '/', scenario, ' ', coalesce(validation_status, 'unknown'), ': score ', cast(quality_score as varchar),
        ', rows ', cast(rows_valid as varchar), ' of ', cast(rows_total as varchar), ', nulls ', cast(avg_null_pct as varchar), '%, duplicates ',
        cast(duplicate_count as varchar)) as line
    from {RECORDS_SQL} r""")
def report_lines_query(spark, sf_dir):
    return report_lines(records(spark, sf_dir))
