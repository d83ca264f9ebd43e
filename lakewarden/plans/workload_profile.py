"""Registered queries: profiles and most frequent values."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators.profile import documentation_summary, profile, profile_with_top, sketch_facts, top_values
from lakewarden.plans.workload import (
    COLUMNS, DIRTY_COLUMNS, DIRTY_ORDERS_SQL, dirty_orders, number_sql, percent_sql, register, round_sql, table, text_sql,
)


def profile_sql(source: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for pos, (name, kind) in enumerate(columns):
        text, number = text_sql(name, kind), number_sql(name, kind)
        parts.append(f"""
        select {pos} as pos, '{name}' as column_name, count(*) as n,
               sum(case when {name} is null or trim({text}) = '' then 1 else 0 end) as nulls,
               count(distinct {name}) as uniq,
               min({number}) as lo, max({number}) as hi, sum({number}) / nullif(count({number}), 0) as mean
        from {source} src""")
    return f"""
    select pos, column_name, 'VARCHAR' as dtype, cast(n as bigint) as "rows", cast(coalesce(nulls, 0) as bigint) as null_count,
           {percent_sql('coalesce(nulls, 0)', 'n')} as null_pct, cast(uniq as bigint) as unique_count,
           {round_sql('lo', 4)} as min_value, {round_sql('hi', 4)} as max_value, {round_sql('mean', 4)} as mean_value
    from ({' union all '.join(parts)}) facts"""


def top_sql(source: str, columns: list[tuple[str, str]], k: int = 5) -> str:
    parts = []
    for pos, (name, kind) in enumerate(columns):
        text = text_sql(name, kind)
        parts.append(f"""
        select {pos} as pos, '{name}' as column_name, value, cast(cnt as bigint) as cnt,
               cast(row_number() over (order by cnt desc, value) as integer) as value_rank
        from (select {text} as value, count(*) as cnt from {source} src where {name} is not null group by 1) c{pos}""")
    return f"select pos, column_name, value_rank, value, cnt from ({' union all '.join(parts)}) t where value_rank <= {k}"


for _name, _columns in COLUMNS.items():
    _names = [c for c, _ in _columns]
    register(f"profile_{_name}", profile_sql(_name, _columns))(
        lambda spark, sf, n=_name, c=_names: profile(table(spark, sf, n), c))

for _name in ("customer", "orders", "lineitem", "part", "supplier", "events", "documents", "pages", "conversations", "labels"):
    _columns = COLUMNS[_name]
    register(f"top_values_{_name}", top_sql(_name, _columns))(
        lambda spark, sf, n=_name, c=[x for x, _ in _columns]: top_values(table(spark, sf, n), c))


@register("profile_dirty_orders", profile_sql(DIRTY_ORDERS_SQL, DIRTY_COLUMNS))
def profile_dirty_orders(spark, sf_dir):
    return profile(dirty_orders(spark, sf_dir))


@register("top_values_dirty_orders", top_sql(DIRTY_ORDERS_SQL, DIRTY_COLUMNS))
def top_values_dirty_orders(spark, sf_dir):
    return top_values(dirty_orders(spark, sf_dir))


# Keys of 16 digits, numbers beyond any bigint, NaN and infinities, made from the orders.
WIDE_NUMBERS = {
    "card": ("int", "4539578763620000 + o_orderkey % 9973"),
    "far": ("double", "case o_orderkey % 4 when 0 then 1e17 when 1 then -1e17 when 2 then cast(o_custkey as double) / 8 end"),
    "odd": ("double", "case o_orderkey % 4 when 0 then cast('NaN' as double) when 1 then cast('Infinity' as double) "
                      "when 2 then cast('-Infinity' as double) else cast(o_custkey as double) end"),
    "card_text": ("text", "cast(4539578763620000 + o_orderkey % 9973 as varchar(20))"),
}
_WIDE_SOURCE = f"(select {', '.join(f'{e} as {n}' for n, (_, e) in WIDE_NUMBERS.items())} from orders)"
_WIDE_COLUMNS = [(n, k) for n, (k, _) in WIDE_NUMBERS.items()]


def _wide_sql() -> str:
    finite = "(select card, far, case when isfinite(odd) then odd end as number, odd, card_text from {} w)".format(_WIDE_SOURCE)
    parts = []
    for pos, (name, kind) in enumerate(_WIDE_COLUMNS):
        number = "number" if name == "odd" else number_sql(name, kind)
        parts.append(f"select {pos} as pos, '{name}' as column_name, count(*) as n, count({name}) as filled, "
                     f"min({number}) as lo, max({number}) as hi from {finite} s")
    return f"""
    select pos, column_name, cast(n as bigint) as "rows", cast(n - filled as bigint) as null_count,
           {round_sql('lo', 4)} as min_value, {round_sql('hi', 4)} as max_value
    from ({' union all '.join(parts)}) p"""


def _wide_numbers(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {n}" for n, (_, e) in WIDE_NUMBERS.items()])


@register("profile_wide_numbers", _wide_sql())
def profile_wide_numbers(spark, sf_dir):
    return profile(_wide_numbers(spark, sf_dir)).select("pos", "column_name", "rows", "null_count", "min_value", "max_value")


@register("sketch_wide_numbers", _wide_sql())
def sketch_wide_numbers(spark, sf_dir):
    return sketch_facts(_wide_numbers(spark, sf_dir)).select("pos", "column_name", "rows", "null_count", "min_value", "max_value")


@register("profile_sketch_lineitem")
def profile_sketch_lineitem(spark, sf_dir):
    """Approximate by design, so it has no SQL twin; tests bound its error."""
    return sketch_facts(table(spark, sf_dir, "lineitem")).drop("missing_count")


@register("sketch_exact_parts_lineitem", f"""
    select pos, column_name, "rows", null_count, null_pct, min_value, max_value, mean_value
    from ({profile_sql('lineitem', COLUMNS['lineitem'])}) p""")
def sketch_exact_parts_lineitem(spark, sf_dir):
    """The part of the sketch profile that is exact."""
    return sketch_facts(table(spark, sf_dir, "lineitem")).select(
        "pos", "column_name", "rows", "null_count", "null_pct", "min_value", "max_value", "mean_value")


@register("documentation_summary", f"""
    select p.pos, p.column_name, p.null_pct, p.unique_count, p.min_value, p.max_value, p.mean_value,
           t.top3, case when p.null_pct > 30 then 1 else 0 end as is_anomaly
    from ({profile_sql(DIRTY_ORDERS_SQL, DIRTY_COLUMNS)}) p
    left join (select pos, string_agg(value || '=' || cast(cnt as varchar), ';' order by value_rank) as top3
               from ({top_sql(DIRTY_ORDERS_SQL, DIRTY_COLUMNS, 3)}) x group by pos) t on p.pos = t.pos""")
def documentation(spark, sf_dir):
    summary = documentation_summary(profile_with_top(dirty_orders(spark, sf_dir)))
    return summary.select(
        "pos", "column_name", "null_pct", "unique_count", "min_value", "max_value", "mean_value",
        F.array_join(F.transform("top_values", lambda t: F.concat(t["value"], F.lit("="), t["cnt"].cast("string"))), ";").alias("top3"),
        F.when(F.col("anomaly").isNotNull(), 1).otherwise(0).alias("is_anomaly"))
