"""Column profiles: nulls, distinct values, numeric range and mean, most frequent values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from lakewarden.functions.numeric import finite_number_sql, percent_sql, round_sql
from lakewarden.functions.sqltext import ident
from lakewarden.functions.text import is_blank_sql
from lakewarden.operators.values import (
    COLUMNS_PER_BRANCH, column_refs, empty_positions, name_columns, text_sql, value_counts,
)

# A profile whose null share exceeds this is marked in the documentation summary.
NULL_ALERT_PCT = 30.0

FACTS_DDL = (
    "pos int, column_name string, dtype string, rows bigint, null_count bigint, null_pct double, unique_count bigint, "
    "min_value double, max_value double, mean_value double, missing_count bigint"
)
STATS = ["dtype", "rows", "null_count", "null_pct", "unique_count", "min_value", "max_value", "mean_value"]


def _named(stats: DataFrame, names: list[str]) -> DataFrame:
    return name_columns(stats, names, [
        "'VARCHAR' as dtype", "rows", "null_count", f"{percent_sql('null_count', 'rows')} as null_pct", "unique_count",
        f"{round_sql('lo', 4)} as min_value", f"{round_sql('hi', 4)} as max_value",
        f"{round_sql('total / nullif(numbers, 0)', 4)} as mean_value", "missing_count",
    ])


def column_facts(df: DataFrame, columns: list[str] | None = None, digest: bool = True) -> DataFrame:
    """Exact statistics of every column, one row per column.

    The second grouping has one group per column, but only after map-side combination has
    brought each task down to one row per column.
    """
    names = [r.name for r in column_refs(df, columns)]
    counts = value_counts(df, columns, digest).select("pos", "number", "missing", "blank", "cnt")
    zero = empty_positions(df, len(names)).selectExpr(
        "pos", "cast(null as double) as number", "true as missing", "true as blank", "0L as cnt")
    stats = counts.unionByName(zero).groupBy("pos").agg(*[F.expr(e) for e in (
        "sum(cnt) as rows",
        "sum(if(blank, cnt, 0)) as null_count",
        "sum(if(missing, cnt, 0)) as missing_count",
        "count_if(not missing) as unique_count",
        "min(number) as lo",
        "max(number) as hi",
        "sum(number * cnt) as total",
        "sum(if(number is not null, cnt, 0)) as numbers",
    )])
    return _named(stats, names)


def sketch_facts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The same statistics with an approximate distinct count and no data shuffle at all.

    Every task sends a single row per aggregation. This is the form for very large tables where the distinct count does not need to be exact.
    """
    refs = column_refs(df, columns)
    parts = [_sketch_part(df, refs[i:i + COLUMNS_PER_BRANCH], distinct)
             for i in range(0, len(refs), COLUMNS_PER_BRANCH) for distinct in (False, True)]
    # Two rows per column, plain figures and distinct sketch, become one.
    merged = reduce(DataFrame.unionByName, parts).groupBy("pos").agg(*[F.expr(f"max({c}) as {c}") for c in (
        "rows", "null_count", "missing_count", "unique_count", "lo", "hi", "total", "numbers")])
    return _named(merged, [r.name for r in refs])


def _sketch_part(df: DataFrame, refs: list, distinct: bool) -> DataFrame:
    """One aggregation of one row per task: the plain figures of these columns, or their distinct sketches.

    Each column's number and blank flag are made once, below the aggregation.
    """
    cells, aggs, rows = [], ["count(1) as n"], []
    for r in refs:
        col, text, pos = ident(r.name), text_sql(df, r.name), r.pos
        numeric = r.kind in ("string", "bigint", "double")
        fields = {"rows": "n"} if not distinct else {}
        if distinct:
            cells.append(f"{text if r.kind == 'string' else col} as v{pos}")
            aggs.append(f"approx_count_distinct(v{pos}) as u{pos}")
            fields["unique_count"] = f"u{pos}"
        else:
            cells.append(f"{col} is null as m{pos}")
            aggs.append(f"count_if(m{pos}) as m{pos}")
            fields["missing_count"] = fields["null_count"] = f"m{pos}"
            if r.kind == "string":
                cells.append(f"{is_blank_sql(text)} as b{pos}")
                aggs.append(f"count_if(b{pos}) as b{pos}")
                fields["null_count"] = f"b{pos}"
            if numeric:
                cells.append(f"{finite_number_sql(r.kind, text if r.kind == 'string' else col)} as x{pos}")
                aggs += [f"{f}(x{pos}) as {n}{pos}" for f, n in (("min", "l"), ("max", "h"), ("sum", "s"), ("count", "c"))]
                fields |= {"lo": f"l{pos}", "hi": f"h{pos}", "total": f"s{pos}", "numbers": f"c{pos}"}
        typed = {"rows": "bigint", "null_count": "bigint", "missing_count": "bigint", "unique_count": "bigint",
                 "lo": "double", "hi": "double", "total": "double", "numbers": "bigint"}
        rows.append("named_struct('pos', %d, %s)" % (pos, ", ".join(f"'{k}', cast({fields.get(k, 'null')} as {t})" for k, t in typed.items())))
    return df.selectExpr(*cells).agg(*[F.expr(a) for a in aggs]).selectExpr(f"inline(array({', '.join(rows)}))")


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True, digest: bool = True) -> DataFrame:
    """One row per column: dtype, rows, nulls, distinct values, numeric min, max and mean."""
    facts = column_facts(df, columns, digest) if exact else sketch_facts(df, columns)
    return facts.select("pos", "column_name", *STATS)


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """The k most frequent non-null values of each column, ties by value.

    The rank filter becomes a per-task group limit, so each task ships at most k rows per
    column to the final ranking, however many distinct values there are.
    """
    names = [r.name for r in column_refs(df, columns)]
    # NULL is one value per column and sorts last, so it can be dropped after ranking. Dropping
    # it before would change the scan below and keep the shuffle from being shared.
    order = W.partitionBy("pos").orderBy("missing", F.desc("cnt"), "value")
    ranked = (
        value_counts(df, columns)
        .withColumn("value_rank", F.row_number().over(order))
        .filter((F.col("value_rank") <= k) & ~F.col("missing"))
    )
    return name_columns(ranked, names, ["value_rank", "value", "cnt"])


def sketch_top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """Most frequent values from a bounded sketch: no shuffle of values, counts are estimates."""
    refs = column_refs(df, columns)
    one = df.agg(*[F.expr(f"approx_top_k({text_sql(df, r.name)}, {int(k)}) as t{r.pos}") for r in refs])
    listed = ", ".join(f"named_struct('pos', {r.pos}, 'items', t{r.pos})" for r in refs)
    rows = one.selectExpr(f"inline(array({listed}))").selectExpr("pos", "posexplode(items) as (i, item)")
    rows = rows.selectExpr("pos", "i + 1 as value_rank", "item.item as value", "item.count as cnt").filter("value is not null")
    return name_columns(rows, [r.name for r in refs], ["value_rank", "value", "cnt"])


def profile_with_top(df: DataFrame, columns: list[str] | None = None, k: int = 5, exact: bool = True) -> DataFrame:
    """Profile plus an array of the top values; the shuffle of the value counts is shared."""
    tops = top_values(df, columns, k) if exact else sketch_top_values(df, columns, k)
    # At most k entries per column by construction.
    packed = tops.groupBy("pos").agg(
        F.array_sort(F.collect_list(F.struct("value_rank", "value", "cnt"))).alias("top_values")
    )
    # Both sides count whole values here, so that one shuffle serves both.
    return profile(df, columns, exact, digest=False).join(packed, "pos", "left")


def documentation_summary(profiled: DataFrame, keep: int = 3, alert_pct: float = NULL_ALERT_PCT) -> DataFrame:
    """What a documentation step gets to see of each column of profile_with_top()."""
    return profiled.select(
        "pos", "column_name", "dtype", "null_pct", "unique_count", "min_value", "max_value", "mean_value",
        F.slice("top_values", 1, keep).alias("top_values"),
        F.when(
            F.col("null_pct") > alert_pct,
            F.concat(F.lit("null_pct "), F.col("null_pct").cast("string"),
                     F.lit(f"% above the limit of {alert_pct:g}%")),
        ).alias("anomaly"),
    )
