"""Infer a draft contract from data: types, nullability, keys, flags, observed rules.

Every test is a fixed-size aggregate over distinct values, so the whole table is looked at
(no sample needed) and nothing is collected per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from lakewarden.contracts import Contract
from lakewarden.functions.coercion import DATE_FORMATS, boolean_bit_sql, is_boolean_domain_sql, matches_date_sql
from lakewarden.functions.flags import regulatory_flags
from lakewarden.functions.naming import snake_name
from lakewarden.functions.numeric import INFINITY_PATTERN
from lakewarden.functions.sqltext import literals
from lakewarden.operators.profile import top_values
from lakewarden.operators.values import column_refs, empty_positions, name_columns, value_counts

KEY_PREFIX_PATTERN = r"^(id_|cd_|nr_|cod_|key_|pk_)"
DOMAIN_LIMIT = 20
MIXED_RANGE = (0.3, 0.95)
_INT64 = float(2**63)


def column_evidence(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """What each column's values look like; one row per column, whatever the table size."""
    refs = column_refs(df, columns)
    zero_row = empty_positions(df, len(refs)).selectExpr(
        "pos", "cast(null as string) as value", "cast(null as double) as number", "true as missing", "0L as cnt")
    counts = (value_counts(df, columns, digest=True).select("pos", "value", "number", "missing", "cnt").unionByName(zero_row)
              .selectExpr("*", "not missing and value <> '' as filled"))
    dates = [f"coalesce(bool_and(if(filled, number is null and {matches_date_sql('value', shape, pattern)}, null)), false) as date_{i}"
             for i, (_, shape, pattern) in enumerate(DATE_FORMATS)]
    evidence = counts.groupBy("pos").agg(*[F.expr(e) for e in (
        "sum(cnt) as rows",
        "sum(if(missing, 0L, cnt)) as non_null",
        "count_if(not missing) as distinct_non_null",
        "sum(if(filled, cnt, 0L)) as filled",
        "count_if(filled) as distinct_filled",
        f"sum(if(filled and (number is not null or trim(value) rlike r'{INFINITY_PATTERN}'), cnt, 0L)) as numeric_rows",
        f"coalesce(bit_or(if(filled, {boolean_bit_sql('value')}, null)), 0L) as boolean_bits",
        *dates,
        "coalesce(bool_and(if(filled, number is not null, null)), false) as all_numbers",
        f"coalesce(bool_and(if(filled, coalesce(number = floor(number) and abs(number) < {_INT64}D, false), null)), false) as all_whole",
        "min(if(filled, number, null)) as lo",
        "max(if(filled, number, null)) as hi",
    )])
    return name_columns(evidence, [r.name for r in refs], [c for c in evidence.columns if c != "pos"])


def infer_columns(df: DataFrame, columns: list[str] | None = None, normalize=snake_name) -> DataFrame:
    """Draft column contracts: one row per column.

    The column name is normalised at plan time; names are schema, not data.
    """
    names = [r.name for r in column_refs(df, columns)]
    formats = " ".join(f"when date_{i} then '{fmt}'" for i, (fmt, _, _) in enumerate(DATE_FORMATS))
    typed = column_evidence(df, columns).selectExpr(
        "*", f"get({literals(normalize(n) for n in names)}, pos) as name", f"case {formats} end as found_format",
        "numeric_rows / nullif(filled, 0) as share",
    ).selectExpr("*", f"""case when filled = 0 then 'string' when {is_boolean_domain_sql('boolean_bits')} then 'boolean'
        when found_format is not null then 'date' when all_whole then 'integer' when all_numbers then 'float'
        else 'string' end as type""")
    drafted = typed.selectExpr(
        "pos", "name", "column_name as source_name", "type",
        "filled < rows as nullable",
        f"name rlike r'{KEY_PREFIX_PATTERN}' and non_null > 0 and distinct_non_null = non_null as primary_key",
        "if(type = 'date', found_format, null) as date_format",
        f"type = 'string' and coalesce(share > {MIXED_RANGE[0]} and share < {MIXED_RANGE[1]}, false) as mixed",
        "if(type in ('integer', 'float'), lo, null) as range_min",
        "if(type in ('integer', 'float'), hi, null) as range_max",
        f"if(type = 'string' and filled > 0 and distinct_filled <= {DOMAIN_LIMIT}, distinct_filled, null) as domain_size",
    )
    return drafted.withColumn("regulatory_flags", regulatory_flags(F.col("name"), F.col("source_name")))


def observed_domains(df: DataFrame, columns: list[str] | None = None, keep: int = 5) -> DataFrame:
    """Most frequent values of the string columns whose domain is small enough to be a rule."""
    drafted = infer_columns(df, columns).filter(F.col("domain_size").isNotNull())
    tops = top_values(df, columns, k=keep + 1).filter(F.col("value") != "")
    # The empty string is not part of a domain; one spare rank makes up for it.
    joined = tops.join(drafted.select("pos", "domain_size"), "pos")
    order = W.partitionBy("pos").orderBy("value_rank")
    return (joined.withColumn("value_rank", F.row_number().over(order)).filter(F.col("value_rank") <= keep)
            .select("pos", "column_name", "domain_size", "value_rank", "value", "cnt"))


def draft_contract(df: DataFrame, table: str, fmt: str = "csv", delimiter: str | None = None,
                   encoding: str = "utf-8", notes: dict[str, list[str]] | None = None,
                   normalize=snake_name) -> Contract:
    """Draft contract of a table: collects one small row per column, never data."""
    drafted = sorted(infer_columns(df, normalize=normalize).collect(), key=lambda r: r["pos"])
    # Only columns with a handful of distinct values are asked for their most frequent ones.
    small = [r["source_name"] for r in drafted if r["domain_size"]]
    domains: dict[str, list[tuple[int, str]]] = {}
    for r in (top_values(df, small, k=6).filter("value <> ''").collect() if small else []):
        domains.setdefault(r["column_name"], []).append((r["value_rank"], r["value"]))
    columns = []
    for r in drafted:
        rules = []
        if r["range_min"] is not None:
            rules.append(f"Range: {r['range_min']:.4g} to {r['range_max']:.4g}")
        if r["domain_size"]:
            listed = [v for _, v in sorted(domains.get(r["source_name"], []))][:5]
            rules.append(f"Domain ({r['domain_size']} values): {listed}")
        if r["date_format"]:
            rules.append(f"Detected format: {r['date_format']}")
        if r["mixed"]:
            rules.append("# TODO: mixed values, check whether this is intended")
        collapsed = (notes or {}).get(r["source_name"], [])
        columns.append({
            "name": r["name"],
            "type": "string" if collapsed else r["type"],
            "nullable": True if collapsed else r["nullable"],
            "primary_key": False if collapsed else r["primary_key"],
            "description": f"# TODO: describe {r['name']}",
            "regulatory_flags": r["regulatory_flags"],
            "business_rules": collapsed or rules,
        })
    return Contract.of(draft_document(table, columns, fmt, delimiter, encoding))


def draft_document(table: str, columns: list[dict], fmt: str, delimiter: str | None = None,
                   encoding: str = "utf-8", status: str = "DRAFT") -> dict:
    """Contract document with everything a person still has to fill in marked."""
    flags = {f for c in columns for f in c["regulatory_flags"]}
    tags = [t for t, hit in (("LGPD", "LGPD_SENSITIVE" in flags), ("SCR", "SCR_CANDIDATE" in flags),
                             ("BACEN_4658", bool(flags))) if hit]
    return {
        "table": table,
        "description": f"# TODO: describe {table}",
        "owner": "# TODO: who answers for this table",
        "version": "1.0.0",
        "manifest_status": status,
        "source": {
            "system": "# TODO: where it comes from", "format": fmt, "encoding": encoding,
            "os": "# TODO: platform that writes the files", "delimiter": delimiter,
            "update_frequency": "# TODO: how often it arrives",
            "contact": "# TODO: whom to ask about the files",
        },
        "regulatory": {
            "tags": tags or ["# TODO: which rules apply"],
            "data_classification": "confidential" if "LGPD_SENSITIVE" in flags else "internal",
            "retention_years": None,
        },
        "steward": {"name": "# TODO: person", "email": "# TODO: address"},
        "business_context": "# TODO: what it is used for",
        "tolerance": {"max_null_pct": 20, "allow_duplicates": False},
        "dependencies": [],
        "sample_queries": [],
        "schema": columns,
    }


def without_contract(landed: DataFrame, registry: DataFrame) -> DataFrame:
    """Landed tables that no contract covers yet; only these need inference.

    Repeated registry entries are folded per task before the join, so none of them is hot.
    """
    return landed.join(registry.select("table").distinct(), "table", "left_anti")
