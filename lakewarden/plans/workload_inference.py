"""Registered queries: inferred types, rules, flags, names and codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.functions.codes import (
    BINARY_CODES, CATALOG_BOOLEAN_FORMATS, CATALOG_FORMAT_PREFIXES, FIXED_WIDTH_CODES, exit_code, fixed_width_type,
)
from lakewarden.functions.coercion import BOOLEAN_DOMAINS, DATE_FORMATS
from lakewarden.functions.flags import FLAG_PATTERNS, regulatory_flags, table_tags
from lakewarden.functions.naming import base_table_name, json_path_name, snake_case, snake_name
from lakewarden.operators.govern import catalog_columns
from lakewarden.operators.infer import DOMAIN_LIMIT, infer_columns, observed_domains, without_contract
from lakewarden.plans.workload import COLUMNS, DIRTY_COLUMNS, DIRTY_ORDERS_SQL, dirty_orders, number_sql, register, table, text_sql
from lakewarden.sources.tabular import estimated_rows


def flags_sql(text: str) -> str:
    parts = [f"case when regexp_matches({text}, '{'|'.join(w)}') then '{f}' end" for f, w in FLAG_PATTERNS.items()]
    return f"concat_ws(',', {', '.join(parts)})"


def infer_sql(source: str, columns: list[tuple[str, str]]) -> str:
    """One row per column with the inferred contract facts."""
    parts = []
    for pos, (name, kind) in enumerate(columns):
        v = text_sql(name, kind)
        tidy = snake_name(name)
        keyish = tidy.startswith(("id_", "cd_", "nr_", "cod_", "key_", "pk_"))
        dates = ", ".join(
            f"coalesce(bool_and(regexp_matches(t, '{shape}') and try_strptime(t, '{fmt}') is not null), false) as d{i}"
            for i, (fmt, shape, _) in enumerate(DATE_FORMATS))
        domains = " or ".join(
            "(" + f"count(distinct lower(t)) = {len(d)} and bool_and(lower(t) in ({', '.join(repr(w) for w in d)}))" + ")"
            for d in BOOLEAN_DOMAINS)
        number = number_sql("t", "text")
        parts.append(f"""
        select {pos} as pos, '{tidy}' as name, '{name}' as source_name,
               n, non_null, uniq_non_null, {str(keyish).lower()} as keyish, f.*, {flags_sql(f"'{tidy.lower()} {name.lower()}'")} as flags
        from (select count(*) as n, count({name}) as non_null, count(distinct {name}) as uniq_non_null from {source} src) a
        join (select count(*) as filled, count(distinct raw) as uniq, ({domains}) as is_bool, {dates},
                   coalesce(bool_and({number} is not null), false) as all_num,
                   coalesce(bool_and(coalesce({number} = floor({number}) and abs({number}) < 9223372036854775808.0::double, false)), false) as all_whole,
                   avg(case when {number} is not null or regexp_matches(lower(t), '^[+-]?inf(inity)?$') then 1.0::double else 0.0::double end) as share,
                   min({number}) as lo, max({number}) as hi
            from (select {v} as raw, trim({v}) as t from {source} src where {name} is not null and {v} <> '') s) f on true""")
    fmt = " ".join(f"when d{i} then '{f}'" for i, (f, _, _) in enumerate(DATE_FORMATS))
    return f"""
    select pos, name, source_name, type, nullable, primary_key, case when type = 'date' then fmt end as date_format,
           type = 'string' and coalesce(share > 0.3 and share < 0.95, false) as mixed,
           case when type in ('integer', 'float') then lo end as range_min,
           case when type in ('integer', 'float') then hi end as range_max,
           cast(case when type = 'string' and filled > 0 and uniq <= {DOMAIN_LIMIT} then uniq end as bigint) as domain_size, flags
    from (select *, case when filled = 0 then 'string' when is_bool then 'boolean' when fmt is not null then 'date'
                 when all_whole then 'integer' when all_num then 'float' else 'string' end as type,
                 filled < n as nullable, keyish and non_null > 0 and non_null = uniq_non_null as primary_key
          from (select *, case {fmt} end as fmt from ({' union all '.join(parts)}) e) g) h"""


def _flat(df):
    return df.withColumn("flags", F.array_join("regulatory_flags", ",")).drop("regulatory_flags")


for _name in ("customer", "orders", "lineitem", "part", "supplier", "events", "nation", "documents", "labels", "conversations"):
    _cols = COLUMNS[_name]
    register(f"infer_types_{_name}", infer_sql(_name, _cols))(
        lambda spark, sf, n=_name, c=[x for x, _ in _cols]: _flat(infer_columns(table(spark, sf, n), c)))


@register("infer_types_dirty_orders", infer_sql(DIRTY_ORDERS_SQL, DIRTY_COLUMNS))
def infer_types_dirty_orders(spark, sf_dir):
    return _flat(infer_columns(dirty_orders(spark, sf_dir)))


def domain_sql(source: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for pos, (name, kind) in enumerate(columns):
        v = text_sql(name, kind)
        parts.append(f"""
        select {pos} as pos, '{name}' as column_name, value, cast(cnt as bigint) as cnt,
               cast(row_number() over (order by cnt desc, value) as integer) as value_rank
        from (select {v} as value, count(*) as cnt from {source} src where {name} is not null and {v} <> '' group by 1) c{pos}""")
    return f"""
    select t.pos, t.column_name, i.domain_size, t.value_rank, t.value, t.cnt
    from ({' union all '.join(parts)}) t join ({infer_sql(source, columns)}) i on t.pos = i.pos
    where i.domain_size is not null and t.value_rank <= 5"""


for _name in ("part", "orders", "events"):
    register(f"domain_rules_{_name}", domain_sql(_name, COLUMNS[_name]))(
        lambda spark, sf, n=_name, c=[x for x, _ in COLUMNS[_name]]: observed_domains(table(spark, sf, n), c))


@register("domain_rules_dirty_orders", domain_sql(DIRTY_ORDERS_SQL, DIRTY_COLUMNS))
def domain_rules_dirty_orders(spark, sf_dir):
    return observed_domains(dirty_orders(spark, sf_dir))


_FLAG_TEXT = "lower(concat(source, ' ', text))"


@register("regulatory_flags_documents", f"select doc_id, {flags_sql(_FLAG_TEXT)} as flags from documents")
def regulatory_flags_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(regulatory_flags(F.col("source"), F.col("text")), ",").alias("flags"))


def _tags_sql(source: str, by: str, text: str) -> str:
    lgpd, scr, restricted = (f"bool_or(regexp_matches({text}, '{'|'.join(FLAG_PATTERNS[f])}'))"
                             for f in ("LGPD_SENSITIVE", "SCR_CANDIDATE", "RESTRICTED"))
    return f"""
    select {by} as "table", concat_ws(',', case when a then 'LGPD' end, case when b then 'SCR' end, case when a or b or c then 'BACEN_4658' end) as tags,
           case when a then 'confidential' else 'internal' end as data_classification
    from (select {by}, {lgpd} as a, {scr} as b, {restricted} as c from {source} group by {by}) g"""


@register("table_tags_parts", _tags_sql("part", "p_brand", "lower(concat(p_name, ' ', p_type))"))
def table_tags_parts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    cols = part.select(F.col("p_brand").alias("table"), regulatory_flags(F.col("p_name"), F.col("p_type")).alias("regulatory_flags"))
    return table_tags(cols).withColumn("tags", F.array_join("tags", ","))


@register("table_tags_documents", _tags_sql("documents", "lang", _FLAG_TEXT))
def table_tags_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cols = docs.select(F.col("lang").alias("table"), regulatory_flags(F.col("source"), F.col("text")).alias("regulatory_flags"))
    return table_tags(cols).withColumn("tags", F.array_join("tags", ","))


# Raw names made from the data: camel case, spaces, hyphens, punctuation, leading digits.
_RAW_NAMES = """(select 'p' || cast(p_partkey as string) as id, concat(' CD ', p_name, '-', p_brand) as raw from part
    union all select 'q' || cast(p_partkey as string), concat('Vl', p_brand, 'CPFCliente', p_type, '/', p_name) from part
    union all select 'u' || cast(page_id as string), url from pages
    union all select 'c' || cast(c_custkey as string), concat('__', c_name, '__') from customer) n"""


def _regex_chain(expr: str, pairs: list[tuple[str, str]]) -> str:
    for pattern, repl in pairs:
        expr = f"regexp_replace({expr}, '{pattern}', '{repl}', 'g')"
    return expr


_SNAKE_SQL = _regex_chain(
    "lower(" + _regex_chain("trim(raw)", [(r"[ \-]", "_"), (r"([A-Z]+)([A-Z][a-z])", r"\1_\2"), (r"([a-z\d])([A-Z])", r"\1_\2"),
                                          (r"[^\w]", "_")]) + ")", [("_+", "_"), ("^_|_$", "")])


def _raw_names(spark, sf_dir):
    for name in ("part", "pages", "customer"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"raw_names_{name}")
    text = _RAW_NAMES
    for name in ("part", "pages", "customer"):
        text = text.replace(f"from {name}", f"from raw_names_{name}")
    return spark.sql(f"select * from {text}")


@register("snake_case_names", f"select id, raw, {_SNAKE_SQL} as name from {_RAW_NAMES}")
def snake_case_names(spark, sf_dir):
    return _raw_names(spark, sf_dir).withColumn("name", snake_case(F.col("raw")))


_PART_SQL = _regex_chain("lower(trim(x))", [(r"[^\w]", "_"), ("_+", "_"), ("^_|_$", "")])


@register("json_path_names", f"""
    select page_id, array_to_string(list_transform(string_split(replace(url, '/', '__'), '__'), lambda x: {_PART_SQL}), '__') as name
    from pages""")
def json_path_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", json_path_name(F.replace(F.col("url"), F.lit("/"), F.lit("__"))).alias("name"))


_CONTRACT_NAME = """concat('tb_', source, case when doc_id % 3 = 0 then '_non_breaking' when doc_id % 3 = 1 then '_breaking' else '' end, '.yaml')"""


@register("base_table_names", f"""
    select replace(split_part(split_part(contract_name, '_non_breaking', 1), '_breaking', 1), '.yaml', '') as table_name, count(*) as contracts
    from (select {_CONTRACT_NAME} as contract_name from documents) d group by 1""")
def base_table_names(spark, sf_dir):
    names = table(spark, sf_dir, "documents").select(F.expr(_CONTRACT_NAME).alias("contract_name"))
    return names.groupBy(base_table_name(F.col("contract_name")).alias("table_name")).agg(F.count(F.lit(1)).alias("contracts"))


# A column catalog: each order is a table, each line a column.
_FORMATS = ["BEST12.", "COMMA10.2", "DATE9.", "DATETIME19.", "$CHAR20.", "YESNO.", "Z8.", "DDMMYY10.", "TOD8.", "XYZ.", "PCT5.2", "", "YN1."]
_CATALOG = {
    '"table"': "concat('tb_', cast(l_orderkey as string))",
    "pos": "l_linenumber - 1",
    "name": "concat(case when l_partkey % 3 = 0 then 'CD ' when l_partkey % 3 = 1 then 'vlRenda' else 'nm-' end, cast(l_partkey as string))",
    "label": "case when l_suppkey % 4 = 0 then '' when l_suppkey % 4 = 1 then 'Nome do cliente' else concat('Coluna ', l_returnflag) end",
    "format": "case l_partkey % 13 " + " ".join(f"when {i} then '{f}'" for i, f in enumerate(_FORMATS)) + " end",
    "storage": "case when l_returnflag = 'R' then 'character' else 'numeric' end",
}
_CLEAN = "trim(regexp_replace(lower(format), '[0-9.]', '', 'g'), '$')"
_CATALOG_TYPE = ("case when storage = 'character' then 'string' when " + _CLEAN
                 + f" in ({', '.join(repr(b) for b in CATALOG_BOOLEAN_FORMATS)}) then 'boolean' "
                 + " ".join("when " + " or ".join(f"starts_with({_CLEAN}, '{p}')" for p in ps) + f" then '{t}'"
                            for t, ps in CATALOG_FORMAT_PREFIXES)
                 + " else 'float' end")
_CATALOG_NAME = _SNAKE_SQL.replace("raw", "name")


@register("catalog_columns", f"""
    with cat as (select {', '.join(f'{e} as {n}' for n, e in _CATALOG.items())} from lineitem)
    select "table", pos, {_CATALOG_NAME} as name, {_CATALOG_TYPE} as type,
           not (pos = 0 and regexp_matches({_CATALOG_NAME}, 'cd_|id_|nr_|cod')) as nullable,
           (pos = 0 and regexp_matches({_CATALOG_NAME}, 'cd_|id_|nr_|cod')) as primary_key,
           coalesce(nullif(label, ''), '# TODO: describe ' || {_CATALOG_NAME}) as description,
           {flags_sql(f"lower(concat({_CATALOG_NAME}, ' ', label))")} as flags
    from cat""")
def catalog_columns_query(spark, sf_dir):
    cat = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} as {n.replace(chr(34), '`')}" for n, e in _CATALOG.items()])
    return _flat(catalog_columns(cat)).drop("sas_label", "business_rules")


_CODES = [c for codes in FIXED_WIDTH_CODES.values() for c in codes] + ["unknown"]
_CODE = f"case p_partkey % {len(_CODES)} " + " ".join(f"when {i} then ' {c.upper()}'" for i, c in enumerate(_CODES)) + " end"


@register("fixed_width_types", f"""
    select p_partkey, lower(trim(code)) as code,
           case {' '.join(f"when lower(trim(code)) in ({', '.join(repr(c) for c in cs)}) then '{t}'" for t, cs in FIXED_WIDTH_CODES.items())} else 'string' end as type,
           lower(trim(code)) in ({', '.join(repr(c) for c in BINARY_CODES)}) as is_binary
    from (select p_partkey, {_CODE} as code from part) p""")
def fixed_width_types(spark, sf_dir):
    codes = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_CODE} as code")
    return codes.select("p_partkey", F.lower(F.trim("code")).alias("code"), fixed_width_type(F.col("code")).alias("type"),
                        F.lower(F.trim("code")).isin(BINARY_CODES).alias("is_binary"))


_STATUS = "case o_orderkey % 6 when 0 then 'PASS' when 1 then 'SKIPPED' when 2 then 'WARNING' when 3 then 'DLQ' when 4 then 'ERROR' else 'ODD' end"


@register("exit_codes", f"""
    select status, case status when 'PASS' then 0 when 'SKIPPED' then 0 when 'WARNING' then 1 when 'DLQ' then 2 when 'ERROR' then 2 else 1 end as exit_code,
           count(*) as n from (select {_STATUS} as status from orders) o group by 1, 2""")
def exit_codes(spark, sf_dir):
    return (table(spark, sf_dir, "orders").select(F.expr(_STATUS).alias("status"))
            .groupBy("status", exit_code(F.col("status")).alias("exit_code")).agg(F.count(F.lit(1)).alias("n")))


@register("estimated_rows_documents", """
    select greatest(count(*) - 1, 0) as rows_estimate from (select unnest(string_split(text, chr(10))) as line from documents) l""")
def estimated_rows_documents(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return estimated_rows(lines)


@register("tables_without_contract", """
    select cast(c_custkey as varchar) as "table" from customer where cast(c_custkey as varchar) not in (select cast(o_custkey as varchar) from orders)""")
def tables_without_contract(spark, sf_dir):
    landed = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("table"))
    registry = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("table"))
    return without_contract(landed, registry)
