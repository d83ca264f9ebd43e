"""Registered queries: delimited, nested and fixed-width formats, and landing bytes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from lakewarden.functions.encoding import line_ending_class, to_lf
from lakewarden.operators.profile import profile
from lakewarden.operators.values import to_text
from lakewarden.plans.workload import COLUMNS, register, table, text_sql
from lakewarden.plans.workload_profile import profile_sql
from lakewarden.session import shared_dir
from lakewarden.sources.fixed import (
    check_layout, format_fixed, infer_layout, layout_of, layout_offsets, parse_fixed, parse_layout_lines,
    parse_layout_table, read_fixed,
)
from lakewarden.sources.landing import normalize_bytes
from lakewarden.sources.nested import flatten, nest, observed_schema, read_json_document, write_documents
from lakewarden.sources.reader import read_table, write_table
from lakewarden.sources.tabular import DELIMITERS, detect_delimiter, detect_header, read_csv, read_split_lines

# ---- delimited text -------------------------------------------------------------------------


def _line(name: str, sep: str) -> str:
    sep_sql = "chr(9)" if sep == "\t" else f"'{sep}'"
    return f"concat_ws({sep_sql}, {', '.join(f'cast({c} as string)' for c, _ in COLUMNS[name])})"


# Lines of different tables with different delimiters; notes add stray candidates to some lines.
_LINES = {
    "orders_comma": ("orders", _line("orders", ",")),
    "customer_semicolon": ("customer", f"concat({_line('customer', ';')}, case when c_custkey % 3 = 0 then ', x' else '' end)"),
    "part_pipe": ("part", f"concat({_line('part', '|')}, case when p_partkey % 5 = 0 then ';;' else '' end)"),
    "events_tab": ("events", _line("events", "\t")),
    "nation_none": ("nation", "n_name"),
}


def _delimiter_sql(case: str, source: str, expr: str) -> str:
    names = {",": "','", ";": "';'", "|": "'|'", "\t": "chr(9)"}
    parts = [f"""select {i} as preference, {names[sep]} as delimiter, count(*) as n, sum(h) as s, sum(h * h) as q
                 from (select cast(length(line) - length(replace(line, {names[sep]}, '')) as hugeint) as h
                       from (select {expr} as line from {source}) l where line <> '') x""" for i, sep in enumerate(DELIMITERS)]
    return f"""
    select '{case}' as lines, coalesce((select delimiter from (
        select *, (cast(n as double) * cast(q as double) - cast(s as double) * cast(s as double)) / (cast(s as double) * cast(s as double)) as variation
        from ({' union all '.join(parts)}) c where s > 0) v order by variation, s desc, preference limit 1), ',') as delimiter"""


@register("delimiter_detect", " union all ".join(_delimiter_sql(c, t, e) for c, (t, e) in _LINES.items()))
def delimiter_detect(spark, sf_dir):
    found = []
    for case, (name, expr) in _LINES.items():
        lines = table(spark, sf_dir, name).selectExpr(f"{expr} as value")
        found.append(detect_delimiter(lines).select(F.lit(case).alias("lines"), "delimiter"))
    return reduce(DataFrame.unionByName, found)


# (table, separator, first line)
_HEADERS = {
    "orders_named": ("orders", ",", "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"),
    "orders_unnamed": ("orders", ",", "7,3,F,10.5,1998-10-03 00:00:00,5-LOW"),
    "part_named": ("part", ";", "p_partkey;p_name;p_brand;p_type;p_size;p_retailprice"),
}


def _header_sql(case: str, name: str, sep: str, first: str) -> str:
    cells = first.split(sep)
    stats, votes = [], []
    for i, ((column, kind), head) in enumerate(zip(COLUMNS[name], cells)):
        v = f"cast({column} as varchar)"
        number = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"
        stats += [f"bool_and(regexp_matches(trim({v}), {number})) as n{i}", f"min(length({v})) as a{i}", f"max(length({v})) as z{i}"]
        votes.append(f"(case when n{i} then (case when regexp_matches('{head}', {number}) then -1 else 1 end) "
                     f"when a{i} = z{i} then (case when length('{head}') = a{i} then -1 else 1 end) else 0 end)")
    return f"select '{case}' as lines, ({' + '.join(votes)}) > 0 as has_header, cast({' + '.join(votes)} as integer) as votes from (select {', '.join(stats)} from {name}) s"


@register("header_detect", " union all ".join(_header_sql(c, *h) for c, h in _HEADERS.items()))
def header_detect(spark, sf_dir):
    found = []
    for case, (name, sep, first) in _HEADERS.items():
        lines = table(spark, sf_dir, name).selectExpr(f"{_line(name, sep)} as value")
        lines = lines.unionByName(spark.range(1).select(F.lit(first).alias("value")))
        found.append(detect_header(lines, first, sep).select(F.lit(case).alias("lines"), "has_header", "votes"))
    return reduce(DataFrame.unionByName, found)


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("csv_roundtrip_orders", profile_sql("orders", [(c, "double" if k == "double" else k) for c, k in COLUMNS["orders"]]))
def csv_roundtrip_orders(spark, sf_dir):
    """Write as CSV, read back as strings, profile; equal to the profile of the source."""
    path = _scratch(spark, "orders.csv")
    write_table(to_text(table(spark, sf_dir, "orders")), path, "csv")
    return profile(read_table(spark, path, "csv"))


# Text that CSV must carry unchanged: quotes, separators, line breaks, blanks at the ends, empty against NULL.
def _hard_text(column: str, key: str, sql: bool = False) -> str:
    line_break, text = ("chr(10)", "varchar") if sql else ("chr(10)", "string")
    return (f"case {key} % 7 when 0 then concat('  ', {column}, ' ') when 1 then concat('say \"', {column}, '\", ok')  when 2 then '' when 3 then null "
            f"when 4 then concat({column}, {line_break}, 'a;b,c|d', chr(9)) when 5 then concat('\"', {line_break}, '\"\"') else cast({column} as {text}) end")


_CSV_TEXT = {"documents": ("doc_id", "text"), "pages": ("page_id", "html"), "conversations": ("conv_id", "text")}


def _csv_cells(name: str, sql: bool = False) -> list[str]:
    key, text = _CSV_TEXT[name]
    kind = "varchar" if sql else "string"
    return [f"{_hard_text(text, key, sql) if c == text else f'cast({c} as {kind})'} as {c}" for c, _ in COLUMNS[name]]


for _name in _CSV_TEXT:
    @register(f"csv_text_{_name}", f"select {', '.join(_csv_cells(_name, True))} from {_name}")
    def _csv_text(spark, sf_dir, name=_name):
        """Every row and column written as CSV and read back as text."""
        path = _scratch(spark, f"{name}.csv")
        write_table(table(spark, sf_dir, name).selectExpr(*_csv_cells(name)), path, "csv")
        return read_table(spark, path, "csv", multi_line=True)


@register("csv_corrupt_rows", """
    select cast(count(*) as bigint) as rows_total, cast(sum(case when o_orderkey % 10 in (3, 4) then 1 else 0 end) as bigint) as corrupt_rows
    from orders""")
def csv_corrupt_rows(spark, sf_dir):
    """Lines with a field too many or too few are counted, not dropped or cut without a trace."""
    path = _scratch(spark, "corrupt.csv")
    lines = table(spark, sf_dir, "orders").selectExpr(
        "case o_orderkey % 10 when 3 then concat_ws(',', o_orderkey, o_custkey, 'x', 'surplus') when 4 then cast(o_orderkey as string) "
        "else concat_ws(',', o_orderkey, o_custkey, o_orderstatus) end as value")
    lines.write.text(path)
    df = read_csv(spark, path, header=False, schema=T.StructType([T.StructField(c, T.StringType()) for c in ("k", "c", "s")]), corrupt="_corrupt_record")
    return df.agg(F.count_if(F.col("k").isNotNull() | F.col("_corrupt_record").isNotNull()).alias("rows_total"),
                  F.count("_corrupt_record").alias("corrupt_rows"))


@register("json_roundtrip_customer", profile_sql(
    "customer", [("c_custkey", "int"), ("c_acctbal", "double"), ("c_name", "text"), ("c_mktsegment", "text")]).replace(
    "'c_name'", "'person__c_name'").replace("'c_mktsegment'", "'person__c_mktsegment'"))
def json_roundtrip_customer(spark, sf_dir):
    """Nest, write as JSON Lines, read back flat, profile."""
    path = _scratch(spark, "customer") + ".jsonl"
    customer = table(spark, sf_dir, "customer").drop("c_nationkey")
    write_table(customer, path, "json", groups={"person": ["c_name", "c_mktsegment"]})
    return profile(read_table(spark, path), ["c_custkey", "c_acctbal", "person__c_name", "person__c_mktsegment"])


# Documents of three shapes in one folder; numbers as text that a DOUBLE would change.
@register("json_documents_supplier", """
    select cast(s_suppkey as varchar) as s_suppkey, s_name, concat('9', cast(s_suppkey as varchar), '12345678901234567.10') as wide, 'mixed' as structure
    from supplier""")
def json_documents_supplier(spark, sf_dir):
    """A list, records under a root key, and single objects, written as .json files and read back record by record."""
    path = _scratch(spark, "documents")
    item = "concat('{\"s_suppkey\": ', s_suppkey, ', \"s_name\": \"', s_name, '\", \"wide\": 9', s_suppkey, '12345678901234567.10}')"
    rows = table(spark, sf_dir, "supplier").selectExpr(
        "case when s_suppkey % 5 = 0 then 1000 + s_suppkey else s_suppkey % 4 end as bucket", f"{item} as item")
    # One file per bucket, each one document, all in one folder: a folder for each is a task for each wherever they are listed.
    shapes = rows.groupBy("bucket").agg(F.sort_array(F.collect_list("item")).alias("items")).selectExpr("bucket", """
        case when size(items) = 1 then items[0] when bucket % 2 = 0 then concat('[', array_join(items, ', '), ']')
             else concat('{"made": "x", "rows": [', array_join(items, ', '), '], "tags": [1]}') end as value""")
    write_documents(shapes.select("value"), path)
    read = read_json_document(spark, path)
    return read.df.select("s_suppkey", "s_name", "wide").withColumn("structure", F.lit(read.structure))


@register("split_lines_part", """
    select regexp_extract(line, '^(\\S+)', 1) as col_001, nullif(regexp_extract(line, '^\\S+\\s+(\\S+)', 1), '') as col_002,
           nullif(regexp_extract(line, '^\\S+\\s+\\S+\\s+(\\S+)', 1), '') as col_003
    from (select trim(concat('  ', p_name, '   ', p_brand, ' ')) as line from part) p""".replace("\\\\", "\\"))
def split_lines_part(spark, sf_dir):
    lines = table(spark, sf_dir, "part").selectExpr("concat('  ', p_name, '   ', p_brand, ' ') as value")
    return read_split_lines(lines)


# ---- nested ---------------------------------------------------------------------------------


@register("json_flatten_events", """
    select event_id, user_id as body__user_id, event_type as body__inner__kind,
           concat('{"value":', cast(value as varchar), '}') as body__inner__deep,
           concat('[', cast(user_id as varchar), ',', cast(event_id as varchar), ']') as ids,
           cast(json_extract_string(props, '$.k') as bigint) as props__k
    from events""")
def json_flatten_events(spark, sf_dir):
    nested = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "named_struct('user_id', user_id, 'inner', named_struct('kind', event_type, 'deep', named_struct('value', value))) as body",
        "array(user_id, event_id) as ids",
        "from_json(props, 'k bigint') as props")
    return flatten(nested, max_level=2)[0]


@register("json_nest_customer", """
    select c_custkey, concat('{"c_custkey":', cast(c_custkey as varchar), ',"c_mktsegment":"', c_mktsegment, '","person":{"c_name":"', c_name,
           '","c_nationkey":', cast(c_nationkey as varchar), '}}') as document
    from customer""")
def json_nest_customer(spark, sf_dir):
    nested = nest(table(spark, sf_dir, "customer").drop("c_acctbal"), {"person": ["c_name", "c_nationkey"]})
    return nested.select("c_custkey", F.to_json(F.struct(*nested.columns), {"ignoreNullFields": "false"}).alias("document"))


@register("json_schema_events")
def json_schema_events(spark, sf_dir):
    """Merged schema as a type description, which SQL has no words for."""
    return observed_schema(table(spark, sf_dir, "events"), "props")


# ---- fixed width ----------------------------------------------------------------------------

_ORDER_LAYOUT = layout_of([("o_orderkey", 8, "integer"), ("o_orderstatus", 3, "string"), ("o_totalprice", 12, "float"),
                           ("o_orderpriority", 10, "string"), ("o_clerk", 6, "string")])
_ORDER_FIELDS = {
    "o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus", "o_totalprice": "o_totalprice",
    "o_orderpriority": "o_orderpriority", "o_clerk": "case when o_orderkey % 4 = 0 then null else concat('c', cast(o_custkey as string)) end",
}
_KINDS = {"o_orderkey": "int", "o_totalprice": "double"}
_FIXED_SQL = "concat(" + ", ".join(
    f"{'lpad' if f.type in ('integer', 'float') else 'rpad'}(substr(coalesce({text_sql(_ORDER_FIELDS[f.name], _KINDS.get(f.name, 'text'))}, ''), 1, {f.width}), {f.width}, ' ')"
    for f in _ORDER_LAYOUT) + ")"


def _fixed_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {n}" for n, e in _ORDER_FIELDS.items()])


@register("fixed_width_encode", f"select {_FIXED_SQL} as value, length({_FIXED_SQL}) as width from orders")
def fixed_width_encode(spark, sf_dir):
    return format_fixed(_fixed_orders(spark, sf_dir), _ORDER_LAYOUT).withColumn("width", F.length("value").cast("bigint"))


_PARSED_SQL = ", ".join(f"nullif(trim(substr(line, {f.start}, {f.width})), '') as {f.name}" for f in _ORDER_LAYOUT)


@register("fixed_width_parse", f"select {_PARSED_SQL} from (select {_FIXED_SQL} as line from orders) l")
def fixed_width_parse(spark, sf_dir):
    return parse_fixed(format_fixed(_fixed_orders(spark, sf_dir), _ORDER_LAYOUT), _ORDER_LAYOUT)


@register("fixed_width_roundtrip", f"select {_PARSED_SQL} from (select {_FIXED_SQL} as line from orders) l")
def fixed_width_roundtrip(spark, sf_dir):
    path = _scratch(spark, "orders.txt")
    write_table(_fixed_orders(spark, sf_dir), path, "fixed", layout=_ORDER_LAYOUT)
    return read_fixed(spark, path, _ORDER_LAYOUT)


_WIDE = {n: COLUMNS[n] for n in ("customer", "part", "nation", "pages", "documents")}


@register("layout_offsets", """
    select layout, name, pos, cast(width as bigint) as width,
           cast(sum(width) over (partition by layout order by pos rows unbounded preceding) - width + 1 as bigint) as start,
           cast(sum(width) over (partition by layout order by pos rows unbounded preceding) as bigint) as "end"
    from (""" + " union all ".join(
    f"select '{t}' as layout, '{c}' as name, {i} as pos, max(length({text_sql(c, k)})) as width from {t}"
    for t, cols in _WIDE.items() for i, (c, k) in enumerate(cols)) + ") w")
def layout_offsets_query(spark, sf_dir):
    """Widths are the longest value of each column, found in one pass per table."""
    widths = []
    for name, cols in _WIDE.items():
        text = to_text(table(spark, sf_dir, name), [c for c, _ in cols])
        one = text.agg(*[F.expr(f"max(length({c})) as {c}") for c, _ in cols])
        listed = ", ".join(f"named_struct('layout', '{name}', 'name', '{c}', 'pos', {i}, 'width', cast({c} as bigint))"
                           for i, (c, _) in enumerate(cols))
        widths.append(one.selectExpr(f"inline(array({listed}))"))
    return layout_offsets(reduce(DataFrame.unionByName, widths), ["layout"])


# Fields of a layout made from the lines of a supplier; few suppliers hold all lines.
_LAYOUT_FIELDS = {
    "layout": "l_suppkey % 7",
    "name": "concat('f', lpad(cast(l_orderkey as string), 9, '0'), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_extendedprice as string))",
    "start": "l_orderkey * 3 + l_linenumber",
    '"end"': "l_orderkey * 3 + l_linenumber + l_partkey % 4 - 1",
}


@register("layout_check", f"""
    select layout, name, start, "end", prev_end, "end" < start as reversed,
           coalesce(prev_end, 0) > 0 and start <= prev_end as overlap,
           cast(case when coalesce(prev_end, 0) > 0 and start > prev_end + 1 then start - prev_end - 1 else 0 end as bigint) as gap
    from (select *, lag("end") over (partition by layout order by start, name, "end") as prev_end
          from (select {', '.join(f'{e} as {n}' for n, e in _LAYOUT_FIELDS.items())} from lineitem) f) g""")
def layout_check(spark, sf_dir):
    fields = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} as {n.replace(chr(34), '`')}" for n, e in _LAYOUT_FIELDS.items()])
    return check_layout(fields, ["layout"])


def _infer_layout_sql(line: str, source: str) -> str:
    return f"""
    with lines as (select {line} as line from {source}), filled as (select line from lines where line <> ''),
         total as (select count(*) as n, max(length(line)) as len from filled),
         spaces as (select pos, cast(sum(case when substr(line, pos + 1, 1) = ' ' then 1 else 0 end) as double) as s
                    from (select line, unnest(range(length(line))) as pos from filled) c group by pos),
         marked as (select pos, s / n >= 0.7 as sp from spaces, total),
         opened as (select *, (not sp) and coalesce(lag(sp) over (order by pos), true) as opens from marked),
         runs as (select *, sum(case when opens then 1 else 0 end) over (order by pos) as run,
                  (select max(case when pos = 0 and sp then 1 else 0 end) from marked) as shift from opened)
    select printf('campo_%03d', cast(run + shift as integer)) as name, cast(min(pos) + 1 as integer) as start, cast(max(pos) + 1 as integer) as "end"
    from runs where not sp group by run, shift having max(pos) - min(pos) >= 1"""


_CUSTOMER_LINE = "concat('  ', rpad(c_mktsegment, 14, ' '), lpad(cast(c_custkey as string), 8, ' '), ' ', rpad(c_name, 20, ' '), cast(c_nationkey % 10 as string))"


@register("layout_infer_customer", _infer_layout_sql(_CUSTOMER_LINE, "customer"))
def layout_infer_customer(spark, sf_dir):
    return infer_layout(table(spark, sf_dir, "customer").selectExpr(f"{_CUSTOMER_LINE} as value"))


@register("layout_infer_documents", _infer_layout_sql("text", "documents"))
def layout_infer_documents(spark, sf_dir):
    """Whole texts as records: positions up to the longest text."""
    return infer_layout(table(spark, sf_dir, "documents").select(F.col("text").alias("value")))


# Layout text lines made from parts: good ones, comments, blanks, short ones and bad numbers.
_LAYOUT_LINE = """case when p_partkey % 17 = 0 then '# comment' when p_partkey % 17 = 1 then '   '
    when p_partkey % 17 = 2 then concat('CD_', p_type, ' 4') when p_partkey % 17 = 3 then concat('CD_', p_type, ' one 4 CHAR')
    when p_partkey % 17 = 4 then concat('VL', p_type, '  ', cast(p_partkey as string), ' ', cast(p_partkey + p_size as string))
    else concat(' ', p_type, cast(p_partkey as string), ' ', cast(p_partkey as string), '   ', cast(p_partkey + p_size as string), ' ',
                case p_partkey % 5 when 0 then 'NUMERIC' when 1 then 'char' when 2 then '9' when 3 then 'B' else 'Date' end,
                case when p_partkey % 2 = 0 then concat('  ', p_name, '  here ') else '' end) end"""
_TOK = "string_split_regex(line, '\\s+')"


def _snake_of(expr: str) -> str:
    from lakewarden.plans.workload_inference import _SNAKE_SQL
    return _SNAKE_SQL.replace("raw", expr)


@register("layout_lines_part", f"""
    with lines as (select p_partkey, trim({_LAYOUT_LINE}) as line from part),
         cut as (select *, {_TOK} as t from lines where line <> '' and not starts_with(line, '#'))
    select p_partkey, {_snake_of('t[1]')} as name, t[1] as sas_label, try_cast(t[2] as integer) as start, try_cast(t[3] as integer) as "end",
           case when lower(coalesce(t[4], 'char')) = 'numeric' then 'float' when lower(coalesce(t[4], 'char')) = '9' then 'integer'
                when lower(coalesce(t[4], 'char')) = 'date' then 'date' else 'string' end as type,
           coalesce(nullif(array_to_string(t[5:], ' '), ''), concat('# TODO: describe ', {_snake_of('t[1]')})) as description,
           coalesce(lower(t[4]) = 'b', false) as "binary",
           case when len(t) < 3 then 'ignored: fewer than three fields'
                when not (regexp_matches(t[2], '^[+-]?[0-9]+$') and regexp_matches(t[3], '^[+-]?[0-9]+$')) then 'invalid: start and end must be whole numbers' end as rejected
    from cut""")
def layout_lines_part(spark, sf_dir):
    lines = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_LAYOUT_LINE} as value")
    return parse_layout_lines(lines, keep=("p_partkey",)).drop("line")


@register("layout_table_part", f"""
    select {_snake_of('trim(campo)')} as name, trim(campo) as sas_label, try_cast(trim(inicio) as integer) as start, try_cast(trim(fim) as integer) as "end",
           case when lower(trim(tipo)) = 'packed' then 'float' when lower(trim(tipo)) = 'int' then 'integer' else 'string' end as type,
           coalesce(trim(descricao), concat('# TODO: describe ', {_snake_of('trim(campo)')})) as description,
           coalesce(lower(trim(tipo)) = 'binary', false) as "binary",
           case when coalesce(regexp_matches(trim(inicio), '^[+-]?[0-9]+$') and regexp_matches(trim(fim), '^[+-]?[0-9]+$'), false) then null
                else 'invalid: start and end must be whole numbers' end as rejected
    from (select concat(p_type, ' Campo ', cast(p_partkey as varchar)) as campo, cast(p_size as varchar) as inicio,
                 case when p_partkey % 9 = 0 then 'x' when p_partkey % 9 = 1 then null else cast(p_size + 3 as varchar) end as fim,
                 case p_partkey % 4 when 0 then 'PACKED' when 1 then ' int ' when 2 then 'Binary' else 'an' end as tipo,
                 case when p_partkey % 2 = 0 then concat(p_name, ' ') end as descricao from part) l""")
def layout_table_part(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "concat(p_type, ' Campo ', cast(p_partkey as string)) as Campo", "cast(p_size as string) as INICIO",
        "case when p_partkey % 9 = 0 then 'x' when p_partkey % 9 = 1 then null else cast(p_size + 3 as string) end as fim",
        "case p_partkey % 4 when 0 then 'PACKED' when 1 then ' int ' when 2 then 'Binary' else 'an' end as tipo",
        "case when p_partkey % 2 = 0 then concat(p_name, ' ') end as descricao")
    return parse_layout_table(rows)


# ---- landing bytes --------------------------------------------------------------------------

_ENDINGS = """case when doc_id % 4 = 1 then replace(text, chr(10), concat(chr(13), chr(10)))
    when doc_id % 4 = 2 then replace(text, chr(10), chr(13)) when doc_id % 4 = 3 then concat(text, chr(13), chr(10), 'x', chr(10)) else text end"""
_CLASS_SQL = """case when crlf and contains(rest, chr(10)) then 'mixed' when crlf then 'CRLF' when contains(rest, chr(13)) then 'CR' else 'LF' end"""


@register("line_endings_documents", f"""
    select doc_id, {_CLASS_SQL} as line_endings, replace(replace(t, concat(chr(13), chr(10)), chr(10)), chr(13), chr(10)) as text
    from (select doc_id, t, contains(t, concat(chr(13), chr(10))) as crlf, replace(t, concat(chr(13), chr(10)), '') as rest
          from (select doc_id, {_ENDINGS} as t from documents) d) e""")
def line_endings_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_ENDINGS} as text")
    return docs.select("doc_id", line_ending_class(F.col("text")).alias("line_endings"), to_lf(F.col("text")).alias("text"))


@register("line_endings_pages", """
    select line_endings, count(*) as pages, cast(sum(length(t)) as bigint) as chars from (
      select t, case when contains(t, concat(chr(13), chr(10))) and contains(replace(t, concat(chr(13), chr(10)), ''), chr(10)) then 'mixed'
                when contains(t, concat(chr(13), chr(10))) then 'CRLF'
                when contains(replace(t, concat(chr(13), chr(10)), ''), chr(13)) then 'CR' else 'LF' end as line_endings
      from (select html as t from pages) p) c group by 1""")
def line_endings_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.groupBy(line_ending_class(F.col("html")).alias("line_endings")).agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.length("html")).alias("chars"))


_BYTES = """case when doc_id % 4 = 0 then encode(text, 'UTF-8') when doc_id % 4 = 1 then unhex(concat('EFBBBF', hex(encode(text, 'UTF-8'))))
    when doc_id % 4 = 2 then encode(concat(regexp_replace(text, '[^\\\\x00-\\\\xFF]', '?'), 'é'), 'ISO-8859-1')
    else unhex(concat('FFFE', hex(encode(text, 'UTF-16LE')))) end"""
_DECODED = "case when doc_id % 4 = 2 then concat(regexp_replace(text, '[^\\x00-\\x{FF}]', '?', 'g'), 'é') else text end"


@register("encoding_triage_documents", f"""
    select doc_id,
           case when doc_id % 4 = 1 then 'utf-8-sig' when doc_id % 4 = 3 then 'utf-16' when doc_id % 4 = 2 then 'latin-1'
                when regexp_matches(text, '[^\\x00-\\x7F]') then 'utf-8' else 'ascii' end as encoding,
           doc_id % 4 in (1, 3) as bom_removed,
           case when le = 'LF' then 'LF' else concat(le, '->LF') end as line_endings,
           case when doc_id % 4 = 0 and le = 'LF' then 'already_utf8' else 'ok' end as status,
           doc_id % 4 = 2 as warned,
           md5(replace(replace(t, concat(chr(13), chr(10)), chr(10)), chr(13), chr(10))) as digest
    from (select *, {_CLASS_SQL} as le from (select *, contains(t, concat(chr(13), chr(10))) as crlf, replace(t, concat(chr(13), chr(10)), '') as rest
          from (select doc_id, text, {_DECODED} as t from documents) d) e) f""")
def encoding_triage_documents(spark, sf_dir):
    files = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_BYTES} as content")
    report = normalize_bytes(files)
    return report.select("doc_id", "encoding", "bom_removed", "line_endings", "status", F.col("warning").isNotNull().alias("warned"),
                         F.md5("text").alias("digest"))
