"""The registered workload: every operator as a query over the whole input tables.

Each module adds its queries to QUERIES and, where the result can be written as SQL, the
equivalent statement to ORACLE. Statements are plain text made from the same column lists and
the same row expressions as the queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


# (column, kind) of the input tables; kind is how the column is read as a number.
COLUMNS = {
    "region": [("r_regionkey", "int"), ("r_name", "text")],
    "nation": [("n_nationkey", "int"), ("n_name", "text"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "int"), ("c_name", "text"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "text")],
    "supplier": [("s_suppkey", "int"), ("s_name", "text"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "int"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"), ("p_size", "int"),
             ("p_retailprice", "double")],
    "orders": [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "text"), ("o_totalprice", "double"),
               ("o_orderdate", "time"), ("o_orderpriority", "text")],
    "lineitem": [("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "time")],
    "events": [("event_id", "int"), ("ts", "time"), ("user_id", "int"), ("event_type", "text"),
               ("value", "double"), ("props", "text")],
    "documents": [("doc_id", "int"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "int")],
    "labels": [("doc_id", "int"), ("quality", "int"), ("toxic", "int")],
    "pages": [("page_id", "int"), ("url", "text"), ("html", "text")],
    "conversations": [("conv_id", "int"), ("turn", "int"), ("role", "text"), ("text", "text")],
    "benchmark": [("item_id", "int"), ("text", "text")],
    "embeddings": [("vec_id", "int"), ("label", "int")],
}
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"], "documents": ["doc_id"], "labels": ["doc_id"], "pages": ["page_id"],
    "conversations": ["conv_id", "turn"], "benchmark": ["item_id"], "embeddings": ["vec_id"],
}

# A dirty landing table derived from orders: the same expressions in Spark and in SQL.
DIRTY_ORDERS = {
    "nr_pedido": "cast(o_orderkey as string)",
    "cd_agencia": "case when o_orderkey % 11 = 3 then '<unknown>' else cast(o_orderkey % 9000 + 1000 as string) end",
    "tp_prioridade": "case when o_orderkey % 7 = 0 then null when o_orderkey % 13 = 0 then '  ' else o_orderpriority end",
    "vl_misto": "case when o_orderkey % 2 = 0 then cast(o_custkey as string) else 'N/D' end",
    "fl_ativo": "case when o_orderstatus = 'F' then 'S' else 'N' end",
    "dt_cadastro": "concat(substr(cast(o_orderdate as string), 9, 2), '/', substr(cast(o_orderdate as string), 6, 2), '/', "
                   "substr(cast(o_orderdate as string), 1, 4))",
    "dt_iso": "case when o_orderkey % 5 = 0 then '' else substr(cast(o_orderdate as string), 1, 10) end",
    "vl_renda": "case when o_orderkey % 4 = 0 then null else concat(' ', cast(o_custkey as string), '.50 ') end",
    "qt_inteira": "concat(cast(o_custkey as string), '.0')",
    "ds_vazia": "case when o_orderkey % 3 = 0 then null else '' end",
    "fl_um": "'1'",
    "fl_ingles": "case when o_orderkey % 2 = 0 then 'Yes' else 'no' end",
    "fl_tres": "case o_orderkey % 3 when 0 then 'sim' when 1 then 'NAO' else 'não' end",
    "fl_dois": "case o_orderkey % 2 when 0 then 'sim' else 'nao' end",
}


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {n}" for n, e in DIRTY_ORDERS.items()])


DIRTY_ORDERS_SQL = "(select " + ", ".join(f"{e} as {n}" for n, e in DIRTY_ORDERS.items()) + " from orders)"
DIRTY_COLUMNS = [(n, "text") for n in DIRTY_ORDERS]

NUMBER_SQL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def text_sql(column: str, kind: str) -> str:
    return column if kind == "text" else f"cast({column} as varchar)"


def number_sql(column: str, kind: str) -> str:
    if kind in ("int", "double"):
        return f"cast({column} as double)"
    if kind == "time":
        return "cast(null as double)"
    return f"case when regexp_matches(trim({column}), '{NUMBER_SQL}') then try_cast(trim({column}) as double) end"


def round_sql(expr: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"case when abs({expr}) < {float(2**52 // 10**digits)!r}::double then floor(({expr}) * {scale} + 0.5) / {scale} else ({expr}) end"


def percent_sql(part: str, whole: str, digits: int = 2) -> str:
    ratio = f"cast({part} as double) * 100.0::double / cast({whole} as double)"
    return f"case when {whole} > 0 then {round_sql(ratio, digits)} else 0.0::double end"
