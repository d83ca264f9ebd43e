"""Registered queries: what lands as files, and is read back, judged and taken in as it is."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakewarden.contracts import Contract
from lakewarden.operators.history import export_fields
from lakewarden.operators.infer import draft_contract, infer_columns
from lakewarden.operators.values import to_text
from lakewarden.plans.layers import Lake, read_route
from lakewarden.plans.onboard import onboard
from lakewarden.plans.workload import COLUMNS, register, table, text_sql
from lakewarden.plans.workload_history import RECORDS_SQL, records
from lakewarden.plans.workload_inference import infer_sql
from lakewarden.session import shared_dir
from lakewarden.sources.fixed import contract_from_layout, parse_layout_lines
from lakewarden.sources.landing import file_summaries
from lakewarden.sources.nested import json_documents, observed_types, read_json_document, write_documents
from lakewarden.sources.reader import read_load, read_table
from lakewarden.sources.records import export_records, read_records, write_records
from lakewarden.sources.registry import read_registry, registry_frame, row_contract, write_registry
from lakewarden.sources.tabular import read_csv
from lakewarden.streaming.ingest import ingest, landing_stream


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _texts(name: str) -> str:
    return ", ".join(f"{text_sql(c, k)} as {c}" for c, k in COLUMNS[name])


# ---- files with their own headers -----------------------------------------------------------

_ORDER_NAMES = [c for c, _ in COLUMNS["orders"]]
_ORDERS = Contract.of({"table": "orders", "version": "1.0.0", "schema": [
    {"name": c, "type": "integer" if c == "o_orderkey" else "string", "nullable": c not in ("o_orderkey", "o_custkey"), "primary_key": c == "o_orderkey"} for c in _ORDER_NAMES]})
#: Files of four kinds by o_orderkey: as the contract says, columns the other way round, one column more, a required one less.
_KINDS = (_ORDER_NAMES, _ORDER_NAMES[::-1], ["note", *_ORDER_NAMES], [c for c in _ORDER_NAMES if c != "o_custkey"])


@register("stream_drifting_orders", f"""
    select {', '.join(f"case when o_orderkey % 4 = 3 and '{c}' = 'o_custkey' then null else {text_sql(c, k)} end as {c}" for c, k in COLUMNS['orders'])},
           case when o_orderkey % 4 = 2 then concat('n', cast(o_orderkey as varchar)) end as note,
           case o_orderkey % 4 when 2 then 'WARNING' when 3 then 'DLQ' else 'PASS' end as status,
           case o_orderkey % 4 when 2 then 'NON_BREAKING' when 3 then 'BREAKING' end as evolution_type,
           case when o_orderkey % 4 = 3 then 'quarantine' else 'silver' end as layer
    from orders""")
def stream_drifting_orders(spark, sf_dir):
    """Files whose headers differ arrive on one stream; every row ends where its own file's columns put it."""
    root = _scratch(spark, "drift")
    lake = Lake(f"{root}/lake")
    source = to_text(table(spark, sf_dir, "orders")).withColumn("note", F.concat(F.lit("n"), "o_orderkey"))
    for k, columns in enumerate(_KINDS):
        source.where(f"o_orderkey % 4 = {k}").select(columns).write.option("header", True).csv(f"{root}/landing/kind={k}")
    stream = landing_stream(spark, f"{root}/landing/*")
    ingest(stream, _ORDERS, lake, f"{root}/checkpoint", timestamp="1970-01-01T00:00:00").awaitTermination()
    results = spark.read.parquet(lake.path("bronze", "orders__files")).select("_file", "status", "evolution_type")
    rows = [read_route(spark, lake, layer, "orders").select(*_ORDER_NAMES, F.col("_extra")["note"].alias("note"), "_file", F.lit(layer).alias("layer")) for layer in ("silver", "quarantine")]
    return rows[0].unionByName(rows[1]).join(results, "_file").drop("_file")


# ---- loads as their contract says -----------------------------------------------------------

_LATIN = "concat('é', {0}, case when {1} % 3 = 0 then chr(10) else ' ' end, 'ß;x')"
_LOADS = [
    Contract.of({"table": "supplier", "version": "1.0.0", "source": {"format": "csv", "encoding": "latin-1", "delimiter": ";"},
                 "schema": [{"name": c, "type": "string"} for c, _ in COLUMNS["supplier"]]}),
    Contract.of({"table": "nation", "version": "1.0.0", "source": {"format": "fixed_width", "encoding": "iso_8859-1"},
                 "schema": [{"name": c, "type": "string"} for c, _ in COLUMNS["nation"]],
                 "layout": [{"field": "n_nationkey", "start": 1, "end": 4}, {"field": "n_name", "start": 5, "end": 34}, {"field": "n_regionkey", "start": 35, "end": 38}]}),
]


@register("contract_loads", f"""
    select 'supplier' as source, cast(s_suppkey as varchar) as k, {_LATIN.format('s_name', 's_suppkey')} as name, cast(s_nationkey as varchar) as parent, cast(s_acctbal as varchar) as amount from supplier
    union all select 'nation', cast(n_nationkey as varchar), concat('ö', n_name, 'é'), cast(n_regionkey as varchar), null from nation""")
def contract_loads(spark, sf_dir):
    """Contracts stored in a registry and read back say how a Latin-1 CSV with line breaks in quotes and a Latin-1 fixed-width file are read."""
    root = _scratch(spark, "loads")
    write_registry(registry_frame(spark, _LOADS), f"{root}/registry")
    known = {r["table"]: row_contract(r) for r in read_registry(spark, f"{root}/registry").collect()}
    supplier = to_text(table(spark, sf_dir, "supplier")).withColumn("s_name", F.expr(_LATIN.format("s_name", "cast(s_suppkey as bigint)")))
    supplier.write.options(sep=";", header=True, encoding="ISO-8859-1", escape='"').csv(f"{root}/supplier")
    nation = table(spark, sf_dir, "nation").select(F.concat(
        F.lpad(F.col("n_nationkey").cast("string"), 4, " "), F.rpad(F.concat(F.lit("ö"), "n_name", F.lit("é")), 30, " "), F.lpad(F.col("n_regionkey").cast("string"), 4, " ")).alias("value"))
    nation.write.options(sep="\u0001", quote="", encoding="ISO-8859-1", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/nation")
    one = read_load(spark, f"{root}/supplier", known["supplier"]).select(
        F.lit("supplier").alias("source"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("parent"), F.col("s_acctbal").alias("amount"))
    two = read_load(spark, f"{root}/nation", known["nation"]).select(
        F.lit("nation"), "n_nationkey", "n_name", "n_regionkey", F.lit(None).cast("string"))
    return one.unionAll(two)


# ---- JSON -----------------------------------------------------------------------------------

_AMOUNT = "cast(cast(s_acctbal as decimal(15,3)) as {0})"


@register("json_roots_supplier", f"""
    select cast(s_suppkey as varchar) as s_suppkey, s_name, cast(s_nationkey as varchar) as s_nationkey, {_AMOUNT.format('varchar')} as s_acctbal,
           case when s_suppkey % 5 = 0 then 'object' else 'list' end as structure,
           case when s_suppkey % 5 = 0 or s_suppkey % 3 = 2 then null when s_suppkey % 3 = 0 then 'rows' else 'items' end as root_key
    from supplier""")
def json_roots_supplier(spark, sf_dir):
    """Documents with different root keys, lists and single objects; records, numbers as written, and each file's structure."""
    path = _scratch(spark, "roots")
    item = (f"""concat('{{"bucket": "', bucket, '", "s_suppkey": ', s_suppkey, ', "s_name": "', s_name, '", "s_nationkey": ', s_nationkey, ', "s_acctbal": ', {_AMOUNT.format('string')}, '}}') as item""")
    rows = table(spark, sf_dir, "supplier").selectExpr("*", "case when s_suppkey % 5 = 0 then concat('o', s_suppkey) else concat('k', s_suppkey % 3, '-', s_suppkey % 7) end as bucket").selectExpr("bucket", item)
    shapes = rows.groupBy("bucket").agg(F.array_join(F.sort_array(F.collect_list("item")), ", ").alias("items")).selectExpr("bucket", """
        case substr(bucket, 1, 2) when 'k0' then concat('{"made": "x", "rows": [', items, '], "tags": [1]}') when 'k1' then concat('{"items": [', items, '], "rows": [2]}')
             when 'k2' then concat('[', items, ']') else items end as value""")
    write_documents(shapes.select("value"), path)
    # The first record of a document names the bucket of all.
    told = json_documents(spark, path).select(F.regexp_extract("text", '"bucket": "([^"]*)"', 1).alias("bucket"), "structure", "root_key")
    return read_json_document(spark, path).df.select("bucket", "s_suppkey", "s_name", "s_nationkey", "s_acctbal").join(told, "bucket").drop("bucket")


@register("jsonl_digits_orders", "select cast(o_orderkey as varchar) as k, cast(cast(o_totalprice as decimal(15,3)) as varchar) as price, concat('9', cast(o_custkey as varchar), '12345678901234567890.10') as wide from orders")
def jsonl_digits_orders(spark, sf_dir):
    """Numbers in JSON Lines come back digit for digit."""
    path = _scratch(spark, "digits") + ".jsonl"
    table(spark, sf_dir, "orders").selectExpr(
        """concat('{"k": ', o_orderkey, ', "price": ', cast(o_totalprice as decimal(15,3)), ', "wide": 9', o_custkey, '12345678901234567890.10}') as value""").write.text(path)
    return read_table(spark, path).select("k", "price", "wide")


@register("json_key_types_events", """
    select 'k' as name, case json_type(props, '$.k') when 'UBIGINT' then 'BIGINT' when 'VARCHAR' then 'STRING' else json_type(props, '$.k') end as type, count(*) as occurrences
    from events where json_extract(props, '$.k') is not null group by 2""")
def json_key_types_events(spark, sf_dir):
    return observed_types(table(spark, sf_dir, "events"), "props")


_DRAFT_SQL = "select name, type, nullable, primary_key, array_to_string(list_sort(string_split(flags, ',')), ',') as flags from ({0}) d"


def _drafted(spark, contract: Contract) -> DataFrame:
    rows = [(c.name, c.type, c.nullable, c.primary_key, ",".join(sorted(c.regulatory_flags))) for c in contract.columns]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean, primary_key boolean, flags string")


@register("draft_json_customer", _DRAFT_SQL.format(infer_sql("customer", COLUMNS["customer"])))
def draft_json_customer(spark, sf_dir):
    """The columns of a draft contract inferred from JSON records."""
    path = _scratch(spark, "draft") + ".jsonl"
    table(spark, sf_dir, "customer").write.json(path)
    return _drafted(spark, draft_contract(read_table(spark, path), "customer", fmt="json"))


@register("draft_layout_nation", """
    select concat('f_', lower(n_name)) as name, case when n_regionkey % 2 = 0 then 'string' else 'float' end as type, true as nullable, false as primary_key,
           concat('about ', n_name) as description, cast(1 + n_nationkey * 10 as integer) as first, cast(8 + n_nationkey * 10 as integer) as last from nation""".replace("lower(n_name)", "replace(lower(n_name), ' ', '_')"))
def draft_layout_nation(spark, sf_dir):
    """The columns of a draft contract made from layout lines."""
    lines = table(spark, sf_dir, "nation").selectExpr(
        "concat('F_', replace(n_name, ' ', '_'), ' ', 1 + n_nationkey * 10, ' ', 8 + n_nationkey * 10, if(n_regionkey % 2 = 0, ' CHAR', ' NUM'), ' about ', n_name) as value")
    contract = contract_from_layout(parse_layout_lines(lines), "nation")[0]
    places = {f["field"]: f for f in contract.layout}
    rows = [(c.name, c.type, c.nullable, c.primary_key, c.description, places[c.name]["start"], places[c.name]["end"]) for c in contract.columns]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean, primary_key boolean, description string, first int, last int")


# ---- bytes ----------------------------------------------------------------------------------

_PARTS = 16


def _dealt(docs: DataFrame) -> DataFrame:
    """Texts and the part they go to, each part in a task of its own: dealt out by a hash, several parts meet in one task."""
    parts = docs.selectExpr("text as value", f"cast(doc_id % {_PARTS} as string) as part")
    return parts.repartitionById(_PARTS, F.col("part").cast("int"))


@register("landing_files_documents", f"""
    select cast(doc_id % {_PARTS} as varchar) as part, cast(sum(strlen(text) + 1) as bigint) as length,
           case when bool_or(regexp_matches(text, '[^\\x00-\\x7F]')) then 'utf-8' else 'ascii' end as encoding, false as bom_removed,
           case when bool_or(contains(t, chr(13))) then 'CR->LF' else 'LF' end as line_endings, case when bool_or(contains(t, chr(13))) then 'ok' else 'already_utf8' end as status
    from (select doc_id, text, text as t from documents) d group by doc_id % {_PARTS}""")
def landing_files_documents(spark, sf_dir):
    """All texts as files in a folder; encoding, byte order mark and line ends of each, found split by split."""
    path = _scratch(spark, "files")
    _dealt(table(spark, sf_dir, "documents")).write.partitionBy("part").text(path)
    report = file_summaries(spark, f"{path}/*/*").withColumn("part", F.regexp_extract("path", "part=([^/]*)/", 1))
    return report.select("part", "length", "encoding", "bom_removed", "line_endings", "status")


# ---- samples, order, export -----------------------------------------------------------------

_SAMPLE = 500


@register("csv_sample_orders", f"select cast(least(count(*), {_SAMPLE}) as bigint) as sampled, cast(0 as bigint) as foreign_rows from orders")
def csv_sample_orders(spark, sf_dir):
    """A sample scan: so many rows, all of them rows of the file."""
    path = _scratch(spark, "sample.csv")
    source = to_text(table(spark, sf_dir, "orders"))
    source.write.option("header", True).csv(path)
    sample = read_csv(spark, path, mode="DROPMALFORMED", sample_rows=_SAMPLE)
    return sample.join(source.select("o_orderkey", F.lit(1).alias("known")), "o_orderkey", "left").agg(
        F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("known").isNull()).alias("foreign_rows"))


@register("infer_sample_orders", infer_sql(f"(select * from orders order by o_orderkey limit {_SAMPLE})", COLUMNS["orders"]))
def infer_sample_orders(spark, sf_dir):
    """Inference over a sample of the first rows by key, where a full scan is not wanted."""
    sample = table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(_SAMPLE)
    return infer_columns(sample, [c for c, _ in COLUMNS["orders"]]).withColumn("flags", F.array_join("regulatory_flags", ",")).drop("regulatory_flags")


_EXPORTED = {"rows_total": "bigint", "rows_valid": "bigint", "duplicate_count": "bigint", "avg_null_pct": "double", "profiling_ms": "double", "slm_inference_ms": "double", "quality_score": "double"}


@register("exported_records", f"""select run_id, "timestamp", "table", scenario, validation_status, evolution_type, rows_total, rows_valid, duplicate_count,
    avg_null_pct, profiling_ms, slm_status, slm_inference_ms, quality_score from {RECORDS_SQL} r""")
def exported_records(spark, sf_dir):
    """The fourteen exported fields, written as CSV and read back."""
    path = _scratch(spark, "export.csv")
    export_records(records(spark, sf_dir), path)
    back = read_csv(spark, path)
    return back.select(*[F.col(c).cast(_EXPORTED.get(c, "string")).alias(c) for c in back.columns])


_FIRST = 200


@register("first_records", f"""select run_id, "timestamp", "table", scenario, format, quality_score from {RECORDS_SQL} r
    order by "timestamp", run_id, scenario, format, "table" limit {_FIRST}""")
def first_records(spark, sf_dir):
    """The earliest records of a stored history, which read_records() sorts."""
    path = _scratch(spark, "history")
    history = records(spark, sf_dir)
    extra = history.withColumn("null_violations", F.lit(None).cast("map<string,double>"))
    write_records(extra.where(F.col("run_id") < "run-000000010"), f"{path}/a")
    extra.where(F.col("run_id") >= "run-000000010").write.json(f"{path}/b")
    stored = read_records(spark, f"{path}/a").unionByName(read_records(spark, f"{path}/b"))
    return stored.orderBy("timestamp", "run_id", "scenario", "format", "table").limit(_FIRST).select("run_id", "timestamp", "table", "scenario", "format", "quality_score")


# ---- onboarding -----------------------------------------------------------------------------


@register("onboard_twice", """
    select * from (values ('customer', 'first', 'AWAITING_REVIEW'), ('part', 'first', 'AWAITING_REVIEW'), ('customer', 'third', 'PASS')) v("table", run_id, outcome)
    union all select 'silver', 'third', cast(count(*) as varchar) from customer""")
def onboard_twice(spark, sf_dir):
    """Two tables land, are drafted, and land again without effect; one draft is validated, and its file is taken in."""
    root = _scratch(spark, "onboard")
    lake = Lake(f"{root}/lake")
    for name in ("customer", "part"):
        to_text(table(spark, sf_dir, name)).coalesce(1).write.option("header", True).option("sep", ";").csv(f"{root}/made/{name}")
        _as_file(spark, f"{root}/made/{name}", f"{root}/landing/{name}_2024.csv")
    ran = [onboard(spark, lake, f"{root}/landing", "first")]
    _as_file(spark, f"{root}/made/part", f"{root}/landing/part_2025.csv")  # the same content under another name
    ran.append(onboard(spark, lake, f"{root}/landing", "second"))
    registry = read_registry(spark, lake.path("contracts"))
    write_registry(registry.withColumn("manifest_status", F.when(F.col("table") == "customer", "VALIDATED").otherwise(F.col("manifest_status"))), lake.path("contracts"))
    ran.append(onboard(spark, lake, f"{root}/landing", "third"))
    ran.append(onboard(spark, lake, f"{root}/landing", "fourth"))
    silver = read_route(spark, lake, "silver", "customer").agg(F.count(F.lit(1)).cast("string").alias("outcome"))
    out = silver.select(F.lit("silver").alias("table"), F.lit("third").alias("run_id"), "outcome")
    for frame in ran:
        out = out.unionByName(frame.select("table", "run_id", "outcome"))
    return out


def _as_file(spark, folder: str, target: str) -> None:
    """Copy the only part of a written folder to a file of that name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    source = hadoop.Path(f"{folder}/part-*.csv")
    fs = source.getFileSystem(conf)
    hadoop.FileUtil.copy(fs, fs.globStatus(source)[0].getPath(), fs, hadoop.Path(target), False, conf)
