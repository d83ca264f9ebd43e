"""JSON documents, JSON Lines, flattening and nesting."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakewarden.functions.numeric import double_text_sql
from lakewarden.functions.sqltext import ident
from lakewarden.session import shared_dir

SEPARATOR = "__"


@dataclass
class JsonTable:
    df: DataFrame
    structure: str
    root_key: str | None = None
    notes: dict[str, list[str]] = field(default_factory=dict)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None, as_text: bool = False) -> JsonTable:
    """One record per line; lines that are no JSON are skipped. This is the form that splits.

    With ``as_text`` numbers and booleans come back as the text in the file, digit for digit.
    """
    reader = spark.read.option("mode", "DROPMALFORMED").option("primitivesAsString", as_text)
    if schema is not None:
        reader = reader.schema(schema)
    return JsonTable(reader.json(path), "jsonlines")


def json_documents(spark: SparkSession, path: str, root_key: str | None = None) -> DataFrame:
    """(_file, structure, root_key, many, text) of every file, told from that file alone.

    A file holds a list, records under a root key, or a single object. The root key is the given one where
    the file has it, else the first of its keys that holds a list; ``many`` says whether a list is under
    it. structure is list or object, or NULL where the file is no JSON. Each file is one JSON value and
    therefore one task; many files run in parallel, whatever their shapes.
    """
    text = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_file"), F.regexp_replace("value", "^[\\s\ufeff]+", "").alias("text"))
    is_list, is_object = F.col("text").startswith("["), F.col("text").startswith("{")
    found = text.withColumns({
        "_whole": F.try_parse_json("text").isNotNull(),
        "_top": F.when(is_object, F.map_entries(F.from_json("text", "map<string,variant>")))})
    of_kind = lambda e, kind: F.schema_of_variant(e["value"]).startswith(kind)
    wanted = (lambda e: of_kind(e, "ARRAY")) if root_key is None else (lambda e: (e["key"] == root_key) & (of_kind(e, "ARRAY") | of_kind(e, "OBJECT")))
    found = found.withColumn("_root", F.get(F.filter("_top", wanted), F.lit(0))).withColumn("many", F.coalesce(of_kind(F.col("_root"), "ARRAY"), F.lit(False)))
    shape = F.when(is_list | F.col("many"), "list").when(is_object, "object")
    return found.select("_file", F.when(F.col("_whole"), shape).alias("structure"), F.col("_root.key").alias("root_key"), "many", "text")


def _read_shape(spark: SparkSession, lines: str, root_key: str | None, many: bool) -> DataFrame:
    """Records of documents of one shape, one document a line, every value as the text in the file."""
    df = spark.read.option("primitivesAsString", True).json(lines)
    if root_key is None:
        if df.columns != ["_corrupt_record"]:
            return df
        # A list of plain values has no columns to read.
        return spark.read.text(lines).select(F.explode(F.from_json("value", "array<string>")).alias("item"))
    root = F.col(ident(root_key))
    items = df.select((F.explode(root) if many else root).alias("item"))
    return items.select("item.*") if isinstance(items.schema["item"].dataType, T.StructType) else items


def _put_together(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column that has different types in them becomes JSON text."""
    kinds: dict[str, set] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    out = []
    for df in frames:
        mixed = [f for f in df.schema.fields if len(kinds[f.name]) > 1 and not isinstance(f.dataType, T.StringType)]
        out.append(df.withColumns({f.name: F.to_json(F.col(ident(f.name))) for f in mixed}) if mixed else df)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), out)


def read_json_document(spark: SparkSession, path: str, root_key: str | None = None) -> JsonTable:
    """Records of documents that are a list, records under a root key, or a single object, file by file.

    Files are read together by shape, which is their root key and what is under it, each shape with a schema of
    its own; a shape's rows lack the columns of others. Numbers and booleans come back as the text in the
    file. ``structure`` is list or object, or mixed where files differ, and ``root_key`` that of all files,
    or None. Keys beside the root key of an object are not part of its records. A file that is no JSON
    is an error. Files are listed once and put down again in the shared folder as one document a line, a folder
    for each shape, so that neither the number of files nor that of shapes makes for more listings. Only the
    shapes reach the driver.
    """
    told = json_documents(spark, path, root_key)
    shapes = told.groupBy("structure", "root_key", "many", _shape()).count().collect()
    unreadable = sum(r["count"] for r in shapes if r["structure"] is None)
    if unreadable:
        raise ValueError(f"{unreadable} document(s) are no JSON")
    structures, roots = {r["structure"] for r in shapes}, {r["root_key"] for r in shapes}
    structure = structures.pop() if len(structures) == 1 else "mixed" if structures else "object"
    read = sorted({(r["root_key"] or "", r["many"], r["root_key"] is None, r["shape"]) for r in shapes})
    lines = f"{shared_dir(spark)}/documents-{uuid.uuid4().hex}"
    if read:
        # Line breaks in JSON are blanks between values; those in strings are escaped.
        told.select(F.translate("text", "\r\n", "  ").alias("value"), _shape()).write.partitionBy("shape").text(lines)
    frames = [_read_shape(spark, f"{lines}/shape={shape}", None if rootless else key, many) for key, many, rootless, shape in read]
    df = _put_together(frames) if frames else spark.createDataFrame([], T.StructType([]))
    return JsonTable(df, structure, roots.pop() if len(roots) == 1 else None)


def _shape() -> Column:
    """A name for the root key of a document and what is under it that is fit for a folder."""
    return F.concat(F.when(F.col("many"), "many-").otherwise("one-"), F.coalesce(F.sha2("root_key", 256), F.lit("rootless"))).alias("shape")


def flatten(df: DataFrame, max_level: int = 2, sep: str = SEPARATOR) -> tuple[DataFrame, dict[str, list[str]]]:
    """Objects down to ``max_level`` become columns joined by the separator.

    What lies deeper, and every list, becomes JSON text; those columns are named in the notes.
    A pure projection: it costs no shuffle and unused branches are pruned.
    """
    selected: list[Column] = []
    notes: dict[str, list[str]] = {}

    def walk(col: Column, name: str, dtype: T.DataType, level: int) -> None:
        if isinstance(dtype, T.StructType) and level < max_level:
            for f in dtype.fields:
                walk(col.getField(f.name), f"{name}{sep}{f.name}", f.dataType, level + 1)
        elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
            selected.append(F.to_json(col).alias(name))
            notes[name] = [f"collapsed nested structure (deeper than level {max_level} or a list)"]
        elif isinstance(dtype, T.VariantType):
            selected.append(F.to_json(col).alias(name))
            notes[name] = ["values of different types, kept as JSON text"]
        else:
            selected.append(col.alias(name))

    for f in df.schema.fields:
        walk(F.col("`" + f.name.replace("`", "``") + "`"), f.name, f.dataType, 0)
    return df.select(*selected), notes


def nest(df: DataFrame, groups: dict[str, list[str]], keep_nulls: bool = True) -> DataFrame:
    """Put flat columns into objects: {parent: [children]}. Children leave the root."""
    missing = [c for children in groups.values() for c in children if c not in df.columns]
    if missing:
        raise ValueError(f"columns to nest are not in the table: {missing}")
    inner = {c for children in groups.values() for c in children}
    flat = [F.col(c) for c in df.columns if c not in inner]
    return df.select(*flat, *[F.struct(*children).alias(parent) for parent, children in groups.items()])


def _plain_number(df: DataFrame, name: str) -> Column:
    """A DOUBLE as a number without an exponent where its text has none; NaN and infinities as text."""
    text = double_text_sql(ident(name))
    finite = f"not isnan({ident(name)}) and abs({ident(name)}) < double('infinity')"
    return F.expr(f"if({finite}, parse_json({text}), cast({text} as variant))")


def write_json(df: DataFrame, path: str, groups: dict[str, list[str]] | None = None) -> None:
    """JSON Lines with null keys kept and numbers as a landing file has them (12345678.5, not 1.23456785E7)."""
    doubles = {f.name: _plain_number(df, f.name) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    df = df.withColumns(doubles) if doubles else df
    out = nest(df, groups) if groups else df
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Each row of a frame (value) as a file of its own, all in one folder.

    Files cost time by their number, so they are dealt out among all shuffle partitions, however small they are.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(partitions, F.xxhash64("value")).write.option("maxRecordsPerFile", 1).text(path)


def observed_keys(df: DataFrame, column: str) -> DataFrame:
    """(name, occurrences) of the top-level keys in a column of JSON texts; per-task counts first."""
    keys = df.select(F.explode(F.json_object_keys(column)).alias("name"))
    return keys.groupBy("name").agg(F.count(F.lit(1)).alias("occurrences"))


def observed_schema(df: DataFrame, column: str) -> DataFrame:
    """Merged schema of drifting JSON texts; types in conflict become VARIANT."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("json_schema"))


def observed_types(df: DataFrame, column: str) -> DataFrame:
    """(name, type, occurrences) of the top-level keys in a column of JSON texts: a row for every type a key was seen with."""
    entries = df.select(F.explode(F.map_entries(F.from_json(column, "map<string,variant>"))).alias("e"))
    return entries.groupBy(F.col("e.key").alias("name"), F.schema_of_variant("e.value").alias("type")).agg(F.count(F.lit(1)).alias("occurrences"))
