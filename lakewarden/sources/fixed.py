"""Fixed-width text: layouts, reading, writing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from lakewarden.contracts import Contract
from lakewarden.functions.codes import BINARY_CODES, fixed_width_type
from lakewarden.functions.flags import FLAG_PATTERNS
from lakewarden.functions.naming import snake_case
from lakewarden.functions.numeric import INTEGER_PATTERN, double_text_sql
from lakewarden.functions.sqltext import ident
from lakewarden.operators.infer import draft_document
from lakewarden.operators.ordered import previous_row
from lakewarden.sources.tabular import read_lines

# Header names accepted in a layout table.
LAYOUT_HEADERS = {
    "name": ["campo", "field", "nome", "name"],
    "start": ["inicio", "start", "ini"],
    "end": ["fim", "end", "fin"],
    "type": ["tipo", "type", "dtype"],
    "desc": ["descricao", "description", "desc"],
}
SPACE_SHARE = 0.7
#: Positions counted in one array, arrays a task holds before it sends them on, and characters looked at together.
RANGE, HELD_RANGES, GROUP_CHARS = 1 << 16, 128, 1 << 22
INFERENCE_WARNING = "layout guessed from blank columns; compare it with the file's specification"


@dataclass(frozen=True)
class Field:
    """One field; ``start`` is 1-based."""

    name: str
    start: int
    width: int
    type: str = "string"


def layout_of(widths: list[tuple[str, int, str]]) -> list[Field]:
    """Layout from (name, width, type) in order."""
    if not widths:
        raise ValueError("a layout needs at least one field")
    fields, start = [], 1
    for name, width, dtype in widths:
        fields.append(Field(name, start, width, dtype))
        start += width
    return fields


def layout_offsets(widths: DataFrame, by: list[str], order: str = "pos") -> DataFrame:
    """Running 1-based start and inclusive end from field widths, per layout."""
    upto = F.sum("width").over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return widths.withColumn("end", upto).withColumn("start", F.col("end") - F.col("width") + 1)


def parse_fixed(lines: DataFrame, layout: list[Field], value: str = "value") -> DataFrame:
    """Fields of fixed-width lines: trimmed text, blank as NULL. Unused fields are never cut."""
    return lines.selectExpr(*[
        f"nullif(trim(substring({ident(value)}, {int(f.start)}, {int(f.width)})), '') as {ident(f.name)}" for f in layout])


def read_fixed(spark: SparkSession, path: str, layout: list[Field], encoding: str | None = None) -> DataFrame:
    """Positions are characters of the file's encoding."""
    return parse_fixed(read_lines(spark, path, encoding), layout)


def field_sql(name: str, dtype: T.DataType, width: int, contract_type: str) -> str:
    """One value in exactly ``width`` characters: numbers right-aligned, others left, NULL as spaces.

    Both pads also cut a longer value at the right.
    """
    text = double_text_sql(ident(name)) if isinstance(dtype, T.DoubleType) else f"cast({ident(name)} as string)"
    pad = "lpad" if contract_type in ("integer", "float") else "rpad"
    return f"{pad}(coalesce({text}, ''), {int(width)}, ' ')"


def format_fixed(df: DataFrame, layout: list[Field]) -> DataFrame:
    """Single-column frame of fixed-width lines."""
    if not layout:
        raise ValueError("a layout needs at least one field")
    missing = [f.name for f in layout if f.name not in df.columns]
    if missing:
        raise ValueError(f"layout columns are not in the table: {missing}")
    parts = [field_sql(f.name, df.schema[f.name].dataType, f.width, f.type) for f in layout]
    return df.selectExpr(f"concat({', '.join(parts)}) as value")


def write_fixed(df: DataFrame, path: str, layout: list[Field]) -> None:
    format_fixed(df, layout).write.mode("overwrite").text(path)


def _named_field(name: Column, start: Column, end: Column, code: Column, desc: Column) -> list[Column]:
    return [
        snake_case(name).alias("name"),
        name.alias("sas_label"),
        start.cast("int").alias("start"),
        end.cast("int").alias("end"),
        fixed_width_type(code).alias("type"),
        F.coalesce(desc, F.concat(F.lit("# TODO: describe "), snake_case(name))).alias("description"),
        F.coalesce(F.lower(F.trim(code)).isin(BINARY_CODES), F.lit(False)).alias("binary"),
    ]


def parse_layout_lines(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Layout text lines 'name start end [type [description]]'.

    Blank lines and lines starting with # are left out; a line that is neither becomes a
    row with a reason in ``rejected``.
    """
    text = F.trim(F.col(value))
    tokens = F.split(text, r"\s+")
    cut = lines.filter((text != "") & ~text.startswith("#")).select(*keep, text.alias("line"), tokens.alias("t"))
    bounds_ok = F.get("t", F.lit(1)).rlike(INTEGER_PATTERN) & F.get("t", F.lit(2)).rlike(INTEGER_PATTERN)
    reason = (F.when(F.size("t") < 3, F.lit("ignored: fewer than three fields"))
              .when(~bounds_ok, F.lit("invalid: start and end must be whole numbers")))
    desc = F.nullif(F.array_join(F.slice("t", 5, F.greatest(F.size("t") - 4, F.lit(0))), " "), F.lit(""))
    return cut.select(
        *keep,
        *_named_field(F.get("t", F.lit(0)), F.get("t", F.lit(1)).try_cast("int"), F.get("t", F.lit(2)).try_cast("int"),
                      F.lower(F.coalesce(F.get("t", F.lit(3)), F.lit("char"))), desc),
        reason.alias("rejected"),
        "line",
    )


def parse_layout_table(df: DataFrame) -> DataFrame:
    """Layout rows from a table whose header uses any of the accepted names."""
    alias = {h: k for k, hs in LAYOUT_HEADERS.items() for h in hs}
    renamed = df.toDF(*[alias.get(c.strip().lower(), c.strip().lower()) for c in df.columns])
    if not {"name", "start", "end"} <= set(renamed.columns):
        raise ValueError(f"a layout table needs name, start and end; found {df.columns}")
    code = F.lower(F.trim("type")) if "type" in renamed.columns else F.lit("char")
    desc = F.trim("desc") if "desc" in renamed.columns else F.lit(None).cast("string")
    bounds_ok = F.trim("start").rlike(INTEGER_PATTERN) & F.trim("end").rlike(INTEGER_PATTERN)
    return renamed.select(
        *_named_field(F.trim("name"), F.trim("start").try_cast("int"), F.trim("end").try_cast("int"), code, desc),
        F.when(~F.coalesce(bounds_ok, F.lit(False)), F.lit("invalid: start and end must be whole numbers")).alias("rejected"),
    )


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    if path.lower().endswith(".csv"):
        return parse_layout_table(spark.read.option("header", True).option("mode", "DROPMALFORMED").csv(path))
    return parse_layout_lines(spark.read.text(path))


def check_layout(fields: DataFrame, by: list[str], tie: str = "name") -> DataFrame:
    """Reversed bounds, overlaps and gaps of fields sorted by start; the first field is exempt.

    The previous field is looked up over even cuts, so that one layout with very many fields is
    not sorted in a single task.
    """
    out = previous_row(fields, by, ["start", tie], {"prev_end": "end"})
    prev = F.coalesce(F.col("prev_end"), F.lit(0))
    follows = prev > 0
    return out.select(
        *by, tie, "start", "end", "prev_end",
        (F.col("end") < F.col("start")).alias("reversed"),
        (follows & (F.col("start") <= prev)).alias("overlap"),
        F.when(follows & (F.col("start") > prev + 1), F.col("start") - prev - 1).otherwise(F.lit(0)).cast("bigint").alias("gap"),
    )


def layout_findings(checked: DataFrame, tie: str = "name") -> DataFrame:
    """(finding, field, position, bytes) of check_layout(): fields that run backwards, overlaps and gaps."""
    kinds = {
        "backwards": (F.col("reversed"), F.col("start") - F.col("end")),
        "overlap": (F.col("overlap"), F.col("prev_end") - F.col("start") + 1),
        "gap": (F.col("gap") > 0, F.col("gap")),
    }
    found = F.array_compact(F.array(*[F.when(hit, F.struct(F.lit(k).alias("finding"), size.cast("bigint").alias("bytes"))) for k, (hit, size) in kinds.items()]))
    return checked.select(F.explode(found).alias("f"), F.col(tie).alias("field"), F.col("start").alias("position")).select("f.finding", "field", "position", "f.bytes")


def space_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """(pos, spaces): how many lines have a space at each 0-based position; positions without any have no row.

    A task adds up its own lines in arrays over ranges of positions, so what is shuffled is one row per
    position and task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for group in _groups(batch.column(0)):
                sizes = np.fromiter(map(len, group), np.int64, len(group))
                chars = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32)
                at = np.flatnonzero(chars == 32)
                at -= np.repeat(np.cumsum(sizes) - sizes, sizes)[at]
                for k in np.unique(at // RANGE):
                    held[int(k)] = held.get(int(k), 0) + np.bincount(at[at // RANGE == k] % RANGE, minlength=RANGE)
            if len(held) > HELD_RANGES:
                yield from map(_rows, held.items())
                held.clear()
        yield from map(_rows, held.items())

    filled = lines.filter(F.col(value) != "").select(value)
    return filled.mapInArrow(count, "pos int, spaces long").groupBy("pos").agg(F.sum("spaces").alias("spaces"))


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """Lines of a batch in groups of bounded size."""
    group, size = [], 0
    for line in column:
        group.append(line.as_py())
        size += len(group[-1])
        if size > GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _rows(item: tuple[int, np.ndarray]) -> pa.RecordBatch:
    at = np.flatnonzero(item[1])
    return pa.RecordBatch.from_arrays([pa.array(item[0] * RANGE + at, pa.int32()), pa.array(item[1][at], pa.int64())], ["pos", "spaces"])


def infer_layout(lines: DataFrame, value: str = "value") -> DataFrame:
    """Fields as runs of positions that are mostly not spaces: (name, start, end), 1-based inclusive.

    Runs are the gaps between positions that are mostly spaces, the end of the longest line being one
    too. Gaps are found and numbered inside ranges of positions, then over the ranges: a text has fewer than
    2**31 characters, so there are fewer than 2**15 ranges.
    """
    filled = lines.filter(F.col(value) != "")
    total = filled.agg(F.struct(F.count(F.lit(1)).alias("lines"), F.max(F.length(value)).alias("longest")).alias("t")).scalar()
    spaces = space_counts(lines, value).filter(F.col("spaces") / total["lines"] >= SPACE_SHARE).select("pos")
    end = lines.sparkSession.range(1).select(total["longest"].alias("pos")).filter("pos is not null")
    marks = spaces.unionAll(end).withColumn("_range", F.floor(F.col("pos") / RANGE).cast("int"))
    inside, over = W.partitionBy("_range").orderBy("pos"), W.partitionBy(F.floor(F.col("_range") / RANGE)).orderBy("_range")
    marks = marks.withColumn("_prev", F.lag("pos").over(inside))
    ranges = marks.groupBy("_range").agg(F.min("pos").alias("_first"), F.max("pos").alias("_last"), F.count_if(F.col("pos") - F.col("_prev") > 1).alias("_gaps"))
    ranges = ranges.withColumn("_before", F.coalesce(F.lag("_last").over(over), F.lit(-1)))
    ranges = ranges.withColumn("_gaps", F.col("_gaps") + F.when(F.col("_first") - F.col("_before") > 1, 1).otherwise(0))
    ranges = ranges.withColumn("_base", F.sum("_gaps").over(over) - F.col("_gaps"))
    gaps = marks.join(ranges.select("_range", "_before", "_base"), "_range").withColumn("first", F.coalesce("_prev", "_before") + 1)
    gaps = gaps.withColumn("_size", F.col("pos") - F.col("first"))
    gaps = gaps.withColumn("run", F.col("_base") + F.count_if(F.col("_size") > 0).over(inside))
    # A line that begins with spaces has an empty first run, which still takes a number.
    leads = spaces.filter("pos = 0").agg(F.count(F.lit(1))).scalar()
    return gaps.filter("_size > 1").select(
        F.format_string("campo_%03d", F.col("run") + leads).alias("name"), (F.col("first") + 1).alias("start"), F.col("pos").alias("end"))


def fields_of(layout_rows: list) -> list[Field]:
    """Field list from collected layout rows (a layout is as long as a record is wide)."""
    return [Field(r["name"], r["start"], r["end"] - r["start"] + 1, r["type"] if "type" in r else "string")
            for r in sorted(layout_rows, key=lambda r: r["start"])]


def contract_from_layout(layout: DataFrame, table: str, inferred: bool = False) -> tuple[Contract, list[str]]:
    """Draft contract of a fixed-width table, and the warnings of its layout."""
    if "rejected" in layout.columns:
        warnings = [f"Line {r['rejected']}" for r in layout.filter(F.col("rejected").isNotNull()).collect()]
        good = layout.filter(F.col("rejected").isNull())
    else:
        warnings, good = [], layout
    rows = sorted(good.collect(), key=lambda r: r["start"])
    if inferred:
        warnings.append(INFERENCE_WARNING)
        if len(rows) <= 1:
            warnings.append("no blank columns tell fields apart; supply a layout")
    if rows:
        checked = check_layout(good.withColumn("layout", F.lit(table)), ["layout"])
        warnings += [f"{r['finding']} at byte {r['position']}, field {r['field']}: {r['bytes']} byte(s)" for r in layout_findings(checked).collect()]
    columns = []
    for r in rows:
        d = r.asDict()
        text = f"{d['name']} {d.get('sas_label') or d['name']}".lower()
        columns.append({
            "name": d["name"], "type": d.get("type", "string"), "nullable": True, "primary_key": False,
            "description": d.get("description") or f"# TODO: describe {d['name']}",
            "sas_label": d.get("sas_label") or d["name"],
            "regulatory_flags": [f for f, words in FLAG_PATTERNS.items() if any(w in text for w in words)],
            "business_rules": ["Binary field, check the conversion"] if d.get("binary") else [],
        })
    document = draft_document(table, columns, "fixed_width", encoding="# TODO: encoding of the file",
                              status="DRAFT_EXPERIMENTAL" if inferred else "DRAFT")
    document["layout"] = [{"field": r["name"], "start": r["start"], "end": r["end"],
                           "dtype": r["type"] if "type" in r else "string"} for r in rows]
    return Contract.of(document), warnings
