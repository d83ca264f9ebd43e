"""One entry point for landing formats."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lakewarden.contracts import Contract
from lakewarden.operators.values import to_text
from lakewarden.sources.fixed import Field, fields_of, infer_layout, read_fixed, write_fixed
from lakewarden.sources.nested import flatten, read_json_document, read_json_lines, write_json
from lakewarden.sources.tabular import breaks_inside_quotes, read_csv, read_lines, read_split_lines, write_csv

FORMATS = ("csv", "json", "fixed")
SUFFIXES = {
    "csv": "csv", "tsv": "csv", "json": "json", "jsonl": "json", "ndjson": "json",
    "txt": "fixed", "dat": "fixed", "pos": "fixed", "fix": "fixed", "parquet": "parquet",
}
LOAD_LEVELS = 5


def format_of(path: str, fmt: str | None = None) -> str:
    """Format by name (any case, 'fixed_width' too) or else by suffix; csv when there is none."""
    if fmt is not None:
        name = fmt.strip().lower()
        name = "fixed" if name == "fixed_width" else name
        if name not in FORMATS + ("parquet",):
            raise ValueError(f"unsupported format '{fmt}', choose one of {', '.join(FORMATS)}")
        return name
    suffix = re.search(r"\.([A-Za-z0-9]+)/?$", path)
    return SUFFIXES.get(suffix.group(1).lower(), "csv") if suffix else "csv"


def read_table(spark: SparkSession, path: str, fmt: str | None = None, layout: list[Field] | None = None,
               encoding: str | None = None, **options) -> DataFrame:
    """A landing table as strings, whatever its format; numbers in JSON stay as written."""
    kind = format_of(path, fmt)
    if kind == "parquet":
        return to_text(spark.read.parquet(path))
    if kind == "csv":
        return read_csv(spark, path, encoding=encoding, **options)
    if kind == "json":
        lines = path.lower().rstrip("/").endswith((".jsonl", ".ndjson"))
        table = (read_json_lines(spark, path, as_text=True, **options) if lines else read_json_document(spark, path, **options))
        return to_text(flatten(table.df, max_level=LOAD_LEVELS)[0])
    if layout:
        return read_fixed(spark, path, layout, encoding)
    guessed = fields_of(infer_layout(read_lines(spark, path, encoding)).collect())
    if len(guessed) > 1:
        return read_fixed(spark, path, guessed, encoding)
    return read_split_lines(read_lines(spark, path, encoding))


def read_load(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """A landing table read as its contract says: format, delimiter, encoding, line breaks inside quotes and, for fixed width, layout.

    Where the contract does not say whether quoted text may span lines, the lines themselves tell.
    """
    source = contract.source or {}
    kind, encoding = format_of(path, source.get("format")), source.get("encoding")
    if kind == "csv":
        breaks = source.get("multi_line")
        breaks = breaks_inside_quotes(read_lines(spark, path, encoding)) if breaks is None else bool(breaks)
        return read_csv(spark, path, sep=source.get("delimiter"), encoding=encoding, multi_line=breaks)
    layout = [Field(f["field"], f["start"], f["end"] - f["start"] + 1, f.get("dtype") or "string") for f in contract.layout]
    return read_table(spark, path, kind, layout or None, encoding)


def write_table(df: DataFrame, path: str, fmt: str, layout: list[Field] | None = None, **options) -> None:
    kind = format_of(path, fmt)
    if kind == "csv":
        write_csv(df, path, **options)
    elif kind == "json":
        write_json(df, path, **options)
    elif kind == "fixed":
        write_fixed(df, path, layout or [])
    else:
        df.write.mode("overwrite").parquet(path)
