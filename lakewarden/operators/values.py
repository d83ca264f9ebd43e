"""Counts of every distinct value of every column.

This is the one heavy step behind profiling, inference and most checks: each column is laid
out as (pos, value) rows and pre-aggregated before the only shuffle, so a value that fills a
third of a column reaches the shuffle as one row per map task. Columns of the same kind
share a branch and stay in their own type (a BIGINT column is hashed as BIGINT), which keeps
the hash table and the shuffle narrow; text is made afterwards, from distinct values only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from lakewarden.functions.numeric import double_text_sql, finite_number_sql, is_number_sql
from lakewarden.functions.sqltext import ident, literals
from lakewarden.functions.text import is_blank_sql

# Columns laid out together; a wider table is split into several branches of this many.
COLUMNS_PER_BRANCH = 64

_KINDS = {
    T.ByteType: "bigint", T.ShortType: "bigint", T.IntegerType: "bigint", T.LongType: "bigint",
    T.DoubleType: "double", T.TimestampType: "timestamp", T.DateType: "date",
    T.StringType: "string",
}


@dataclass(frozen=True)
class ColumnRef:
    pos: int
    name: str
    kind: str


def column_refs(df: DataFrame, columns: list[str] | None = None) -> list[ColumnRef]:
    wanted = columns or df.columns
    schema = df.schema
    kinds = {f.name: _KINDS.get(type(f.dataType), "string") for f in schema.fields}
    return [ColumnRef(i, c, kinds[c]) for i, c in enumerate(wanted)]


def text_sql(df: DataFrame, name: str) -> str:
    """A column as the text a landing file would hold."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DoubleType):
        return double_text_sql(ident(name))
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return f"to_json({ident(name)})"
    if isinstance(dtype, T.StringType):
        return ident(name)
    return f"cast({ident(name)} as string)"


def to_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.selectExpr(*[f"{text_sql(df, c)} as {ident(c)}" for c in columns or df.columns])


def _text_and_number(kind: str) -> tuple[str, str]:
    text = {"string": "v", "double": double_text_sql("v")}.get(kind, "cast(v as string)")
    return text, finite_number_sql(kind, "v")


# A text that is longer than this after trimming is no date, no boolean and, unless it looks
# like one, no number: where the text itself is not asked for, its digest stands in for it.
LONG_TEXT = 128


def digest_sql(text: str) -> str:
    """The text, or '#' and its SHA-512 where it is long.

    A digest has 129 characters, so it is long itself and no text that is kept can equal it.
    """
    return (f"if(octet_length({text}) > {LONG_TEXT} and length(trim({text})) > {LONG_TEXT} and not ({is_number_sql(text)}), "
            f"concat('#', sha2({text}, 512)), {text})")


def _branch(df: DataFrame, refs: list[ColumnRef], kind: str, digest: bool) -> DataFrame:
    def cell(ref: ColumnRef) -> str:
        if kind != "string":
            return f"cast({ident(ref.name)} as {kind})"
        dtype = df.schema[ref.name].dataType
        plain = isinstance(dtype, (T.BooleanType, T.DecimalType, T.FloatType)) or not digest
        return text_sql(df, ref.name) if plain else digest_sql(text_sql(df, ref.name))

    cells = [f"{cell(r)} as `{r.pos}`" for r in refs]
    long = df.selectExpr(*cells).unpivot([], [str(r.pos) for r in refs], "p", "v")
    counted = long.groupBy("p", "v").agg(F.expr("count(1) as cnt"))
    text, number = _text_and_number(kind)
    return counted.selectExpr(
        "coalesce(cast(p as int), 0) as pos",  # never NULL, and typed so
        f"{text} as value",
        f"{number} as number",
        "v is null as missing",
        f"{is_blank_sql('v') if kind == 'string' else 'v is null'} as blank",
        "cnt",
    )


def value_counts(df: DataFrame, columns: list[str] | None = None, digest: bool = False) -> DataFrame:
    """(pos, value, number, missing, blank, cnt), one row per column and distinct value.

    ``value`` is the text, ``number`` its DOUBLE where it is a number. Unused columns are
    pruned, so a consumer that needs no text never pays for making it. With ``digest`` long
    texts are counted by their SHA-512 and ``value`` holds that: for consumers that want to
    know how many texts there are and what they look like, not what they say.
    """
    by_kind: dict[str, list[ColumnRef]] = {}
    for ref in column_refs(df, columns):
        by_kind.setdefault(ref.kind, []).append(ref)
    branches = [
        _branch(df, refs[i:i + COLUMNS_PER_BRANCH], kind, digest)
        for kind, refs in by_kind.items()
        for i in range(0, len(refs), COLUMNS_PER_BRANCH)
    ]
    return reduce(DataFrame.unionByName, branches)


def name_columns(by_pos: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """Put column names back for positions; the list is as long as the table is wide."""
    return by_pos.selectExpr("pos", f"get({literals(names)}, pos) as column_name", *keep)


def empty_positions(df: DataFrame, width: int) -> DataFrame:
    """One row per column position, so that a table without rows still reports its columns."""
    return df.sparkSession.range(0, width, 1, 1).selectExpr("cast(id as int) as pos")
