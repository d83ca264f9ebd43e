"""Regulatory flags found in column names and labels."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

# Substrings looked for in lower-cased "name label", flags in this order.
FLAG_PATTERNS = {
    "LGPD_SENSITIVE": [
        "cpf", "cnpj", "rg", "passaporte", "nome", "email",
        "telefone", "celular", "endereco", "nascimento", "mae",
    ],
    "SCR_CANDIDATE": [
        "renda", "salario", "limite", "credito", "divida", "inadimplencia", "score", "rating",
    ],
    "RESTRICTED": ["senha", "token", "chave", "secret", "hash", "pin"],
}


def flag_conditions(name: Column, label: Column | None = None) -> dict[str, Column]:
    """One boolean per flag, over 'name label' in lower case.

    Plain substring tests: on long texts they are several times faster than one pattern with
    alternatives, and the lower-cased text is a shared subexpression.
    """
    text = F.lower(F.concat(name, F.lit(" "), F.coalesce(label, F.lit("")))
                   if label is not None else F.concat(name, F.lit(" ")))
    return {flag: reduce(or_, [F.contains(text, F.lit(w)) for w in words]) for flag, words in FLAG_PATTERNS.items()}


def _without_nulls(*marks: Column) -> Column:
    """Array of the marks that are set. Unlike array_compact this stays inside generated code,
    which is what lets the lower-cased text be shared between all tests.
    """
    return F.array_except(F.array(*marks), F.array(F.lit(None).cast("string")))


def regulatory_flags(name: Column, label: Column | None = None) -> Column:
    marks = [F.when(cond, F.lit(flag)) for flag, cond in flag_conditions(name, label).items()]
    return _without_nulls(*marks)


def tags_of(flags: Column) -> Column:
    """Table tags from the union of its column flags."""
    return _without_nulls(
        F.when(F.array_contains(flags, "LGPD_SENSITIVE"), F.lit("LGPD")),
        F.when(F.array_contains(flags, "SCR_CANDIDATE"), F.lit("SCR")),
        F.when(F.size(flags) > 0, F.lit("BACEN_4658")),
    )


def table_tags(columns: DataFrame, by: str = "table", flags: str = "regulatory_flags") -> DataFrame:
    """Tags and classification per table from a (table, flags array) frame.

    Three boolean buffers per table: nothing is collected, so a table with very many
    columns costs the same as any other.
    """
    has = {f: F.coalesce(F.bool_or(F.array_contains(flags, f)), F.lit(False)) for f in FLAG_PATTERNS}
    seen = columns.groupBy(by).agg(
        has["LGPD_SENSITIVE"].alias("_lgpd"),
        has["SCR_CANDIDATE"].alias("_scr"),
        F.coalesce(F.bool_or(F.size(flags) > 0), F.lit(False)).alias("_any"),
    )
    return seen.select(
        by,
        _without_nulls(
            F.when(F.col("_lgpd"), F.lit("LGPD")),
            F.when(F.col("_scr"), F.lit("SCR")),
            F.when(F.col("_any"), F.lit("BACEN_4658")),
        ).alias("tags"),
        F.when(F.col("_lgpd"), F.lit("confidential")).otherwise(F.lit("internal"))
        .alias("data_classification"),
    )
