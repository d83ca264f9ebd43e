"""Column and table naming rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# (pattern, replacement) in order; lower-casing happens before the last two.
_WORD_BREAKS = [
    (r"[ \-]", "_"),
    (r"([A-Z]+)([A-Z][a-z])", r"$1_$2"),
    (r"([a-z\d])([A-Z])", r"$1_$2"),
    (r"(?U)[^\w]", "_"),
]
_UNDERSCORE_TIDY = [(r"_+", "_"), (r"^_|_$", "")]


def snake_case(name: Column) -> Column:
    out = F.trim(name)
    for pattern, repl in _WORD_BREAKS:
        out = F.regexp_replace(out, pattern, repl)
    out = F.lower(out)
    for pattern, repl in _UNDERSCORE_TIDY:
        out = F.regexp_replace(out, pattern, repl)
    return out


def json_path_name(path: Column) -> Column:
    """Tidy each level of an 'a__b__c' path on its own; the '__' separators stay."""

    def tidy(part: Column) -> Column:
        out = F.regexp_replace(F.lower(F.trim(part)), r"(?U)[^\w]", "_")
        for pattern, repl in _UNDERSCORE_TIDY:
            out = F.regexp_replace(out, pattern, repl)
        return out

    return F.array_join(F.transform(F.split(path, "__"), tidy), "__")


def base_table_name(contract_name: Column) -> Column:
    """Table behind a contract file name: scenario suffix and extension removed."""
    cut = F.split_part(contract_name, F.lit("_non_breaking"), F.lit(1))
    cut = F.split_part(cut, F.lit("_breaking"), F.lit(1))
    return F.replace(cut, F.lit(".yaml"), F.lit(""))


def snake_name(name: str) -> str:
    """Plan-time twin of snake_case, for names that come from a schema."""
    out = name.strip()
    for pattern, repl in _WORD_BREAKS:
        out = re.sub(pattern.replace("(?U)", ""), repl.replace("$", "\\"), out)
    out = out.lower()
    for pattern, repl in _UNDERSCORE_TIDY:
        out = re.sub(pattern, repl, out)
    return out


def json_path_tidy(path: str) -> str:
    """Plan-time twin of json_path_name."""
    parts = (re.sub(r"[^\w]", "_", p.strip().lower()) for p in path.split("__"))
    return "__".join(re.sub(r"_+", "_", p).strip("_") for p in parts)


def rename_snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])
