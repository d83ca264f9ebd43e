"""Code lists: storage formats to contract types, statuses to exit codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CONTRACT_TYPES = ("string", "integer", "float", "boolean", "date", "datetime")

# Fixed-width type codes by contract type; anything else is a string.
FIXED_WIDTH_CODES = {
    "string": ["char", "character", "c", "varchar", "alpha", "an", "binary", "b"],
    "float": ["numeric", "num", "n", "decimal", "dec", "packed"],
    "integer": ["integer", "int", "9"],
    "date": ["date", "d"],
    "datetime": ["datetime", "dt"],
}
BINARY_CODES = ["binary", "b"]

# Catalog format prefixes, tried in this order.
CATALOG_FORMAT_PREFIXES = [
    ("float", ["best", "comma", "dollar", "f", "e", "pct"]),
    ("integer", ["z", "ib", "pk"]),
    ("date", ["date", "ddmmyy", "mmddyy", "yymmdd", "yymmddn", "julian"]),
    ("datetime", ["datetime", "dt", "tod"]),
    ("string", ["$", "char"]),
]
CATALOG_BOOLEAN_FORMATS = ["yn", "yesno", "truefalse", "simnao"]

# Exit code per status; any other status is 1.
EXIT_CODES = {"PASS": 0, "SKIPPED": 0, "WARNING": 1, "DLQ": 2, "ERROR": 2}


def fixed_width_type(code: Column) -> Column:
    norm = F.lower(F.trim(code))
    out = F.when(F.lit(False), F.lit("string"))
    for contract_type, codes in FIXED_WIDTH_CODES.items():
        out = out.when(norm.isin(codes), F.lit(contract_type))
    return out.otherwise(F.lit("string"))


def clean_format(fmt: Column) -> Column:
    """Storage format without digits, dots and the leading or trailing $."""
    letters = F.translate(F.lower(F.coalesce(fmt, F.lit(""))), "0123456789.", "")
    return F.btrim(letters, F.lit("$"))


def catalog_type(clean: Column, storage: Column, fix_datetime: bool = False) -> Column:
    """Contract type of a SAS catalog column from its clean_format() and storage kind.

    'DATETIME19.' is a date here because the date prefixes are tried first; that is the
    established behaviour. ``fix_datetime`` tries the datetime prefixes before them.
    """
    groups = list(CATALOG_FORMAT_PREFIXES)
    if fix_datetime:
        groups.sort(key=lambda g: g[0] != "datetime")
    out = F.when(storage == "character", F.lit("string"))
    out = out.when(clean.isin(CATALOG_BOOLEAN_FORMATS), F.lit("boolean"))
    for contract_type, prefixes in groups:
        hit = F.lit(False)
        for prefix in prefixes:
            hit = hit | clean.startswith(prefix)
        out = out.when(hit, F.lit(contract_type))
    return out.otherwise(F.lit("float"))


def catalog_key(position: Column, name: Column) -> Column:
    """First catalog column with an identifier-like name."""
    return (position == 0) & name.rlike("cd_|id_|nr_|cod")


def exit_code(status: Column) -> Column:
    out = F.when(F.lit(False), F.lit(1))
    for name, code in EXIT_CODES.items():
        out = out.when(status == name, F.lit(code))
    return out.otherwise(F.lit(1))
