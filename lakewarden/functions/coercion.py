"""Which texts are booleans, dates or members of a declared type (all as SQL text)."""

from __future__ import annotations

from lakewarden.functions.numeric import INFINITY_PATTERN, INTEGER_PATTERN, NAN_PATTERN, NUMBER_PATTERN
from lakewarden.functions.sqltext import literal, literals

# Complete boolean domains. A column is boolean when its distinct lower-cased
# values are exactly one of these sets.
BOOLEAN_DOMAINS = [
    ["0", "1"],
    ["s", "n"],
    ["sim", "nao", "não"],
    ["true", "false"],
    ["y", "n"],
    ["yes", "no"],
]
# What a boolean key column may hold.
BOOLEAN_WORDS = ["true", "false", "1", "0", "yes", "no", "sim", "não", "nao"]

# Fixed values: (label, shape, Spark pattern) of the date formats, first full match wins.
DATE_FORMATS = [
    ("%d/%m/%Y", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"),
    ("%d-%m-%Y", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "d-M-yyyy"),
    ("%Y-%m-%d", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"),
    ("%Y/%m/%d", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    ("%d/%m/%y", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", "d/M/yy"),
]

_WORDS = sorted({w for domain in BOOLEAN_DOMAINS for w in domain})


def boolean_bit_sql(value: str) -> str:
    """One bit per known word, bit 0 for anything else; OR them over a column."""
    return f"shiftleft(1L, cast(array_position({literals(_WORDS)}, lower(trim({value}))) as int))"


def is_boolean_domain_sql(bits: str) -> str:
    """True when the ORed bits are exactly one complete domain."""
    masks = [sum(2 << _WORDS.index(w) for w in domain) for domain in BOOLEAN_DOMAINS]
    return f"{bits} in ({', '.join(f'{m}L' for m in masks)})"


def matches_date_sql(value: str, shape: str, pattern: str) -> str:
    return (f"case when trim({value}) rlike r'{shape}' "
            f"then try_to_timestamp(trim({value}), '{pattern}') is not null else false end")


def fits_type_sql(value: str, contract_type: str) -> str:
    """Whether a key value can be read as its declared type; NULL always fits."""
    text = f"trim({value})"
    if contract_type == "integer":
        ok = f"{text} rlike r'{INTEGER_PATTERN}'"
    elif contract_type == "float":
        ok = " or ".join(f"{text} rlike r'{p}'" for p in (NUMBER_PATTERN, INFINITY_PATTERN, NAN_PATTERN))
    elif contract_type == "boolean":
        ok = f"lower({text}) in ({', '.join(literal(w) for w in BOOLEAN_WORDS)})"
    else:
        return "true"
    return f"({value} is null or {ok})"
