"""Number handling shared by profiling, validation and inference.

Functions ending in ``_sql`` take and return SQL text; the others work on Columns.
"""

from __future__ import annotations

# Text that counts as a number, after trimming. Stricter than a cast: Spark also
# accepts '1d' and other engines also accept '1_000'.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
INFINITY_PATTERN = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"
NAN_PATTERN = r"^[+-]?[nN][aA][nN]$"


def is_number_sql(text: str) -> str:
    return f"trim({text}) rlike r'{NUMBER_PATTERN}'"


def to_number_sql(text: str) -> str:
    """DOUBLE value of a text, NULL where the text is no number."""
    return f"case when {is_number_sql(text)} then try_cast(trim({text}) as double) end"


def finite_number_sql(kind: str, value: str) -> str:
    """DOUBLE of a value of that kind: text that is a number, or a number that is neither NaN nor infinite."""
    if kind == "string":
        return to_number_sql(value)
    if kind == "double":
        return f"case when not isnan({value}) and abs({value}) < double('infinity') then {value} end"
    return f"cast({value} as double)" if kind == "bigint" else "cast(null as double)"


def round_sql(value: str, digits: int) -> str:
    """Round half up with plain double arithmetic, so every engine agrees on the digits.

    From 2**52 / 10**digits on a double has no digits left to round (and floor would leave the range of
    a bigint); such values, infinities and NaN stay as they are.
    """
    scale = f"{10**digits}.0D"
    limit = f"{float(2**52 // 10**digits)!r}D"
    return f"case when abs({value}) < {limit} then floor(({value}) * {scale} + 0.5D) / {scale} else ({value}) end"


def percent_sql(part: str, whole: str, digits: int = 2) -> str:
    """100 * part / whole rounded; 0 when there is nothing to divide by."""
    ratio = f"cast({part} as double) * 100.0D / cast({whole} as double)"
    return f"case when {whole} > 0 then {round_sql(ratio, digits)} else 0.0D end"


def double_text_sql(value: str) -> str:
    """Text of a DOUBLE without an exponent between 1e-4 and 1e16 ('10000000.0', not '1.0E7')."""
    plain = f"rtrim('0', cast(cast(cast({value} as string) as decimal(38,20)) as string))"
    return (f"case when (abs({value}) >= 1e7D and abs({value}) < 1e16D) or (abs({value}) >= 1e-4D and abs({value}) < 1e-3D) "
            f"then case when endswith({plain}, '.') then concat({plain}, '0') else {plain} end "
            f"else cast({value} as string) end")

