"""Small helpers for expressions written as SQL text.

Rules that run once per table column are written as text: one parse in the JVM instead of a
Python call per operator, which is what keeps planning short for wide tables.
"""

from __future__ import annotations

from collections.abc import Iterable


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str | None) -> str:
    if text is None:
        return "cast(null as string)"
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literals(texts: Iterable[str]) -> str:
    """Array of string literals; typed even when empty."""
    return f"cast(array({', '.join(literal(t) for t in texts)}) as array<string>)"
