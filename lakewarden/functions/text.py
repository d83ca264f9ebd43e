"""Predicates on text values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the marker left in a draft contract where a person still has to write something.
TODO_MARKER = "# TODO"


def is_blank_sql(text: str) -> str:
    """NULL or only spaces; what the profiler counts as null."""
    return f"({text} is null or trim({text}) = '')"


def has_todo(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit(TODO_MARKER)), F.lit(False))


def is_unfilled(text: Column) -> Column:
    """Nothing written yet, or still carrying the marker."""
    return (F.coalesce(text, F.lit("")) == "") | has_todo(text)
