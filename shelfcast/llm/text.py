"""Column expressions shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the characters that separate words, as a regular-expression class body.
SPACES = r"\x20\x09-\x0D"


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Runs of non-space characters."""
    return F.array_remove(F.split(text, f"[{SPACES}]+"), "")


def n_bytes(text: Column) -> Column:
    return F.octet_length(whole(text)).cast("long")
