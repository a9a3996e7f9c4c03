"""Column expressions on texts, shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words, as a character class and as plain characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """All words of the text in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"([^{SPACE_CLASS}]+)"), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE_CLASS}]+")).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body reads it.

    A lambda variable over a one-element array: unlike a projected column it cannot
    be inlined into the loops of the body.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def unused(name: str, columns: list[str]) -> str:
    """``name``, or with underscores behind it until no column (of any case) has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
