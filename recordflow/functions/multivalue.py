"""Cells that hold a set of values: arrays inside, ``||``-joined text at the edges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordflow.functions.text import strip

# Fixed value: the separator of multi-valued cells.
SEPARATOR = "||"


def join_values(c: Column, separator: str = SEPARATOR) -> Column:
    """Array to cell text; a NULL array is an empty cell."""
    return F.coalesce(F.array_join(c, separator), F.lit(""))


def join_prefixed(c: Column, prefix: str, separator: str = SEPARATOR) -> Column:
    """Array without NULL members to cell text, ``prefix`` before each member."""
    joined = F.concat(F.lit(prefix), F.array_join(c, separator + prefix))
    return F.when(F.size(c) > 0, joined).otherwise(F.lit(""))


def raw_values(c: Column, separator: str = SEPARATOR) -> Column:
    """Cell text to all that stands between its separators."""
    return F.split(c, r"\Q" + separator + r"\E")


def is_value(member: Column) -> Column:
    """Whether a trimmed member is neither blank nor a ``nan`` leftover."""
    return (member != "") & (F.lower(member) != "nan")


def split_values(c: Column, separator: str = SEPARATOR) -> Column:
    """Cell text to its trimmed members, without blanks and ``nan`` leftovers."""
    return F.filter(F.transform(raw_values(c, separator), strip), is_value)


def has_member(c: Column, term: str, separator: str = SEPARATOR) -> Column:
    """One member of the cell equals ``term`` literally.

    Framing cell and term with the separator turns the test into one literal
    substring search: no regular expression and no array per row.
    """
    framed = F.concat(F.lit(separator), c, F.lit(separator))
    return framed.contains(separator + term + separator)
