"""Record lookup and search over multi-valued cells."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.functions.multivalue import SEPARATOR, has_member
from recordflow.functions.text import search_key

# How many hits a console shows; callers that want them pass them.
LOOKUP_SIZE = 10
SEARCH_SIZE = 2000


def _first(df: DataFrame, order: Sequence[str], size: int | None) -> DataFrame:
    return df.orderBy(*order) if size is None else df.orderBy(*order).limit(size)


def is_number(term: str) -> bool:
    """Decimal digits as an id has them; other scripts' digits and superscripts are patterns."""
    return term.isascii() and term.isdigit()


def lookup_condition(df: DataFrame, term: str, id_column: str, name_column: str) -> Column:
    """What :func:`lookup` asks of a row."""
    ident = F.col(id_column).cast("string")
    if is_number(term):
        kind = df.schema[id_column].dataType
        typed = isinstance(kind, T.IntegralType) and str(int(term)) == term and int(term) < 1 << 31
        return F.col(id_column) == F.lit(int(term)).cast(kind) if typed else ident == term
    pattern = F.lit("(?i)" + term)
    return F.coalesce(F.regexp_like(ident, pattern), F.lit(False)) | F.coalesce(
        F.regexp_like(F.col(name_column), pattern), F.lit(False)
    )


def lookup(
    df: DataFrame, term: str, id_column: str, name_column: str, order: Sequence[str] | None = None,
    size: int | None = None,
) -> DataFrame:
    """Hits for a term, in order: digits are an exact id, else a pattern on id or name.

    The pattern is a case-insensitive regular expression; NULL never matches.
    ``size`` keeps the first hits only. A number in its plain form is compared
    with a numeric id column as a number, so the filter reaches the scan.
    """
    hit = lookup_condition(df, term, id_column, name_column)
    return _first(df.where(hit), order or [id_column], size)


def exact_condition(term: str, id_column: str, name_column: str, separator: str) -> Column:
    return (search_key(F.col(id_column)) == term) | has_member(search_key(F.col(name_column)), term, separator)


def contains_condition(term: str, id_column: str, name_column: str) -> Column:
    return search_key(F.col(name_column)).contains(term) | search_key(F.col(id_column)).contains(term)


def search_exact(
    df: DataFrame, term: str, id_column: str, name_column: str, separator: str = SEPARATOR
) -> DataFrame:
    """Id equals the term, or one member of the multi-valued cell does."""
    return df.where(exact_condition(term.strip().lower(), id_column, name_column, separator))


def search_contains(df: DataFrame, term: str, id_column: str, name_column: str) -> DataFrame:
    """The term occurs literally in the id or the names."""
    return df.where(contains_condition(term.strip().lower(), id_column, name_column))


def search_exact_or_partial(
    df: DataFrame,
    term: str,
    id_column: str,
    name_column: str,
    order: Sequence[str] | None = None,
    size: int | None = None,
    separator: str = SEPARATOR,
) -> DataFrame:
    """All exact hits if there are any, else the partial hits, or the first ``size`` of them.

    Whether an exact hit exists is an uncorrelated ``EXISTS`` that stops at the
    first one; the plan has no global window and no join. A blank term lists
    all rows, or the first ``size``. Exact hits are never cut.
    """
    order = order or [id_column]
    term = term.strip().lower()
    if not term:
        return _first(df, order, size)
    exact = df.where(exact_condition(term, id_column, name_column, separator))
    partial = df.where(~exact.exists() & contains_condition(term, id_column, name_column))
    return exact.unionAll(partial if size is None else _first(partial, order, size))


def search_records(
    df: DataFrame,
    term: str | None = None,
    text_column: str = "text",
    date_column: str | None = None,
    start: date | None = None,
    end: date | None = None,
    type_column: str | None = None,
    type_value: str | None = None,
) -> DataFrame:
    """Free term, inclusive date range and type; every part is optional.

    The date range is a plain comparison on the column (end exclusive at the
    next midnight), so it reaches the scan.
    """
    if type_column and type_value is not None:
        df = df.where(F.col(type_column) == type_value)
    if date_column and start is not None:
        df = df.where(F.col(date_column) >= F.lit(start))
    if date_column and end is not None:
        df = df.where(F.col(date_column) < F.date_add(F.lit(end), 1))
    if term:
        df = df.where(F.lower(F.col(text_column)).contains(term.lower()))
    return df
