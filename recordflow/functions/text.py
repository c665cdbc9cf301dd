"""Text rendering, field merging and cleaning."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Control characters removed from text (tab, LF and CR are kept),
# and what counts as a number when a protocol is rendered.
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
# Removed characters that put the texts of a row together.
BETWEEN_TEXTS, NULL_TEXT = "\x1f", "\x1e"
DECIMAL_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

WHITESPACE = " \t\n\r\x0b\x0c"

_LONG_LIMIT = float(2**63)


def strip(c: Column) -> Column:
    """Remove surrounding white space of any kind, not only spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def as_text(c: Column) -> Column:
    """Any type as text, NULL as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def first_non_blank(*sources: Column) -> Column:
    """First source that is neither NULL nor empty, in priority order, else empty."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in sources], F.lit(""))


def first_non_null_text(*sources: Column) -> Column:
    """First non-NULL source as text (no blank test), else empty."""
    return F.coalesce(*[c.cast("string") for c in sources], F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c.cast("string"), F.lit(""))


def strip_control_chars(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL_CHARS, "")


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _packed_name(columns: Sequence[str]) -> str:
    packed = "_texts"
    while packed in columns:
        packed += "_"
    return packed


def _cleaned_array(df: DataFrame, texts: Sequence[str], packed: str) -> DataFrame:
    """The other columns and, as one array, the cleaned texts.

    The texts of a row are searched as one; only a row that holds a control
    character is cleaned text by text.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in texts]
    gathered = df.select(*others, F.array(*[F.col(f"`{c}`") for c in texts]).alias(packed))
    found = F.array_join(packed, "").rlike(CONTROL_CHARS)
    return gathered.withColumn(packed, F.when(found, F.transform(packed, strip_control_chars)).otherwise(F.col(packed)))


def strip_control_everywhere(df: DataFrame) -> DataFrame:
    """Clean every text column of a frame."""
    texts = {name: i for i, name in enumerate(_text_columns(df))}
    if not texts:
        return df
    packed = _packed_name(df.columns)
    cleaned = _cleaned_array(df, list(texts), packed)
    return cleaned.select(*[F.get(packed, F.lit(texts[c])).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def strip_control_packed(df: DataFrame, apart: Sequence[str] = ()) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """:func:`strip_control_everywhere` in two steps: a frame with all texts but ``apart`` in one column, and what takes them apart.

    Rows of many texts are shuffled smaller that way: a row holds eight bytes for
    the place of each, different ones in every row. What stands between the texts
    and for NULL are control characters, so no cleaned text holds them. Bytes that
    are no UTF-8 would not survive that; a row that has some keeps an array.
    """
    texts = [c for c in _text_columns(df) if c not in apart]
    if not texts:
        return strip_control_everywhere(df), lambda rows: rows
    columns = df.columns
    packed = _packed_name(columns)
    odd = _packed_name([*columns, packed])
    alone = [c for c in _text_columns(df) if c in apart]
    cleaned = _cleaned_array(df, texts + alone, packed)
    frame = cleaned.select(
        *[F.col(f"`{c}`") for c in cleaned.columns if c != packed],
        *[F.get(packed, F.lit(i)).alias(c) for i, c in enumerate(alone, len(texts))],
        F.slice(packed, 1, len(texts)).alias(odd),
    ).withColumn(packed, F.array_join(odd, BETWEEN_TEXTS, NULL_TEXT))
    valid = F.is_valid_utf8(packed)
    frame = frame.withColumns({packed: F.when(valid, F.col(packed)), odd: F.when(~valid, F.col(odd))})
    places = {c: i for i, c in enumerate(texts)}

    def unpacked(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn(odd, F.coalesce(F.split(packed, BETWEEN_TEXTS), F.col(odd)))
        own = {c: F.nullif(F.get(odd, F.lit(i)), F.lit(NULL_TEXT)).alias(c) for c, i in places.items()}
        return rows.select(*[own.get(c, F.col(f"`{c}`")) for c in columns])

    return frame, unpacked


def protocol_text(c: Column) -> Column:
    """Spreadsheet-safe protocol: numbers are truncated and prefixed with ``'``.

    Blank gives NULL, other text is kept. The double detour is intended: it
    truncates toward zero and loses digits beyond 2**53 as in the original
    output. Numbers outside the 64-bit range are kept as text.
    """
    text = c.cast("string")
    number = text.try_cast("double")
    whole = number.try_cast("bigint")
    numeric = text.rlike(DECIMAL_NUMBER) & (F.abs(number) < F.lit(_LONG_LIMIT))
    return (
        F.when(text.isNull() | (text == ""), F.lit(None).cast("string"))
        .when(numeric, F.concat(F.lit("'"), whole.cast("string")))
        .otherwise(text)
    )


def search_key(c: Column) -> Column:
    """Normal form used for searching: NULL as empty, lower case, trimmed."""
    return strip(F.lower(as_text(c)))
