"""Tri-state flags (true / false / unknown) and their text form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The spellings of a flag and its rendered labels.
TRUE_TEXT = ("1", "true")
FALSE_TEXT = ("0", "false")
YES_LABEL = "Sim"
NO_LABEL = "Não"


def _spelling(c: Column, ignore_case: bool) -> Column:
    text = c.cast("string")
    return F.lower(text) if ignore_case else text


def flag_text(c: Column, ignore_case: bool = False, yes: str = YES_LABEL, no: str = NO_LABEL) -> Column:
    """``yes`` / ``no`` for a recognised flag of any type, else the empty text."""
    text = _spelling(c, ignore_case)
    return F.when(text.isin(*TRUE_TEXT), F.lit(yes)).when(text.isin(*FALSE_TEXT), F.lit(no)).otherwise(F.lit(""))


def flag_bool(c: Column) -> Column:
    """Nullable boolean from any spelling, including the rendered labels."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isin(*TRUE_TEXT, YES_LABEL.lower()), F.lit(True)).when(
        text.isin(*FALSE_TEXT, NO_LABEL.lower()), F.lit(False)
    )


def bool_default_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_invalid_flag(c: Column) -> Column:
    """True where a value is present but is no flag; NULL counts as valid."""
    text = F.lower(c.cast("string"))
    return F.coalesce(~text.isin(*TRUE_TEXT, *FALSE_TEXT), F.lit(False))


def repaired_flag(c: Column) -> Column:
    """Invalid values become false, NULL stays NULL."""
    text = F.lower(c.cast("string"))
    return F.when(text.isin(*TRUE_TEXT), F.lit(True)).when(text.isNotNull(), F.lit(False))
