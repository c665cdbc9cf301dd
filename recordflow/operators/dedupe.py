"""Duplicate keys: counting them and keeping the first row of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str], copies: str | None = None) -> DataFrame:
    """First row per key by ``order`` (NULL keys are one key, NULL sorts first).

    ``min_by`` reduces every key to one row per map task before the shuffle, so
    a key with a third of all rows costs one row per task. A window with
    ``row_number() = 1`` is cut per task by Spark too and is faster where keys
    are unique, but slower on hot keys. ``order`` must be
    total for a repeatable result. With ``copies`` the group size is added.
    """
    rest = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    size = [F.count(F.lit(1)).alias(copies)] if copies else []
    kept = df.groupBy(*key).agg(first, *size)
    out = [F.col(c) if c in key else F.col(f"_first.`{c}`").alias(c) for c in df.columns]
    return kept.select(*out, *([copies] if copies else []))


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows that repeat an earlier key."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
