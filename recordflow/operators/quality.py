"""Data-quality counts, all from one pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.coerce import is_fractional
from recordflow.functions.flags import is_invalid_flag


def negative_counts(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in columns]


def invalid_flag_count(column: str) -> Column:
    return F.count_if(is_invalid_flag(F.col(column))).alias(f"invalid_{column}")


def future_count(column: str, asof: datetime) -> Column:
    """Timestamps after ``asof``; a parameter, so that a rerun gives the same count."""
    return F.count_if(F.col(column) > F.lit(asof)).alias(f"future_{column}")


def fractional_count(column: str) -> Column:
    return F.count_if(is_fractional(F.col(column))).alias(f"fractional_{column}")


def quality_counts(
    df: DataFrame,
    ids: Sequence[str] = (),
    flags: Sequence[str] = (),
    dates: Sequence[str] = (),
    asof: datetime | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row with every warning count; columns that do not exist are skipped."""
    return df.agg(*count_metrics(df.columns, ids, flags, dates, asof), *extra)


def count_metrics(
    columns: Sequence[str], ids: Sequence[str] = (), flags: Sequence[str] = (), dates: Sequence[str] = (), asof: datetime | None = None
) -> list[Column]:
    """The aggregates of :func:`quality_counts`."""
    have = set(columns)
    checks = negative_counts([c for c in ids if c in have])
    checks += [invalid_flag_count(c) for c in flags if c in have]
    if asof is not None:
        checks += [future_count(c, asof) for c in dates if c in have]
    return [F.count(F.lit(1)).alias("rows"), *checks]


def quality_totals(df: DataFrame, complete: Column, described: Column, published: Column) -> DataFrame:
    """Complete rows (count, percent), described rows and published sum."""
    return df.agg(*total_metrics(complete, described, published))


def total_metrics(complete: Column, described: Column, published: Column) -> list[Column]:
    """The aggregates of :func:`quality_totals`."""
    total = F.count(F.lit(1))
    n_complete = F.count_if(complete)
    return [
        total.alias("total"),
        n_complete.alias("complete"),
        F.coalesce(F.try_divide(n_complete * F.lit(100.0), total), F.lit(0.0)).alias("pct_complete"),
        F.count_if(described).alias("described"),
        F.coalesce(F.sum(published.cast("bigint")), F.lit(0)).cast("bigint").alias("published"),
    ]
