"""Fetch results: classes per status and batch summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Outcome classes by HTTP status.
OUTCOMES = {200: "ok", 401: "unauthorized", 404: "not_found", 500: "server_error"}
OTHER = "other"


def outcome_class(status: Column) -> Column:
    chained = F
    for code, label in OUTCOMES.items():
        chained = chained.when(status == code, F.lit(label))
    return chained.otherwise(F.lit(OTHER))


def outcome_summary(df: DataFrame, status: str) -> DataFrame:
    """Files per outcome class."""
    return df.groupBy(outcome_class(F.col(status)).alias("outcome")).agg(F.count(F.lit(1)).alias("files"))


def outcome_failures(df: DataFrame, file: str, status: str, message: str | None = None) -> DataFrame:
    """One row per failed file with its message.

    Messages stay rows: a failing batch can be as large as the input, which
    must not end up in one cell.
    """
    text = F.format_string("%s: Status %s", F.col(file), F.col(status).cast("string"))
    if message:
        text = F.when(F.col(status).isNull(), F.concat_ws(": ", F.col(file), F.col(message))).otherwise(text)
    failed = F.col(status).isNull() | (F.col(status) != 200)
    return df.where(failed).select(F.col(file).alias("file"), text.alias("message"))
