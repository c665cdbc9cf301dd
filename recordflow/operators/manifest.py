"""Rows from multi-valued cells and URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.multivalue import SEPARATOR, is_value, raw_values
from recordflow.functions.text import strip
from recordflow.functions.urls import build_url, grouped_pairs, url_base, url_pairs


def attachment_manifest(
    df: DataFrame, id_column: str, name_column: str, base: str, bucket: str, separator: str = SEPARATOR
) -> DataFrame:
    """One row per distinct (record, file) with its display label and URL.

    ``distinct`` hashes id and file together, so a record with very many files
    is spread over the tasks.
    """
    files = df.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("nan")).alias("id"),
        F.explode(raw_values(F.col(name_column), separator)).alias("file"),
    )
    # Members are trimmed and judged as rows: inside the array that takes an interpreted lambda.
    files = files.select("id", strip(F.col("file")).alias("file")).where(is_value(F.col("file"))).distinct()
    return files.select(
        F.concat(F.lit("["), "id", F.lit("] "), "file").alias("label"),
        "id",
        "file",
        build_url(base, F.lit(bucket), F.col("file")).alias("url"),
    )


def url_params(df: DataFrame, url: Column, *keep: str) -> DataFrame:
    """One row per query parameter, in order, with the base URL."""
    return df.select(*keep, url_base(url).alias("base"), F.posexplode(url_pairs(url)).alias("position", "pair")).select(
        *keep, "base", "position", "pair.key", "pair.value"
    )


def url_params_grouped(df: DataFrame, url: Column, *keep: str) -> DataFrame:
    """One row per distinct parameter key with all its values as an array."""
    return df.select(*keep, F.inline(grouped_pairs(url_pairs(url))))
