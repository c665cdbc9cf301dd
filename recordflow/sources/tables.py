"""Table access."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A Parquet table below ``folder``, or a catalog table."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def read_query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` in the text stands for the given frame."""
    return spark.sql(text, **tables)


def capped(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Optional row cap; put it after ``orderBy`` so that it becomes a top-n."""
    return df if max_rows is None else df.limit(max_rows)
