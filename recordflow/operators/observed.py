"""Metrics taken while rows are written, without a pass of their own."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

Metrics = Mapping[str, Sequence[Column]]


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], metrics: Metrics) -> dict[str, DataFrame]:
    """Write ``df`` and give one row per name of ``metrics``, as ``df.agg(*metrics[name])`` would.

    The aggregates run in the tasks that write, on the rows as they pass; only
    their partial results travel. They are the last step before the write, so a
    task that is run again counts once. ``write`` must run exactly one action on
    the frame it gets, and that action must see all rows.
    """
    seen, shapes = {}, {}
    passing = df
    for name, columns in metrics.items():
        shapes[name] = df.agg(*columns).schema
        seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        passing = passing.observe(seen[name], *columns)
    write(passing)
    return {name: one_row(df.sparkSession, seen[name].get, shape) for name, shape in shapes.items()}


def one_row(spark: SparkSession, values: Mapping[str, object], schema) -> DataFrame:
    return spark.createDataFrame([tuple(values[name] for name in schema.names)], schema)


def written_metrics(
    rows: DataFrame, columns: int, path: str, started: datetime | None = None, finished: datetime | None = None, count: str = "rows"
) -> DataFrame:
    """As :func:`~recordflow.sinks.delimited.run_metrics`, from an observed row: the files are listed, not read.

    ``rows`` has the number of rows in column ``count``; the size is that of all
    files below ``path``.
    """
    spark = rows.sparkSession
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = F.round(files.agg(F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1048576)).scalar(), 2)
    seconds = (finished - started).total_seconds() if started and finished else None
    return rows.select(
        F.col(count).alias("rows"), F.lit(columns).alias("columns"), size.alias("size_mb"), F.lit(seconds).cast("double").alias("duration_seconds")
    )
