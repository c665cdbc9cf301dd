"""File inventory: newest file and archive plan."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*.csv", exclude: str = "old") -> DataFrame:
    """``path, modificationTime, length`` without reading any content.

    Files below a folder named ``exclude``, itself below ``folder``, are left
    out; other names that hold the word are not.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    below = F.regexp_replace("path", f"^([a-zA-Z]+:/*)?/?{re.escape(_bare(folder))}/*", "")
    parts = F.split(F.regexp_extract(below, "^(.*)/[^/]*$", 1), "/")
    return files.where(~F.array_contains(parts, exclude)).select("path", "modificationTime", "length")


def _bare(folder: str) -> str:
    """A path without scheme and outer slashes."""
    return re.sub("^[a-zA-Z]+:/*", "", folder).strip("/")


def latest_file(files: DataFrame) -> DataFrame:
    """The newest file (by time, then path); no row for an empty inventory."""
    newest = F.max_by(F.struct("path", "modificationTime", "length"), F.struct("modificationTime", "path"))
    return files.agg(newest.alias("f")).where(F.col("f").isNotNull()).select("f.*")


def latest_path(spark: SparkSession, folder: str, pattern: str = "*.csv", required: bool = False) -> str | None:
    """Path of the newest file for a reader; one row reaches the driver."""
    row = latest_file(file_inventory(spark, folder, pattern)).first()
    if row is None and required:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return row["path"] if row else None


def archive_plan(files: DataFrame, target: str, stamp: datetime) -> DataFrame:
    """``path, dest`` for every file but the newest.

    Names without an underscore or without a digit get ``_archived_<stamp>``.
    The newest is found by a scalar aggregate, so no task sorts all files.
    """
    newest = files.agg(F.max(F.struct("modificationTime", "path"))["path"].alias("p")).scalar()
    name = F.regexp_extract("path", "([^/]*)$", 1)
    stem, ext = F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^.+?(\.[^.]*)?$", 1)
    stamped = F.concat(stem, F.lit(stamp.strftime("_archived_%Y%m%d_%H%M%S")), ext)
    dated = name.contains("_") & name.rlike("[0-9]")
    return files.where(F.col("path") != newest).select(
        "path", F.concat_ws("/", F.lit(target.rstrip("/")), F.when(dated, name).otherwise(stamped)).alias("dest")
    )
