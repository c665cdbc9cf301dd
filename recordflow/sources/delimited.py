"""Semicolon-delimited record files."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from recordflow.functions.coerce import NULL_TOKENS, coerce_int, coerce_timestamp, null_tokens
from recordflow.functions.flags import flag_bool
from recordflow.schemas import text_schema

# The file dialect (a byte-order mark is skipped by Spark).
DIALECT = {"sep": ";", "header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}

POSITION = ("_source_file", "_source_block", "_source_row")


def read_csv_as_text(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multiline: bool = False, mixed: bool = False
) -> DataFrame:
    """Every column as text.

    Files are split between tasks. ``multiline`` reads cells with line breaks,
    each file by one task. All files must have the same header: with
    ``columns`` (the file's columns in order) no file is opened to find it, and
    a file with another one is an error, never shifted columns. ``mixed`` reads
    every file by its own header and joins the columns by name; one more scan
    finds the headers.
    """
    reader = spark.read.options(**DIALECT).option("multiLine", str(multiline).lower())
    if mixed:
        frames = [_by_header(reader, layout, files) for layout, files in _layouts(spark, path)]
        if frames:
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if columns is None:
        columns = reader.option("inferSchema", "false").csv(path).columns
    return reader.schema(text_schema(*columns)).option("enforceSchema", "false").csv(path)


def _layouts(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Header lines with the paths of their files. Paths are what a reader lists on the driver anyway."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"),
    )
    first = rows.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [(r["header"], r["files"]) for r in found]


def _by_header(reader: DataFrameReader, header: str, files: list[str]) -> DataFrame:
    names = next(csv.reader([header.lstrip("\ufeff").rstrip("\r")], delimiter=DIALECT["sep"], quotechar=DIALECT["quote"]))
    return reader.schema(text_schema(*names)).option("enforceSchema", "false").csv(files)


def typed(c: Column, kind: T.DataType) -> Column:
    """Lenient conversion of text to a column type."""
    if isinstance(kind, T.LongType):
        return coerce_int(c)
    if isinstance(kind, T.TimestampType):
        return coerce_timestamp(c)
    if isinstance(kind, T.BooleanType):
        return flag_bool(c)
    return c if isinstance(kind, T.StringType) else c.try_cast(kind)


def read_records_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    tokens: tuple[str, ...] = NULL_TOKENS,
    multiline: bool = False,
    position: bool = False,
    mixed: bool = False,
) -> DataFrame:
    """Typed records; NULL tokens and unreadable values are NULL.

    Columns of ``schema`` missing in the file become typed NULLs, further
    columns of the file stay text. ``position`` adds :data:`POSITION`, which
    orders rows as they stand in the files.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = read_csv_as_text(spark, path, multiline=multiline, mixed=mixed)
    if position and mixed:
        raise ValueError("positions are known for files of one layout only")
    kinds = {f.name: f.dataType for f in schema.fields}
    present = [
        typed(null_tokens(F.col(f"`{c}`"), tokens), kinds.get(c, T.StringType())).alias(c) for c in raw.columns
    ]
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in raw.columns]
    place = []
    if position:
        # Rows of one file block lie in one partition, numbered in file order.
        place = [
            F.col("_metadata.file_path").alias(POSITION[0]),
            F.col("_metadata.file_block_start").alias(POSITION[1]),
            F.monotonically_increasing_id().alias(POSITION[2]),
        ]
    return raw.select(*present, *absent, *place)


def read_columns(
    spark: SparkSession, path: str, columns: Sequence[str], fallback: str = "N/A", multiline: bool = False, mixed: bool = False
) -> DataFrame:
    """Only the named columns; one that the file lacks is filled with ``fallback``."""
    raw = read_csv_as_text(spark, path, multiline=multiline, mixed=mixed)
    return raw.select(*[F.col(f"`{c}`") if c in raw.columns else F.lit(fallback).alias(c) for c in columns])
