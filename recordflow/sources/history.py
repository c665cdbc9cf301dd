"""Run history and run logs."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from recordflow.functions.coerce import coerce_timestamp
from recordflow.operators.joins import left_join_rows

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("log_file", T.StringType()),
        T.StructField("script", T.StringType()),
    ]
)

COMMIT = "commit"


def read_history(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Run entries from a JSON array file, or from appended JSON lines.

    A missing or broken file is an empty history; older entries without
    ``script`` read as NULL.
    """
    reader = spark.read.schema(HISTORY_SCHEMA).option("mode", "PERMISSIVE")
    try:
        runs = reader.json(path, multiLine=not lines)
    except AnalysisException:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return runs.where(F.col("id").isNotNull())


def append_history(runs: DataFrame, path: str) -> None:
    """Add runs as JSON lines; earlier entries are never rewritten."""
    columns = [
        F.col(f.name).cast(f.dataType) if f.name in runs.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in HISTORY_SCHEMA.fields
    ]
    runs.select(*columns).write.mode("append").json(path)


def commit_history(runs: DataFrame, path: str, commit: str | None = None) -> str:
    """Add runs as one commit; the same commit again replaces itself, and no other file is touched.

    A driver that is started again after a failure may thus repeat its append.
    ``commit`` names it; by default a digest of the run ids does, which needs no
    state and does not depend on the rows' order. Returns the name.
    """
    columns = [
        F.col(f.name).cast(f.dataType) if f.name in runs.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in HISTORY_SCHEMA.fields
    ]
    rows = runs.select(*columns)
    if commit is None:
        # Two hashes of 64 bits and the number of rows; one row reaches the driver.
        digest = F.concat_ws("-", F.count(F.lit(1)), F.hex(F.bit_xor(F.xxhash64("id"))), F.hex(F.bit_xor(F.xxhash64("id", F.lit("run")))))
        commit = rows.agg(digest).first()[0]
    # Only the partitions that the rows name are replaced, here one.
    writer = rows.withColumn(COMMIT, F.lit(commit)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(COMMIT).json(path)
    return commit


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """Runs of all commits; a missing history is empty."""
    schema = T.StructType([*HISTORY_SCHEMA.fields, T.StructField(COMMIT, T.StringType())])
    try:
        runs = spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return runs.where(F.col("id").isNotNull()).drop(COMMIT)


def history_between(runs: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Runs whose day lies in the inclusive range; an open end is unbounded.

    A date that cannot be read lies in no range, and in the unbounded one only.
    """
    day = F.to_date(coerce_timestamp(F.col("date")))
    if start is not None:
        runs = runs.where(day >= F.lit(start))
    if end is not None:
        runs = runs.where(day <= F.lit(end))
    return runs


def history_recent(runs: DataFrame) -> DataFrame:
    """Newest first, display columns only; runs of one moment by id."""
    return runs.select("id", "date", "status", "duration_seconds", "log_file").orderBy(F.desc("date"), "id")


def run_ids(runs: DataFrame) -> DataFrame:
    """The distinct run ids, as a selector lists them."""
    return runs.select("id").distinct()


def read_run_logs(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """Log lines with the ``name`` (or ``path``) of the file they come from."""
    return spark.read.text(path).select(F.col(f"_metadata.file_{name}").alias("log_file"), F.col("value").alias("line"))


def history_logs(runs: DataFrame, logs: DataFrame) -> DataFrame:
    """Runs with the lines of their log; a run without a log keeps one NULL line."""
    return left_join_rows(runs, logs.withColumnRenamed("log_file", "_log"), "log_file", "_log")


#: Lines of a chunk of a log's text.
CHUNK_LINES = 1000


def log_text(spark: SparkSession, path: str, lines: int = CHUNK_LINES) -> DataFrame:
    """``path, log_file, chunk, text``: each log's text in order, cut after every ``lines`` lines of a file block.

    The chunks of a file, by number, put together are the file, byte for byte
    (UTF-8, lines ended by a line feed; a last line without one stays so). Long
    logs are read in blocks by many tasks, and no cell holds more than a chunk.
    An empty file has no chunk.
    """
    # Rows of one block lie in one partition, numbered in file order.
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("log_file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    # One shuffle, by block: a block's rows are bounded by its size, and both steps below keep the partitioning.
    inside = Window.partitionBy("path", "block").orderBy("row")
    numbered = read.withColumn("part", F.floor((F.row_number().over(inside) - 1) / lines))
    cell = F.sort_array(F.collect_list(F.struct("row", "line")))["line"]
    chunks = numbered.groupBy("path", "log_file", "size", "block", "part").agg(
        F.array_join(cell, "\n").alias("text"), F.sum(F.octet_length("line") + 1).alias("bytes")
    )
    whole = Window.partitionBy("path")  # one row per chunk
    placed = chunks.select(
        "path",
        "log_file",
        F.row_number().over(whole.orderBy("block", "part")).cast("long").alias("chunk"),
        F.count(F.lit(1)).over(whole).alias("of"),
        F.sum("bytes").over(whole).alias("all"),
        "size",
        "text",
    )
    open_end = (F.col("chunk") == F.col("of")) & (F.col("all") > F.col("size"))
    return placed.select("path", "log_file", "chunk", F.when(open_end, F.col("text")).otherwise(F.concat("text", F.lit("\n"))).alias("text"))
