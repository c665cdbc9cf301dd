"""Progress of runs from their log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordflow.sinks.versions import as_parquet, current_path, expire_versions, write_version

# Phrase in a log line -> progress in percent.
PHASES = {
    "Conectando ao Impala": 10,
    "Executando query": 30,
    "Estruturando dados": 60,
    "Salvando arquivo": 80,
    "Fim do ETL": 100,
}


def line_progress(line: Column, phases: dict[str, int] = PHASES) -> Column:
    """Progress a line announces, NULL for other lines; earlier phrases win."""
    found = F
    for phrase, percent in phases.items():
        found = found.when(line.contains(phrase), F.lit(percent))
    return found.otherwise(F.lit(None).cast("int"))


def log_progress(lines: DataFrame, run: str, line: str, phases: dict[str, int] = PHASES) -> DataFrame:
    """Furthest progress per run; the same plan serves batch and streaming input.

    State is one small number per run and the maximum is order-independent, so
    late lines need no watermark to be counted.
    """
    return (
        lines.select(F.col(run), line_progress(F.col(line), phases).alias("pct"))
        .groupBy(run)
        .agg(F.coalesce(F.max("pct"), F.lit(0)).alias("progress"))
    )


def read_log_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New log files as a stream of ``log_file, line``."""
    lines = spark.readStream.text(folder)
    return lines.select(F.col("_metadata.file_name").alias("log_file"), F.col("value").alias("line"))


def run_progress_stream(lines: DataFrame, run: str, line: str, target: str, checkpoint: str) -> None:
    """Process all waiting log lines and store the progress of every run as a version of ``target``.

    The stream keeps the furthest progress per run as its state, so a version is
    written from the state and not from earlier files. It is named by its batch:
    a batch repeated after a failure replaces its own version. Older versions
    are removed, whatever the number of batches.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, target, as_parquet, number=batch_id)
        expire_versions(batch.sparkSession, target)

    query = (
        log_progress(lines, run, line)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()


def read_progress(spark: SparkSession, target: str, run: str) -> DataFrame:
    """The progress per run in the newest version: a reader opens that version's files only."""
    return spark.read.parquet(current_path(spark, target)).select(run, "progress")
