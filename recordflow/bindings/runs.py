"""Run history, logs and progress; events and conversations stand for runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from recordflow.bindings.registry import bind
from recordflow.session import scratch_path
from recordflow.sources.history import (
    append_history, commit_history, history_between, history_logs, history_recent, log_text, read_commits, read_history, read_run_logs, run_ids,
)
from recordflow.streaming.progress import log_progress, read_progress, run_progress_stream

RUNS = """(SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS date, value AS duration_seconds,
                  CASE event_type WHEN 'error' THEN 'Error' ELSE 'Success' END AS status,
                  'run_' || CAST(event_id AS VARCHAR) || '.log' AS log_file,
                  CASE WHEN event_type <> 'view' THEN event_type || '.py' END AS script FROM events)"""


def runs(t):
    return t.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"),
        F.col("value").alias("duration_seconds"),
        F.when(F.col("event_type") == "error", F.lit("Error")).otherwise(F.lit("Success")).alias("status"),
        F.concat(F.lit("run_"), F.col("event_id").cast("string"), F.lit(".log")).alias("log_file"),
        F.when(F.col("event_type") != "view", F.concat("event_type", F.lit(".py"))).alias("script"),
    )


@bind("history_scan", f"SELECT * FROM {RUNS}")
def history_scan(t):
    path = scratch_path(t.spark, "history")
    runs(t).write.json(path)
    return read_history(t.spark, path, lines=True)


@bind("history_scan_array", f"SELECT * FROM {RUNS}")
def history_scan_array(t):
    """The form of one JSON array per file, one file per day."""
    path, day = scratch_path(t.spark, "history-array"), F.substring("date", 1, 10)
    cells = runs(t).withColumn("day", day).groupBy("day").agg(F.collect_list(F.struct(*runs(t).columns)).alias("all"))
    cells.repartition("day").select("day", F.to_json("all").alias("value")).write.partitionBy("day").text(path)
    return read_history(t.spark, f"{path}/*")


@bind("run_ids", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events")
def run_ids_query(t):
    return run_ids(t.events.select(F.col("user_id").cast("string").alias("id")))


@bind(
    "history_dates_tolerant",
    f"SELECT id, date FROM {RUNS} WHERE status <> 'Error' AND CAST(date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'",
)
def history_dates_tolerant(t):
    """Runs that failed carry an unreadable date and lie in no range."""
    broken = F.when(F.col("status") == "Error", F.lit("2024-13-45 x")).otherwise(F.col("date"))
    return history_between(runs(t).withColumn("date", broken), date(2024, 1, 5), date(2024, 1, 12)).select("id", "date")


@bind("run_logs", "SELECT 'conv_' || CAST(conv_id % 10 AS VARCHAR) AS log, role || ' ' || CAST(turn AS VARCHAR) AS line FROM conversations")
def run_logs_query(t):
    """Log files written by ten runs and read back with the run's name (the folder stands for it)."""
    path = scratch_path(t.spark, "run-logs")
    lines = t.conversations.select(F.concat(F.lit("conv_"), (F.col("conv_id") % 10).cast("string")).alias("log"), F.concat_ws(" ", "role", "turn").alias("value"))
    lines.write.partitionBy("log").text(path)
    read = read_run_logs(t.spark, f"{path}/*", name="path")
    return read.select(F.regexp_extract("log_file", "log=(conv_[0-9]+)/", 1).alias("log"), "line")


@bind("history_append", f"SELECT * REPLACE (CASE WHEN status = 'Error' THEN script END AS script) FROM {RUNS}")
def history_append(t):
    """Two appends, the first without the ``script`` column, as in older entries."""
    path, all_runs = scratch_path(t.spark, "history"), runs(t)
    append_history(all_runs.where(F.col("status") == "Success").drop("script"), path)
    append_history(all_runs.where(F.col("status") == "Error"), path)
    return read_history(t.spark, path, lines=True)


@bind("history_commits", f"SELECT * FROM {RUNS}")
def history_commits(t):
    """Two commits, the second repeated in another order as by a driver that was started again."""
    path, all_runs = scratch_path(t.spark, "history-commits"), runs(t)
    commit_history(all_runs.where(F.col("status") == "Success"), path)
    failed = all_runs.where(F.col("status") == "Error")
    commit_history(failed, path)
    commit_history(failed.orderBy(F.desc("id")), path)
    return read_commits(t.spark, path)


@bind(
    "run_log_text",
    """SELECT log, chunk, string_agg(line || chr(10), '' ORDER BY conv_id, turn) AS text FROM (
         SELECT 'conv_' || CAST(conv_id % 10 AS VARCHAR) AS log, conv_id, turn, role || ' ' || CAST(turn AS VARCHAR) AS line,
                (row_number() OVER (PARTITION BY conv_id % 10 ORDER BY conv_id, turn) - 1) // 50 + 1 AS chunk FROM conversations)
       GROUP BY log, chunk""",
)
def run_log_text(t):
    """The logs of ten runs as written, in order, fifty lines a chunk."""
    path = scratch_path(t.spark, "log-text")
    log = F.concat(F.lit("conv_"), (F.col("conv_id") % 10).cast("string"))
    lines = t.conversations.select(log.alias("log"), "conv_id", "turn", F.concat_ws(" ", "role", "turn").alias("value"))
    # One file per run: a log is written by its run alone.
    lines.repartition("log").sortWithinPartitions("log", "conv_id", "turn").select("log", "value").write.partitionBy("log").text(path)
    run = F.regexp_extract("path", "log=(conv_[0-9]+)/", 1).alias("log")
    return log_text(t.spark, f"{path}/*", lines=50).select(run, "chunk", "text")


@bind(
    "history_between",
    f"SELECT * FROM {RUNS} WHERE CAST(date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'",
)
def history_between_query(t):
    return history_between(runs(t), date(2024, 1, 5), date(2024, 1, 12))


@bind("history_recent", f"SELECT id, date, status, duration_seconds, log_file FROM {RUNS} ORDER BY date DESC")
def history_recent_query(t):
    return history_recent(runs(t))


@bind(
    "history_log_join",
    """SELECT 'conv_' || CAST(d.doc_id AS VARCHAR) || '.log' AS log_file, CAST(d.doc_id AS VARCHAR) AS id, c.text AS line
       FROM documents d LEFT JOIN conversations c ON c.conv_id = d.doc_id""",
)
def history_log_join(t):
    """Documents as runs, the turns of the conversation of that number as log lines; most runs have no log."""
    log = F.concat(F.lit("conv_"), F.col("id"), F.lit(".log")).alias("log_file")
    ran = t.documents.select(F.col("doc_id").cast("string").alias("id")).select("id", log)
    lines = t.conversations.select(F.col("conv_id").cast("string").alias("id"), F.col("text").alias("line"))
    return history_logs(ran, lines.select(log, "line")).select("log_file", "id", "line")


PROGRESS = """SELECT CAST(user_id AS VARCHAR) AS run, CAST(max(CASE event_type WHEN 'signup' THEN 10 WHEN 'view' THEN 30
    WHEN 'click' THEN 60 WHEN 'purchase' THEN 80 ELSE 0 END) AS INTEGER) AS progress FROM events
    GROUP BY user_id"""


def log_lines(t):
    """One log line per event, with the run in front."""
    phrase = (
        F.when(F.col("event_type") == "signup", F.lit("Conectando ao Impala: porta"))
        .when(F.col("event_type") == "view", F.lit("Executando query..."))
        .when(F.col("event_type") == "click", F.lit("Estruturando dados..."))
        .when(F.col("event_type") == "purchase", F.lit("Salvando arquivo: x.csv"))
        .otherwise(F.lit("Erro"))
    )
    return t.events.select(
        F.concat(F.col("user_id").cast("string"), F.lit(" "), phrase).alias("value")
    )


def with_run(lines):
    return lines.select(F.regexp_extract("value", r"^(\d+) ", 1).alias("run"), F.col("value").alias("line"))


@bind("log_progress", PROGRESS)
def log_progress_query(t):
    return log_progress(with_run(log_lines(t)), "run", "line")


@bind("log_progress_stream", PROGRESS)
def log_progress_stream(t):
    """The same result from a stream over log files."""
    folder = scratch_path(t.spark, "logs")
    log_lines(t).write.text(folder)
    target = scratch_path(t.spark, "progress")
    lines = with_run(t.spark.readStream.text(folder))
    run_progress_stream(lines, "run", "line", target, scratch_path(t.spark, "stream-checkpoint"))
    return read_progress(t.spark, target, "run")
