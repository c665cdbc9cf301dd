"""Delimited files, file inventory, text export and previews.

Each query writes the whole table it reads to a new scratch folder first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from recordflow.bindings.registry import bind
from recordflow.session import scratch_path
from recordflow.sinks.delimited import (
    preview_header, preview_lines, run_metrics, write_records_csv, write_structured, write_text,
)
from recordflow.sinks.versions import current_path, write_version
from recordflow.sources.delimited import read_columns, read_csv_as_text, read_records_csv
from recordflow.sources.mixed import REST, read_mixed_records
from recordflow.sources.files import archive_plan, file_inventory, latest_file

ORDER_TYPES = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, paid boolean, extra long"


@bind(
    "scan_csv_typed",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus, o_orderdate,
              CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS paid, CAST(NULL AS BIGINT) AS extra
       FROM orders""",
)
def scan_csv_typed(t):
    """Dirty text (NULL tokens, ``.0`` ids, flag labels) read as typed columns; ``extra`` is not in the file."""
    status = F.col("o_orderstatus")
    dirty = t.orders.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("o_orderkey"),
        F.when(status == "P", F.element_at(F.array(F.lit("NULL"), F.lit("None"), F.lit("N/A")), F.length("o_orderpriority") % 3 + 1))
        .otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"))).alias("o_custkey"),
        status,
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        F.when(status == "F", F.lit("Sim")).when(status == "O", F.lit("False")).otherwise(F.lit("?")).alias("paid"),
    )
    path = scratch_path(t.spark, "scan-csv-typed")
    write_records_csv(dirty, path)
    return read_records_csv(t.spark, path, ORDER_TYPES)


@bind(
    "scan_csv_text",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || '; "' || p_brand || '"' AS label,
              CAST(p_size AS VARCHAR) AS p_size FROM part""",
)
def scan_csv_text(t):
    """Separators and quotes inside a cell survive."""
    label = F.concat("p_name", F.lit('; "'), "p_brand", F.lit('"')).alias("label")
    path = scratch_path(t.spark, "scan-csv-text")
    write_records_csv(t.part.select("p_partkey", label, "p_size"), path)
    return read_csv_as_text(t.spark, path)


@bind(
    "scan_csv_mixed_headers",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CASE WHEN p_size <= 25 THEN p_brand END AS p_brand FROM part""",
)
def scan_csv_mixed_headers(t):
    """Two exports in one folder: another column order, and one column missing in the second."""
    path = scratch_path(t.spark, "scan-mixed")
    small = F.col("p_size") <= 25
    write_records_csv(t.part.where(small).select("p_partkey", "p_name", "p_brand"), f"{path}/first")
    write_records_csv(t.part.where(~small).select("p_name", "p_partkey"), f"{path}/second")
    return read_csv_as_text(t.spark, f"{path}/*", mixed=True)


@bind(
    "scan_mixed_one_pass",
    """SELECT doc_id, source || '; "' || lang || '"' AS label, CASE WHEN lang = 'en' THEN n_chars END AS n_chars,
              CASE WHEN lang <> 'en' THEN lang END AS lang_of_second FROM documents""",
)
def scan_mixed_one_pass(t):
    """Two exports in one folder, read by the data source that takes each file's own header; undeclared columns go to a map."""
    path, first = scratch_path(t.spark, "scan-one-pass"), F.col("lang") == "en"
    label = F.concat("source", F.lit('; "'), "lang", F.lit('"')).alias("label")
    write_records_csv(t.documents.where(first).select("doc_id", label, "n_chars"), f"{path}/first")
    write_records_csv(t.documents.where(~first).select("lang", label, "doc_id"), f"{path}/second")
    read = read_mixed_records(t.spark, f"{path}/*", "doc_id long, label string, n_chars long", rest=True)
    return read.select("doc_id", "label", "n_chars", F.col(REST)["lang"].alias("lang_of_second"))


@bind("scan_pruned_fallback", "SELECT 'N/A' AS id_arquivo_acervo, p_name AS nome_arquivo_gravado FROM part")
def scan_pruned_fallback(t):
    path = scratch_path(t.spark, "scan-pruned")
    write_records_csv(t.part.select(F.col("p_name").alias("nome_arquivo_gravado"), "p_brand", "p_type"), path)
    return read_columns(t.spark, path, ["id_arquivo_acervo", "nome_arquivo_gravado"])


@bind(
    "sink_csv_roundtrip",
    """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, date_trunc('day', o_orderdate) AS o_orderdate,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS paid, CAST(NULL AS BIGINT) AS extra FROM orders""",
)
def sink_csv_roundtrip(t):
    status = F.col("o_orderstatus")
    typed = t.orders.select(
        "o_orderkey", "o_custkey", F.when(status != "P", status).otherwise(F.lit("")).alias("o_orderstatus"),
        "o_orderdate", F.when(status != "P", status == "F").alias("paid"), F.lit(None).cast("long").alias("extra"),
    )
    path = scratch_path(t.spark, "csv-roundtrip")
    write_records_csv(typed, path)
    return read_records_csv(t.spark, path, ORDER_TYPES)


@bind("sink_overwrite", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part")
def sink_overwrite(t):
    """The second version replaces the first under the same name."""
    path = scratch_path(t.spark, "structured")
    write_structured(t.part.select("p_partkey", "p_brand"), path)
    write_structured(t.part.select("p_partkey", "p_name"), path)
    return read_csv_as_text(t.spark, path)


@bind("sink_versions", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source FROM documents")
def sink_versions(t):
    """Two versions, and a third whose writer was lost before its last step: readers keep the second."""
    path = scratch_path(t.spark, "versions")
    write_version(t.documents.select("doc_id", "lang"), path)
    write_version(t.documents.select("doc_id", "source"), path)
    write_records_csv(t.documents.select("doc_id", "n_chars"), f"{path}/data/000000000002.unfinished")
    return read_csv_as_text(t.spark, current_path(t.spark, path))


@bind(
    "sink_text_lines",
    '''SELECT CAST(p_partkey AS VARCHAR) || ';"' || p_name || '; ""x"""' || ';' || CASE WHEN p_size > 20 THEN 'True'
              WHEN p_size > 10 THEN 'False' ELSE '' END || ';' || p_type AS value FROM part''',
)
def sink_text_lines(t):
    flag = F.when(F.col("p_size") > 20, F.lit(True)).when(F.col("p_size") > 10, F.lit(False))
    label = F.concat("p_name", F.lit('; "x"')).alias("label")
    path = scratch_path(t.spark, "text-export")
    write_text(t.part.select("p_partkey", label, flag.alias("flag"), "p_type"), path)
    return t.spark.read.text(path)


def part_files(t) -> str:
    """One file per brand."""
    path = scratch_path(t.spark, "inventory")
    t.part.repartition("p_brand").write.partitionBy("p_brand").option("sep", ";").csv(path)
    return path


BRAND_NUMBER = "CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT)"


def dated(files):
    """The files with the number of their brand as day of change, so that the newest is known."""
    number = F.regexp_extract("path", r"p_brand=Brand(?:%23|#)([0-9]+)/", 1).cast("long")
    return files.withColumn("modificationTime", F.timestamp_seconds(number * 86400))


def day_number(time):
    return F.floor(F.unix_timestamp(time) / 86400).cast("long")


@bind("latest_file", f"SELECT max({BRAND_NUMBER}) AS newest FROM part")
def latest_file_query(t):
    files = dated(file_inventory(t.spark, part_files(t)))
    return latest_file(files).select(day_number(F.col("modificationTime")).alias("newest"))


@bind(
    "archive_plan",
    f"""SELECT DISTINCT {BRAND_NUMBER} AS brand, true AS stamped FROM part
        WHERE {BRAND_NUMBER} < (SELECT max({BRAND_NUMBER}) FROM part)""",
)
def archive_plan_query(t):
    """Every file but the newest moves; Spark's file names carry no underscore, so all get a stamp."""
    files = dated(file_inventory(t.spark, part_files(t)))
    plan = archive_plan(files, "/archive/old", datetime(2000, 1, 1))
    name = F.regexp_extract("path", r"([^/]*)\.csv$", 1)
    expected = F.concat(F.lit("/archive/old/"), name, F.lit("_archived_20000101_000000.csv"))
    moved = plan.withColumnRenamed("path", "from_path").join(files, F.col("from_path") == F.col("path"))
    return moved.select(day_number(F.col("modificationTime")).alias("brand"), (F.col("dest") == expected).alias("stamped"))


@bind(
    "preview_lines",
    """SELECT concat_ws(' | ', substr(CAST(o_orderkey AS VARCHAR), 1, 20), substr(CAST(o_custkey AS VARCHAR), 1, 20),
              coalesce(nullif(o_orderstatus, 'P'), 'nan'), substr('Priority of order: ' || o_orderpriority, 1, 20),
              substr(CAST(o_orderdate AS VARCHAR), 1, 20)) AS line FROM orders ORDER BY o_orderkey LIMIT 10""",
)
def preview_lines_query(t):
    rows = t.orders.select(
        "o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.concat(F.lit("Priority of order: "), "o_orderpriority").alias("priority"), "o_orderdate", "o_totalprice",
    )
    return preview_lines(rows, "o_orderkey")


@bind("preview_header", "SELECT count(*) AS total, 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate' AS columns FROM orders")
def preview_header_query(t):
    return preview_header(t.orders)


@bind("run_metrics", "SELECT count(*) AS rows, 6 AS columns, true AS has_size, 90.5::DOUBLE AS duration_seconds FROM orders")
def run_metrics_query(t):
    files = t.spark.read.format("binaryFile").load(f"{t.folder}/orders.parquet")
    metrics = run_metrics(t.orders, files, datetime(2000, 1, 1, 10), datetime(2000, 1, 1, 10, 1, 30, 500000))
    return metrics.select("rows", "columns", (F.col("size_mb") > 0).alias("has_size"), "duration_seconds")
