import datetime as dt
import os

import pytest
from pyspark.sql import functions as F, types as T

from recordflow.schemas import with_missing_columns
from recordflow.sinks import delimited as sinks
from recordflow.sources import delimited, files, history, tables
from recordflow.streaming.progress import log_progress, read_log_stream, read_progress, run_progress_stream

SCHEMA = "id long, flag boolean, day timestamp, note string, gone long"


def test_typed_records_from_a_spreadsheet_file(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        'id;flag;day;note;more\n1.0;True;2021-01-02;"a;""b""";x\n3.5;Sim;2021-02-30;NULL;\nx;0;;None;z\n', encoding="utf-8-sig"
    )
    got = delimited.read_records_csv(spark, str(path), SCHEMA)
    assert got.columns == ["id", "flag", "day", "note", "more", "gone"]
    assert [tuple(r) for r in got.collect()] == [
        (1, True, dt.datetime(2021, 1, 2), 'a;"b"', "x", None),
        (None, True, None, None, None, None),
        (None, False, None, None, "z", None),
    ]


def test_position_is_file_order(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id\n" + "\n".join(str(i) for i in range(1000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        rows = delimited.read_records_csv(spark, str(tmp_path / "in.csv"), "id long", multiline=False, position=True)
        assert rows.rdd.getNumPartitions() > 2
        assert [r.id for r in rows.orderBy(*delimited.POSITION).collect()] == list(range(1000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fallback_columns(spark, tmp_path):
    (tmp_path / "in.csv").write_text("name;x\na;1\n", encoding="utf-8")
    assert [tuple(r) for r in delimited.read_columns(spark, str(tmp_path / "in.csv"), ["id", "name"]).collect()] == [("N/A", "a")]
    missing = with_missing_columns(spark.range(1), T.StructType.fromDDL("id long, n int"))
    assert [tuple(r) for r in missing.collect()] == [(0, None)]


def test_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, True, dt.datetime(2021, 1, 2), ' a;"b"\t\nc', 5), (2, None, None, None, None), (3, False, None, "", 0)], SCHEMA
    )
    path = str(tmp_path / "out")
    sinks.write_records_csv(rows, path)
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    assert '1;True;2021-01-02;" a;""b""\t\nc";5' in text and "2;;;;" in text and "3;False;;;0" in text
    back = sorted((tuple(r) for r in delimited.read_records_csv(spark, path, SCHEMA, multiline=True).collect()), key=lambda r: r[0])
    assert back == [
        (1, True, dt.datetime(2021, 1, 2), ' a;"b"\t\nc', 5), (2, None, None, None, None), (3, False, None, None, 0),
    ]


def test_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (5, 3):
        sinks.write_structured(spark.range(n), path)
    assert delimited.read_csv_as_text(spark, path).count() == 3
    sinks.write_structured(spark.range(2), str(tmp_path / "p"), "parquet")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_preview(spark):
    rows = spark.createDataFrame([(2, None, "x" * 30), (1, "b", "y")], "a int, b string, c string")
    lines = [r.line for r in sinks.preview_lines(rows, "a").collect()]
    assert lines == ["1 | b | y", "2 | nan | " + "x" * 20]
    assert tuple(sinks.preview_header(rows, 2).first()) == (2, "a, b")


def test_inventory(spark, tmp_path):
    (tmp_path / "old").mkdir()
    for name, age in (("a.csv", 30), ("run_1.csv", 20), ("b2.csv", 10), ("note.txt", 1), ("old/z.csv", 0)):
        (tmp_path / name).write_text("x")
        stamp = dt.datetime(2024, 1, 1).timestamp() - age
        os.utime(tmp_path / name, (stamp, stamp))
    found = files.file_inventory(spark, str(tmp_path))
    assert files.latest_path(spark, str(tmp_path)).endswith("/b2.csv")
    plan = {r.path.rsplit("/", 1)[1]: r.dest for r in files.archive_plan(found, "/t/old/", dt.datetime(2024, 5, 6, 7, 8, 9)).collect()}
    assert plan == {"a.csv": "/t/old/a_archived_20240506_070809.csv", "run_1.csv": "/t/old/run_1.csv"}
    assert files.latest_path(spark, str(tmp_path), "*.json") is None
    assert files.latest_file(files.file_inventory(spark, str(tmp_path), "*.json")).count() == 0
    with pytest.raises(FileNotFoundError):
        files.latest_path(spark, str(tmp_path), "*.json", required=True)


def test_only_folders_named_old_are_left_out(spark, tmp_path):
    for name in ("threshold/in/a.csv", "threshold/in/old/b.csv", "threshold/in/older/c.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    for folder in (str(tmp_path / "threshold/in"), "file://" + str(tmp_path / "threshold/in") + "/"):
        found = files.file_inventory(spark, folder)
        assert sorted(r.path.rsplit("/", 1)[1] for r in found.collect()) == ["a.csv", "c.csv"]


def test_mixed_headers_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffid;kind\n1;x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text('kind;"id"\ny;2\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("id\n3\n", encoding="utf-8")
    rows = delimited.read_csv_as_text(spark, str(tmp_path), mixed=True)
    assert sorted((r.id, r.kind or "") for r in rows.collect()) == [("1", "x"), ("2", "y"), ("3", "")]
    typed = delimited.read_records_csv(spark, str(tmp_path), "id long, more long", mixed=True)
    assert sorted(r.id for r in typed.collect()) == [1, 2, 3] and typed.schema["more"].dataType.simpleString() == "bigint"
    with pytest.raises(Exception, match="(?i)header"):  # never shifted columns
        delimited.read_csv_as_text(spark, str(tmp_path)).collect()


def test_one_large_file_is_split(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id;text\n" + "".join(f"{k};{'x' * 90}\n" for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        rows = delimited.read_csv_as_text(spark, str(tmp_path / "in.csv"))
        assert rows.select(F.spark_partition_id()).distinct().count() > 3 and rows.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


HISTORY = """[
 {"id": "r1", "date": "2026-01-13T15:09:47.465286", "duration_seconds": 31.2, "status": "Success", "log_file": "r1.log"},
 {"id": "r2", "date": "2026-01-15T13:01:52", "duration_seconds": 42.2, "status": "Error", "log_file": "r2.log", "script": "s.py"}
]"""


def test_history(spark, tmp_path):
    path = tmp_path / "history.json"
    path.write_text(HISTORY)
    runs = history.read_history(spark, str(path))
    assert [(r.id, r.script) for r in history.history_recent(runs.withColumn("x", F.lit(1))).select("id").join(runs, "id").orderBy("id").collect()] == [("r1", None), ("r2", "s.py")]
    assert [r.id for r in history.history_recent(runs).collect()] == ["r2", "r1"]
    assert [r.id for r in history.history_between(runs, dt.date(2026, 1, 13), dt.date(2026, 1, 14)).collect()] == ["r1"]
    assert history.history_between(runs).count() == 2
    bad = runs.withColumn("date", F.when(F.col("id") == "r1", F.lit("2026-13-99")).otherwise(F.col("date")))
    assert [r.id for r in history.history_between(bad, dt.date(2026, 1, 1), dt.date(2026, 2, 1)).collect()] == ["r2"]
    assert history.history_between(bad).count() == 2
    assert sorted(r.id for r in history.run_ids(runs.unionAll(runs)).collect()) == ["r1", "r2"]
    (tmp_path / "bad.json").write_text("{ not json")
    assert history.read_history(spark, str(tmp_path / "bad.json")).count() == 0
    assert history.read_history(spark, str(tmp_path / "absent.json")).count() == 0
    lines = str(tmp_path / "lines")
    history.append_history(runs.where("id = 'r1'").drop("script"), lines)
    history.append_history(runs.where("id = 'r2'"), lines)
    assert sorted(r.id for r in history.read_history(spark, lines, lines=True).collect()) == ["r1", "r2"]


LOGS = {"r1.log": "Conectando ao Impala: x\nExecutando query...\n", "r2.log": "Fim do ETL\nExecutando query...\n", "r3.log": "Erro\n"}


def test_logs(spark, tmp_path):
    for name, text in LOGS.items():
        (tmp_path / name).write_text(text)
    logs = history.read_run_logs(spark, str(tmp_path))
    runs = spark.createDataFrame([("r1", "r1.log"), ("r9", "r9.log")], "id string, log_file string")
    got = sorted((r.id, r.line or "") for r in history.history_logs(runs, logs).collect())
    assert got == [("r1", "Conectando ao Impala: x"), ("r1", "Executando query..."), ("r9", "")]
    expected = {"r1.log": 30, "r2.log": 100, "r3.log": 0}
    assert {r.log_file: r.progress for r in log_progress(logs, "log_file", "line").collect()} == expected


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    os.mkdir(source)
    for name in ("r1.log", "r3.log"):
        (tmp_path / "in" / name).write_text(LOGS[name])
    run_progress_stream(read_log_stream(spark, source), "log_file", "line", target, state)
    (tmp_path / "in" / "r2.log").write_text(LOGS["r2.log"])
    run_progress_stream(read_log_stream(spark, source), "log_file", "line", target, state)
    got = {r.log_file: r.progress for r in read_progress(spark, target, "log_file").collect()}
    assert got == {"r1.log": 30, "r2.log": 100, "r3.log": 0}


def test_tables(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "n.parquet"))
    frame = tables.read_table(spark, "n", str(tmp_path))
    assert tables.read_query(spark, "SELECT max(id) FROM {t}", t=frame).first()[0] == 3
    assert tables.capped(frame.orderBy("id"), 2).count() == 2 and tables.capped(frame).count() == 4
