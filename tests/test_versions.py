"""Replacing, appending and reassembling files whatever fails in between."""

import os
import random

import pytest
from pyspark.sql import functions as F

from recordflow.sinks.versions import as_parquet, current_path, expire_versions, versions, write_version
from recordflow.sources.delimited import read_csv_as_text
from recordflow.sources.history import commit_history, log_text, read_commits
from recordflow.streaming.progress import read_log_stream, read_progress, run_progress_stream


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        current_path(spark, path)
    write_version(spark.range(5).selectExpr("cast(id as string) v"), path)
    old = current_path(spark, path)
    held = read_csv_as_text(spark, old)
    lost = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        write_version(lost, path)
    assert current_path(spark, path) == old and held.count() == 5
    new = write_version(spark.range(7).selectExpr("cast(id as string) v"), path)
    assert current_path(spark, path) == new and read_csv_as_text(spark, new).count() == 7
    assert held.count() == 5  # a reader of the old version goes on
    assert len(os.listdir(f"{path}/data")) == 3  # the old, the failed, the new
    assert len(expire_versions(spark, path, keep=1)) == 2
    assert len(versions(spark, path)) == len(os.listdir(f"{path}/data")) == 1
    assert expire_versions(spark, path) == [] and read_csv_as_text(spark, current_path(spark, path)).count() == 7
    with pytest.raises(ValueError):
        expire_versions(spark, path, keep=0)


def test_a_repeated_step_replaces_its_version(spark, tmp_path):
    path = str(tmp_path / "set")
    for number, rows in ((0, 3), (1, 4), (1, 4)):
        write_version(spark.range(rows), path, as_parquet, number=number)
        assert spark.read.parquet(current_path(spark, path)).count() == rows
    write_version(spark.range(9), path, as_parquet)
    assert spark.read.parquet(current_path(spark, path)).count() == 9


def test_the_same_append_twice(spark, tmp_path):
    path = str(tmp_path / "history")
    assert read_commits(spark, path).collect() == []
    runs = spark.createDataFrame([("007", "2024-01-01", 1.5, "Success", "a.log"), ("r 2/ü", "2024-01-02", None, "Error", None)], "id string, date string, duration_seconds double, status string, log_file string")
    first = commit_history(runs, path)
    before = {f: os.path.getmtime(f) for f in files(f"{path}/commit={first}")}
    more = spark.createDataFrame([("r3", "x")], "id string, script string")
    second = commit_history(more, path)
    assert commit_history(runs.orderBy(F.desc("id")).repartition(3), path) == first != second
    assert sorted((r.id, r.script) for r in read_commits(spark, path).collect()) == [("007", None), ("r 2/ü", None), ("r3", "x")]
    commit_history(more, path, commit="named")
    assert read_commits(spark, path).count() == 4
    third = files(f"{path}/commit={second}")
    commit_history(runs, path)
    assert files(f"{path}/commit={second}") == third and before  # earlier commits keep their files
    commit_history(more.where("false"), path)
    assert read_commits(spark, path).count() == 4


@pytest.mark.parametrize("lines, split", [(3, None), (1000, None), (7, "200")])
def test_logs_byte_for_byte(spark, tmp_path, lines, split):
    rnd = random.Random(lines)
    written = {"empty.log": "", "one.log": "only", "end.log": "a\n\n\nb\r\n", "blank.log": "\n"}
    for i in range(4):
        written[f"r{i}.log"] = "".join(rnd.choice(["x", "ü line", "", "a longer line of text", "tab\t", "cr\r"]) + "\n" for _ in range(rnd.randint(1, 300))) + rnd.choice(["", "no end"])
    for name, text in written.items():
        (tmp_path / name).write_bytes(text.encode())
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        chunks = log_text(spark, str(tmp_path), lines).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, text in written.items():
        own = sorted((r.chunk, r.text) for r in chunks if r.log_file == name)
        assert "".join(t for _, t in own) == text
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and all(t.count("\n") <= lines for _, t in own)
    assert not split or len(chunks) > sum(-(-t.count("\n") // lines) for t in written.values())  # cut by block too


def test_progress_files_do_not_grow(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("logs", "progress", "state"))
    os.mkdir(source)
    phrases = ["Conectando ao Impala", "Executando query", "nothing", "Estruturando dados", "Executando query"]
    seen = []
    for i, phrase in enumerate(phrases):
        with open(f"{source}/{i}.log", "w") as f:
            f.write(f"r1 {phrase}\nr{i} other\n")
        lines = read_log_stream(spark, source).select(F.regexp_extract("line", r"^(\S+)", 1).alias("run"), "line")
        run_progress_stream(lines, "run", "line", target, state)  # a new query each time, from the checkpoint
        progress = read_progress(spark, target, "run")
        seen.append((len(versions(spark, target)), {r.run: r.progress for r in progress.collect()}["r1"]))
        assert all(f.startswith(f"file:{current_path(spark, target)}") or current_path(spark, target) in f for f in progress.inputFiles())
    assert [p for _, p in seen] == [10, 30, 30, 60, 60]
    assert max(n for n, _ in seen) <= 2 and len(os.listdir(f"{target}/data")) <= 2
