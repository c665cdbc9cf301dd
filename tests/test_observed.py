"""Counts taken while writing equal the aggregates over the written rows."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordflow.operators.observed import observed_write, written_metrics
from recordflow.operators.profile import profile, profile_metrics, profile_rows
from recordflow.operators.quality import count_metrics, quality_counts, quality_totals, total_metrics
from recordflow.plans import structuring
from recordflow.session import drop_scratch, scratch_path, shared_folder

SCHEMA = "id long, x double, ok boolean, text string, `odd name` int, day timestamp"


def rows(n, seed=1):
    rnd = random.Random(seed)
    pick = lambda v: None if rnd.random() < 0.2 else v
    return [(pick(i - 5), pick(i / 3), pick(i % 2 == 0), pick(f"t{i % 7}"), pick(i), pick(datetime(2020, 1, 1 + i % 28))) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_same_as_aggregates(spark, tmp_path, n):
    df, asof = spark.createDataFrame(rows(n), SCHEMA).repartition(7), datetime(2020, 1, 10)
    metrics = {
        "counts": count_metrics(df.columns, ["id", "odd name"], ["text"], ["day"], asof),
        "totals": total_metrics(F.col("ok"), F.col("x") > 3, F.col("id")),
        "profile": profile_metrics(df.schema),
    }
    path = str(tmp_path / "out")
    got = observed_write(df, lambda x: x.write.parquet(path), metrics)
    stored = spark.read.parquet(path)
    assert stored.count() == n
    expected = {
        "counts": quality_counts(df, ["id", "odd name"], ["text"], ["day"], asof),
        "totals": quality_totals(df, F.col("ok"), F.col("x") > 3, F.col("id")),
    }
    for name, frame in expected.items():
        assert got[name].schema.simpleString() == frame.schema.simpleString()
        assert got[name].collect() == frame.collect()
    long, plain = (sorted(map(str, x.select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in x.dtypes]).collect())) for x in (profile_rows(got["profile"], df.schema), profile(df)))
    assert long == plain
    for frame in got.values():
        assert "Scan parquet" not in frame._jdf.queryExecution().executedPlan().toString()


def test_size_is_that_of_the_files(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(400_000).withColumn("v", F.rand(1)).withColumn("p", F.col("id") % 3)
    got = observed_write(df, lambda x: x.write.partitionBy("p").parquet(path), {"n": [F.count(F.lit(1)).alias("rows")]})
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))
    row = written_metrics(got["n"], 3, path, datetime(2020, 1, 1), datetime(2020, 1, 1, 0, 1)).first()
    assert (row["rows"], row["columns"], row["duration_seconds"]) == (400_000, 3, 60.0)
    assert row["size_mb"] == round(size / 1048576, 2) > 1


def test_a_run_counts_while_it_writes(spark, tmp_path):
    """After the run, checks, totals and profile read no file; the copy of the input is gone."""
    source = tmp_path / "in.csv"
    source.write_text("id_arquivo_acervo;ic_principal;id_categoria;co_protocolo_acervo;ic_publicado_internet\n1;maybe;-3;5;1\n1;True;4;5;1\n2;;4;;\n")
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    result = structuring.run_structuring(spark, str(source), str(tmp_path / "out"), datetime(2020, 1, 1))
    for frame in (result.checks, result.totals, result.profile):
        assert "Scan" not in frame._jdf.queryExecution().executedPlan().toString().replace("Scan ExistingRDD", "").replace("LocalTableScan", "")
    checks = result.checks.first()
    assert (checks["rows"], checks["duplicates"], checks["negative_id_categoria"], checks["invalid_ic_principal"]) == (2, 1, 1, 1)
    assert result.totals.first().asDict() == {"total": 2, "complete": 0, "pct_complete": 0.0, "described": 0, "published": 1}
    assert sorted(map(str, result.profile.collect())) == sorted(map(str, profile(result.structured).collect()))
    assert result.metrics.first()["rows"] == 2
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before


def test_scratch_is_removed_by_path_parts(spark):
    path = scratch_path(spark, "kept")
    spark.range(1).write.parquet(path)
    for wrong in (shared_folder(spark), shared_folder(spark) + "-other/x", path + "/../../x", "/tmp"):
        with pytest.raises(ValueError, match="not below"):
            drop_scratch(spark, wrong)
    drop_scratch(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
