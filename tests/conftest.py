import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from recordflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate an expression over single-column text rows."""
    def run(expression, *texts, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], f"i int, c {kind}")
        return [r[0] for r in rows.orderBy("i").select(expression(F.col("c"))).collect()]

    return run
