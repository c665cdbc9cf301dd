"""Queries with reference SQL against it, on the smallest data set."""

import os

import pytest

from compare import connect, difference
from recordflow.llm import queries as llm

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query(spark, name):
    assert difference(llm.queries()[name](spark, FOLDER), connect(FOLDER), llm.oracle_sql()[name]) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_aliases_occur(spark):
    found = {r.via: r.n for r in llm.queries()["url_aliases"](spark, FOLDER).groupBy("via", "verdict").count().withColumnRenamed("count", "n").collect()}
    assert set(found) == {"rule", "alias", "default"}
