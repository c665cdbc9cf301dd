import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recordflow.operators import dedupe, filters, joins, manifest, outcomes, paging, profile, quality, search
from recordflow.operators.sets import distinct_join


def test_filters(spark):
    rows = spark.createDataFrame([(1, 1, None), (2, 0, 1), (3, None, 2), (4, 1, 2), (5, 1, 1)], "id int, p int, s int")
    kept = filters.exclude_value(filters.published_only(rows, "p"), "s", 2)
    assert sorted(r.id for r in kept.collect()) == [1, 5]
    text = spark.createDataFrame([("true",), ("True",), ("1",), ("0",), (None,)], "p string")
    assert filters.published_only(text, "p").count() == 3
    assert filters.published_only(text.select((F.col("p") == "1").alias("p")), "p").count() == 1


def test_typed_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).select("id", (F.col("id") % 2).alias("p")).write.parquet(path)
    plan = filters.exclude_value(filters.published_only(spark.read.parquet(path), "p"), "id", 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters"):]
    assert "EqualTo(p,1)" in pushed and "Not(EqualTo(id,2))" in pushed


def test_distinct_join_keeps_blank_and_skips_null(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, ""), (3, "x"), (None, "n")], "k int, v string")
    got = {r.k: r.v for r in distinct_join(rows, "k", {"v": F.col("v")}).collect()}
    assert got == {1: "a||b", 2: "", 3: "||x", None: "n"}


def test_child_and_bridge_sets(spark):
    base = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    child = spark.createDataFrame([(1, "x"), (1, "y"), (9, "z"), (None, "n")], "rid int, v string")
    got = {r.id: r.v for r in joins.child_sets(base, child, "id", "rid", {"v": F.col("v")}).collect()}
    assert got == {1: ["x", "y"], 2: None, None: None}
    bridge = spark.createDataFrame([(1, 7), (1, 8), (1, 7), (2, 99)], "rid int, w int")
    words = spark.createDataFrame([(7, "seven"), (8, "eight")], "w int, word string")
    got = {r.id: r.v for r in joins.bridge_sets(base, bridge, words, "id", "rid", "w", {"v": F.col("word")}).collect()}
    assert got == {1: ["eight", "seven"], 2: None, None: None}


def test_associations(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a int, b int")
    own = {r.id: (r.a, r.b) for r in joins.association_sets(base, pairs, "id", "a", "b").collect()}
    assert own == {1: (["1"], None), 2: (["2"], ["2"]), 3: (None, ["3"])}
    other = {r.id: (r.x, r.y) for r in joins.association_partners(base, pairs, "id", "a", "b", ("x", "y")).collect()}
    assert other == {1: (["2", "3"], None), 2: (["3"], ["1"]), 3: (None, ["1", "2"])}


def test_dedupe(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 5, "n"), (None, 4, None), (2, 3, "c")], "id int, o int, v string")
    got = {(r.id, r.o, r.v, r.n) for r in dedupe.dedupe_first(rows, ["id"], ["o"], "n").collect()}
    assert got == {(1, 1, "a", 2), (None, 4, None, 2), (2, 3, "c", 1)}
    assert dedupe.duplicate_count(rows, ["id"]).first()[0] == 2
    assert dedupe.duplicate_count(rows.where("id > 9"), ["id"]).first()[0] == 0


def test_dedupe_reduces_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = dedupe.dedupe_first(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_quality(spark):
    stamp = dt.datetime(2020, 1, 1)
    rows = spark.createDataFrame(
        [(1, "x", stamp), (-1, "True", dt.datetime(2030, 1, 1)), (None, None, None)], "id long, f string, t timestamp"
    )
    got = quality.quality_counts(rows, ["id", "absent"], ["f"], ["t"], dt.datetime(2025, 1, 1)).first().asDict()
    assert got == {"rows": 3, "negative_id": 1, "invalid_f": 1, "future_t": 1}


def test_totals_of_nothing(spark):
    rows = spark.createDataFrame([], "a int, b int, p int")
    got = quality.quality_totals(rows, F.col("a") > 0, F.col("b") > 0, F.col("p")).first()
    assert tuple(got) == (0, 0, 0.0, 0, 0)


def test_profile(spark):
    rows = spark.createDataFrame([(1, True, "a"), (3, None, None), (None, False, "b")], "n long, b boolean, s string")
    got = {r["column"]: r for r in profile.profile(rows).collect()}
    assert (got["n"].non_null, got["n"].nulls, got["n"]["min"], got["n"]["max"], got["n"].mean) == (2, 1, 1.0, 3.0, 2.0)
    assert (got["b"].true_count, got["b"].false_count, got["b"].mean) == (1, 1, None)
    assert got["s"].pct_null == pytest.approx(100 / 3)
    assert all(r.non_null + r.nulls == 3 for r in got.values())
    empty = profile.profile(rows.where("n > 9")).collect()
    assert all(r.pct_null == 0.0 and r.non_null == 0 for r in empty)


def test_profile_scans_once(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(5).write.parquet(path)
    plan = profile.profile(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_distribution(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,)], "c int")
    got = {r.value: (r.n, r.pct) for r in profile.distribution(rows, "c").collect()}
    assert got == {1: (2, 50.0), 2: (1, 25.0)}


CELLS = [("1", "alpha||beta"), ("2", "alphabet"), ("3", None), ("4", " Beta "), ("12", "x||alpha")]


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame(CELLS, "id string, names string")


def ids(frame):
    return sorted((r.id for r in frame.collect()), key=int)


def test_lookup(cells):
    assert ids(search.lookup(cells, "1", "id", "names")) == ["1"]
    assert ids(search.lookup(cells, "ALPHA.?$", "id", "names")) == ["12"]
    assert ids(search.lookup(cells, "a", "id", "names", size=2)) == ["1", "12"]


def test_all_hits_without_a_size(spark):
    many = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("alphabet").alias("names"))
    assert search.search_exact_or_partial(many, "alph", "id", "names").count() == 5000
    assert search.search_exact_or_partial(many, " ", "id", "names").count() == 5000
    assert search.lookup(many, "alph", "id", "names").count() == 5000


def test_numeric_id_reaches_the_scan(spark, tmp_path):
    spark.range(100).select("id", F.lit("x").alias("names")).write.parquet(str(tmp_path / "n"))
    rows = spark.read.parquet(str(tmp_path / "n"))
    hit = search.lookup(rows, "77", "id", "names")
    assert [r.id for r in hit.collect()] == [77]
    assert "EqualTo(id,77)" in hit._jdf.queryExecution().executedPlan().toString()
    assert search.lookup(rows, "077", "id", "names").count() == 0
    assert search.lookup(rows, "9" * 30, "id", "names").count() == 0


def test_search(cells):
    assert ids(search.search_exact(cells, "ALPHA ", "id", "names")) == ["1", "12"]
    assert ids(search.search_exact(cells, "beta", "id", "names")) == ["1", "4"]
    assert ids(search.search_contains(cells, "alpha", "id", "names")) == ["1", "2", "12"]
    # An exact member hides the partial hits, an exact id too.
    assert ids(search.search_exact_or_partial(cells, "alpha", "id", "names")) == ["1", "12"]
    assert ids(search.search_exact_or_partial(cells, "1", "id", "names")) == ["1"]
    assert ids(search.search_exact_or_partial(cells, "alph", "id", "names")) == ["1", "2", "12"]
    assert ids(search.search_exact_or_partial(cells, "alph", "id", "names", size=2)) == ["1", "12"]
    assert ids(search.search_exact_or_partial(cells, " ", "id", "names", size=3)) == ["1", "2", "12"]
    assert ids(search.search_exact_or_partial(cells, ".", "id", "names")) == []


def test_search_records(spark):
    rows = spark.createDataFrame(
        [("A plan", dt.datetime(2023, 12, 31, 23), "map"), ("plan b", dt.datetime(2024, 1, 1), "map"), (None, None, "map")],
        "text string, day timestamp, kind string",
    )
    hits = search.search_records(rows, "PLAN", "text", "day", dt.date(2023, 1, 1), dt.date(2023, 12, 31), "kind", "map")
    assert [r.text for r in hits.collect()] == ["A plan"]
    assert search.search_records(rows).count() == 3


def test_manifest(spark):
    rows = spark.createDataFrame([(1, "b || a||b||nan||"), (2, None)], "id int, names string")
    got = manifest.attachment_manifest(rows, "id", "names", "http://h", "/k/").orderBy("label").collect()
    assert [tuple(r) for r in got] == [("[1] a", "1", "a", "http://h/k/a"), ("[1] b", "1", "b", "http://h/k/b")]


def test_manifest_members_are_made_without_lambdas(spark):
    rows = spark.createDataFrame([(None, " a b ||NaN|| ||a b"), (7, "\tx\n"), (7, "")], "id int, names string")
    made = manifest.attachment_manifest(rows, "id", "names", "http://h", "k")
    assert sorted(r.label for r in made.collect()) == ["[7] x", "[nan] a b"]
    assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_staged_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        made.add(1)
        return -x

    rows = spark.range(200).select(counted("id").alias("v"))
    numbered = paging.number_rows(rows, "v", staged=True)
    assert sorted(map(tuple, numbered.collect())) == [(v, v + 200) for v in range(-199, 1)]
    assert made.value == 200


def test_outcomes(spark):
    rows = spark.createDataFrame([("a", 200), ("b", 404), ("c", 418), ("d", None)], "f string, s int").withColumn("m", F.lit("timeout"))
    got = {r.outcome: r.files for r in outcomes.outcome_summary(rows, "s").collect()}
    assert got == {"ok": 1, "not_found": 1, "other": 2}
    failed = sorted(r.message for r in outcomes.outcome_failures(rows, "f", "s", "m").collect())
    assert failed == ["b: Status 404", "c: Status 418", "d: timeout"]


def test_numbering_and_pages(spark):
    rng = random.Random(3)
    keys = [(rng.randrange(50), i) for i in range(500)]
    rows = spark.createDataFrame(keys, "a int, b int").repartition(7)
    numbered = paging.number_rows(rows, F.desc("a"), "b").collect()
    expected = sorted(keys, key=lambda k: (-k[0], k[1]))
    assert [(r.a, r.b) for r in sorted(numbered, key=lambda r: r.row_no)] == expected
    assert sorted(r.row_no for r in numbered) == list(range(1, 501))
    pages = [[tuple(r) for r in paging.page(rows, 120, n, F.desc("a"), "b").collect()] for n in range(1, 6)]
    assert [k for p in pages for k in p] == expected
    assert tuple(paging.page_count(rows, 120).first()) == (500, 5)


def test_page_stays_lazy_and_equals_numbered_rows(spark):
    rows = spark.range(30_000).select((F.col("id") * 7919 % 30_011).alias("id"))
    deep = paging.page(rows, 40, 500, "id")
    assert "parquet" not in deep._jdf.queryExecution().executedPlan().toString().lower()
    numbered = paging.number_rows(rows, "id").where("row_no BETWEEN 19961 AND 20000").orderBy("id")
    assert [r.id for r in deep.collect()] == [r.id for r in numbered.collect()]


def test_keyset_pages_cover_everything(spark):
    rows, last, seen = spark.range(25), None, []
    while batch := [r.id for r in paging.page_after(rows, 10, "id", last).collect()]:
        seen += batch
        last = batch[-1]
    assert seen == list(range(25))


def test_sort_nulls_last(spark):
    rows = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert [r.a for r in paging.sort_nulls_last(rows, "a").collect()] == [1, 2, None]
