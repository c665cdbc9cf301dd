"""Every search over the index gives the rows of the scan."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.operators import search
from recordflow.operators.search_index import (
    BUCKET, CHUNK_BITS, _gram_lists, _listed, build_search_index, open_search_index, required_texts,
)

WORDS = ["red", "Widget", "gear", "ÉCLAIR", "x", "ab", "İstanbul", "  pad  ", "a|b", "pad|", "", "nan", "Σίσυφος", "r.d", "redd", "𝒳yz", "1.5"]


def rows(seed=1, n=400):
    rnd, out = random.Random(seed), []
    for i in range(n):
        names = "||".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 5)))
        names = rnd.choice([names, names, f" {names}", None, names + "|", names.replace("||", "|||")])
        out.append((rnd.choice([i, i, i // 2, None]), names, rnd.choice(["k", None])))
    return out + [(7, "red||common", "hot")] * 200 + [(7, "red||common", "hot")]


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    df = spark.createDataFrame(rows(), "id long, names string, kind string").repartition(5).cache()
    path = str(tmp_path_factory.mktemp("index") / "one")
    build_search_index(df, path, "id", "names", buckets=8)
    return df, open_search_index(spark, path)


def same(one, two):
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


TERMS = ["red", " Red ", "WIDGET", "7", "éclair", "a|b", "b", "red||common", "pad|", "x", "istanbul", "i̇stanbul", "σίσυφος", "none such", "𝒳yz", "", "||", "dget||ge"]


@pytest.mark.parametrize("term", TERMS)
def test_terms(both, term):
    df, index = both
    same(index.exact(term), search.search_exact(df, term, "id", "names"))
    same(index.contains(term), search.search_contains(df, term, "id", "names"))
    same(index.exact_or_partial(term), search.search_exact_or_partial(df, term, "id", "names"))


PATTERNS = ["7", "²", "RED", "red.*gear", "^red", "re?d", "wid(get|th)", r"r\.d", "common{2}", "widget*?", "ÉCLAIR", r"\d\d", "", "pad  ", "ΣΊΣ"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_patterns(both, pattern):
    df, index = both
    same(index.lookup(pattern), search.lookup(df, pattern, "id", "names"))


def test_first_hits(both):
    df, index = both
    same(index.lookup("widget", ["id", "names", "kind"], 5), search.lookup(df, "widget", "id", "names", ["id", "names", "kind"], 5))
    same(index.exact_or_partial("edd", ["id", "names", "kind"], 3), search.search_exact_or_partial(df, "edd", "id", "names", ["id", "names", "kind"], 3))


@pytest.mark.parametrize("pattern", ["RED.*gear", "re?d", "ab+cde", "a{2}bcd", r"x\.yz", "abc?def", "ab*c", "one two", "abcé", r"abc\ddef", "(abc)", "a|bcd", "[abc]d", r"\x41bcd", r"\Qabc\E", "abc++def", "^abc$", "abc{0,2}?xyz"])
def test_required_texts(pattern):
    """Every text that matches holds the required ones."""
    rnd, tried = random.Random(pattern), 0
    needed = required_texts(pattern)
    try:
        compiled = re.compile(pattern, re.IGNORECASE | re.ASCII)
    except re.error:
        assert needed == []
        return
    alphabet = [c for c in pattern if c.isalnum() or c in " ."] + ["a", "1", " "]
    for _ in range(20000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12)))
        if compiled.search(text):
            tried += 1
            assert all(x in text.lower() for x in needed), (pattern, text, needed)
    assert needed == {"RED.*gear": ["red", "gear"], "x\\.yz": ["x.yz"], "one two": ["one", "two"]}.get(pattern, needed)


def directories(plan: str) -> str:
    return re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_term_reads_one_bucket(both):
    _, index = both
    plan = plan_of(index.member_rows("widget"))
    assert re.search(rf"\({BUCKET}#\d+ = \d+\)", directories(plan))
    assert index.postings("members", "token").select(BUCKET).distinct().count() > 4
    # The records of the hits are read by block.
    assert re.search(r"PartitionFilters: \[[^]]*_block", plan_of(index.exact("common")))
    assert search.search_exact(index.records(), "common", "id", "names").count() == index.exact("common").count() > 0


def test_a_hot_token_has_many_files(spark, tmp_path):
    """One member of every record: its postings are cut between tasks."""
    df = spark.range(200_000).selectExpr("id", "concat('everywhere||m', id % 7) as names")
    index = build_search_index(df, str(tmp_path / "hot"), "id", "names", buckets=4)
    hot = index.postings("members", "token").where("token = 'everywhere'")
    assert hot.select(F.input_file_name()).distinct().count() > 1
    assert index.exact("everywhere").count() == 200_000


def test_empty_table_and_taken_names(spark, tmp_path):
    index = build_search_index(spark.createDataFrame([], "id long, names string"), str(tmp_path / "none"), "id", "names")
    assert index.exact("a").collect() == index.contains("abc").collect() == index.lookup("7").collect() == []
    with pytest.raises(ValueError, match="_row"):
        build_search_index(spark.createDataFrame([(1, "a", 2)], "id long, names string, _row long"), str(tmp_path / "x"), "id", "names")


def test_other_separators(spark, tmp_path):
    df = spark.createDataFrame([(1, "a; b;c"), (2, "[a]^-b"), (3, "b"), (4, None)], "id long, names string")
    for n, separator in enumerate([";", "; ", "]^-"]):
        index = build_search_index(df, str(tmp_path / str(n)), "id", "names", separator)
        for term in ("a", "b", "c", "[a"):
            same(index.exact(term), search.search_exact(df, term, "id", "names", separator))


def test_grams_are_stored_as_lists(spark, tmp_path):
    """Not a row for every record of a gram, but one for the records of a chunk; the postings are those of the texts."""
    df = spark.range(30_000).selectExpr("id", "concat('everywhere||m', id % 7) as names")
    index = build_search_index(df, str(tmp_path / "lists"), "id", "names", buckets=4)
    stored, postings = spark.read.parquet(str(tmp_path / "lists" / "grams")), index.postings("grams", "gram")
    assert 10 * stored.count() < postings.count()
    assert postings.select("gram", "_row").distinct().count() == postings.count()
    expected = {}
    for row in index.stored().collect():
        for text in (row.names, str(row.id)):
            for gram in {text[i : i + 3] for i in range(len(text) - 2)}:
                expected.setdefault(gram, set()).add(row._row)
    found = {}
    for row in postings.collect():
        found.setdefault(row.gram, set()).add(row._row)
    assert found == expected
    assert {r.gram: r.n for r in index.postings("counts", "gram").collect()} == {g: len(x) for g, x in expected.items()}
    # A term still opens the directory of its bucket alone.
    assert re.search(rf"\({BUCKET}#\d+ = \d+\)", directories(plan_of(index.gram_rows(["ywh"]))))


@pytest.mark.parametrize("rows", [[], [5], [3, 1, 2], [1, (1 << CHUNK_BITS) - 1, 1 << CHUNK_BITS, (3 << 33) + 7], list(range(40, 0, -1))])
def test_gram_lists(rows):
    """Lists of any texts: with NUL and letters beyond 16 bits, short, empty, in any order of the rows."""
    rnd = random.Random(len(rows))
    texts = [["".join(rnd.choice("ab\0é𝒳") for _ in range(rnd.randint(0, 12))) for _ in rows] for _ in range(2)]
    batch = _gram_lists(np.array(rows, np.int64), texts[0] + texts[1]).to_pylist()
    found = [(x["gram"], (x["_chunk"] << CHUNK_BITS) + place) for x in batch for place in x["places"]]
    expected = {(t[i : i + 3], row) for column in texts for row, t in zip(rows, column) for i in range(len(t) - 2)}
    assert sorted(found) == sorted(expected)
    assert all(x["n"] == len(x["places"]) for x in batch)
    assert len({(x["gram"], x["_chunk"]) for x in batch}) == len(batch)


def test_long_texts_are_listed_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr("recordflow.operators.search_index.LETTERS", 10)
    texts = ["abcd", "", "abcdefghijklmnop", "abc", "xyz", "abcdef"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), pa.array(texts), pa.array(["12"] * 6)], ["_row", "names", "id"])
    parts = list(_listed(iter([batch])))
    found = [(x["gram"], p) for part in parts for x in part.to_pylist() for p in x["places"]]
    assert len(parts) > 2
    assert sorted(found) == sorted((t[i : i + 3], row) for row, t in enumerate(texts) for i in range(len(t) - 2))


def test_texts_that_are_no_text(spark, tmp_path):
    """Bytes that are no UTF-8 do not stop the index."""
    df = spark.sql("SELECT id, CAST(x AS STRING) AS names FROM VALUES (1, X'61626380C3'), (2, X'FF616263'), (3, X'616263') AS t(id, x)")
    index = build_search_index(df, str(tmp_path / "bytes"), "id", "names")
    assert index.contains("abc").count() == search.search_contains(df, "abc", "id", "names").count() == 3


def test_an_index_of_an_earlier_form_is_refused(spark, tmp_path):
    path = str(tmp_path / "old")
    build_search_index(spark.createDataFrame([(1, "abc")], "id long, names string"), path, "id", "names")
    layout = json.loads(spark.read.text(f"{path}/layout").first()["value"])
    del layout["form"]
    spark.createDataFrame([(json.dumps(layout),)], "value string").write.mode("overwrite").text(f"{path}/layout")
    with pytest.raises(ValueError, match="build it again"):
        open_search_index(spark, path)
