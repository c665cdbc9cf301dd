"""Files with different headers: one pass, the rows of the two-scan reader."""

import random

import pytest
from pyspark.sql import functions as F

from recordflow.sources import mixed
from recordflow.sources.delimited import read_csv_as_text, read_records_csv
from recordflow.sources.mixed import read_mixed_records, read_mixed_text

CELLS = ["", '""', "a", "ü", '"x;y"', '"say ""hi"""', " pad ", "7", "NULL", "漢字", "a'b", "0"]


def folder(tmp_path, seed=1, rows=200):
    rnd = random.Random(seed)
    headers = [["a", "b", "c"], ["c", "a"], ["b", "z z", "a", "c"], ["d"], ["a", "b", "c"]]
    for i, names in enumerate(headers):
        place = tmp_path / f"f{i % 2}"
        place.mkdir(exist_ok=True)
        lines = [";".join(names)]
        for _ in range(rows):
            cells = [rnd.choice(CELLS) for _ in names]
            if len(names) > 1 and rnd.random() < 0.1:
                cells = cells[: rnd.randint(1, len(names))] + rnd.choice([[], ["more", "still"]])
            lines.append(";".join(cells))
        text = rnd.choice(["\n", "\r\n"]).join(lines) + rnd.choice(["", "\n"])
        (place / f"part-{i}.csv").write_bytes((b"\xef\xbb\xbf" if i % 2 else b"") + text.encode())
    (tmp_path / "f0" / "_SUCCESS").write_text("")
    (tmp_path / "f1" / "empty.csv").write_text("")
    return str(tmp_path)


def rows_of(df, columns):
    return sorted(map(str, df.select(*columns).where(F.coalesce(*columns).isNotNull()).collect()))


@pytest.mark.parametrize("split", [37, 1000, 1 << 20])
def test_rows_of_the_two_scan_reader(spark, tmp_path, split):
    path, columns = folder(tmp_path), ["a", "b", "c", "d"]
    got = read_mixed_text(spark, f"{path}/*/part-*.csv", columns, split_bytes=split)
    assert rows_of(got, columns) == rows_of(read_csv_as_text(spark, f"{path}/*/part-*.csv", mixed=True), columns)


def test_folders_rest_and_position(spark, tmp_path):
    path = folder(tmp_path, 2)
    got = read_mixed_text(spark, f"{path}/f?", ["a"], rest=True, position=True, split_bytes=500).collect()
    two = read_csv_as_text(spark, f"{path}/*/part-*.csv", mixed=True)
    assert rows_of(read_mixed_text(spark, f"file:{path}/f*", ["z z"]), ["`z z`"]) == rows_of(two, ["`z z`"])
    keys = {frozenset(r["_rest"]) for r in got}
    assert keys <= {frozenset("bc"), frozenset("c"), frozenset(["b", "z z", "c"]), frozenset("d")}
    places = [(r["_source_file"], r["_source_block"], r["_source_row"]) for r in got]
    assert len(set(places)) == len(places) > 500


def test_typed(spark, tmp_path):
    (tmp_path / "one.csv").write_text("id;flag;when\n1.0;Sim;2020-01-02\nNULL;Não;x\n")
    (tmp_path / "two.csv").write_text("when;id\n2021-03-04;2\n")
    schema = "id long, flag boolean, when timestamp, none long"
    got = read_mixed_records(spark, str(tmp_path), schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, read_records_csv(spark, str(tmp_path), schema, mixed=True).select(got.columns).collect()))


def test_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a;b\n"x\ny";1\n"z";"2\n\n3"\n')
    (tmp_path / "two.csv").write_text('b;a\n4;"""q""\n"\n')
    got = read_mixed_text(spark, str(tmp_path), ["a", "b"], multiline=True)
    assert sorted(map(tuple, got.collect())) == sorted([("x\ny", "1"), ("z", "2\n\n3"), ('"q"\n', "4")])


@pytest.mark.parametrize("content, message", [(b"a;b;a\n1;2;3\n", "twice"), (b"a;b\n\xff\xfe;2\n", "UTF8|utf-8")])
def test_a_broken_file_is_named(spark, tmp_path, content, message):
    (tmp_path / "fine.csv").write_text("a;b\n1;2\n")
    (tmp_path / "broken.csv").write_bytes(content)
    with pytest.raises(Exception, match=f"broken.csv.*({message})"):
        read_mixed_text(spark, str(tmp_path), ["a"]).collect()


def test_missing_path_and_undeclared_columns(spark, tmp_path):
    with pytest.raises(Exception, match="no such file"):
        read_mixed_text(spark, str(tmp_path / "none"), ["a"]).collect()
    (tmp_path / "empty").mkdir()
    assert read_mixed_text(spark, str(tmp_path / "empty"), ["a"]).collect() == []
    with pytest.raises(Exception, match="name the columns"):
        spark.read.format(mixed.MixedCsv.name()).load(str(tmp_path))


@pytest.mark.parametrize("split", [1, 2, 3, 5, 8, 64])
def test_every_line_belongs_to_one_piece(tmp_path, split):
    text = b"h1;h2\n" + b"".join(b"%d;%s\n" % (i, b"x" * (i % 9)) for i in range(40)) + b"last;y"
    (tmp_path / "f").write_bytes(text)
    with mixed.fs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as file:
        names, length = mixed._header(file)
        got = b"".join(b for at in range(0, len(text), split) for b in mixed._blocks(file, max(at, length), min(at + split, len(text))))
    assert names == ["h1", "h2"] and got == text[6:]


def test_one_scan_and_no_job_before(spark, tmp_path):
    """Planning reads no file content by a job; the plan is a single scan."""
    path = folder(tmp_path, 3)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("mixed", "planning")
    df = read_mixed_text(spark, f"{path}/*", ["a", "b"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert list(tracker.getJobIdsForGroup("mixed")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("BatchScan") == 1 and "Exchange" not in plan
