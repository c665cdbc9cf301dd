"""The extract over stored tables: the same rows, and no shuffle of child tables."""

import re

import pytest
from pyspark.sql import functions as F

from recordflow.operators.sets import stored_arrays
from recordflow.plans.archive import archive_spec, flat_spec
from recordflow.plans import layout as layout_plan
from recordflow.plans.layout import open_layout, write_layout
from recordflow.plans.wide import denormalize, flat_extract
from test_wide import URL, as_rows, frames, random_tables


@pytest.mark.parametrize("seed, options", [(1, {"protocol_rows": True}), (3, {"unique_key": True})])
def test_same_rows(spark, tmp_path, seed, options):
    made = random_tables(seed, rows=12, key_range=3)
    if options.get("unique_key"):
        for i, record in enumerate(made["tb_arquivo_acervo"]):
            record["id_arquivo_acervo"] = i
    tables, spec = frames(spark, made), archive_spec(URL, **options)
    layout = write_layout(tables, spec, str(tmp_path / "layout"), buckets=3)
    expected = denormalize(tables, spec, arrays=True)
    stored = denormalize(layout.tables, layout.spec, arrays=True)
    assert stored.columns == expected.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect())) != []
    layout.forget(spark)  # a later session opens it again, under new names
    again = open_layout(spark, spec, layout.path)
    assert not set(layout.names) & set(again.names) and again.spec == layout.spec
    assert all(again.tables[name].count() == rows.count() for name, rows in again.tables.items())


def subtree(lines: list[str], at: int) -> list[str]:
    """The plan below a line of the tree."""
    depth = re.search(r"[A-Za-z*]", lines[at]).start()
    end = next((i for i in range(at + 1, len(lines)) if re.search(r"[A-Za-z*]", lines[i]).start() <= depth), len(lines))
    return lines[at + 1 : end]


def test_children_are_not_shuffled(spark, tmp_path):
    """Shuffles: pairs by link, what a link leads to by link, and that by record; all tables are read by bucket."""
    tables = frames(spark, random_tables(5, rows=30, key_range=9))
    spec = archive_spec(URL, unique_key=True)
    layout = write_layout(tables, spec, str(tmp_path / "layout"), buckets=3)
    children = {"tx", "tq", "tq1", "tac", "tao", "tpv", "tpc", "ti", "tpa"}
    wide = denormalize(layout.tables, layout.spec)
    planned = [x for x in wide._jdf.queryExecution().executedPlan().toString().split("\n") if re.search("[A-Za-z]", x)]
    assert sum("Bucketed: true" in x for x in planned) >= len(children)
    shuffles = [i for i, x in enumerate(planned) if re.search(r"\bExchange hashpartitioning", x)]
    keys = [re.search(r"hashpartitioning\((.*?)#", planned[i]).group(1) for i in shuffles]
    assert set(keys) <= {"_link", "_key", "_record", "tc__id_categoria", "id_categoria"}
    # A shuffle by _key has whole pieces below it: sets are made before, not after.
    for i, key in zip(shuffles, keys):
        below = "\n".join(subtree(planned, i))
        assert key == "_key" or not any(f"/layout/{c}]" in below and "ObjectHashAggregate" not in below for c in children)
    plain = denormalize(tables, spec)._jdf.queryExecution().executedPlan().toString()
    assert len(shuffles) < plain.count("Exchange hashpartitioning") / 2


def test_sets_of_a_stored_table_have_no_exchange(spark, tmp_path):
    tables = frames(spark, random_tables(6, rows=10, key_range=4))
    layout = write_layout(tables, archive_spec(URL), str(tmp_path / "layout"), buckets=4)
    sets = stored_arrays(layout.tables["tac"], "id_descritoes_informacionais_iconografico", {"a": F.col("ds_autor_copia")})
    assert "Exchange" not in sets._jdf.queryExecution().executedPlan().toString()


def test_raw_rows_need_the_tables(spark, tmp_path):
    tables = frames(spark, random_tables(8, rows=5))
    layout = write_layout(tables, archive_spec(URL), str(tmp_path / "layout"), buckets=2)
    with pytest.raises(ValueError, match="raw rows"):
        flat_extract(layout.tables, layout.spec)
    assert flat_extract(tables, flat_spec()).columns


def test_buckets_grow_with_the_records(spark, tmp_path, monkeypatch):
    """A bucket holds a bounded number of records, whatever the least number of buckets is."""
    tables, spec = frames(spark, random_tables(9, rows=40, key_range=9)), archive_spec(URL)
    monkeypatch.setattr(layout_plan, "BUCKET_RECORDS", 10)
    layout = write_layout(tables, spec, str(tmp_path / "layout"), buckets=2)
    said = spark.sql(f"DESCRIBE EXTENDED {layout.names[0]}").where("col_name = 'Num Buckets'").first()["data_type"]
    assert int(said) == 4
    assert sorted(map(str, denormalize(layout.tables, layout.spec).collect())) == sorted(map(str, denormalize(tables, spec).collect()))
