"""The wide extract against the plain form: join everything, then GROUP BY."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F, types as T

from compare import normal
from recordflow.bindings.wide_sql import naive_sql
from recordflow.plans.archive import ARCHIVE_TABLES, archive_spec, extract_archive, flat_spec
from recordflow.plans import wide as wide_plan
from recordflow.plans.wide import (
    Bridge, Children, Descriptor, Lookup, WideSpec, denormalize, flat_extract, member_rows, members, raw, text,
)

URL = "https://files.example.org/"


def random_tables(seed: int, rows: int = 6, key_range: int = 5) -> dict[str, list[dict]]:
    """Small tables with NULL, dangling and duplicate keys and blank texts."""
    rng = random.Random(seed)

    def value(field: T.StructField, i: int):
        kind = field.dataType
        if field.name in ("ic_publicado_internet", "id_situacao"):
            return rng.choice([1, 1, 1, 2, None])
        if rng.random() < 0.2:
            return None
        if isinstance(kind, T.LongType):
            return rng.randrange(key_range)
        if isinstance(kind, T.BooleanType):
            return rng.random() < 0.5
        if isinstance(kind, T.StringType):
            return rng.choice(["", "a", "b", "c||d"])
        if isinstance(kind, T.DecimalType):
            from decimal import Decimal

            return Decimal(rng.randrange(4)).quantize(Decimal("0.0001"))
        from datetime import datetime

        return datetime(2020, 1, 1 + rng.randrange(3))

    made = {}
    for name, ddl in ARCHIVE_TABLES.items():
        fields = T.StructType.fromDDL(ddl).fields
        # Few child rows: the plain form multiplies them.
        count = rows if name == "tb_arquivo_acervo" else rng.randrange(2, 5)
        made[name] = [{f.name: value(f, i) for f in fields} for i in range(count)]
    return made


def frames(spark, made):
    return {
        name: spark.createDataFrame([tuple(r.values()) for r in rows], T.StructType.fromDDL(ARCHIVE_TABLES[name]))
        for name, rows in made.items()
    }


def database(made):
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
    con = duckdb.connect()
    for name, rows in made.items():
        fields = T.StructType.fromDDL(ARCHIVE_TABLES[name]).fields
        columns = ", ".join(f"{f.name} {kinds.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in fields)
        con.execute(f"CREATE TABLE {name} ({columns})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(fields))})", [list(r.values()) for r in rows])
    return con


def as_rows(rows):
    return sorted(tuple(normal(x) for x in row) for row in rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_plain_joins_and_group_by(spark, seed):
    made = random_tables(seed, rows=12, key_range=3)
    spec = archive_spec(URL)
    ours = denormalize(frames(spark, made), spec)
    names = [f.name for f in spec.fields]
    theirs = database(made).execute(naive_sql(spec)).fetchall()
    assert ours.columns == names and len(names) == 79
    assert as_rows(ours.collect()) == as_rows(theirs)
    assert theirs


@pytest.mark.parametrize(
    "options",
    [
        {"url_source": "tx.id_arquivo_anexo", "file_names": False},
        {"ignore_case": True, "protocol_rows": True},
        {"protocol_rows": True, "url_source": "tx.id_arquivo_anexo", "file_names": False},
    ],
)
def test_earlier_forms_equal_their_plain_form(spark, options):
    made = random_tables(8, rows=12, key_range=3)
    spec = archive_spec(URL, **options)
    ours, theirs = denormalize(frames(spark, made), spec), database(made).execute(naive_sql(spec)).fetchall()
    assert as_rows(ours.collect()) == as_rows(theirs) and theirs
    assert len(spec.fields) == 79 - (not options.get("file_names", True))


def test_extract_is_ordered_by_number(spark):
    made = random_tables(4, rows=15, key_range=13)
    ids = [int(r[0]) for r in extract_archive(frames(spark, made), URL, ordered=True).select("id_arquivo_acervo").where("id_arquivo_acervo is not null and id_arquivo_acervo <> ''").collect()]
    assert ids == sorted(ids)


def test_unique_key_gives_the_same(spark):
    made = random_tables(9, rows=12, key_range=3)
    for i, record in enumerate(made["tb_arquivo_acervo"]):
        record["id_arquivo_acervo"] = i
    tables = frames(spark, made)
    fast, exact = (denormalize(tables, archive_spec(URL, unique_key=u)) for u in (True, False))
    assert as_rows(fast.collect()) == as_rows(exact.collect())


def small_spec(**options):
    return WideSpec(
        "r", "record", "id",
        links=(
            Descriptor("d", "descriptor", "r", "d_id"),
            Lookup("l", "lookup", "d", "l_id"),
            Children("a", "author", "d", "d_id"),
            Children("f", "file", "r", "id"),
        ),
        fields=(
            raw("id", "r.id"), raw("d_id", "r.d_id"), text("l_name", "l.name"), members("authors", "a.author"),
            members("files", "f.file"), members("urls", "f.file", "u/"),
        ),
        **options,
    )


def small_tables(spark):
    return {
        "record": spark.createDataFrame([(1, 10), (2, 10), (3, 99), (4, None), (1, 10)], "id long, d_id long"),
        "descriptor": spark.createDataFrame([(10, 5), (11, 5)], "d_id long, l_id long"),
        "lookup": spark.createDataFrame([(5, "five")], "l_id long, name string"),
        "author": spark.createDataFrame([(10, "x"), (10, "y"), (10, "x"), (99, "z")], "d_id long, author string"),
        "file": spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, "")], "id long, file string"),
    }


def test_small_extract(spark):
    rows = {r["id"]: tuple(r)[1:] for r in denormalize(small_tables(spark), small_spec()).collect()}
    assert rows == {
        1: (10, "five", "x||y", "a||b", "u/a||u/b"),
        2: (10, "five", "x||y", "", "u/"),
        3: (99, "", "", "", ""),
        4: (None, "", "", "", ""),
    }


def test_arrays_inside(spark):
    rows = {r["id"]: r for r in denormalize(small_tables(spark), small_spec(), arrays=True).collect()}
    assert rows[1]["files"] == ["a", "b"] and rows[1]["urls"] == ["u/a", "u/b"] and rows[4]["files"] is None


def test_duplicate_lookup_fans_out(spark):
    tables = small_tables(spark)
    tables["lookup"] = spark.createDataFrame([(5, "five"), (5, "cinco"), (5, "five")], "l_id long, name string")
    names = [r["l_name"] for r in denormalize(tables, small_spec()).where("id = 2").collect()]
    assert sorted(names) == ["cinco", "five"]


def test_flat_rows(spark):
    flat = flat_extract(small_tables(spark), small_spec(), expand="f")
    rows = sorted((r["id"], r["files"] or "", tuple(r["authors"] or ())) for r in flat.collect())
    # Record 1 occurs twice and has four file rows.
    assert len(rows) == 2 * 4 + 1 + 1 + 1
    assert (3, "", ()) in rows and (1, "a", ("x", "y")) in rows
    assert flat_extract(small_tables(spark), small_spec()).count() == 5
    with pytest.raises(ValueError):
        flat_extract(small_tables(spark), small_spec(), expand="l")


def test_flat_archive_columns(spark):
    flat = flat_extract(frames(spark, random_tables(6)), flat_spec(), expand="tx")
    assert len(flat.columns) == 75 and flat.count() >= 6


def test_unused_links_are_not_read(spark):
    spec = WideSpec("r", "record", "id", small_spec().links, (raw("id", "r.id"), raw("d_id", "r.d_id")))
    tables = {k: v for k, v in small_tables(spark).items()}
    plan = denormalize(tables, spec)._jdf.queryExecution().optimizedPlan().toString()
    assert "author" not in plan and "file" not in plan


def test_hot_key_is_spread_before_it_is_gathered(spark):
    from recordflow.operators.sets import distinct_arrays

    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("v")
    )
    sets = distinct_arrays(rows, "k", {"v": F.col("v")})
    assert sets.where("k = 0").first()["v"] == [str(i) for i in range(7)]
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "value" in plan.split("hashpartitioning(k")[2].split(")")[0]


@pytest.fixture
def eager_skew_splitting(spark):
    """Thresholds so low that AQE treats small test partitions like large ones."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def hot_tables(spark, rows=40000):
    """A third of the records share one descriptor, a third have none; record 0 owns a third of the files."""
    i = F.col("id")
    link = F.when(i % 3 == 0, F.lit(0)).when(i % 3 == 1, i % 1000)
    return {
        "record": spark.range(0, rows, 1, 8).select("id", link.alias("d_id")),
        "descriptor": spark.range(1000).select(i.alias("d_id"), (i % 7).alias("l_id")),
        "lookup": spark.range(7).select(i.alias("l_id"), F.concat(F.lit("n"), i.cast("string")).alias("name")),
        "author": spark.range(3000).select((i % 1000).alias("d_id"), i.cast("string").alias("author")),
        "file": spark.range(0, rows, 1, 8).select(
            F.when(i % 3 == 0, F.lit(0)).otherwise(i).alias("id"), F.concat(F.lit("f"), i.cast("string")).alias("file")
        ),
    }


def test_hot_link_is_split(spark, eager_skew_splitting):
    wide = denormalize(hot_tables(spark), small_spec())
    assert "skew=true" in executed_plan(wide)
    assert wide.count() == 40000
    assert wide.where("d_id = 0 and authors = '0||1000||2000' and l_name = 'n0'").count() == 13334 + 13


def test_hot_left_key_of_set_joins_is_split(spark, eager_skew_splitting):
    from recordflow.operators import joins

    i = F.col("id")
    records = spark.range(0, 40000, 1, 8).select(F.when(i % 10 > 0, F.lit(0)).otherwise(i % 1000).alias("k"), F.rand(1).alias("x"))
    child = spark.range(3000).select((i % 1000).alias("k"), i.alias("v"))
    target = spark.range(3000).select(i.alias("v"), i.cast("string").alias("name"))
    pairs = child.select(F.col("k").alias("a"), F.col("v").alias("b"))
    for frame in (
        joins.child_sets(records, child, "k", "k", {"vs": F.col("v")}),
        joins.bridge_sets(records, child, target, "k", "k", "v", {"names": F.col("name")}),
        joins.association_sets(records, pairs, "k", "a", "b"),
        joins.association_partners(records, pairs, "k", "a", "b", ("one", "two")),
    ):
        assert "skew=true" in executed_plan(frame)
        assert frame.count() == 40000


def test_hot_key_of_expanded_rows_is_split(spark, eager_skew_splitting):
    flat = flat_extract(hot_tables(spark), small_spec(), expand="f")
    assert "skew=true" in executed_plan(flat)
    assert flat.where("id = 0").count() == 13334
    assert flat.count() == 40000 + 13333


def test_rows_of_a_child_do_not_shuffle_the_wide_rows(spark, eager_skew_splitting, monkeypatch):
    """With a unique key only the records with very many rows are shuffled once more, and their join is split."""
    tables = hot_tables(spark)
    expected = sorted(map(str, flat_extract(tables, small_spec(), expand="f").collect()))
    monkeypatch.setattr(wide_plan, "HOT_ROWS", 1000)
    flat = flat_extract(tables, small_spec(unique_key=True), expand="f")
    # The column of the base is only a shuffle's key where wide rows are shuffled for their child rows.
    planned = flat._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in planned.split("\n") if "Exchange hashpartitioning(r__id#" in x]) == 1
    assert "skew=true" in executed_plan(flat)
    assert sorted(map(str, flat.collect())) == expected
    monkeypatch.setattr(wide_plan, "HOT_ROWS", 10**9)
    assert sorted(map(str, flat_extract(tables, small_spec(unique_key=True), expand="f").collect())) == expected


@pytest.mark.parametrize("most", [0, 1, 10**9])
def test_plain_columns_of_a_child_with_a_unique_key(spark, monkeypatch, most):
    """One row per record and file, for hot records and others; records without files have one with NULL."""
    spec = small_spec(unique_key=True)
    fields = (raw("id", "r.id"), raw("file", "f.file"), members("authors", "a.author"))
    spec = WideSpec(spec.alias, spec.table, spec.key, spec.links, fields, unique_key=True)
    tables = small_tables(spark)
    tables["record"] = spark.createDataFrame([(1, 10), (2, 10), (3, 99), (4, None)], "id long, d_id long")
    monkeypatch.setattr(wide_plan, "HOT_ROWS", most)
    rows = sorted(denormalize(tables, spec).collect(), key=str)
    expected = [(1, "a", "x||y"), (1, "b", "x||y"), (1, None, "x||y"), (2, "", "x||y"), (3, None, ""), (4, None, "")]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))


def test_member_rows_are_distinct_without_a_last_shuffle(spark):
    """Records of one id with several links need the distinct at the end, and nothing else does."""
    links = (
        Descriptor("d", "descriptor", "r", "d_id"), Children("a", "author", "d", "d_id"), Children("f", "file", "r", "id"),
        Bridge("b", "bridge", "r", "d_id", target="target", target_key="t_id"),
    )
    fields = (members("authors", "a.author"), members("files", "f.file"), members("urls", "f.file", "u/"), members("names", "b.name"))
    tables = {
        "record": spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 10), (None, 10), (None, 11), (3, 99), (4, None)], "id long, d_id long"),
        "descriptor": spark.createDataFrame([(10,), (10,), (11,)], "d_id long"),
        "author": spark.createDataFrame([(10, "x"), (10, "x"), (11, "x"), (11, "y"), (99, "z"), (10, None)], "d_id long, author string"),
        "file": spark.createDataFrame([(1, "b"), (1, "b"), (2, ""), (2, None)], "id long, file string"),
        "bridge": spark.createDataFrame([(10, 7), (10, 7), (10, 8), (11, 8), (None, 7)], "d_id long, t_id long"),
        "target": spark.createDataFrame([(7, "n"), (8, "n"), (9, "m")], "t_id long, name string"),
    }
    rows = member_rows(tables, WideSpec("r", "record", "id", links, fields, unique_key=True))
    ids = {1: ["x", "y"], 2: ["x"], None: ["x", "y"]}
    expected = [(i, "authors", v) for i, vs in ids.items() for v in vs] + [(i, "names", "n") for i in ids]
    expected += [(1, "files", "b"), (1, "urls", "u/b"), (2, "files", ""), (2, "urls", "u/")]
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, expected))
    assert rows._jdf.queryExecution().optimizedPlan().toString().startswith("Union")


def test_joins_of_wide_rows_are_narrow(spark):
    """What a link leads to meets the records as one column: methods over all columns are too long for the JVM to compile."""
    tables = {name: spark.createDataFrame([], ddl) for name, ddl in ARCHIVE_TABLES.items()}

    def widest(plan) -> int:
        below = [widest(plan.children().apply(i)) for i in range(plan.children().size())]
        return max([plan.output().size() if plan.nodeName() == "Join" else 0, *below])

    for options in ({}, {"protocol_rows": True}):
        wide = denormalize(tables, archive_spec(unique_key=True, **options))
        assert 0 < widest(wide._jdf.queryExecution().optimizedPlan()) < 50
        assert not any(c.startswith("_") for c in wide.columns)


def as_sorted(rows):
    return sorted(normal(list(r)) for r in rows)


def test_sets_travel_as_cell_text(spark):
    """Sets are joined where they are gathered; only those with a prefix before their members wait for it as arrays."""
    for seed in (3, 4):
        tables = frames(spark, random_tables(seed, key_range=3))
        spec = archive_spec(URL)
        kinds = {f.name: f.dataType.typeName() for f in wide_plan._Plan(tables, spec, True, None, texts=True).build().schema.fields}
        sets = {name: kind for name, kind in kinds.items() if name.startswith("set__")}
        assert sets.pop("set__tx__ds_arquivo_gravado") == "array"
        assert len(sets) == 9 and set(sets.values()) == {"string"}
        names = [f.name for f in spec.fields if f.kind == "members"]
        inside = denormalize(tables, spec, arrays=True)
        joined = inside.select(*[F.coalesce(F.array_join(c, "||"), F.lit("")).alias(c) for c in names])
        assert as_sorted(denormalize(tables, spec).select(*names).collect()) == as_sorted(joined.collect())


def test_sets_of_the_own_key_are_not_gathered(spark):
    tables = {
        "record": spark.createDataFrame([(1,), (2,), (None,), (1,)], "id long"),
        "pair": spark.createDataFrame([(1, 5), (1, 6), (None, 7), (3, 1)], "id long, other long"),
    }
    spec = WideSpec("r", "record", "id", (Children("p", "pair", "r", "id"),), (raw("id", "r.id"), members("ids", "p.id")))
    wide = denormalize(tables, spec)
    assert "collect_list" not in wide._jdf.queryExecution().optimizedPlan().toString()
    assert as_sorted(wide.collect()) == as_sorted([(1, "1"), (2, ""), (None, "")])
    assert as_sorted(denormalize(tables, spec, arrays=True).collect()) == as_sorted([(1, ["1"]), (2, None), (None, None)])


def test_rows_of_a_child_are_gathered_where_they_are_joined(spark, eager_skew_splitting):
    from recordflow.operators.sets import distinct_arrays_beside

    rows = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (1, "x", None), (2, "x", "a"), (9, "x", "a")], "k long, p string, v string")
    records = spark.createDataFrame([(1,), (2,)], "id long")
    sets = distinct_arrays_beside(rows, "k", ["p"], {"v": F.col("v")}, lambda df: df.where("k < 9"))
    assert as_sorted(sets.collect()) == as_sorted([(1, None, ["a", "b"]), (1, "x", []), (2, "x", ["a"])])
    found = records.join(sets, records["id"] == sets["k"], "left")
    # The rows are spread to be made distinct, then lie by key for the grouping and for the join.
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3


def final_plan(frame) -> str:
    return executed_plan(frame).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("most", [0, 50, 10**9])
def test_members_of_a_key_move_once_unless_it_is_hot(spark, most):
    from recordflow.operators.sets import arrays_by_key, distinct_arrays, hot_buckets

    i = F.col("id")
    rows = spark.range(0, 3000, 1, 4).select(
        F.when(i % 3 == 0, F.lit(7)).when(i % 3 == 1, i % 200).alias("k"),
        F.when(i % 5 > 0, i % 11).alias("v"), F.when(i % 7 > 0, F.concat(F.lit("w"), (i % 2).cast("string"))).alias("w"),
    )
    values = {"v": F.col("v"), "w": F.col("w")}
    hot = hot_buckets(rows, "k", most)
    assert min(hot.count(), 3) == {0: 3, 50: 2, 10**9: 0}[most]  # also the bucket of NULL
    sets = arrays_by_key(rows, "k", values, hot)
    plan = final_plan(sets)
    assert len(re.findall(r"Exchange hashpartitioning\(k#", plan)) == {0: 2, 50: 3, 10**9: 1}[most]
    assert as_sorted(sets.collect()) == as_sorted(distinct_arrays(rows, "k", values).collect())


def test_pieces_of_a_link_meet_where_they_lie(spark, eager_skew_splitting):
    """A descriptor with its children and a child of the same link are shuffled once by it, and once more to meet the pairs."""
    links = (Descriptor("d", "descriptor", "r", "d_id"), Children("a", "author", "d", "d_id"), Children("w", "word", "r", "d_id"))
    fields = (raw("id", "r.id"), raw("d_id", "r.d_id"), raw("l_id", "d.l_id"), members("authors", "a.author"), members("words", "w.word"))
    tables = small_tables(spark) | {"word": spark.createDataFrame([(10, "p"), (99, "q"), (10, "o"), (10, "o")], "d_id long, word string")}
    wide = denormalize(tables, WideSpec("r", "record", "id", links, fields))
    expected = [(1, 10, 5, "x||y", "o||p"), (2, 10, 5, "x||y", "o||p"), (3, 99, None, "", "q"), (4, None, None, "", "")]
    assert as_sorted(wide.collect()) == as_sorted(expected)
    assert len(re.findall(r"Exchange hashpartitioning\(_key#", final_plan(wide))) == 1


def test_flat_sets_travel_as_cell_text(spark):
    tables = frames(spark, random_tables(7, key_range=3))
    spec = flat_spec()
    cells = flat_extract(tables, spec, expand="tx", arrays=False)
    arrays = flat_extract(tables, spec, expand="tx")
    assert "array" not in {f.dataType.typeName() for f in cells.schema.fields}
    sets = [f.name for f in arrays.schema.fields if f.dataType.typeName() == "array"]
    joined = [F.coalesce(F.array_join(c, "||"), F.lit("")).alias(c) if c in sets else c for c in arrays.columns]
    assert len(sets) == 8 and as_sorted(cells.collect()) == as_sorted(arrays.select(*joined).collect())


def test_rows_of_a_child_move_once(spark, eager_skew_splitting):
    from recordflow.operators.sets import arrays_beside, distinct_arrays_beside

    rows = spark.createDataFrame(
        [(1, None, "a"), (1, None, "b"), (1, None, "b"), (1, "x", None), (2, "x", "a"), (9, "x", "a"), (None, "x", "a")], "k long, p string, v string"
    )
    records = spark.createDataFrame([(1,), (2,)], "id long")
    made = [f(rows, "k", ["p"], {"v": F.col("v")}, lambda df: df.where("k < 9")) for f in (arrays_beside, distinct_arrays_beside)]
    assert as_sorted(made[0].collect()) == as_sorted(made[1].collect()) == as_sorted([(1, None, ["a", "b"]), (1, "x", []), (2, "x", ["a"])])
    found = records.join(made[0], records["id"] == made[0]["k"], "left")
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_protocol_rows_move_once(spark, eager_skew_splitting):
    fields = (raw("id", "r.id"), raw("p", "f.p"), members("files", "f.file"))
    spec = WideSpec("r", "record", "id", (Children("f", "file", "r", "id"),), fields, unique_key=True)
    tables = {
        "record": spark.createDataFrame([(1,), (2,)], "id long"),
        "file": spark.createDataFrame([(1, "x", "b"), (1, "x", "a"), (1, "x", "a"), (1, None, None)], "id long, p string, file string"),
    }
    wide = denormalize(tables, spec)
    assert as_sorted(wide.collect()) == as_sorted([(1, "x", "a||b"), (1, None, ""), (2, None, "")])
    assert not re.search(r"Exchange hashpartitioning\(_key#\w+, \w+#", final_plan(wide))
