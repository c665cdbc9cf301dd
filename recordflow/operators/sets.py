"""Distinct sets per key: the multi-valued fields of the wide extract.

Sets are built in two steps. First the (key, field, value) rows are made
distinct: copies are combined on the map side, and because the value is part of
the shuffle key, a key that owns a third of all rows is spread over all tasks.
Only the distinct rest is brought together per key, which moves exactly the
members of the resulting cells.

The second step must be ``collect_list``. Spark removes a ``distinct`` below
``collect_set``, and then every map task would send its own partial set of a
hot key to one reducer.

Where the buckets of hot keys are known (:func:`hot_buckets`), only these need two
steps: :func:`arrays_by_key` moves the members of all other keys once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.functions.multivalue import SEPARATOR, join_values
from recordflow.session import scratch_path

#: Buckets in which the rows of keys are counted. A hot bucket holds 1/2048 of all rows at least, eight times its share.
BUCKETS, HOT_SHARE = 16_384, 2_048


def _members(df: DataFrame, key: str, values: Mapping[str, Column], nulls: bool, also: Sequence[str] = ()) -> DataFrame:
    """Distinct ``(key, field, value)`` rows, ``field`` being a position; none for a single one."""
    if len(values) == 1:
        (value,) = values.values()
        rows = df.select(F.col(key), *also, value.cast("string").alias("value"))
    else:
        fields = [F.struct(F.lit(i).alias("field"), c.cast("string").alias("value")) for i, c in enumerate(values.values())]
        rows = df.select(F.col(key), *also, F.inline(F.array(*fields)))
    if not nulls:
        rows = rows.where(F.col(key).isNotNull() & F.col("value").isNotNull())
    return rows.distinct()


def _gathered(members: DataFrame, key: str, names: list[str], also: Sequence[str] = ()) -> DataFrame:
    """Sorted array per key and field; collect_list leaves out NULL.

    ``sort_array`` compares texts directly, ``array_sort`` by an interpreted lambda.
    """
    def own(i: int) -> Column:
        return F.when(F.col("field") == i, F.col("value")) if len(names) > 1 else F.col("value")

    # Partitioned by key up front: a partial collect_list would reduce nothing.
    return members.repartition(key).groupBy(key, *also).agg(
        *[F.sort_array(F.collect_list(own(i))).alias(name) for i, name in enumerate(names)]
    )


def distinct_members(df: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    """Long form ``(key, field, value)``: one row per distinct non-NULL member.

    This form has no cell size limit; use it when a single set may be huge.
    """
    names = F.array(*[F.lit(name) for name in values])
    position = F.col("field") if len(values) > 1 else F.lit(0)
    return _members(df, key, values, nulls=False).select(key, names[position].alias("field"), "value")


def distinct_arrays(df: DataFrame, key: str, values: Mapping[str, Column], keep_empty: bool = False) -> DataFrame:
    """One row per key with a sorted array of distinct members per field.

    Keys whose members are all NULL have no row; a left join turns that into a
    NULL array, which renders as the empty text. With ``keep_empty`` they have
    empty arrays.
    """
    return _gathered(_members(df, key, values, nulls=keep_empty), key, list(values))


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def hot_buckets(df: DataFrame, key: str, most: int) -> DataFrame:
    """The buckets of keys with very many rows, to be broadcast.

    A key that has more than ``most`` rows and more than their :data:`HOT_SHARE`
    lies in one. What is counted is a number per bucket and task, whatever the keys.
    """
    counts = df.groupBy(_bucket(F.col(key)).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    whole = counts.agg(F.sum("_n").alias("_all"), F.collect_list(F.struct("_bucket", "_n")).alias("_counts"))
    bound = F.greatest(F.lit(most), F.col("_all") / F.lit(HOT_SHARE))
    return whole.select(F.inline(F.filter("_counts", lambda x: x["_n"] > bound))).select("_bucket")


def split_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows outside and inside the given buckets; without hot buckets AQE plans the first only."""
    hot = F.broadcast(hot)
    inside = _bucket(df[key]) == hot["_bucket"]
    return df.join(hot, inside, "left_anti"), df.join(hot, inside, "left_semi")


def arrays_by_key(df: DataFrame, key: str, values: Mapping[str, Column], hot: DataFrame) -> DataFrame:
    """:func:`distinct_arrays` with one shuffle: members are combined by key on the map side.

    Keys in the buckets ``hot`` go the way of :func:`distinct_arrays`, spread by their members.
    """
    rows = df.select(F.col(key), *[c.cast("string").alias(name) for name, c in values.items()])
    rows = rows.where(F.col(key).isNotNull() & F.coalesce(*[F.col(name) for name in values]).isNotNull())
    few, many = split_hot(rows, key, hot)
    sets = few.groupBy(key).agg(*[F.sort_array(F.collect_set(name)).alias(name) for name in values])
    return sets.unionByName(distinct_arrays(many, key, {name: F.col(name) for name in values}))


def arrays_beside(
    df: DataFrame, key: str, also: Sequence[str], values: Mapping[str, Column], kept: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """:func:`distinct_arrays_beside` with one shuffle: the rows go to their key as they are, those of hot keys being left out."""
    rows = kept(df.select(F.col(key), *also, *[c.cast("string").alias(name) for name, c in values.items()]))
    return rows.repartition(key).groupBy(key, *also).agg(*[F.sort_array(F.collect_set(name)).alias(name) for name in values])


def distinct_arrays_beside(
    df: DataFrame, key: str, also: Sequence[str], values: Mapping[str, Column], kept: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """:func:`distinct_arrays` per key and further columns, all rows of a key lying together, empty arrays kept.

    ``kept`` filters the distinct members before they are gathered by ``key``:
    keys with very many rows have to go there.
    """
    members = kept(_members(df, key, values, nulls=True, also=also))
    return _gathered(members, key, list(values), also)


def own_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur, once each: a set of nothing but its own key needs no gathering."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def chunked_sets(df: DataFrame, key: str, values: Mapping[str, Column], cell: int = 1000) -> DataFrame:
    """``key, field, chunk, members``: each set in numbered cells of at most ``cell`` sorted members.

    The cells of a key and field, by number, put together are the array of
    :func:`distinct_arrays`. Members are range-cut by key and value, so a key
    that owns a third of them is spread over the tasks before and after; keys
    without members have no cell.
    """
    spark = df.sparkSession
    members = distinct_members(df, key, values).withColumnRenamed(key, "_key")
    order = ["_key", "field", "value"]
    path = scratch_path(spark, "chunks")
    placed = members.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)  # where a member lies must not change between counting and cutting
    rows = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_at", 33))
    # Runs of one key and field in one partition; narrow, one row per run.
    run = ["_key", "field", "_part"]
    runs = rows.groupBy(*run).agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).alias("_cells"))
    before = Window.partitionBy("_key", "field").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*run, F.coalesce(F.sum("_cells").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*run).orderBy("_at")) - 1
    numbered = rows.join(runs, run).withColumn("chunk", (F.col("_start") + F.floor(inside / cell) + 1).cast("long"))
    cells = numbered.groupBy(*run, "chunk").agg(F.array_sort(F.collect_list("value")).alias("members"))
    return cells.select(F.col("_key").alias(key), "field", "chunk", "members")


def joined_below(chunks: DataFrame, key: str, most: int, separator: str = SEPARATOR) -> DataFrame:
    """``key, field, n, text`` of :func:`chunked_sets`: joined text of sets with at most ``most`` members, else NULL.

    Larger sets are counted and never brought together.
    """
    counts = chunks.groupBy(key, "field").agg(F.sum(F.size("members")).alias("n"))
    small = counts.where(F.col("n") <= most).select(F.col(key).alias("_key"), F.col("field").alias("_field"))
    few = chunks.join(small, (F.col(key) == F.col("_key")) & (F.col("field") == F.col("_field"))).drop("_key", "_field")
    whole = few.groupBy(key, "field").agg(F.sort_array(F.collect_list(F.struct("chunk", "members"))).alias("cells"))
    texts = whole.select(F.col(key).alias("_key"), F.col("field").alias("_field"), F.array_join(F.flatten(F.col("cells")["members"]), separator).alias("text"))
    joined = counts.join(texts, (F.col(key) == F.col("_key")) & (F.col("field") == F.col("_field")), "left")
    return joined.select(key, "field", F.col("n").cast("long"), "text")


def stored_arrays(df: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    """:func:`distinct_arrays` of a table that lies by ``key``: one grouping where the rows are, no shuffle.

    A key's members already lie in one bucket, so a key with very many of them
    is one task's, as its cell would be in any case.
    """
    texts = [c.cast("string").alias(name) for name, c in values.items()]
    rows = df.select(key, *texts).where(F.col(key).isNotNull() & F.coalesce(*values).isNotNull())
    return rows.groupBy(key).agg(*[F.sort_array(F.collect_set(name)).alias(name) for name in values])


def distinct_join(df: DataFrame, key: str, values: Mapping[str, Column], separator: str = SEPARATOR) -> DataFrame:
    """Every key of ``df`` with its sets as joined text, empty text for empty sets."""
    arrays = distinct_arrays(df, key, values, keep_empty=True)
    return arrays.select(key, *[join_values(F.col(f"`{name}`"), separator).alias(name) for name in values])
