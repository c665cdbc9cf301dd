"""The left joins of the extract, each shaped so that no task gets a hot group.

No side is force-broadcast: Spark broadcasts a lookup when its size estimate
(or, under AQE, its measured size) is below ``autoBroadcastJoinThreshold`` and
otherwise shuffles, where AQE splits skewed partitions of the left side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.operators.sets import distinct_arrays


def lookup_join(df: DataFrame, lookup: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """N:1 left join; duplicate lookup keys fan out as in SQL."""
    key = key or on
    return df.join(lookup, df[on] == lookup[key], "left").drop(*([lookup[key]] if key == on else []))


def left_join_rows(df: DataFrame, child: DataFrame, on: str, key: str) -> DataFrame:
    """1:N left join as rows, for a child table that may have a hot key.

    AQE can split the many side of an inner join but not the right side of a
    left join, so matches come from an inner join and the rows without a match
    are added. ``key`` is not part of the result.
    """
    child = child.withColumnRenamed(key, "_child_key").where(F.col("_child_key").isNotNull())
    keys = child.select("_child_key").distinct()
    matched = df.join(child, df[on] == child["_child_key"]).drop("_child_key")
    unmatched = df.join(keys, df[on] == keys["_child_key"], "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def child_sets(
    df: DataFrame, child: DataFrame, on: str, key: str, values: Mapping[str, Column]
) -> DataFrame:
    """1:N left join as sets: children are aggregated first, then joined 1:1.

    Joining several child tables this way costs the sum of their sizes, where
    joining first and grouping later costs the product per record.

    A key that very many records share is split by AQE, which needs a plain
    shuffle on both sides of the join: the sets get one of their own, as the
    aggregate's would not do.
    """
    return _with_sets(df, on, _sets(child, key, values))


def _sets(child: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    named = child.select(F.col(key).alias("_key"), *[c.alias(name) for name, c in values.items()])
    sets = distinct_arrays(named, "_key", {name: F.col(name) for name in values})
    # A new column: it hides from the planner that the sets lie by key already.
    return sets.select(F.when(F.col("_key").isNotNull(), F.col("_key")).alias("_set_key"), *values)


def _with_sets(df: DataFrame, on: str, *pieces: DataFrame) -> DataFrame:
    """Sets of several children meet each other first, one row per key, and the records in one join.

    A second join on the same key above it would keep AQE from splitting.
    """
    sets, *others = pieces
    for other in others:
        other = other.withColumnRenamed("_set_key", "_other_key")
        sets = sets.join(other, sets["_set_key"] == other["_other_key"], "full")
        sets = sets.withColumn("_set_key", F.coalesce("_set_key", "_other_key")).drop("_other_key")
    return df.join(sets, df[on] == sets["_set_key"], "left").drop("_set_key")


def bridge_sets(
    df: DataFrame,
    bridge: DataFrame,
    target: DataFrame,
    on: str,
    key: str,
    target_key: str,
    values: Mapping[str, Column],
) -> DataFrame:
    """N:M left join as sets: bridge to target, aggregate per key, join 1:1.

    The bridge is made distinct on its two ids before it meets the target.
    """
    links = bridge.select(key, target_key).distinct()
    return child_sets(df, links.join(target, target_key), on, key, values)


def association_sets(df: DataFrame, pairs: DataFrame, on: str, first: str, second: str) -> DataFrame:
    """Both directions of a self-association, emitting the record's own id.

    The matched side equals the join column, so a cell is the own id or empty.
    """
    return _with_sets(df, on, *(_sets(pairs, side, {side: F.col(side)}) for side in (first, second)))


def association_partners(
    df: DataFrame, pairs: DataFrame, on: str, first: str, second: str, names: tuple[str, str]
) -> DataFrame:
    """Both directions of a self-association, emitting the ids on the other side."""
    as_first, as_second = _sets(pairs, first, {names[0]: F.col(second)}), _sets(pairs, second, {names[1]: F.col(first)})
    return _with_sets(df, on, as_first, as_second)


def link_pairs(df: DataFrame, record_key: str, link: str, unique: bool = False) -> DataFrame:
    """Distinct ``(_record, _link)`` ids of all records that have a link.

    Tables reached through the link are joined to these two ids and the result
    goes back by record with :func:`attach_resolved`. Records without a link
    (often most of them) never enter that join, so NULLs cannot pile up in one
    task, and a link shared by very many records costs two numbers per record;
    AQE can split such a partition because the result is shuffled by record.
    ``unique`` states that the record key has no duplicates.
    """
    pairs = df.select(F.col(record_key).alias("_record"), F.col(link).alias("_link"))
    pairs = pairs.where(F.col("_link").isNotNull())
    return pairs if unique else pairs.distinct()


def attach_resolved(df: DataFrame, record_key: str, link: str, branch: DataFrame) -> DataFrame:
    """Left join resolved pairs to their records, partitioned by record only.

    The link comparison is a residual condition on purpose: as a second join
    key it would force a new shuffle of the wide side for every link.
    """
    same_link = F.coalesce(df[link] == branch["_link"], F.lit(False))
    return df.join(branch, (df[record_key] == branch["_record"]) & same_link, "left").drop("_record", "_link")
