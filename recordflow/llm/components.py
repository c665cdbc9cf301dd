"""Distributed connected components with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import Stages

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, stages: Stages) -> DataFrame:
    """``(node, component)`` for every node of ``edges(src, dst)``; the component is its smallest node.

    Alternating large and small stars: each round links neighbours to the
    smallest neighbour, which ends in one star per component after a
    logarithmic number of rounds. Minima are pre-aggregated before the shuffle
    and a node with very many edges is one side of a plain join, whose hot
    partitions the adaptive planner splits. Every round is a staged table, so a
    lost executor costs one round at most. Nulls and self-links are ignored; an
    empty table gives an empty result.
    """
    known = edges.where("src IS NOT NULL AND dst IS NOT NULL")
    pair = known.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    pair = pair.where("u != v")
    current = stages.write(pair.distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _is_star(current):
            roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        following = stages.write(_small_star(_large_star(current)), "edges")
        stages.drop(current)
        current = following
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _is_star(pairs: DataFrame) -> bool:
    """Does every node have one parent at most, and no parent a parent?"""
    roles = pairs.select(
        F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("child")), F.struct(F.col("v").alias("n"), F.lit(0).alias("child")))).alias("r")
    ).select("r.n", "r.child")
    per_node = roles.groupBy("n").agg(F.sum("child").alias("parents"), F.min("child").alias("least"))
    return per_node.where("parents > 1 OR (parents = 1 AND least = 0)").isEmpty()


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
