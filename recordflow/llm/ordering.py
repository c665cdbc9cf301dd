"""Positions in a total order, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from recordflow.llm.common import Stages, bounded

_INDEX = (1 << 33) - 1


def positions(df: DataFrame, group: list[str], order: list[Column], stages: Stages) -> DataFrame:
    """``df`` with ``pos`` (from 0, in ``order`` within ``group``) and ``n`` (rows of the group).

    Rows are range-partitioned by group, order and their place in the input, so
    that neither a hot group nor rows that are equal in everything come together
    in one task. The sorted rows are staged with their partition and place; the
    positions follow from one count per group and partition. A null is a group
    of its own. Internal columns: ``_tie``, ``_at``, ``_part``.
    """
    keys = [F.asc_nulls_first(g) for g in group] + order + [F.col("_tie")]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    # The id holds the partition above bit 33 and the row's place in it below.
    rows = stages.write(placed.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(_INDEX))
    # A group that spans k partitions has k rows here: partitions + groups in all.
    runs = rows.groupBy(*group, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    whole = W.partitionBy(*group)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = stages.write(runs.select(*group, "_part", (before - F.col("_from")).alias("_shift"), F.sum("_rows").over(whole).alias("n")), "runs")
    renamed = runs.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_p"), "_shift", "n")
    match = F.col("_part") == F.col("_p")
    for g in group:
        match &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = rows.join(bounded(renamed, runs.count() * 64), match)
    return joined.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_p", "_shift", *[f"_{g}" for g in group])
