"""Shared helpers: staged tables, size-checked broadcasts, text columns in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.session import drop_scratch, package_on_workers as on_workers, scratch_path

#: A side is broadcast only if its measured size is below this; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20


class Stages:
    """Tables written in the shared folder to cut lineage; ``drop`` removes one that nothing reads any more."""

    #: Written and not dropped yet, oldest first: (owner, path). One entry per staged table of this driver.
    written: list[tuple["Stages", str]] = []

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}
        on_workers(spark)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = (table, path)
        Stages.written.append((self, path))
        return table

    def drop(self, table: DataFrame) -> None:
        _, path = self.paths.pop(id(table))
        Stages.written.remove((self, path))
        drop_scratch(self.spark, path)

    def drop_others(self, since: int) -> None:
        """Remove what operators have staged since ``len(Stages.written)`` was ``since``, once their result is stored here."""
        for owner, path in Stages.written[since:]:
            if owner is not self:
                Stages.written.remove((owner, path))
                drop_scratch(self.spark, path)


def bounded(df: DataFrame, measured_bytes: int | None) -> DataFrame:
    """``df`` marked for broadcast if its measured size allows it, else as it is."""
    return F.broadcast(df) if (measured_bytes or 0) <= BROADCAST_BYTES else df


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(batches: Iterable[pa.RecordBatch], schema: pa.Schema, build, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Batches of ``size`` rows from the tuples that ``build(batch)`` yields."""
    pending = []
    for batch in batches:
        for row in build(batch):
            pending.append(row)
            if len(pending) >= size:
                yield as_batch(pending, schema)
                pending = []
    if pending:
        yield as_batch(pending, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def groups(batches: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows of equal ``key``, for input sorted by it inside the partition."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in key)))
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                if held and held_key != keys[start]:
                    yield held_key, pa.Table.from_batches(held)
                    held = []
                held_key = keys[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield held_key, pa.Table.from_batches(held)
