"""Any page of a large table as a key range.

A directory holds the order columns of every ``stride``-th row of a table in a
total order. A page then lies between two of its entries, so it is a filter on
the order columns, which reaches the scan, and a small top-n inside that range.
Only the order columns are sorted to build the directory; the table is neither
copied nor numbered, and one directory serves every page size.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from recordflow.session import drop_scratch, scratch_path

STRIDE = 10_000
POS = "_pos"


@dataclass(frozen=True)
class By:
    """One column of the order; NULL is lowest, as in Spark's own order."""

    column: str
    descending: bool = False

    def sort(self) -> Column:
        return F.desc(self.column) if self.descending else F.asc(self.column)


@dataclass(frozen=True)
class PageDirectory:
    """Entries ``_pos`` (from 0) and the order columns, stored below ``path``."""

    spark: SparkSession
    path: str
    order: tuple[By, ...]
    stride: int
    rows: int

    def pages(self, size: int) -> int:
        return -(-self.rows // size)

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/entries")

    def range_of(self, size: int, number: int) -> tuple[dict | None, dict | None, int]:
        """The entry at or before the page's first row, the one after its last, and the rows to skip after the first."""
        first = (number - 1) * size
        low = first // self.stride * self.stride
        high = (first + size + self.stride - 1) // self.stride * self.stride
        found = {r[POS]: r.asDict() for r in self.entries().where(F.col(POS).isin(low, high)).collect()}  # two rows at most
        return found.get(low), found.get(high), first - low

    def page(self, df: DataFrame, size: int, number: int) -> DataFrame:
        """Page ``number`` (from 1) of the table that the directory was built for."""
        if size < 1 or number < 1:
            raise ValueError("pages are numbered from 1 and hold a row at least")
        low, high, skip = self.range_of(size, number)
        if low is None:  # beyond the end
            return df.limit(0)
        inside = df.where(_from(self.order, low))
        if high is not None:
            inside = inside.where(~_from(self.order, high) | _same(self.order, high))
        # Rows equal to the entry in all order columns may stand before it.
        return inside.orderBy(*[by.sort() for by in self.order]).offset(skip + low["_before"]).limit(size)


def _after(by: By, value) -> Column:
    """Strictly behind a value in the order of one column."""
    c = F.col(by.column)
    if by.descending:
        return F.lit(False) if value is None else (c < F.lit(value)) | c.isNull()
    return c.isNotNull() if value is None else c > F.lit(value)


def _same(order: Sequence[By], entry: dict) -> Column:
    out = F.lit(True)
    for by in order:
        out &= F.col(by.column).eqNullSafe(F.lit(entry[by.column]))
    return out


def _from(order: Sequence[By], entry: dict) -> Column:
    """At or behind an entry. The bound on the first column is said again alone, so that the scan can use it."""
    behind = F.lit(True)
    for by in reversed(order):
        value = entry[by.column]
        behind = F.coalesce(_after(by, value), F.lit(False)) | (F.col(by.column).eqNullSafe(F.lit(value)) & behind)
    lead, value = order[0], entry[order[0].column]
    if value is None:
        return behind
    c = F.col(lead.column)
    return ((c <= F.lit(value)) | c.isNull() if lead.descending else c >= F.lit(value)) & behind


def build_page_directory(df: DataFrame, path: str, order: Sequence[By | str], stride: int = STRIDE) -> PageDirectory:
    """Sort the order columns of ``df`` once and store every ``stride``-th row of them below ``path``.

    Rows that are equal in all order columns have no order among them; a page
    that begins between such rows takes as many of them as are left, which is a
    true page if the order is total. The directory describes the table as it is:
    build it again when the table changes.
    """
    spark = df.sparkSession
    order = tuple(by if isinstance(by, By) else By(by) for by in order)
    names = [by.column for by in order]
    staged = scratch_path(spark, "directory")
    keys = df.select(*names)
    # Sorted rows are numbered where they lie: the id holds the partition above bit 33.
    keys.orderBy(*[by.sort() for by in order]).withColumn("_at", F.monotonically_increasing_id()).write.parquet(staged)
    stored = spark.read.schema(keys.schema.add("_at", T.LongType())).parquet(staged)
    rows = stored.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per shuffle partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = rows.join(F.broadcast(starts), "_part").withColumn(POS, F.col("_start") + F.col("_at"))
    marks = placed.where(F.col(POS) % stride == 0).select(POS, *names)
    # Equal rows before an entry, counted for entries whose columns occur more than once.
    ties = placed.groupBy(*names).agg(F.count(F.lit(1)).alias("_ties"), F.min(POS).alias("_first")).where("_ties > 1")
    match = F.lit(True)
    for name in names:
        match &= marks[name].eqNullSafe(ties[name])
    entries = marks.join(ties, match, "left").select(
        marks[POS], *[marks[n] for n in names], F.coalesce(marks[POS] - F.col("_first"), F.lit(0)).alias("_before")
    )
    entries.orderBy(POS).write.parquet(f"{path}/entries")
    count = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    head = {"order": [[by.column, by.descending] for by in order], "stride": stride, "rows": count}
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/head")
    drop_scratch(spark, staged)
    return open_page_directory(spark, path)


def open_page_directory(spark: SparkSession, path: str) -> PageDirectory:
    head = json.loads(spark.read.text(f"{path}/head").first()["value"])
    return PageDirectory(spark, path, tuple(By(*by) for by in head["order"]), head["stride"], head["rows"])
