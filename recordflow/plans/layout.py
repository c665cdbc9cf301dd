"""The tables of an extract stored by their link keys.

The extract shuffles every child and descriptor table by the key that links it,
on each run. :func:`write_layout` pays for these shuffles once: it stores the
base by record, descriptors by their key and the distinct rows of child tables
by the key of their parent, in buckets (``bucketBy``/``sortBy``). Tables linked by
one key have equal buckets, so they meet where they lie:

* sets of children need no exchange, nor the joins of child sets with their
  parent, nor the merging of equal descriptor rows;
* an N:M link is stored with its target's columns, so the bridge is joined once;
* pairs of record and link are still shuffled, on both sides, because a link
  that very many records share must be split at run time.

Only tables that the extract uses are stored, and of these only its columns.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recordflow.plans.wide import Bridge, Children, Descriptor, Link, Lookup, Tables, WideSpec, _Plan

#: Part of table names in the session's catalog; the data lies below the layout's path.
PREFIX = "layout"
#: Records for which a layout has one bucket, if it has more of them than its fewest buckets take.
BUCKET_RECORDS = 100_000


@dataclass(frozen=True)
class Layout:
    """Stored tables and the spec that reads them: ``denormalize(layout.tables, layout.spec)``."""

    path: str
    tables: Tables
    spec: WideSpec
    names: tuple[str, ...]

    def forget(self, spark: SparkSession) -> None:
        """Take the names out of the session's catalog; the stored tables stay."""
        for name in self.names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _columns(plan: _Plan, link: Link) -> list[str]:
    """The columns of a linked table that reach the output or lead on."""
    members = [f.sources[0].split(".")[1] for f in plan.sets[link.alias]]
    return list(dict.fromkeys([link.key, *plan.output[link.alias], *plan.link_columns(link.alias), *members]))


def _rows(tables: Tables, plan: _Plan, link: Link) -> DataFrame:
    wanted = _columns(plan, link)
    if not isinstance(link, Bridge):
        rows = tables[link.table].select(*wanted)
    else:
        # As in the extract: distinct links, then the target's columns; a link without target keeps NULLs.
        links = tables[link.table].select(link.key, link.target_key).distinct()
        own = [c for c in wanted if c != link.key]
        target = tables[link.target].select(F.col(link.target_key).alias("_target"), *[F.col(c).alias(f"_{c}") for c in own])
        joined = links.join(target, links[link.target_key] == target["_target"], "left")
        rows = joined.select(link.key, *[F.col(f"_{c}").alias(c) for c in own])
    rows = rows.where(F.col(link.key).isNotNull())
    return rows.distinct() if isinstance(link, Children) else rows


def _used(spec: WideSpec, tables: Tables) -> tuple[_Plan, list[Link]]:
    plan = _Plan(tables, spec, merge_equal=True, expand=None)
    reached, todo = [], [spec.alias]
    while todo:
        found = plan.links_of(todo.pop(), Link)
        reached += found
        todo += [link.alias for link in found]
    return plan, reached


def _stored_spec(spec: WideSpec, links: list[Link]) -> WideSpec:
    """The spec over stored tables: each is named by its alias, a bridge is a child table."""
    def stored(link: Link) -> Link:
        if isinstance(link, Children):
            return Children(link.alias, link.alias, link.parent, link.on, link.key, link.unique, stored=True)
        return replace(link, table=link.alias, stored=isinstance(link, Descriptor))

    return replace(spec, table=spec.alias, links=tuple(stored(link) for link in links))


def write_layout(tables: Tables, spec: WideSpec, path: str, buckets: int = 32) -> Layout:
    """Store the tables of ``spec`` below ``path``, which must not exist.

    Tables have ``buckets`` buckets or, if that is more, one for every
    :data:`BUCKET_RECORDS` records of the base, so that a bucket stays as large
    as a task can take while the tables grow. A bucket is one file, sorted by its key.
    """
    plan, links = _used(spec, tables)
    spark = tables[spec.table].sparkSession
    buckets = max(buckets, -(-tables[spec.table].count() // BUCKET_RECORDS))
    wanted = list(dict.fromkeys([spec.key, *plan.output[spec.alias], *plan.link_columns(spec.alias)]))
    # Records are filtered before they are stored: the filter may need columns that the extract does not show.
    records = tables[spec.table] if spec.where is None else spec.where(tables[spec.table])
    frames = {spec.alias: (records.select(*wanted), spec.key)}
    frames |= {link.alias: (_rows(tables, plan, link), None if isinstance(link, Lookup) else link.key) for link in links}
    entries = []
    for alias, (rows, key) in frames.items():
        place = f"{path}/{alias}"
        if key is None:
            rows.write.parquet(place)
        else:
            name = f"{PREFIX}_{uuid.uuid4().hex}"
            rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", place).saveAsTable(name, format="parquet")
            spark.sql(f"DROP TABLE {name}")
        entries.append({"alias": alias, "key": key, "buckets": buckets, "schema": rows.schema.json()})
    spark.createDataFrame([(json.dumps(entries),)], "value string").coalesce(1).write.text(f"{path}/layout")
    return open_layout(spark, spec, path)


def open_layout(spark: SparkSession, spec: WideSpec, path: str) -> Layout:
    """The stored tables of ``spec``, also in a later session; the base's filter has been applied when they were stored."""
    frames, names = {}, []
    for entry in json.loads(spark.read.text(f"{path}/layout").first()["value"]):
        place, schema = f"{path}/{entry['alias']}", T.StructType.fromJson(json.loads(entry["schema"]))
        if entry["key"] is None:
            frames[entry["alias"]] = spark.read.schema(schema).parquet(place)
            continue
        name = f"{PREFIX}_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{entry['key']}`) SORTED BY (`{entry['key']}`)"
            f" INTO {entry['buckets']} BUCKETS LOCATION '{place}'"
        )
        frames[entry["alias"]] = spark.table(name)
        names.append(name)
    links = [link for link in spec.links if link.alias in frames]
    return Layout(path, frames, replace(_stored_spec(spec, links), where=None), tuple(names))
