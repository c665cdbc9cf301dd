"""Data sets that are replaced while others read them.

A write goes to a folder of its own and becomes the current version by one small
step at its end, the creation of an empty marker named after it. A reader takes
the newest marker: before that step it sees the old version whole, after it the
new one. A writer that dies leaves a folder without a marker, which nobody
reads. Markers are only ever added, so no store needs an atomic replacement,
and two writers at once end with one of their versions, never a mixture.

``<path>/data/<number>.<id>``      the rows of a version
``<path>/versions/<number>.<id>``  its marker
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordflow.sinks.delimited import write_records_csv

Writer = Callable[[DataFrame, str], None]


def _store(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, path: str) -> list[str]:
    store, found = _store(spark, path)
    return sorted(x.getPath().getName() for x in store.listStatus(found)) if store.exists(found) else []


def _number(name: str) -> int:
    return int(name.split(".")[0])


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    return [n for n in _names(spark, f"{path}/versions") if not n.startswith((".", "_"))]


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of the current version are; an error if there is none yet."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"{path} has no complete version")
    return f"{path}/data/{found[-1]}"


def write_version(df: DataFrame, path: str, write: Writer = write_records_csv, number: int | None = None) -> str:
    """Write ``df`` as the next version and make it current; returns its path.

    ``number`` names the version for a step that may be repeated, as a batch of
    a stream: a repetition replaces its own version only.
    """
    spark = df.sparkSession
    if number is None:
        known = [*versions(spark, path), *_names(spark, f"{path}/data")]
        number = max(map(_number, known), default=-1) + 1
    name = f"{number:012d}.{uuid.uuid4().hex}"
    write(df, f"{path}/data/{name}")
    store, marker = _store(spark, f"{path}/versions/{name}")
    store.create(marker, False).close()
    return f"{path}/data/{name}"


def as_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the ``keep`` newest versions, and older folders that no writer finished; returns the names.

    A reader may still be at work on a version that has just been replaced, so
    keep two at least. Markers go first: what is half removed is not listed.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    kept = versions(spark, path)[-keep:]
    if not kept:
        return []
    gone = [n for n in _names(spark, f"{path}/data") if n not in kept and _number(n) < _number(kept[0])]
    gone += [n for n in versions(spark, path)[:-keep] if n not in gone]
    for folder in ("versions", "data"):
        for name in gone:
            store, found = _store(spark, f"{path}/{folder}/{name}")
            store.delete(found, True)
    return gone
