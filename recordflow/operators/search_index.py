"""A stored index for the searches of :mod:`recordflow.operators.search`.

Three tables stand beside a copy of the records, each partitioned by a hash of
its token, so that a term opens one directory and not the whole table:

=========== ============================ ==================================
``members`` ``token, _row``              members of the cells, and the ids
``grams``   ``gram, _chunk, n, places``  every three letters of cell and id
``counts``  ``gram, n``                  records per gram
=========== ============================ ==================================

A search reads the few postings of its term, then the blocks of the records
that they name, and asks the same question of these rows as a scan would of
all. The index may therefore name too many rows and never too few, and every
result equals the scan's. A term without anything to look up (fewer than three
letters inside a text, a pattern with groups) is answered by the scan itself.

Postings of members are range-partitioned by token and row before they are
written: a token that a third of all records hold is spread over many tasks and
files. A record has ten times as many grams as members, and most of them stand in
the records beside it too. So the task that reads some records already makes one
list of each gram: the places of its records within their chunk of row ids. These
lists, and no single postings, are dealt to the directories and sorted there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordflow.functions.multivalue import SEPARATOR
from recordflow.functions.text import search_key
from recordflow.operators.search import (
    contains_condition, exact_condition, is_number, lookup_condition,
)
from recordflow.session import package_on_workers

ROW, BLOCK, BUCKET, CHUNK = "_row", "_block", "_bucket", "_chunk"
#: Letters of a gram, and how many of a term's grams are looked up, the rarest ones.
GRAM, RAREST = 3, 3
#: Row ids of a chunk, in bits: a place in it is a short number.
CHUNK_BITS = 13
#: Letters that are taken together when grams are listed; a longer text is taken alone.
LETTERS = 500_000
#: How the tables are stored: 1 had a row for every record of a gram.
FORM = 2
_LISTS = "gram string, _chunk long, n int, places array<short>"


@dataclass(frozen=True)
class _Layout:
    id_column: str
    name_column: str
    separator: str
    buckets: int
    schema: str
    form: int = 1


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def _block(row: Column, buckets: int) -> Column:
    """The directory of a row: ids made while writing hold the writing task above bit 33."""
    return F.pmod(F.shiftright(row, 33), F.lit(buckets)).cast("int")


def _pieces(cell: Column, separator: str) -> Column:
    """Runs of characters that no separator contains.

    A term without such characters that stands between two separators is one of
    these runs, however the separators around it overlap.
    """
    marks = re.sub(r"(\W)", r"\\\1", "".join(sorted(set(separator))))
    return F.split(cell, marks if len(set(separator)) == 1 else f"[{marks}]")  # one mark is split at without a regular expression


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted; ``np.unique`` would hash them, which takes ten times as long."""
    numbers = np.sort(numbers)
    return numbers[np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)]]


def _gram_lists(rows: np.ndarray, texts: list[str]) -> pa.RecordBatch:
    """One list per gram and chunk of some records; their texts come once or more in the order of ``rows``."""
    ids, record = np.unique(rows, return_inverse=True)
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    # A code point has 21 bits, so a gram is one number.
    starts = np.flatnonzero(text[: 1 - GRAM] == text[GRAM - 1 :])
    keys = letters[starts] << 42 | letters[starts + 1] << 21 | letters[starts + 2]
    grams = _distinct(keys)
    # Distinct (gram, record), sorted by gram and row id.
    found = _distinct(np.searchsorted(grams, keys) * len(ids) + record[text[starts] % len(rows)])
    gram, row = found // len(ids), ids[found % len(ids)]
    chunk = row >> CHUNK_BITS
    first = np.flatnonzero(np.append(True, (np.diff(gram) != 0) | (np.diff(chunk) != 0))[: len(found)])
    ends = np.r_[first, len(found)].astype(np.int32)
    spelled = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], 1).astype("<u4").tobytes().decode("utf-32-le")
    named = [spelled[GRAM * i : GRAM * (i + 1)] for i in gram[first].tolist()]
    places = pa.ListArray.from_arrays(ends, (row & ((1 << CHUNK_BITS) - 1)).astype(np.int16))
    return pa.RecordBatch.from_arrays(
        [pa.array(named, pa.string()), pa.array(chunk[first]), pa.array(np.diff(ends)), places], ["gram", CHUNK, "n", "places"]
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram lists of batches of ``(_row, text, ...)``, so many records at a time that their texts have a bounded length."""
    for batch in batches:
        rows, texts = batch.column(0).to_numpy(), [c.to_pylist() for c in batch.columns[1:]]
        total = np.cumsum([sum(map(len, x)) for x in zip(*texts)])
        low = 0
        while low < len(rows):
            before = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, before + LETTERS, "right")))
            yield _gram_lists(rows[low:high], [x for c in texts for x in c[low:high]])
            low = high


def _write_postings(rows: DataFrame, token: str, buckets: int, path: str) -> None:
    rows = rows.withColumn(BUCKET, _bucket(F.col(token), buckets))
    order = [BUCKET, token, *([ROW] if ROW in rows.columns else [])]
    # Ranges of a given number are not merged again, so that a hot token stays cut.
    ranges = [int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))] if ROW in rows.columns else []
    rows.repartitionByRange(*ranges, *order).sortWithinPartitions(*order).write.partitionBy(BUCKET).parquet(path)


def build_search_index(
    df: DataFrame, path: str, id_column: str, name_column: str, separator: str = SEPARATOR, buckets: int = 64
) -> SearchIndex:
    """Store ``df`` and its index below ``path``, which must not exist, and open it.

    Rows may be equal, ids may repeat or be NULL. ``buckets`` is the number of
    directories per table; a term reads one of them.
    """
    taken = {ROW, BLOCK, BUCKET} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are used by the index")
    spark = df.sparkSession
    layout = _Layout(id_column, name_column, separator, buckets, df.schema.json(), FORM)
    # The row id is settled by writing it; everything else refers to the stored rows.
    numbered = df.withColumn(ROW, F.monotonically_increasing_id())
    numbered.withColumn(BLOCK, _block(F.col(ROW), buckets)).write.partitionBy(BLOCK).parquet(f"{path}/records")
    index = SearchIndex(spark, path, layout)
    ident, names = search_key(F.col(id_column)), search_key(F.col(name_column))
    tokens = F.array_distinct(F.concat(_pieces(names, separator), F.array(ident)))
    members = index.stored().select(F.explode(tokens).alias("token"), ROW).where("token != ''")
    _write_postings(members, "token", buckets, f"{path}/members")
    package_on_workers(spark)
    keys = index.stored().select(ROW, F.make_valid_utf8(names).alias("names"), F.make_valid_utf8(ident).alias("id"))
    lists = keys.mapInArrow(_listed, _LISTS).withColumn(BUCKET, _bucket(F.col("gram"), buckets))
    # Dealt without a sample, which would make the lists twice; AQE cuts a directory that is too large for one task.
    dealt = lists.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "gram", CHUNK)
    dealt.write.partitionBy(BUCKET).parquet(f"{path}/grams")
    counts = index.gram_lists().groupBy("gram").agg(F.sum("n").alias("n"))
    _write_postings(counts, "gram", buckets, f"{path}/counts")
    # Written last: an index without it is not complete and cannot be opened.
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.text(f"{path}/layout")
    return index


def open_search_index(spark: SparkSession, path: str) -> SearchIndex:
    """An index stored by an earlier session."""
    layout = _Layout(**json.loads(spark.read.text(f"{path}/layout").first()["value"]))
    if layout.form != FORM:
        raise ValueError(f"the index is stored in form {layout.form}, not {FORM}: build it again")
    return SearchIndex(spark, path, layout)


@dataclass(frozen=True)
class SearchIndex:
    """The searches over stored records; each returns rows with the columns of the indexed frame."""

    spark: SparkSession
    path: str
    layout: _Layout

    # -- tables -----------------------------------------------------------

    def stored(self) -> DataFrame:
        """The records with their row ids and blocks."""
        schema = T.StructType.fromJson(json.loads(self.layout.schema))
        return self.spark.read.schema(schema.add(ROW, T.LongType()).add(BLOCK, T.IntegerType())).parquet(f"{self.path}/records")

    def records(self) -> DataFrame:
        return self.stored().drop(ROW, BLOCK)

    def gram_lists(self) -> DataFrame:
        """The grams as stored: the number of records that hold them in a chunk, and their places there."""
        return self.spark.read.schema(f"{_LISTS}, {BUCKET} int").parquet(f"{self.path}/grams")

    def postings(self, table: str, token: str) -> DataFrame:
        if table == "grams":
            place = self.gram_lists().select("gram", CHUNK, F.explode("places").alias("place"), BUCKET)
            return place.select("gram", (F.shiftleft(CHUNK, CHUNK_BITS) + F.col("place")).alias(ROW), BUCKET)
        last = "n" if table == "counts" else ROW
        return self.spark.read.schema(f"{token} string, {last} long, {BUCKET} int").parquet(f"{self.path}/{table}")

    def _holding(self, table: str, token: str, values: Sequence[str]) -> DataFrame:
        """The postings of some tokens; the filter on the bucket leaves their directories only."""
        buckets = [_bucket(F.lit(v), self.layout.buckets) for v in values]
        rows = self.postings(table, token).where(F.col(BUCKET).isin(buckets) if len(values) > 1 else F.col(BUCKET) == buckets[0])
        return rows.where(F.col(token).isin(list(values)))

    # -- candidates ---------------------------------------------------------

    def member_rows(self, token: str) -> DataFrame:
        """Row ids of records with this member or id."""
        return self._holding("members", "token", [token]).select(ROW)

    def gram_rows(self, texts: Sequence[str]) -> DataFrame | None:
        """Row ids of records that hold the rarest grams of all the texts; None if there is no gram."""
        grams = sorted({t[i : i + GRAM] for t in texts for i in range(len(t) - GRAM + 1)})
        if not grams:
            return None
        known = {r["gram"]: r["n"] for r in self._holding("counts", "gram", grams).collect()}  # a row per gram of the term
        if len(known) < len(grams):
            return self.spark.createDataFrame([], f"{ROW} long")
        rarest = sorted(grams, key=lambda g: (known[g], g))[:RAREST]
        found = self._holding("grams", "gram", rarest)
        if len(rarest) > 1:
            found = found.groupBy(ROW).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rarest))
        return found.select(ROW)

    def _fetch(self, rows: DataFrame | None, condition: Column) -> DataFrame:
        """Records of some row ids for which the condition holds; of all records if there are no ids to go by."""
        if rows is None:
            return self.records().where(condition)
        # As many numbers as the index has blocks, at most.
        blocks = [r[0] for r in rows.select(_block(F.col(ROW), self.layout.buckets)).distinct().collect()]
        if not blocks:
            return self.records().where(F.lit(False))
        found = self.stored().where(F.col(BLOCK).isin(blocks)).join(rows, ROW, "left_semi")
        return found.where(condition).drop(ROW, BLOCK)

    # -- searches -----------------------------------------------------------

    def exact(self, term: str) -> DataFrame:
        """As :func:`~recordflow.operators.search.search_exact`."""
        term, layout = term.strip().lower(), self.layout
        condition = exact_condition(term, layout.id_column, layout.name_column, layout.separator)
        if set(term) & set(layout.separator) or not term:
            return self._fetch(self.gram_rows([term]), condition)
        return self._fetch(self.member_rows(term), condition)

    def contains(self, term: str) -> DataFrame:
        """As :func:`~recordflow.operators.search.search_contains`."""
        term = term.strip().lower()
        return self._fetch(self.gram_rows([term]), contains_condition(term, self.layout.id_column, self.layout.name_column))

    def exact_or_partial(self, term: str, order: Sequence[str] | None = None, size: int | None = None) -> DataFrame:
        """As :func:`~recordflow.operators.search.search_exact_or_partial`; whether there are exact hits is asked at once."""
        if term.strip():
            exact = self.exact(term)
            if not exact.isEmpty():
                return exact
        return self._first(self.contains(term) if term.strip() else self.records(), order, size)

    def lookup(self, term: str, order: Sequence[str] | None = None, size: int | None = None) -> DataFrame:
        """As :func:`~recordflow.operators.search.lookup`."""
        condition = lookup_condition(self.records(), term, self.layout.id_column, self.layout.name_column)
        rows = self.member_rows(term) if is_number(term) else self.gram_rows(required_texts(term))
        return self._first(self._fetch(rows, condition), order, size)

    def _first(self, df: DataFrame, order: Sequence[str] | None, size: int | None) -> DataFrame:
        df = df.orderBy(*(order or [self.layout.id_column]))
        return df if size is None else df.limit(size)


def required_texts(pattern: str) -> list[str]:
    """Lower-case texts that every match of a regular expression holds; none if that is not plain to see.

    Only runs of ASCII characters without white space count: the keys are
    trimmed, and other letters may change in number with their case.
    """
    if re.search(r"[|()\[\]]|\\[^\WdDwWsSbBAzZ]", pattern):
        return []
    # Pieces: an escape, a repetition (with its lazy or possessive mark), or one character.
    found, run = [], ""
    for piece in re.findall(r"\\.|\{[^}]*\}[?+]?|[*+?][?+]?|.", pattern, re.DOTALL):
        if piece[0] in "*?{":
            found, run = [*found, run[:-1]], ""  # the character before may be absent
        elif piece[0] == "+" or piece in (".", "^", "$") or re.fullmatch(r"\\\w", piece) or piece.isspace() or not piece.isascii():
            found, run = [*found, run], ""
        else:
            run += piece[-1].lower()
    return [x for x in [*found, run] if len(x) >= GRAM]
