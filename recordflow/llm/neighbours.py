"""Nearest neighbours by a block matrix join: int8 tiles bound the products, survivors are computed in double.

Vectors are gathered into blocks. Every query block meets every candidate block
once, as a row of a repartitioned table, streamed one candidate block at a time.
For each tile, int8 products and the vectors' quantisation residuals bound every
inner product from both sides; only pairs whose upper bound reaches the query's
current k-th best are recomputed in double precision and merged into its heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.llm.common import Stages

QUERY_BLOCK = 1024
BLOCK = 4096
#: Candidate blocks that one task streams for one query block.
BLOCKS_PER_TILE = 16
#: Rows that are gathered together: whole candidate blocks, and about one block of queries of every twentieth.
GATHERED = 5 * BLOCK


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, norms of the quantised rows, residual norms, norms of the rows."""
    # A scale may underflow to zero; the least number serves as well, since all components are few times it.
    scale = np.maximum(np.abs(x).max(axis=1) / 127, 5e-324)
    rows = np.rint(x / scale[:, None]).astype(np.int8)
    back = rows * scale[:, None]

    def norm(m: np.ndarray) -> np.ndarray:
        # What underflows in the squares is given back: half of the least number's root for each component.
        with np.errstate(over="ignore"):
            return np.sqrt((m * m).sum(axis=1)) + m.shape[1] * 1e-162

    return rows, scale, norm(back), norm(x - back), norm(x)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double, added in the order of the components."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(a.shape[1]):
            total += a[:, d] * b[:, d]
    return np.where(np.isnan(total), -np.inf, total)


class Tile:
    """The k best of each query over the candidate blocks seen so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.q, self.scale, self.norm_q, self.rest, self.norm = quantised(rows)
        # Sums of int8 products are exact in single precision up to 2^24.
        self.kind = np.float32 if rows.shape[1] * 127 * 127 < 1 << 24 else np.float64
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        c, scale, norm_c, rest, norm = quantised(rows)
        with np.errstate(over="ignore", invalid="ignore"):
            near = (self.q.astype(self.kind) @ c.astype(self.kind).T).astype(np.float64) * self.scale[:, None] * scale
            error = self.rest[:, None] * norm + self.norm_q[:, None] * rest + 1e-9 * self.norm[:, None] * norm
            upper, lower = near + error, near - error
        # Where components are so large that a bound is no number, the pair is recomputed.
        upper[~np.isfinite(upper)] = np.inf
        lower[~np.isfinite(lower)] = -np.inf
        upper[self.ids[:, None] == ids] = -np.inf
        floor = self.least
        distinct = len(np.unique(ids))
        if distinct == len(ids) > self.k:  # the k-th largest lower bound holds too, if ids do not repeat
            lower[upper == -np.inf] = -np.inf
            floor = np.maximum(floor, np.partition(lower, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        at, other = np.nonzero((upper >= floor[:, None]) & (upper > -np.inf))
        for start in range(0, len(at), 1 << 17):
            i, j = at[start : start + (1 << 17)], other[start : start + (1 << 17)]
            for q, vec, score in zip(i.tolist(), ids[j].tolist(), products(self.rows[i], rows[j]).tolist()):
                self.push(q, vec, score)

    def push(self, q: int, vec: int, score: float) -> None:
        heap, item = self.heaps[q], (score, -vec)
        if len(heap) == self.k and item <= heap[0]:
            return
        same = next((x for x in heap if x[1] == -vec), None)
        if same:  # a repeated row counts once
            if item > same:
                heap[heap.index(same)] = item
                heapq.heapify(heap)
        elif len(heap) < self.k:
            heapq.heappush(heap, item)
        else:
            heapq.heapreplace(heap, item)
        if len(heap) == self.k:
            self.least[q] = heap[0][0]

    def best(self) -> Iterator[tuple[int, int, float]]:
        for query, heap in zip(self.ids.tolist(), self.heaps):
            for score, vec in heap:
                yield query, -vec, score


_BLOCKS = "task long, number long, dim int, queries boolean, ids binary, vectors binary"


def vector_blocks(vectors: DataFrame, query_every: int) -> DataFrame:
    """Blocks of usable vectors of one length: all as candidates, and the queries once more."""
    schema = pa.schema([("task", pa.int64()), ("number", pa.int64()), ("dim", pa.int32()), ("queries", pa.bool_()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def gather(batches):
        task, number, held = TaskContext.get().partitionId(), 0, {}

        def packed(key):
            nonlocal number
            number += 1
            ids, rows = zip(*held.pop(key))
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t.type) for x, t in zip((task, number, key[0], key[1], np.array(ids, np.int64).tobytes(), np.stack(rows).tobytes()), schema)], schema=schema
            )

        for batch in batches:
            for vec_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                if vec_id is None or not cell.is_valid or not len(cell.values) or cell.values.null_count:
                    continue
                row = cell.values.to_numpy().astype(np.float64)
                if not np.isfinite(row).all() or not row.any():
                    continue
                for key, size in (((len(row), False), BLOCK), ((len(row), True), QUERY_BLOCK)):
                    if key[1] and vec_id % query_every:
                        continue
                    held.setdefault(key, []).append((vec_id, row))
                    if len(held[key]) == size:
                        yield packed(key)
        for key in list(held):
            yield packed(key)

    return vectors.mapInArrow(gather, _BLOCKS)


def nearest(vectors: DataFrame, k: int = 20, query_every: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k largest inner products of each query, exact.

    ``vectors(vec_id, embedding, ...)``; queries are the rows whose vec_id is
    divisible by ``query_every``, candidates every row but the query's own.
    Ties go to the smaller vec_id. Vectors that are null, empty, zero, or hold
    null or non-finite components, and rows without an id, take no part; vectors
    of another length are not compared. Rows that share a vec_id count once as a
    candidate, with their best score. A product that overflows to no number
    counts as the least. With fewer candidates than k all are
    returned; an empty table gives no rows; other columns are ignored.
    """
    stages = Stages(vectors.sparkSession, "nearest")
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    # However the input is cut, blocks are filled: their number follows from that of the rows.
    rows = vectors.select(F.col("vec_id")).where("vec_id IS NOT NULL").count()
    usable = usable.repartition(max(1, -(-rows // GATHERED)))
    blocks = stages.write(vector_blocks(usable, query_every), "blocks")
    # Blocks are few (one per thousands of vectors); only their names are numbered here.
    numbered = blocks.select("task", "number", "queries").withColumn("at", F.row_number().over(W.partitionBy("queries").orderBy("task", "number")) - 1)
    n_queries = blocks.where("queries").count()
    placed = blocks.join(numbered.drop("queries"), ["task", "number"])
    tiles = F.ceil(F.lit(max(blocks.where("NOT queries").count(), 1)) / BLOCKS_PER_TILE).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n) - 1))
    query = placed.where("queries").select(F.col("at").alias("q"), every(tiles).alias("c"), "dim", "queries", "ids", "vectors")
    other = placed.where("NOT queries").select(every(max(n_queries, 1)).alias("q"), F.floor(F.col("at") / BLOCKS_PER_TILE).cast("int").alias("c"), "dim", "queries", "ids", "vectors")
    tile = query.unionByName(other).repartition("q", "c").sortWithinPartitions("q", "c", F.col("queries").desc())
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def compare(batches):
        at, tile = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["q"], row["c"]) != at:
                    if tile:
                        yield _best(tile, schema)
                    at, tile = (row["q"], row["c"]), None
                ids = np.frombuffer(row["ids"], np.int64)
                rows = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), row["dim"])
                if row["queries"]:
                    tile = Tile(ids, rows, k)
                elif tile and tile.rows.shape[1] == row["dim"]:
                    tile.add(ids, rows)
        if tile:
            yield _best(tile, schema)

    found = tile.mapInArrow(compare, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(tile: Tile, schema: pa.Schema) -> pa.RecordBatch:
    rows = list(tile.best())
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)
