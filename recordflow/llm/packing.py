"""Packing documents into fixed windows: non-negative least squares over length combinations.

A document is cut into full windows, one main piece whose length is a multiple
of ``grain``, and a crumb below ``grain``. So there are few distinct lengths, and
a histogram of them (bounded by window and grain, not by the data) is all that
the plan needs:

1. Enumerate shallow combinations of lengths that fill the window exactly, solve
   their repeat counts against the histogram by NNLS, and round down.
2. Pack the residual histogram greedily: patterns of any depth that fill the
   window exactly; what fits none is cut into powers of two, which fill windows
   without a gap; left-over crumbs fill windows largest first.

The plan says which ranks of a length go to which sequences. Ranks are per-task
counters plus offsets per task, so assignment is two joins on small rows. Texts
are read and encoded once, and token ids never leave the task that made them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.llm.common import Stages, rows_of
from recordflow.llm.word_bpe import word_bpe

END_ID = 2


# -- the plan ------------------------------------------------------------------


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-10 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if not gradient[best] > tolerance:
            break
        active[best] = True
        while True:
            trial = np.zeros(n)
            trial[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if (trial[active] > 0).all():
                x = trial
                break
            below = active & (trial <= 0)
            step = np.min(x[below] / np.maximum(x[below] - trial[below], 1e-300))
            x = x + step * (trial - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                break
    return x


def shallow(lengths: list[int], window: int, depth: int = 3) -> list[Counter]:
    """Combinations of up to ``depth`` lengths, or of one length repeated, that fill the window exactly."""
    known = set(lengths)
    found = [Counter({v: window // v}) for v in lengths if window % v == 0 and window // v > depth]
    for k in range(1, depth):
        for chosen in combinations_with_replacement(sorted(known), k):
            rest = window - sum(chosen)
            if rest >= chosen[-1] and rest in known:
                found.append(Counter([*chosen, rest]))
    return found


def repeated(lengths: list[int], window: int) -> list[Counter]:
    """For each short length: as many as fit, and one piece that fills the rest exactly."""
    known, found = set(lengths), []
    for v in lengths:
        pattern, rest = Counter({v: window // v}), window % v
        if rest in known:
            pattern[rest] += 1
        found.append(pattern)
    return found


def solved(patterns: list[Counter], left: Counter) -> list[tuple[Counter, int]]:
    """Repeat counts by NNLS, rounded down and never beyond what is left; takes them off ``left``."""
    rows = sorted(v for v in left if left[v] > 0)
    patterns = [p for p in patterns if all(left[v] >= m for v, m in p.items())]
    if not rows or not patterns:
        return []
    place, total = {v: i for i, v in enumerate(rows)}, sum(left.values())
    a = np.zeros((len(rows), len(patterns)))
    for j, pattern in enumerate(patterns):
        for v, m in pattern.items():
            a[place[v], j] = m
    counts = nnls(a, np.array([left[v] / total for v in rows])) * total
    taken = []
    for j in np.argsort(-counts):
        n = min(int(counts[j] + 1e-9), *(left[v] // m for v, m in patterns[j].items()))
        if n > 0:
            taken.append((patterns[j], n))
            for v, m in patterns[j].items():
                left[v] -= n * m
    return taken


def exact_fill(left: Counter, window: int) -> Counter | None:
    """Lengths from ``left``, long ones first, that fill the window exactly; None if there are none."""
    lengths = sorted((v for v in left if left[v] > 0), reverse=True)
    dead = set()

    def fill(at: int, rest: int) -> Counter | None:
        if rest == 0:
            return Counter()
        if at == len(lengths) or (at, rest) in dead:
            return None
        v = lengths[at]
        for m in range(min(left[v], rest // v), -1, -1):
            found = fill(at + 1, rest - m * v)
            if found is not None:
                if m:
                    found[v] = m
                return found
        dead.add((at, rest))
        return None

    return fill(0, window)


def greedy_fill(left: Counter, window: int) -> Counter:
    """Lengths from ``left``, long ones first, as far as they fit."""
    pattern, rest = Counter(), window
    for v in sorted((v for v in left if left[v] > 0), reverse=True):
        m = min(left[v], rest // v)
        if m:
            pattern[v] = m
            rest -= m * v
    return pattern


class Plan:
    """Intervals of ranks per length: ``(length, low, high, part, part_start, part_length, seq0, pos0, per_seq)``.

    A piece of rank r with low <= r < high lies at token
    ``pos0 + i // per_seq * window + i % per_seq * part_length`` behind the start
    of sequence seq0, where i = r - low.
    """

    def __init__(self, histogram: dict[int, int], window: int, grain: int):
        self.window, self.rows, self.next, self.used = window, [], 0, Counter()
        full = histogram.get(window, 0)
        if full:
            self.add(Counter({window: 1}), full)
        mains = Counter({v: n for v, n in histogram.items() if grain <= v < window})
        crumbs = Counter({v: n for v, n in histogram.items() if v < grain})
        for pattern, n in solved(shallow(sorted(mains), window), mains):
            self.add(pattern, n)
        while (pattern := exact_fill(mains, window)) is not None:
            self.take(pattern, mains)
        self.split(mains, grain)
        for pattern, n in solved(repeated(sorted(crumbs), window), crumbs):
            self.add(pattern, n)
        while sum(crumbs.values()):
            self.take(greedy_fill(crumbs, window), crumbs)

    def take(self, pattern: Counter, left: Counter) -> None:
        n = min(left[v] // m for v, m in pattern.items())
        self.add(pattern, n)
        for v, m in pattern.items():
            left[v] -= n * m

    def add(self, pattern: Counter, n: int) -> None:
        offset = 0
        for v, m in sorted(pattern.items(), reverse=True):
            self.rows.append((v, self.used[v], self.used[v] + n * m, -1, 0, v, self.next, offset, m))
            self.used[v] += n * m
            offset += v * m
        self.next += n

    def split(self, left: Counter, grain: int) -> None:
        """Mains that fit no pattern, as powers of two in falling order: they never cross a window."""
        total = sum(v * n for v, n in left.items())
        full, at, single = total // self.window, 0, 0
        base, size = self.next, self.window // 2
        while size >= grain:
            for v in sorted(left):
                n = left[v]
                if not n or not v & size:
                    continue
                start, part = v & ~(2 * size - 1), bin(v >> (size.bit_length())).count("1")
                low, high = self.used[v], self.used[v] + n
                inside = max(0, min(n, (full * self.window - at) // size))
                if inside:
                    self.rows.append((v, low, low + inside, part, start, size, base + at // self.window, at % self.window, self.window // size))
                if inside < n:  # the last, incomplete window: each power of two is a sequence without padding
                    self.rows.append((v, low + inside, high, part, start, size, base + full + single, 0, 1))
                    single += n - inside
                at += n * size
            size //= 2
        self.next = base + full + single
        for v in left:
            self.used[v] += left[v]


# -- the job -------------------------------------------------------------------

_PIECES = pa.schema(
    [("task", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
     ("crc", pa.int64()), ("parts", pa.list_(pa.int64())), ("rank", pa.int64())]
)


def pieces(ids: bytes, window: int, grain: int):
    """``(start, length, crc, crcs of its powers of two)`` of the pieces of one document (packed ids)."""
    n, start = len(ids) // 4, 0
    view = memoryview(ids)
    while n - start >= window:
        yield start, window, zlib.crc32(view[4 * start : 4 * (start + window)]), []
        start += window
    main = (n - start) // grain * grain
    if main:
        parts, at, size = [], start, window // 2
        while size >= grain:
            if main & size:
                parts.append(zlib.crc32(view[4 * at : 4 * (at + size)]))
                at += size
            size //= 2
        yield start, main, zlib.crc32(view[4 * start : 4 * (start + main)]), parts
        start += main
    if start < n:
        yield start, n - start, zlib.crc32(view[4 * start :]), []


def token_pieces(docs: DataFrame, tokenizer: str, window: int, grain: int, end_id: int) -> DataFrame:
    """All pieces, with their rank among the task's pieces of the same length."""
    end = end_id.to_bytes(4, "little")

    def build(batches):
        task, seen, encoder = TaskContext.get().partitionId(), Counter(), word_bpe(tokenizer)

        def rows(batch):
            for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.pack(cell.as_py() or "") + end
                for start, length, crc, parts in pieces(ids, window, grain):
                    yield task, doc_id, len(ids) // 4, start, length, crc, parts, seen[length]
                    seen[length] += 1

        yield from rows_of(batches, _PIECES, rows, 10_000)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(build, "task long, doc_id long, doc_tokens long, start long, length long, crc long, parts array<long>, rank long")


_PLAN = "length long, low long, high long, part int, part_start long, part_length long, seq0 long, pos0 long, per_seq long"


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 4096, grain: int = 64, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every row of ``docs(doc_id, text, ...)``.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    ``window`` and ``grain`` are powers of two. A null or empty text is its end
    id alone. Repeated rows are packed each; a null doc_id stays null; other
    columns are ignored; no rows give no rows. The plan comes from the histogram
    of lengths (at most window / grain + grain numbers), whatever the size of
    the input, and holds a few hundred intervals.
    """
    stages = Stages(docs.sparkSession, "packing")
    spark = docs.sparkSession
    cut = stages.write(token_pieces(docs, tokenizer, window, grain, end_id), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = F.broadcast(spark.createDataFrame(Plan(histogram, window, grain).rows, _PLAN))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(plan, "length").where("low <= rank AND rank < high")
    i = F.col("rank") - F.col("low")
    # Whole numbers: floor of a quotient of longs would pass through doubles.
    position = F.expr(f"pos0 + (rank - low) div per_seq * {window}L") + i % F.col("per_seq") * F.col("part_length")
    placed = placed.withColumn("position", position)
    return placed.select(
        "doc_id",
        (F.col("start") + F.col("part_start")).alias("start"),
        F.col("part_length").alias("length"),
        F.when(F.col("part") < 0, F.col("crc")).otherwise(F.try_element_at("parts", F.col("part") + 1)).alias("ids_crc32"),
        "doc_tokens",
        (F.col("seq0") + F.expr(f"position div {window}L")).alias("sequence_id"),
        (F.col("position") % window).alias("offset"),
    )
