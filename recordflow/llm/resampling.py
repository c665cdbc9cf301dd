"""Importance resampling: draw the documents whose n-grams look most like a target's."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.byte_words import WordSpans, chunks, lanes, span_hashes, text_groups, word_spans
from recordflow.llm.common import Stages, as_batch, on_workers
from recordflow.llm.ordering import positions

#: So many words go through one table.
TABLE_WORDS = 1 << 18
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _differ(buffer: np.ndarray, one: np.ndarray, two: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Do the bytes of two spans of equal length differ?"""
    eight, out = lanes(buffer), np.zeros(len(one), bool)
    left, done = np.arange(len(one)), 0
    while len(left):
        held = np.minimum(lengths[left] - done, 8)
        out[left] |= ((eight[one[left] + done] ^ eight[two[left] + done]) & _MASKS[held]) != 0
        done += 8
        left = left[lengths[left] > done]
    return out


class NgramTable:
    """The distinct n-grams of one batch in an open-addressed table.

    A key is the xxHash64 of the n-gram's bytes; an equal key is taken for the
    same n-gram only if the bytes are equal, else the search goes on in the next
    slot. ``bucket`` and ``count`` have one entry per slot (empty ones count 0),
    ``slot`` one per occurrence. At most half of the slots are taken.
    """

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int):
        n = len(starts)
        size = 1 << max(4, (2 * n).bit_length())
        keys = span_hashes(buffer, starts, lengths)
        holder = np.full(size, -1, np.int64)  # the occurrence that took the slot
        self.slot = np.empty(n, np.int64)
        at, waiting = (keys & np.uint64(size - 1)).astype(np.int64), np.arange(n)
        while len(waiting):
            place = at[waiting]
            free = holder[place] < 0
            holder[place[free]] = waiting[free]  # of several at once, one stays
            there = holder[place]
            same = (keys[there] == keys[waiting]) & (lengths[there] == lengths[waiting])
            check = np.flatnonzero(same & (there != waiting))
            same[check[_differ(buffer, starts[there[check]], starts[waiting[check]], lengths[waiting[check]])]] = False
            self.slot[waiting[same]] = place[same]
            waiting = waiting[~same]
            at[waiting] = (at[waiting] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        taken = np.flatnonzero(holder >= 0)
        first = holder[taken]
        raw = memoryview(buffer)
        self.bucket[taken] = [zlib.crc32(raw[a:b]) for a, b in zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist())]
        self.bucket %= buckets


def _tables(spans: WordSpans, longest: int, buckets: int) -> Iterator[tuple[NgramTable, np.ndarray]]:
    """Tables over all runs of 1 to ``longest`` consecutive words of one text, with the text of each occurrence."""
    n = len(spans.starts)
    text = np.repeat(np.arange(len(spans.first) - 1), np.diff(spans.first))
    for low, high in chunks(n, TABLE_WORDS):
        starts, ends, owners = [], [], []
        for size in range(1, longest + 1):
            word = np.arange(low, min(high, n - size + 1))
            word = word[text[word] == text[word + size - 1]]
            starts.append(spans.starts[word])
            ends.append(spans.ends[word + size - 1])
            owners.append(text[word])
        begin = np.concatenate(starts)
        yield NgramTable(spans.buffer, begin, np.concatenate(ends) - begin, buckets), np.concatenate(owners)


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """``(bucket, n)``: occurrences of n-grams by the crc32 of their bytes; every task sends a row per bucket at most."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def build(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, group in text_groups(batch.column(0)):
                for table, _ in _tables(word_spans(group), longest, buckets):
                    taken = np.flatnonzero(table.count)
                    np.add.at(total, table.bucket[taken], table.count[taken])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], schema=schema)

    return texts.mapInArrow(build, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Thousandths of the log ratio of both tables' smoothed shares, floored, for each of ``buckets`` buckets."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for out, counts in ((s, source), (t, target)):
        for row in counts.collect():  # a row per bucket at most
            out[row["bucket"]] = row["n"]
    all_s, all_t = s.sum() + buckets, t.sum() + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths from the id alone, floored; a null id counts as an empty one."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gains: np.ndarray, longest: int, seed: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of ``docs(doc_id, text)``."""
    fields = ["doc_id", "n_words", "n_features", "weight", "score"]
    schema = pa.schema([(name, pa.int64()) for name in fields])
    buckets = len(gains)

    def build(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, group in text_groups(batch.column(1)):
                spans = word_spans(group)
                total, features = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
                for table, owner in _tables(spans, longest, buckets):
                    gain = gains[table.bucket][table.slot]  # of each occurrence
                    np.add.at(total, owner, gain)
                    features += np.bincount(owner, minlength=len(group))
                weight = np.where(features > 0, total // np.maximum(features, 1), 0).tolist()
                own = ids[start : start + len(group)]
                score = [w + noise(i, seed) for i, w in zip(own, weight)]
                columns = [own, np.diff(spans.first), features, weight, score]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return docs.mapInArrow(build, ", ".join(f"{name} long" for name in fields))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = 10_000, longest: int = 2, seed: int = 7
) -> DataFrame:
    """Draw ``percent`` percent of the documents without replacement, by similarity to ``target(text, ...)``.

    One row per row of ``docs(doc_id, text, ...)``: doc_id, n_words, n_features,
    weight (floored mean of the gains of its n-grams of 1 to ``longest`` words),
    score (weight plus noise fixed by the id), rank (from 1 among the drawn, else
    null). Only documents of ``least_words`` words are drawn; ties go to the
    smaller doc_id, a null doc_id comes last among equal scores and has the noise
    of an empty id. Null texts have no words. Repeated rows are drawn each. Other
    columns are ignored. No documents give no rows; an empty target still gives
    gains, from the smoothing. A text of any length is taken whole, its n-grams
    ``TABLE_WORDS`` words at a time.

    The counts are exact over all rows. What comes to the driver is bounded: one
    row per bucket, and one per distinct score (scores are whole thousandths of
    logarithms, so a few ten thousand at any corpus size). The drawn rows are
    ranked by a range sort, not in one task.
    """
    on_workers(docs.sparkSession)
    stages = Stages(docs.sparkSession, "resample")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = target.select(F.col("text").cast("string").alias("text"))
    gains = bucket_gains(bucket_counts(rows.select("text"), buckets, longest), bucket_counts(wanted, buckets, longest), buckets)
    scored = stages.write(scores(rows, gains, longest, seed), "scored")
    able = F.col("n_words") >= least_words
    by_score = sorted(((r["score"], r["n"]) for r in scored.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted_rows, passed, cut = percent * sum(n for _, n in by_score) // 100, 0, None
    for score, n in by_score:
        if passed >= wanted_rows:
            break
        passed, cut = passed + n, score
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = able & (F.col("score") >= cut)
    placed = positions(scored.where(near), [], [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features")], stages)
    ranked = placed.withColumn("rank", F.when(F.col("pos") < wanted_rows, F.col("pos") + 1)).drop("pos", "n")
    return ranked.unionByName(scored.where(~near).withColumn("rank", F.lit(None).cast("long")))
