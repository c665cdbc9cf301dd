"""Benchmark decontamination by winnowed fingerprints, extended to whole windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.byte_words import WordSpans, span_hashes, text_groups, word_spans
from recordflow.llm.common import Stages, bounded, on_workers, rows_of
from recordflow.llm.shingles import mix

#: Words of the k-grams that are hashed; each run of ``window - GRAM + 1`` of them keeps its least hash.
GRAM = 5
#: The filter has 16 bits for each fingerprint of the benchmark, in powers of two between these.
FILTER_BITS = (16, 28)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from the words' hashes."""
    n = max(0, len(words) - size + 1)
    out = np.full(n, size, np.uint64)
    for i in range(size if n else 0):
        out = mix(out * _MUL + words[i : i + n])
    return out


def fingerprints(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The fingerprint of the window of ``window`` words at each word: the least hash of its k-grams.

    It follows from the window's words alone, so equal windows have equal
    fingerprints wherever they stand; neighbouring windows mostly share one.
    """
    grams = gram_hashes(words, min(gram, window))
    n = max(0, len(words) - window + 1)
    out = grams[:n].copy()
    for i in range(1, window - min(gram, window) + 1):
        np.minimum(out, grams[i : i + n], out=out)
    return mix(out)  # a minimum has small leading bits; the filter wants even ones


def _windows(spans: WordSpans, window: int) -> Iterator[tuple[int, int, int]]:
    """``(text, word, width)`` of every window of each text; a shorter text is one window."""
    for text, (low, high) in enumerate(zip(spans.first[:-1].tolist(), spans.first[1:].tolist())):
        if high > low:
            width = min(window, high - low)
            for word in range(low, high - width + 1):
                yield text, word, width


def item_windows(items: DataFrame, window: int, gram: int) -> DataFrame:
    """``(item, fp, words, width)``: the distinct windows of every item; an item with a null id has the empty id."""
    schema = pa.schema([("item", pa.string()), ("fp", pa.int64()), ("words", pa.string()), ("width", pa.int32())])

    def build(batch) -> Iterator[tuple]:
        ids = batch.column(0).to_pylist()
        for start, group in text_groups(batch.column(1)):
            spans = word_spans(group)
            hashes = span_hashes(spans.buffer, spans.starts, spans.ends - spans.starts)
            known: dict[int, np.ndarray] = {}
            for text, word, width in _windows(spans, window):
                if width not in known:
                    known[width] = fingerprints(hashes, width, gram).view(np.int64)
                yield ids[start + text] or "", int(known[width][word]), spans.text(word, width), width

    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    found = rows.mapInArrow(lambda batches: rows_of(batches, schema, build), "item string, fp long, words string, width int")
    return found.distinct()


class Filter:
    """A bitmap of bounded size that knows every fingerprint of the benchmark, and few others."""

    def __init__(self, prints: DataFrame):
        low, high = FILTER_BITS
        self.bits = min(high, max(low, (16 * max(1, prints.count())).bit_length()))
        fp, mask = F.col("fp"), (1 << self.bits) - 1
        bit = F.explode(F.array(F.shiftrightunsigned(fp, 64 - self.bits), fp.bitwiseAND(F.lit(mask)))).alias("bit")
        cells = prints.select(bit).groupBy(F.shiftright("bit", 5).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 31))")).alias("mask"))
        table = cells.toArrow()  # at most 2 ** (bits - 5) rows, from the distributed union
        self.cells = np.zeros(1 << (self.bits - 5), np.uint32)
        self.cells[table["cell"].to_numpy()] = table["mask"].to_numpy().astype(np.uint32)

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        def known(bit: np.ndarray) -> np.ndarray:
            return (self.cells[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1

        return known(prints >> np.uint64(64 - self.bits)) & known(prints & np.uint64((1 << self.bits) - 1))


def _candidates(spans: WordSpans, widths: list[int], gram: int, known: Filter) -> dict[int, dict[tuple[int, str], list[int]]]:
    """By text: ``(fingerprint, words) -> starts`` of the windows whose fingerprint the filter knows."""
    hashes = span_hashes(spans.buffer, spans.starts, spans.ends - spans.starts)
    first, out = spans.first, {}
    for width in widths:
        prints = fingerprints(hashes, width, gram)
        if not len(prints):
            continue
        fresh = np.concatenate([[True], prints[1:] != prints[:-1]])  # a kept k-gram serves several windows
        passed = np.flatnonzero(known(prints[fresh])[np.cumsum(fresh) - 1])
        owner = np.searchsorted(first, passed, side="right") - 1
        inside = passed + width <= first[owner + 1]
        for word, text in zip(passed[inside].tolist(), owner[inside].tolist()):
            key = (int(prints[word].view(np.int64)), spans.text(word, width))
            out.setdefault(text, {}).setdefault(key, []).append(word - int(first[text]))
    return out


_FOUND = pa.struct([("fp", pa.int64()), ("words", pa.string()), ("width", pa.int32()), ("starts", pa.list_(pa.int32()))])
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _marked(docs: DataFrame, widths: list[int], gram: int, known: Filter) -> DataFrame:
    """``(doc_id, n_words, found)`` of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("found", pa.list_(_FOUND))])
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def build(batch) -> Iterator[tuple]:
        ids = batch.column(0).to_pylist()
        for start, group in text_groups(batch.column(1)):
            spans = word_spans(group)
            found = _candidates(spans, widths, gram, shared.value)
            for text, n in enumerate(np.diff(spans.first).tolist()):
                hits = [{"fp": fp, "words": w, "width": w.count(" ") + 1, "starts": s} for (fp, w), s in found.get(text, {}).items()]
                yield ids[start + text], n, hits

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kind = "array<struct<fp: long, words: string, width: int, starts: array<int>>>"
    return rows.mapInArrow(lambda batches: rows_of(batches, schema, build), f"doc_id long, n_words long, found {kind}")


def _joined_spans(places: DataFrame) -> DataFrame:
    """``(key, sets, spans)`` with the union of each document's windows."""
    schema = pa.schema([("key", pa.int64()), ("sets", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))])

    def build(batch) -> Iterator[tuple]:
        for key, sets, found in zip(*(c.to_pylist() for c in batch.columns)):
            spans: list[list[int]] = []
            for start, end in sorted((s, s + f["width"]) for f in found for s in f["starts"]):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
            yield key, sets, [{"start": a, "end": b} for a, b in spans]

    return places.mapInArrow(lambda batches: rows_of(batches, schema, build), "key long, sets array<string>, spans array<struct<start: int, end: int>>")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = GRAM) -> DataFrame:
    """Where the documents hold windows of ``window`` consecutive words of ``items(item_id, text, ...)``.

    One row per row of ``docs(doc_id, text, ...)``: doc_id, n_words, spans (of
    words inside any such window, joined, end exclusive), item_ids (sorted texts
    of the items with a window there, each once). An item of fewer words is one
    window; one without words has none. Words are lower-cased in A-Z only. Null
    texts have no words, a null item_id is the empty text, rows that share an
    item_id are one item, repeated documents are judged each, other columns are
    ignored; without items no document has a span, without documents no rows.

    Exact: a window's fingerprint, the least hash of its k-grams, follows from its
    words, so every shared window shares one. Documents keep the windows whose
    fingerprint is in a bitmap of the benchmark's (of bounded size; it lets some
    others through and none go); the join by fingerprint then compares the words
    of the window, and touching windows grow into spans. Items of fewer words
    than a window bring one more width each. Windows with equal sets of items
    share one set, and documents with equal sets share one list, so neither a
    passage of many items nor one in many documents is multiplied out.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "winnowing")
    windows = stages.write(item_windows(items, window, gram), "windows")
    widths = [r["width"] for r in windows.select("width").distinct().collect()]  # at most ``window`` numbers
    prints = windows.select("fp").distinct()
    # Every document gets its key as it is written; each is a row of its own from here on.
    marked = _marked(docs, sorted(widths), gram, Filter(prints)).withColumn("key", F.monotonically_increasing_id())
    marked = stages.write(marked, "marked")

    members = F.concat_ws(
        ":", F.count("*"), F.hex(F.bit_xor(F.xxhash64("item"))), F.hex(F.bit_xor(F.xxhash64(F.lit("set"), "item")))
    )
    sets = stages.write(windows.groupBy("fp", "words").agg(members.alias("set_id")), "sets")
    example = sets.groupBy("set_id").agg(F.min(F.struct("fp", "words")).alias("w")).select("set_id", "w.fp", "w.words")
    listed = windows.join(example, ["fp", "words"]).select("set_id", "item")

    found = marked.select("key", F.explode("found").alias("f")).select("key", "f.fp", "f.words", "f.width", "f.starts")
    hits = found.join(bounded(sets, sets.count() * 200), ["fp", "words"])
    place = F.struct("width", "starts")
    per_doc = hits.groupBy("key").agg(F.sort_array(F.collect_set("set_id")).alias("sets"), F.collect_list(place).alias("found"))
    per_doc = stages.write(_joined_spans(per_doc.select("key", "sets", "found")), "spans")
    combos = per_doc.select("sets").distinct()
    ids = combos.select("sets", F.explode("sets").alias("set_id")).join(listed, "set_id").select("sets", "item").distinct()
    lists = ids.groupBy("sets").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    known = per_doc.join(lists, "sets").select("key", "spans", "item_ids")
    return marked.select("key", "doc_id", "n_words").join(known, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.expr("cast(array() as array<struct<start: int, end: int>>)")).alias("spans"),
        F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"),
    )


def contamination_report(found: DataFrame) -> DataFrame:
    """Digest columns of :func:`contamination`."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
