"""Substring dedup by hashing lines and their sentences.

A text is cut at line ends and after sentence marks. Each unit is normalised
(lower case, single spaces) and hashed to 128 bits; equal digests are grouped
over all documents. The occurrence with the smallest (doc_id, text_key, start)
stays, the others are removed; ``text_key`` is a hash of the whole text, so rows
that share a doc_id and differ are different documents. Short units are common in any language, so consecutive
repeated units of a document form a run, and only runs of ``min_words`` words
or more are removed. Offsets are code points of the original text.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.llm.common import Stages, bounded, on_workers, rows_of, unused

MIN_WORDS = 8
UNIT_WORDS = 3
_BREAK = re.compile(r"\n|(?<=[.!?…])[ \t\r\f\v]+")
_LAST = (1 << 63) - 1
_TWO = struct.Struct("<qq")


def units(text: str) -> Iterator[tuple[int, int, str]]:
    """``(start, end, unit)``: lines, cut after sentence marks."""
    start = 0
    for found in _BREAK.finditer(text):
        if found.start() > start:
            yield start, found.start(), text[start : found.start()]
        start = found.end()
    if start < len(text):
        yield start, len(text), text[start:]


def hashed_units(text: str, unit_words: int) -> Iterator[tuple]:
    """``(number, start, end, words, first in the text, digest)`` of the units with ``unit_words`` words or more."""
    seen = set()
    for number, (start, end, unit) in enumerate(units(text)):
        found = unit.lower().split()
        if len(found) >= unit_words:
            digest = xxhash.xxh3_128_digest(" ".join(found).encode("utf-8", "surrogatepass"))
            yield number, start, end, len(found), digest not in seen, *_TWO.unpack(digest)
            seen.add(digest)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("unit", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("words", pa.int32()), ("opens", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64())])


def text_units(docs: DataFrame, unit_words: int = UNIT_WORDS) -> DataFrame:
    on_workers(docs.sparkSession)

    def build(batch) -> Iterator[tuple]:
        for doc_id, key, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            for found in hashed_units(cell.as_py() or "", unit_words):
                yield doc_id, key, *found

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(
        lambda batches: rows_of(batches, _SCHEMA, build, 20_000), "doc_id long, text_key long, unit int, start long, end long, words int, opens boolean, d1 long, d2 long"
    )


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, unit_words: int = UNIT_WORDS) -> DataFrame:
    """The spans to remove, one row per repeated unit: doc_id, text_key, start, end, n_words, kept_doc_id.

    ``kept_doc_id`` is the document whose first such unit stays. Rows that share
    doc_id and text are one document: the same place in the same document is
    never a repeat of itself. Rows that share a doc_id and differ in text are
    different documents, told apart by ``text_key``. Rows without a doc_id rank
    last, are never cut, and give no rows. Null and empty texts have no units;
    other columns are ignored.

    The first document per digest is pre-aggregated before the shuffle. The
    join back is a plain join on the digest, the same at every size, so a very
    common unit is split by the adaptive planner. Texts are cut and hashed once.
    """
    stages = Stages(docs.sparkSession, "substring")
    found = stages.write(text_units(docs, unit_words), "units")
    kept = F.min(F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "text_key")).alias("kept")
    first = found.groupBy("d1", "d2").agg(kept, F.count("*").alias("n"))
    first = stages.write(first.where("n > 1").select("d1", "d2", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.text_key").alias("kept_key")), "repeated")
    again = found.where("doc_id IS NOT NULL").join(first, ["d1", "d2"])
    again = again.where("doc_id != kept_doc_id OR text_key != kept_key OR NOT opens")
    # Repeated rows give a unit twice: number the units of a document by distinct places.
    order = W.partitionBy("doc_id", "text_key").orderBy("unit", "start")
    gap = F.when(F.col("unit") - F.lag("unit").over(order) <= 1, 0).otherwise(1)
    runs = again.withColumn("fresh", gap).withColumn("run", F.sum("fresh").over(order))
    # Equal rows of a document bring a unit several times; it counts once for the length of its run.
    once = F.when(F.row_number().over(W.partitionBy("doc_id", "text_key", "run", "start").orderBy("unit")) == 1, F.col("words")).otherwise(0)
    total = F.sum("own_words").over(W.partitionBy("doc_id", "text_key", "run"))
    return (
        runs.withColumn("own_words", once)
        .withColumn("run_words", total)
        .where(F.col("run_words") >= min_words)
        .select("doc_id", "text_key", "start", "end", F.col("words").cast("long").alias("n_words"), "kept_doc_id")
        .distinct()
    )


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` without the spans of :func:`repeated_spans`; each row loses what its own text repeats."""
    spans = repeated_spans(docs, **settings)
    key = lambda doc_id, text_key: F.concat_ws(":", doc_id.cast("string"), text_key.cast("string"))
    keyed = spans.select(key(F.col("doc_id"), F.col("text_key")).alias("doc_id"), "start", "end")
    # A null doc_id gives a key without a colon, which no span has.
    return cut_spans(docs, keyed, same=key(docs["doc_id"].cast("long"), F.xxhash64(docs["text"].cast("string"))))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; the blank that followed a removed span goes with it."""
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at : max(at, start)])
        at = max(at, end)
        if at < len(text) and text[at] in " \t":
            at += 1
    out.append(text[at:])
    return "".join(out)


def cut_spans(docs: DataFrame, spans: DataFrame, edit=without, few: bool = False, same: Column | None = None) -> DataFrame:
    """``docs`` with ``edit(text, spans)`` as text where ``spans(doc_id, start, end, ...)`` has any; ``n_chars`` follows.

    ``same`` is what of a document equals the spans' ``doc_id`` instead of its own.
    Spans of one document come together (bounded by its length), never those of
    several. ``few`` says that a small share of the documents has any: then they
    are broadcast if their measured size allows it, and no text is shuffled.
    """
    stages = Stages(docs.sparkSession, "cut")
    extra = [c for c in spans.columns if c not in ("doc_id", "start", "end")]
    key, cell = unused(docs, "span_doc_id"), unused(docs, "spans")
    per_doc = spans.groupBy(F.col("doc_id").alias(key)).agg(F.collect_list(F.struct("start", "end", *extra)).alias(cell))
    per_doc = stages.write(per_doc, "spans")
    if few:
        size = per_doc.agg(F.count("*").alias("n"), F.sum(F.size(cell)).alias("spans")).first()
        per_doc = bounded(per_doc, 128 * size["n"] + (24 + 24 * len(extra)) * (size["spans"] or 0))
    joined = docs.join(per_doc, (docs["doc_id"] if same is None else same) == F.col(key), "left").drop(key)
    columns = docs.columns
    at_text = columns.index("text")
    at_chars = columns.index("n_chars") if "n_chars" in columns else None

    def rewrite(batches):
        for batch in batches:
            arrays = [batch.column(i) for i in range(len(columns))]
            marked = batch.column(len(columns)).to_pylist()
            if any(marked):
                texts = [
                    cell.as_py() if not found else edit(cell.as_py() or "", [tuple(s.values()) for s in found])
                    for cell, found in zip(arrays[at_text], marked)
                ]
                arrays[at_text] = pa.array(texts, pa.string())
                if at_chars is not None:
                    lengths = [len(t) if found else n for t, found, n in zip(texts, marked, arrays[at_chars].to_pylist())]
                    arrays[at_chars] = pa.array(lengths, arrays[at_chars].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return joined.mapInArrow(rewrite, docs.schema)
