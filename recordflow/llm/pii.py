"""Personal data: spans found by form, and terms that disclose them found by corpus co-occurrence.

Emails, addresses, cards and phone numbers are protected entities. A term of a
document that holds an entity discloses it when the corpus shows that the term
tells which entity it is: with document counts n over N documents, pointwise
mutual information ``log(n_te N / (n_t n_e))`` against the entity's information
``log(N / n_e)``. Terms that reach ``generalise`` of it become a placeholder,
those that reach ``remove`` of it are removed, wherever they stand in a document
that holds the entity. A pair needs ``min_docs`` documents to count as an
estimate, and half a document is taken off its count, so that few documents say
less than many. Counts cover all words of all documents.

Of an entity in a single document no co-occurrence can be estimated: every rare
word of the document would seem to tell it. There only words that are part of
the entity's own text count, the names in a mail address: such a word names the
entity, and its own information ``log(N / n_t)`` says how much that tells.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import Stages, bounded, rows_of
from recordflow.llm.shingles import word_hashes
from recordflow.llm.substring import cut_spans

KINDS = ("email", "ip", "card", "phone", "term")
MIN_DOCS = 2
#: Documents taken off the count of a pair.
DISCOUNT = 0.5
GENERALISE = 0.8
REMOVE = 0.95

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits whose start failed, nor after a match, which takes whole runs.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
_PUNCTUATION = bytes(32 if c < 128 and not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122) else c for c in range(256))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is the run of its characters before an ``@``, after the last match."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by form, ordered by start and then by kind as listed."""
    found = [("email", *span) for span in emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def entity_of(text: str, kind: str, start: int, end: int) -> str:
    """Numbers are compared by their digits, since they are written with different marks; other kinds as they stand."""
    found = text[start:end]
    return f"{kind}:{re.sub(r'[ ().-]', '', found) if kind in ('card', 'phone') else found.lower()}"


def names_in(text: str, spans: list[tuple[str, int, int]]) -> set[bytes]:
    """Words of three letters or more that stand in a mail address before the ``@`` and elsewhere in the text."""
    parts = {w for kind, a, b in spans if kind == "email" for w in re.findall(r"[^\W\d_]{3,}", text[a:b].split("@")[0].lower())}
    if not parts:
        return set()
    return {w.encode("utf-8", "surrogatepass") for w in parts} & distinct_words(" ".join(text[a:b] for a, b in outside(text, spans)))


def context(text: str, spans: list[tuple[str, int, int]], window: int) -> Iterator[tuple[str, str, int, int]]:
    """``(entity, term, start, end)``: the words within ``window`` words of a span on its line."""
    for kind, start, end in spans:
        entity = entity_of(text, kind, start, end)
        line = text.rfind("\n", 0, start) + 1
        before = _nearby(text, line, start, window, last=True)
        stop = text.find("\n", end)
        after = _nearby(text, end, len(text) if stop < 0 else stop, window, last=False)
        for a, b in before + after:
            if not any(x < b and a < y for _, x, y in spans):
                yield entity, text[a:b].lower(), a, b


def _nearby(text: str, begin: int, end: int, window: int, last: bool) -> list[tuple[int, int]]:
    """The nearest ``window`` words of a piece; looks at a growing part of it, so a long line costs no more."""
    reach = 32 * window
    while True:
        a, b = (max(begin, end - reach), end) if last else (begin, min(end, begin + reach))
        found = [m.span() for m in _TERM.finditer(text, a, b)]
        whole = a == begin and b == end
        if not whole and found:  # the outermost word may be cut
            found = found[1:] if last else found[:-1]
        if whole or len(found) >= window:
            return found[-window:] if last else found[:window]
        reach *= 4


def _in_word(char: str) -> bool:
    return char >= "\x80" or char.isalnum()


def outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """The pieces of ``text`` between spans, less the words that a span cuts."""
    at = 0
    for _, start, end in spans:
        if _in_word(text[start]):
            while start > at and _in_word(text[start - 1]):
                start -= 1
        if start > at:
            yield at, start
        at = max(at, end)
        if _in_word(text[at - 1]):
            while at < len(text) and _in_word(text[at]):
                at += 1
    if at < len(text):
        yield at, len(text)


def distinct_words(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION).split())


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("spans", pa.list_(_SPAN)), ("entities", pa.list_(pa.int64())), ("names", pa.list_(pa.int64())), ("text", pa.string())])
_SPANS_SQL = "array<struct<kind:string,start:bigint,end:bigint>>"
_FOUND_SQL = f"row long, doc_id long, spans {_SPANS_SQL}, entities array<long>, names array<long>, text string"
_MARK = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])
_MARKS_SQL = "array<struct<start:bigint,end:bigint,share:double>>"


def _hashed(items: list[str]) -> list[int]:
    return word_hashes([x.encode("utf-8", "surrogatepass") for x in items]).view(np.int64).tolist()


def found_by_form(docs: DataFrame) -> DataFrame:
    """One row per document: base spans, hashed entities, and the text where it has any."""

    def build(batches):
        # Unique within a written table: the task's number and a counter.
        number = TaskContext.get().partitionId() << 40
        count = 0

        def rows(batch):
            nonlocal count
            for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = cell.as_py() or ""
                spans = base_spans(text)
                entities = _hashed(sorted({entity_of(text, *s) for s in spans}))
                names = word_hashes(sorted(names_in(text, spans))).view(np.int64).tolist()
                count += 1
                yield number + count, doc_id, [{"kind": k, "start": a, "end": b} for k, a, b in spans], entities, names, text if spans else None

        yield from rows_of(batches, _FOUND, rows)

    return docs.mapInArrow(build, _FOUND_SQL)


def _by_text(texts: DataFrame, schema: pa.Schema, sql: str, rows_for) -> DataFrame:
    """The rows of ``rows_for(row, text, spans, marks)`` for each row of ``texts(row, text, spans[, marks])``."""

    def build(batch):
        marks = batch.column(3) if batch.num_columns > 3 else [None] * batch.num_rows
        for row, cell, spans, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), marks):
            yield from rows_for(row, cell.as_py(), [(s["kind"], s["start"], s["end"]) for s in spans.as_py()], found and found.as_py())

    return texts.mapInArrow(lambda batches: rows_of(batches, schema, build, 20_000), sql)


def words_of(texts: DataFrame) -> DataFrame:
    """``(row, t)``: the distinct words of each text outside its spans."""

    def rows(row, text, spans, _):
        found = distinct_words(" ".join(text[a:b] for a, b in outside(text, spans)))
        yield from ((row, t) for t in word_hashes(list(found)).view(np.int64).tolist())

    return _by_text(texts, pa.schema([("row", pa.int64()), ("t", pa.int64())]), "row long, t long", rows)


def words_near(texts: DataFrame, window: int) -> DataFrame:
    """``(row, e, t)``: the distinct words near each entity of a text."""

    def rows(row, text, spans, _):
        pairs = sorted({(e, t) for e, t, *_ in context(text, spans, window)})
        yield from zip([row] * len(pairs), _hashed([e for e, _ in pairs]), _hashed([t for _, t in pairs]))

    return _by_text(texts, pa.schema([("row", pa.int64()), ("e", pa.int64()), ("t", pa.int64())]), "row long, e long, t long", rows)


def marked_words(texts: DataFrame) -> DataFrame:
    """``(row, terms)``: every place outside spans of the words that ``marks`` lists."""

    def rows(row, text, spans, marks):
        share = {m["t"]: m["share"] for m in marks}
        words = [(m.start(), m.end(), m.group().lower()) for a, b in outside(text, spans) for m in _TERM.finditer(text, a, b)]
        known = list({w for *_, w in words})
        hashes = dict(zip(known, _hashed(known)))
        yield row, [{"start": a, "end": b, "share": share[hashes[w]]} for a, b, w in words if hashes[w] in share]

    return _by_text(texts, pa.schema([("row", pa.int64()), ("terms", pa.list_(_MARK))]), f"row long, terms {_MARKS_SQL}", rows)


def term_documents(docs: DataFrame) -> DataFrame:
    """``(t, n)``: documents that hold a word, summed within each block before the shuffle."""
    schema = pa.schema([("t", pa.int64()), ("n", pa.int64())])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            pool, lengths = [], []
            for cell in batch.column(0):
                found = distinct_words(cell.as_py() or "")
                pool.extend(found)
                lengths.append(len(found))
                if len(pool) > 500_000:
                    held.append(word_hashes(pool))
                    size += len(pool)
                    pool = []
                if size > 4_000_000:
                    yield _counted(held, schema)
                    held, size = [], 0
            held.append(word_hashes(pool))
            size += len(pool)
        if size:
            yield _counted(held, schema)

    words = docs.select("text").mapInArrow(count, "t long, n long")
    return words.groupBy("t").agg(F.sum("n").alias("n"))


def _counted(held: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    terms, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n.astype(np.int64))], schema=schema)


def disclosing_terms(found: DataFrame, docs: DataFrame, stages: Stages, window: int | None, min_docs: int, generalise: float) -> DataFrame | None:
    """``(row, terms)``: all places of words that tell an entity of their document, with the share of its information that they give."""
    total = float(max(found.count(), 1))
    n_all = F.lit(total)
    places = found.select("row", F.explode("entities").alias("e"))
    entities = places.groupBy("e").agg(F.count("*").alias("n_e")).where((F.col("n_e") >= min_docs) & (F.col("n_e") < n_all))
    # As n_te <= n_e, no term in more documents than this can reach the share.
    most = n_all * F.pow(F.col("n_e") / n_all, F.lit(generalise)) * 1.000001
    entities = stages.write(entities.withColumn("most", most), "entities")
    size = entities.agg(F.count("*").alias("n"), F.coalesce(F.max("most"), F.lit(0.0)).alias("most")).first()
    names = stages.write(found.select("row", F.explode("names").alias("t")), "names")
    n_names = names.count()
    if not size["n"] and not n_names:
        return None
    held = stages.write(places.join(bounded(entities, 48 * size["n"]), "e"), "held")
    concerned = held.select("row").unionByName(names.select("row")).distinct()
    texts = found.join(bounded(concerned, 16 * (held.count() + n_names)), "row", "left_semi").select("row", "text", "spans")
    named = names.select("t").distinct().withColumn("name", F.lit(True))
    terms = term_documents(docs).withColumnRenamed("n", "n_t").join(bounded(named, 24 * n_names), "t", "left")
    terms = stages.write(terms.where(F.col("name") | (F.col("n_t") >= min_docs) & (F.col("n_t") <= size["most"])), "terms")
    paired = terms.where((F.col("n_t") >= min_docs) & (F.col("n_t") <= size["most"])).select("t", "n_t")
    paired = bounded(paired, 32 * paired.count())
    # A word meets the entities of its own document only: the join is by document, which spreads a hot entity.
    together = words_of(texts).join(paired, "t").join(held, "row").where("n_t <= most")
    near = together if window is None else words_near(texts, window).join(paired, "t").join(held, ["row", "e"]).where("n_t <= most")
    counted = near.groupBy("e", "t", "n_e", "n_t").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= min_docs)
    gain = F.log((F.col("n_te") - DISCOUNT) * n_all / (F.col("n_t").cast("double") * F.col("n_e")))
    own = F.log(n_all / F.col("n_e"))
    pairs = stages.write(counted.select("e", "t", (gain / own).alias("share")).where(F.col("share") >= generalise), "disclosing")
    # A name tells its entity; how much, its own information says, against that of an entity in one document.
    telling = names.join(terms.where("name").select("t", "n_t"), "t").select("row", "t", (F.log(n_all / F.col("n_t")) / math.log(max(total, 2.0))).alias("share"))
    telling = telling.where(F.col("share") >= generalise)
    # A term that tells two entities of a document is judged by the stronger disclosure.
    marks = together.select("row", "e", "t").join(bounded(pairs, 48 * pairs.count()), ["e", "t"]).select("row", "t", "share")
    marks = marks.unionByName(telling).groupBy("row", "t").agg(F.max("share").alias("share"))
    marks = marks.groupBy("row").agg(F.collect_list(F.struct("t", "share")).alias("marks"))
    return marked_words(texts.join(marks, "row"))


def _judged(docs: DataFrame, window: int | None = None, min_docs: int = MIN_DOCS, generalise: float = GENERALISE) -> DataFrame:
    """``(doc_id, spans, terms, text)`` per row; the text only where it has spans."""
    stages = Stages(docs.sparkSession, "pii")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stages.write(found_by_form(rows), "found")
    terms = disclosing_terms(found, rows, stages, window, min_docs, generalise)
    none = F.array().cast(_MARKS_SQL)
    if terms is None:
        return found.select("doc_id", "spans", none.alias("terms"), "text")
    return found.join(terms, "row", "left").select("doc_id", "spans", F.coalesce("terms", none).alias("terms"), "text")


def personal_spans(
    docs: DataFrame, window: int | None = None, min_docs: int = MIN_DOCS, generalise: float = GENERALISE
) -> DataFrame:
    """``(doc_id, spans, terms)`` for every row of ``docs(doc_id, text, ...)``.

    ``spans``: kind, start, end of what the forms find, by start and kind, in
    code points. ``terms``: start, end, share of every disclosing term in the
    rows that hold its entity. Terms are judged by all words of a document;
    with ``window``, by those within so many words of the entity on its line.
    Names in a mail address are judged wherever they stand in its document.
    Null and empty texts have neither; a null doc_id stays null; repeated rows
    are answered one by one and count as documents of their own; other columns
    are ignored.
    """
    return _judged(docs, window, min_docs, generalise).drop("text")


def span_report(spans: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans as text, per row of ``personal_spans``."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    # Order by start, then by kind as listed; the method's kind comes last.
    ranked = F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).cast("long").alias("rank"), s["end"].alias("end"), F.lit("term").alias("kind"))),
    )
    return spans.select(
        "doc_id", *(count(k) for k in KINDS[:4]),
        F.sha2(joined(F.col("spans")), 256).alias("base_sha256"), joined(F.array_sort(ranked)).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitised(text: str, spans: list[tuple]) -> str:
    """``text`` with each span (start, end, replacement) replaced; of overlapping ones the first and longest wins."""
    out, at = [], 0
    for start, end, put in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start < at:  # the rest of an overlapping span goes too
            at = max(at, end)
            continue
        out += [text[at:start], put]
        at = end
    out.append(text[at:])
    return "".join(out)


def sanitise(docs: DataFrame, remove: float = REMOVE, **settings) -> DataFrame:
    """``docs`` with personal data replaced by its kind and disclosing terms generalised or removed; all columns stay.

    Spans depend on a row's text alone, so they go back by the text's digest:
    rows without a doc_id are cleaned like any other, and equal texts share their spans.
    """
    digest = F.sha2(F.col("text").cast("string"), 256)
    found = _judged(docs, **settings).where(F.size("spans") > 0).select(digest.alias("doc_id"), "spans", "terms")
    base = found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.start", "s.end", F.concat(F.lit("["), F.upper("s.kind"), F.lit("]")).alias("put"))
    terms = found.select("doc_id", F.explode("terms").alias("s")).select(
        "doc_id", "s.start", "s.end", F.when(F.col("s.share") >= remove, "").otherwise("[TERM]").alias("put")
    )
    return cut_spans(docs, base.unionByName(terms).distinct(), sanitised, few=True, same=digest)
