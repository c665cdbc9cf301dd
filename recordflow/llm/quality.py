"""Line-first quality rules: judge lines, remove failing ones, then reject documents that lose too much."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import on_workers, rows_of
from recordflow.llm.shingles import mix, word_hashes

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: Share of a document's word characters, in percent, that failing lines may hold.
MAX_LOST = 30
#: A line of so many words needs no closing mark; a shorter one without any mark is a heading or a menu entry.
PROSE_WORDS = 20

_CLOSING = tuple(".!?…:;\"'”’»)")
_MARK = re.compile(r"[.!?…]")
_SEPARATORS = re.compile(r"[|»›•·]")
_BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)|accept cookies|enable javascript"
    r"|click here|read more|sign (?:in|up)|log ?in|subscribe (?:now|to)|skip to (?:main )?content|back to top|lorem ipsum",
    re.IGNORECASE,
)


def word_chars(text: str) -> int:
    """Code points inside words."""
    return len(text) - sum(map(text.count, SPACE))


def symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


def failing_rule(line: str) -> str | None:
    """The first rule a line with words breaks: ``symbols``, ``navigation``, ``boilerplate``, ``capitals`` or ``punctuation``."""
    line = line.strip(SPACE)
    marks = symbols(line)
    n_words = len(line.encode("utf-8", "surrogatepass").split())
    if marks or "•" in line or "·" in line or "»" in line or "›" in line:
        if 10 * marks > word_chars(line):
            return "symbols"
        between = len(_SEPARATORS.findall(line))
        if between >= 2 and 4 * between >= n_words:
            return "navigation"
    if n_words <= 12 and _BOILERPLATE.search(line):
        return "boilerplate"
    if n_words >= 5 and line.isupper():
        return "capitals"
    if n_words < PROSE_WORDS and not line.endswith(_CLOSING) and not _MARK.search(line):
        return "punctuation"
    return None


def split_lines(text: str) -> tuple[list[str], int, int, int]:
    """Lines to keep, lines removed, word characters removed, and lines that repeat an earlier one."""
    kept, seen = [], set()
    removed = lost = repeated = 0
    for line in text.split("\n"):
        if not line.strip(SPACE):
            kept.append(line)
            continue
        if line in seen:
            repeated += 1
        seen.add(line)
        if failing_rule(line):
            removed += 1
            lost += word_chars(line)
        else:
            kept.append(line)
    return kept, removed, lost, repeated


def repeated_words(hashes: np.ndarray, window: int = 8) -> int:
    """Words that lie in a window of ``window`` words found twice or more, the first included."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    ordered = np.sort(rolled)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(np.isin(rolled, again))
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


_FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lines_removed", pa.int64()), ("chars_removed", pa.int64()),
]
_TYPES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines_removed long, chars_removed long"


def judge(text: str, max_lost: int) -> tuple[tuple, list[str]]:
    """The figures and verdict of one text, and the lines that stay."""
    found = text.encode("utf-8", "surrogatepass").split()
    n_words, chars = len(found), word_chars(text)
    lines, removed, lost, repeated = split_lines(text)
    again = repeated_words(word_hashes(found))
    failed = n_words < 20 or 100 * again > 30 * n_words
    kept = not failed and 100 * lost <= max_lost * chars
    return (n_words, chars, symbols(text), repeated, again, failed, kept, removed, lost), lines


def line_quality(docs: DataFrame, max_lost: int = MAX_LOST) -> DataFrame:
    """Figures and verdict for every row of ``docs(doc_id, text, ...)``; other columns are ignored.

    Columns: doc_id, n_words, word_chars (code points in words), n_symbols,
    n_dup_lines, n_repeat_words, base_failed (under 20 words, or over 30 % of the
    words in repeated windows), kept, n_lines_removed, chars_removed. A document
    that does not fail is kept while its failing lines hold ``max_lost`` percent
    of its word characters at most. Null texts are empty and fail; repeated rows
    are judged one by one; a null doc_id stays null; no rows give no rows.
    """
    on_workers(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), *_FIELDS])

    def build(batch) -> Iterator[tuple]:
        for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield doc_id, *judge(cell.as_py() or "", max_lost)[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: rows_of(batches, schema, build), f"doc_id long, {_TYPES}")


def keep_clean(docs: DataFrame, max_lost: int = MAX_LOST) -> DataFrame:
    """The kept rows of ``docs`` with their failing lines removed; all columns stay, ``n_chars`` follows the text."""
    on_workers(docs.sparkSession)
    columns = docs.columns
    at_text = columns.index("text")
    at_chars = columns.index("n_chars") if "n_chars" in columns else None

    def clean(batches):
        for batch in batches:
            keep, cleaned = [], []
            for row, cell in enumerate(batch.column(at_text)):
                text = cell.as_py() or ""
                figures, lines = judge(text, max_lost)
                if figures[6]:
                    keep.append(row)
                    cleaned.append("\n".join(lines) if figures[7] else text)
            if keep:
                arrays = [batch.column(i).take(pa.array(keep, pa.int64())) for i in range(len(columns))]
                arrays[at_text] = pa.array(cleaned, pa.string())
                if at_chars is not None:
                    arrays[at_chars] = pa.array(list(map(len, cleaned)), pa.int64()).cast(batch.column(at_chars).type)
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(clean, docs.schema)
