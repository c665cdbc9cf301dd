"""SentencePiece encoding by a prefix table instead of merging.

For merges chosen by the score of the merged piece, the last token of every
prefix's encoding is unique, and two tokens stand side by side in an encoding
exactly if the encoding of their joined text is the two of them. So one pass over
a text fills a table with each prefix's last token: of the pieces that end there
(found by an Aho-Corasick automaton), the one that is compatible with the last
token of the prefix before it. The ids are read backwards from the table's end.

Neighbouring characters that occur side by side in no piece are never joined.
Texts are cut at such places, between words and around marks, and each part is
encoded once per Python worker (bounded cache), since words repeat.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from string import punctuation

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import on_workers, rows_of

BLANK = "▁"
CACHED = 400_000
PAIRS = 500_000


class PieceEncoder:
    """Encodes texts as the library does, for BPE models without user-defined or unused pieces."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.id, self.byte = {}, {}, {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = i
            elif sp.is_unused(i):
                raise ValueError(f"the model has an unused piece: {piece}")
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.id[piece], self.score[piece] = i, sp.get_score(i)
        self.beside = {piece[k : k + 2] for piece in self.id for k in range(len(piece) - 1)}
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            # Only a piece that its own text encodes to can be a token.
            if len(piece) > 1 and self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), piece))
        self.automaton.make_automaton()
        if any(pair[1] == BLANK and pair[0] != BLANK for pair in self.beside):
            raise ValueError("the model has pieces that reach over a word's end")
        self.words = self.word_pattern()
        self.fits: dict[tuple[str, str], bool] = {}
        self.chunks = _Generations(self._chunk)
        self.end = (struct.pack("<i", sp.eos_id()), str(sp.eos_id()))

    def word_pattern(self) -> re.Pattern:
        """Cuts where the vocabulary never joins: between words, after a word before a mark, around line ends."""
        line = "" if any("\n" in pair for pair in self.beside) else "\n"
        other = punctuation + "0123456789"
        marks = "".join(m for m in punctuation if all(a in other + BLANK for a, b in self.beside if b == m))
        stop, word = re.escape(BLANK + line), re.escape(BLANK + line + other)
        return re.compile(f"{BLANK}*[^{word}]++(?=[{stop}{re.escape(marks)}]|\\Z)|{line and '[' + line + ']|'}{BLANK}*[^{stop}]+|{BLANK}+")

    def merged(self, text: str) -> list[str]:
        """The encoding by its definition: join the best-scored pair, the leftmost of equals, until none is left."""
        tokens = list(text)
        while len(tokens) > 1:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(tokens, tokens[1:])) if a + b in self.score), default=None)
            if best is None:
                break
            k = -best[1]
            tokens[k : k + 2] = [tokens[k] + tokens[k + 1]]
        return tokens

    def compatible(self, left: str, right: str) -> bool:
        known = left[-1] + right[0] not in self.beside or self.merged(left + right) == [left, right]
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        self.fits[left, right] = known
        return known

    def tokens(self, text: str) -> list[str]:
        """Tokens of a text by the prefix table."""
        last: list[str | None] = [None] * (len(text) + 1)
        fits = self.fits
        # Matches come by their end. A place that none has filled so far holds its single character.
        for at, (size, piece) in self.automaton.iter(text):
            if last[at + 1] is None:
                start = at + 1 - size
                if start:
                    before = last[start] or text[start - 1]
                    known = fits.get((before, piece))
                    if not (self.compatible(before, piece) if known is None else known):
                        continue
                last[at + 1] = piece
        out, end = [], len(text)
        while end:
            token = last[end] or text[end - 1]
            out.append(token)
            end -= len(token)
        out.reverse()
        return out

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        """Packed ids of a chunk, and the ids as text."""
        ids, known = [], self.id
        for token in self.tokens(chunk):
            number = known.get(token)
            if number is not None:
                ids.append(number)
            elif self.byte:
                ids += [self.byte[b] for b in token.encode("utf-8", "surrogatepass")]
            else:
                ids.append(self.library.unk_id())
        return struct.pack(f"<{len(ids)}i", *ids), " ".join(map(str, ids))

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids with the end id, as numbers and as text."""
        found = map(self.chunks.__getitem__, self.words.findall(self.library.normalize(text)))
        packed, written = zip(*found, self.end)
        return np.frombuffer(b"".join(packed), np.int32), " ".join(written)


class _Generations(dict):
    """A bounded cache: entries of the older generation stay if they are used."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 48:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per path and Python worker."""
    return PieceEncoder(path)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs(doc_id, text, ...)``, the end id last. Null text is empty."""
    on_workers(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def build(batch) -> Iterator[tuple]:
        encoder = piece_encoder(model)
        for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield doc_id, encoder.encode(cell.as_py() or "")[0]

    return _rows(docs).mapInArrow(lambda batches: rows_of(batches, schema, build, 500), "doc_id long, ids array<int>")


def encoding_digests(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row of ``docs(doc_id, text, ...)``.

    Null and empty texts have the end id only and decode to nothing. Very long
    texts are encoded whole, word by word. Repeated rows are answered one by
    one; a null doc_id stays null; other columns are ignored; no rows give none.
    """
    on_workers(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def build(batch) -> Iterator[tuple]:
        encoder = piece_encoder(model)
        for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids, written = encoder.encode(cell.as_py() or "")
            yield doc_id, len(ids), digest(written), digest(encoder.library.decode(ids.tolist()))

    return _rows(docs).mapInArrow(
        lambda batches: rows_of(batches, schema, build), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
