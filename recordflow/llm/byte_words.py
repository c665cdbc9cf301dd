"""Words of many texts as spans of one byte buffer, and their xxHash64 for all spans at once.

A word is a run of UTF-8 bytes that are digits, letters or part of a non-ASCII
character, with A-Z lower-cased: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Texts are taken together until they hold so many bytes (a longer text stands alone).
TOGETHER = 4 << 20
_SPACE = 32
_U = np.uint64


def _fold() -> np.ndarray:
    table = np.full(256, _SPACE, np.uint8)
    table[128:] = np.arange(128, 256)
    for first, last in ("09", "az"):
        table[ord(first) : ord(last) + 1] = np.arange(ord(first), ord(last) + 1)
    table[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


_FOLD = _fold()


@dataclass
class WordSpans:
    """All words of some texts: word i is ``buffer[starts[i]:ends[i]]``; words are one space apart.

    ``first[t]`` to ``first[t + 1]`` are the words of text t. The buffer ends
    with eight bytes that belong to no word.
    """

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def text(self, word: int, count: int) -> str:
        """``count`` words from ``word`` on, joined by one space."""
        return self.buffer[self.starts[word] : self.ends[word + count - 1]].tobytes().decode("utf-8")


def word_spans(texts: list[bytes]) -> WordSpans:
    joined = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    folded = _FOLD[joined]
    blank = folded == _SPACE
    begins = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(begins, offsets)
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]  # the first blank after a word stays
    packed = folded[keep]
    gaps = np.flatnonzero(packed == _SPACE)
    return WordSpans(np.concatenate([packed, np.zeros(8, np.uint8)]), gaps[:-1] + 1, gaps[1:], first)


def text_groups(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, texts)`` of an Arrow text column, nulls as empty texts, some megabytes at a time."""
    start, held, size = 0, [], 0
    for cell in column.cast(pa.binary()):
        text = cell.as_py() or b""
        if held and size + len(text) > TOGETHER:
            yield start, held
            start, held, size = start + len(held), [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


# The five primes of xxHash64: fixed values.
_P1 = _U(0x9E3779B185EBCA87)
_P2 = _U(0xC2B2AE3D27D4EB4F)
_P3 = _U(0x165667B19E3779F9)
_P4 = _U(0x85EBCA77C2B2AE63)
_P5 = _U(0x27D4EB2F165667C5)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << _U(bits)) | (x >> _U(64 - bits))


def lanes(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each byte, as little-endian numbers (a view)."""
    return np.ndarray(len(buffer) - 7, "<u8", buffer, strides=(1,))


def span_hashes(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of ``buffer[start:start + length]`` for all spans; the buffer ends with eight spare bytes."""
    out, eight = np.empty(len(starts), np.uint64), lanes(buffer)
    order = np.argsort(lengths, kind="stable")
    sizes = lengths[order]
    cuts = np.flatnonzero(np.diff(sizes, prepend=-1, append=-1))
    raw = memoryview(buffer)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        size, rows = int(sizes[low]), order[low:high]
        at = starts[rows]
        if size >= 32:  # the long form; such spans are rare
            out[rows] = [xxhash.xxh64_intdigest(raw[a : a + size]) for a in at.tolist()]
            continue
        h = np.full(len(rows), _P5 + _U(size), np.uint64)
        done = 0
        for done in range(8, size + 1, 8):
            h = _turn(h ^ (_turn(eight[at + (done - 8)] * _P2, 31) * _P1), 27) * _P1 + _P4
        rest = eight[at + done]
        if size - done >= 4:
            h = _turn(h ^ ((rest & _U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            rest, done = rest >> _U(32), done + 4
        for i in range(size - done):
            h = _turn(h ^ (((rest >> _U(8 * i)) & _U(0xFF)) * _P5), 11) * _P1
        h = (h ^ (h >> _U(33))) * _P2
        h = (h ^ (h >> _U(29))) * _P3
        out[rows] = h ^ (h >> _U(32))
    return out


def chunks(n: int, size: int) -> Iterable[tuple[int, int]]:
    return ((low, min(n, low + size)) for low in range(0, n, size))
