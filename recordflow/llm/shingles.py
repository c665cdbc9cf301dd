"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S31, _S29 = np.uint64(31), np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    x = (x ^ (x >> _S31)) * _B
    return x ^ (x >> _S29)


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, in UTF-8: the byte methods know ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(items: list[bytes]) -> np.ndarray:
    """Keyed SipHash of each word, equal in every process."""
    if not items:
        return np.empty(0, np.uint64)
    cells = np.empty(len(items), dtype=object)
    cells[:] = items
    return pd.util.hash_array(cells, categorize=False)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size``-word shingles; fewer words form one shingle, none an empty set."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out * _A + hashes[i : n - width + 1 + i])
    out.sort()
    keep = np.empty(len(out), bool)
    keep[0] = True
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]


def set_digest(items: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit values that stand for the set."""
    one = mix(items)
    both = np.array([one.sum(dtype=np.uint64), mix(one * _A + _B).sum(dtype=np.uint64)])
    return tuple(mix(both).view(np.int64).tolist())


def text_sets(column: pa.Array, size: int, together: int = 100_000) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, shingle set)`` of an Arrow text column; words of several texts are hashed at once."""
    rows, counts, pool = [], [], []

    def flush() -> Iterable[tuple[int, np.ndarray]]:
        hashes, at = word_hashes(pool), 0
        for row, n in zip(rows, counts):
            yield row, shingle_set(hashes[at : at + n], size)
            at += n

    for row, cell in enumerate(column):
        found = words(cell.as_py() or "")
        rows.append(row)
        counts.append(len(found))
        pool.extend(found)
        if len(pool) >= together:
            yield from flush()
            rows, counts, pool = [], [], []
    yield from flush()
