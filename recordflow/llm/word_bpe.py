"""Token ids of whole texts by a word-wise BPE tokenizer, one dictionary look-up per word.

The tokenizer drops white space and never merges across it, so a text's ids are
those of its blank-separated chunks in order. Chunks of plain Latin letters,
digits and punctuation are cut into the tokenizer's words here and merged by
rank with tiktoken; all other chunks go through the tokenizer itself. Merging
by the rank of the result equals merging by listed pairs as long as every token
of the vocabulary is the encoding of its own text; tokens that are not are left
out. The cache is bounded and lives as long as the Python worker.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

CACHED = 400_000
WORD_END = "</w>"
_END = b"\x00"  # marks the end of a word; not a plain character
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if visible, else the next from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


def ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Token bytes to id; the end of a word is one more byte."""
    byte = {letter: b for b, letter in byte_letters().items()}
    out = {}
    for token, number in vocabulary.items():
        stem = token.removesuffix(WORD_END)
        if all(c in byte for c in stem):
            raw = bytes(byte[c] for c in stem)
            if _END not in raw or token == stem and len(raw) == 1:
                out[raw + _END if token != stem else raw] = number
    return out


class Chunks(dict):
    """Chunk (UTF-8) to packed ids, in two generations: entries of the older one are kept if they are used."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer, self.old = Tokenizer.from_file(path), {}
        with open(path, encoding="utf-8") as file:
            known = ranks(json.load(file)["model"]["vocab"])
        own = {v: k for k, v in known.items()}
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=known, special_tokens={})
        assert len(own) == len(known)

    def __missing__(self, chunk: bytes) -> bytes:
        packed = self.old.get(chunk)
        if packed is None:
            packed = self.encoded(chunk.decode())
        if len(chunk) <= 64:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[chunk] = packed
        return packed

    def encoded(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            ids = self.merges.encode_ordinary("\x00".join(_WORD.findall(text.lower())) + "\x00")
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


class WordBpe:
    def __init__(self, path: str):
        self.chunks = Chunks(path)

    def pack(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        raw = text.encode()
        if b"<|" not in raw:  # special tokens are written in lower case only
            raw = raw.lower()
        return b"".join(map(self.chunks.__getitem__, raw.split()))


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One tokenizer per path and Python worker."""
    return WordBpe(path)
