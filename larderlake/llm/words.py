"""Words of whole texts as 64-bit hashes, found on Arrow's own buffers, many texts at a time.

A word is a run of word bytes. Every byte of a multi-byte UTF-8 character counts as a word byte, so
runs of bytes are the same as runs of code points outside the ASCII separators.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; a longer text is a chunk of its own.
CHUNK = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WINDOW = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; a bijection."""
    x = np.asarray(x, dtype=np.uint64).copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


class Alphabet:
    """Which bytes belong to words, and a random value for each; upper case counts as lower case."""

    def __init__(self, separators: set[int]):
        codes = np.arange(256)
        self.is_word = ~np.isin(codes, list(separators))
        lower = np.where((codes >= 0x41) & (codes <= 0x5A), codes + 32, codes)
        values = mix(lower.astype(np.uint64) + np.uint64(0x51ED27))
        self.values = np.where(self.is_word, values, np.uint64(0))


#: Letters, digits and everything outside ASCII.
LETTERS = Alphabet(set(range(0x80)) - set(range(0x30, 0x3A)) - set(range(0x41, 0x5B)) - set(range(0x61, 0x7B)))
#: Everything but ASCII white space.
VISIBLE = Alphabet({0x20, *range(0x09, 0x0E)})


class Words(NamedTuple):
    """Words of consecutive texts. Those of text i are ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def text(self, first: int, last: int) -> list[str]:
        """Words ``first:last`` themselves, A-Z in lower case."""
        return [lower_ascii(bytes(self.data[self.starts[i] : self.ends[i]])).decode() for i in range(first, last)]


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lower_ascii(data: bytes) -> bytes:
    return data.translate(_LOWER)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as they were needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            size = max(n, CHUNK + 1)
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down


_POWERS = _Powers()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets between them; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    found = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return found[ends[0] : ends[-1]], ends - ends[0]


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about CHUNK bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    """All words of consecutive texts."""
    n = len(data)
    inside = alphabet.is_word[data]
    before, after = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    before[:1], before[1:] = False, inside[:-1]
    after[-1:], after[:-1] = False, inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    before[edges], after[edges - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _POWERS.get(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(alphabet.values[data] * up, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Words(hashes, np.searchsorted(starts, offsets).astype(np.int64), starts, ends, data, offsets)


def hashed_words(texts: pa.Array, alphabet: Alphabet) -> Iterator[tuple[int, Words]]:
    """Words of a column, chunk by chunk, with the row the chunk begins at."""
    data, offsets = buffers(texts)
    for first, last in chunks(offsets):
        part = offsets[first : last + 1]
        yield first, words(data[part[0] : part[-1]], part - part[0], alphabet)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words, across texts; order counts."""
    n = max(0, len(hashes) - size + 1)
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= _WINDOW
        out += hashes[i : n + i]
    return mix(out + np.uint64(size))


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte, and after the last."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
