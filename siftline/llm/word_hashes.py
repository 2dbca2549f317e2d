"""Word boundaries and 64-bit word hashes of whole Arrow string arrays, computed with numpy.

A word is a run of UTF-8 bytes that are not separators. Its hash is a polynomial in an odd base modulo 2**64 over
its (lower-cased ASCII) bytes, read off a prefix sum, followed by an avalanche step: a few passes over the bytes
of a batch instead of a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
WHITE = b" \t\n\x0b\x0c\r"
#: ASCII white space and punctuation.
WHITE_AND_PUNCTUATION = WHITE + bytes(c for c in range(33, 127) if not chr(c).isalnum())


class Words(NamedTuple):
    """Parallel arrays, one entry a word; ``start`` and ``end`` are byte positions in ``data``."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    doc_start: np.ndarray
    doc_end: np.ndarray
    sums: np.ndarray
    inverse: np.ndarray

    def prefix_hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(is the word longer than ``n`` bytes, hash of its first ``n`` bytes), the latter of use only where so."""
        to = np.minimum(self.start + n, self.end)
        return self.end - self.start > n, mix((self.sums[to] - self.sums[self.start]) * self.inverse[self.start] + np.uint64(n))


_powers: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 21), base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        _powers[name] = table
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(first * np.uint64(0x9DDFEA08EB382D69) + second)


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and n + 1 offsets; null counts as empty."""
    texts = (texts.fill_null("") if texts.null_count else texts).cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), at


def word_batches(texts: pa.Array, separators: bytes = WHITE, chunk_bytes: int = 1 << 21, marks: bytes = b"") -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) of runs of whole texts of about ``chunk_bytes`` together.

    Runs of ``marks`` are words of their own. Memory follows the chunk or the longest single text, not the batch.
    """
    data, at = string_buffers(texts)
    kind = np.ones(256, np.uint8)
    kind[list(marks)] = 2
    kind[list(separators)] = 0
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + chunk_bytes, "right")) - 1
        last = min(max(last, first + 1), rows)
        part, offsets = data[at[first] : at[last]], at[first : last + 1] - at[first]
        n = len(part)
        kinds = kind[part]
        inside, changed = kinds > 0, np.ones(n + 1, bool)
        if n:
            changed[1:n] = kinds[1:] != kinds[:-1]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        edge |= changed
        starts, ends = np.flatnonzero(inside & edge[:-1]), np.flatnonzero(inside & edge[1:]) + 1
        power, inverse = _table("power", _BASE, n + 1), _table("inverse", _INVERSE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((lower[part].astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
        doc = np.searchsorted(offsets, starts, "right") - 1
        yield first, last, Words(doc, starts, ends, hashes, part, offsets[:-1], offsets[1:], sums, inverse)
        first = last
