"""Words and word windows of Arrow text batches as arrays of 64-bit hashes.

A word's hash is a polynomial over random values of its bytes, read off prefix sums over the whole buffer, then mixed; a
window's hash is a polynomial over word hashes, mixed again. All arithmetic is modulo 2**64. Buffers are cut into pieces
of a few megabytes, so that memory does not depend on how long the texts of a batch are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20
#: Bytes that are hashed at a time, at some 40 bytes of memory each; a longer word is a span of its own.
SPAN_BYTES = 1 << 20

_U = np.uint64
_VALUES = np.random.default_rng(20_011).integers(0, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_ROOT = 0x9E3779B97F4A7C17
_WINDOW_ROOT = _U(0xD6E8FEB86659FD93)

SPACES = b" \t\n\x0b\x0c\r"
#: True for bytes of words when words are what stands between ASCII white space.
PLAIN = np.array([i not in SPACES for i in range(256)])
#: The same for words of letters, digits and non-ASCII characters.
ALNUM = np.array([48 <= i <= 57 or 65 <= i <= 90 or 97 <= i <= 122 or i >= 128 for i in range(256)])
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], dtype=np.uint8)

_powers: list[np.ndarray] = []


def _root_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.full(n, _U(root)) for root in (_ROOT, pow(_ROOT, -1, 1 << 64))]
        for p in _powers:
            p[0] = 1
            np.cumprod(p, out=p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@dataclass
class Words:
    """The words of some texts: ``first[i]:first[i + 1]`` are those of text i; start and end are bytes of data."""

    data: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def count(self, i: int) -> int:
        return int(self.first[i + 1] - self.first[i])

    def raw(self, lo: int, hi: int) -> list[bytes]:
        """The words lo to hi as bytes."""
        return [self.data[a:b].tobytes() for a, b in zip(self.start[lo:hi], self.end[lo:hi], strict=True)]


def words_of(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = PLAIN, lower: bool = False) -> Words:
    data = LOWER[data] if lower else data
    inside = letters[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    edges = offsets[(offsets >= 0) & (offsets < len(data))]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    hashes = np.empty(len(start), _U)
    lo = 0
    while lo < len(start):
        base = start[lo]
        hi = max(lo + 1, int(np.searchsorted(end, base + SPAN_BYTES, "right")))
        span = data[base : end[hi - 1]]
        up, down = _root_powers(max(len(span), SPAN_BYTES))
        sums = np.zeros(len(span) + 1, _U)
        np.cumsum(_VALUES[span] * up[: len(span)], out=sums[1:])
        a, b = start[lo:hi] - base, end[lo:hi] - base
        hashes[lo:hi] = mix((sums[b] - sums[a]) * down[a])
        lo = hi
    return Words(data, offsets, hashes, np.searchsorted(start, offsets), start, end)


def windows_of(hashes: np.ndarray, size: int, root: np.uint64 = _WINDOW_ROOT) -> np.ndarray:
    """The hash of every window of ``size`` entries."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    out = hashes[:n].copy()
    for j in range(1, size):
        out *= root
        out += hashes[j : j + n]
    return mix(out)


def text_array(column: pa.Array) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column, "") if column.null_count else column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text array without nulls and the offsets of its texts."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece has about PIECE_BYTES of text at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            used = part[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(part, used + PIECE_BYTES, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def words_of_column(column: pa.Array, letters: np.ndarray = PLAIN, lower: bool = False) -> Words:
    return words_of(*buffers(text_array(column)), letters, lower)


def owner_ends(words: Words) -> np.ndarray:
    """For every word, the index after the last word of its text."""
    return np.repeat(words.first[1:], np.diff(words.first))
