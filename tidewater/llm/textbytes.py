"""Texts of an Arrow batch as numpy arrays: words, their hashes, hashes of word windows.

A word is ``[^\\x20\\x09-\\x0D]+``. All loops are over batches, never over words.
A document is held whole in one task and needs some 60 bytes for each of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts handled together; a longer text is a chunk of its own

_U = np.uint64
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so they have inverses

IS_WORD_BYTE = np.ones(256, dtype=bool)
IS_WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the table is kept and grows by doubling."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(1024, 1 << int(n).bit_length())
        table = np.full(size, base, dtype=_U)
        table[0] = 1
        table = np.cumprod(table, dtype=_U)
        if size <= 1 << 22:
            _powers[base] = table
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole value (a bijection)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def hash_runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of ``values``; the runs are adjacent and cover them all."""
    if not len(starts):
        return np.empty(0, dtype=_U)
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    table = powers(_BASE, int(lengths.max()))
    sums = np.add.reduceat((values.astype(_U) + _U(1)) * table[place], starts)
    return mix(sums ^ (lengths.astype(_U) << _U(40)))


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of groups of rows with about ``limit`` bytes."""
    data, offsets = string_buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, stop, data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


@dataclass
class Words:
    """Words of a chunk: byte ranges, and where each document's words begin (n + 1 entries)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        kept = self.data[IS_WORD_BYTE[self.data]]
        return hash_runs(kept, np.cumsum(lengths) - lengths, lengths)


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = IS_WORD_BYTE) -> Words:
    """Words of each document of a chunk; documents end words even without white space."""
    word = inside[data]
    before = np.empty_like(word)
    before[:1], before[1:] = False, word[:-1]
    after = np.empty_like(word)
    after[-1:], after[:-1] = False, word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets), data)


def window_hashes(word_hashes: np.ndarray, first: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k consecutive words of one document, and the place of
    each window's first word in the chunk. ``seed`` gives independent families."""
    n = len(word_hashes)
    if n < k:
        return np.empty(0, _U), np.empty(0, np.int64)
    base = (_WORD_BASE + 2 * seed * 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF
    values = mix(word_hashes + _U(seed)) if seed else word_hashes
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum(values * powers(base, n), out=sums[1:])
    back = powers(pow(base, -1, 1 << 64), n - k + 1)
    hashes = (sums[k:] - sums[:-k]) * back
    room = np.repeat(first[1:], np.diff(first))[: n - k + 1] - np.arange(n - k + 1)
    at = np.flatnonzero(room >= k)
    return mix(hashes[at]), at
