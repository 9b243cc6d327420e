"""Numbers packed into binary values, so that shuffles carry few and small rows."""

from __future__ import annotations

import numpy as np
import zstandard

_LEVEL = 1


def pack(values: np.ndarray) -> bytes:
    """One array as compressed byte planes, in which small numbers cost little."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T if len(values) else np.empty(0, np.uint8)
    return zstandard.compress(planes.tobytes(), _LEVEL)


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """An ascending array, as differences."""
    return pack(np.diff(values, prepend=values[:1] * 0))


def unpack_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    if not len(ordered):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(starts, append=total)


def slices(keys: np.ndarray):
    """(key, from, to) of each run of a sorted array of keys."""
    at = runs(keys)
    return zip(keys[at].tolist(), at.tolist(), [*at[1:].tolist(), len(keys)])
