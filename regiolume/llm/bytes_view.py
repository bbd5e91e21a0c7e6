"""Texts of an Arrow column as one array of bytes, in slices of bounded size, and their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
#: Per byte: A-Z become a-z, nothing else changes.
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Per byte: part of a word, words being what stands between ``[\x20\x09-\x0D]``.
NOT_BLANK = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
#: Random numbers for the bytes and an odd base for the rolling hash of words, from a fixed seed.
_RANDOM = np.random.default_rng(20_240_601).integers(1, 2**63, 258, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RANDOM[256])
_POWERS: list[np.ndarray] = []


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows; NULL rows are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``most`` bytes (one row, if it is longer): first row, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, ...]:
    """Starts and ends of the words, and the row of each; a word never spans two rows."""
    inside = in_word[data]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    firsts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[firsts] = inside[firsts]
    finish[lasts] = inside[lasts]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(offsets, starts, side="right") - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        back = np.uint64(pow(_BASE, -1, 2**64))
        _POWERS[:] = []
        for base in (np.uint64(_BASE), back):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of a polynomial in a random value for each byte, up to every place."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_RANDOM[:256][data] * _powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of byte ranges; equal ranges have equal hashes wherever they stand."""
    sums = prefix_sums(data) if sums is None else sums
    back = _powers(len(data) + 1)[1]
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
