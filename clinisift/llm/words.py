"""Words of whole texts as 64-bit numbers, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: UTF-8 bytes of text that are worked on at once.
CHUNK_BYTES = 1 << 20
_rng = np.random.default_rng(20240229)
_LETTER = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the 64-bit numbers spread over all bits (a one-to-one map)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Table(list):
    """A table that each process fills for itself: it travels empty with the functions that use it."""

    def __reduce__(self):
        return _Table, ()


_powers = _Table()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


_SPACE, _OTHER = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_OTHER[:128] = [not chr(b).isalpha() for b in range(128)]


def separators(data: np.ndarray, letters: bool = False) -> np.ndarray:
    """Bytes between words: white space, or with ``letters`` every ASCII byte that is no letter."""
    return (_OTHER if letters else _SPACE)[data]


def word_hashes(data: np.ndarray, breaks: np.ndarray, letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word in UTF-8 bytes, A-Z as a-z; no word crosses a place in ``breaks``."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~separators(data, letters)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    breaks = breaks[(breaks > 0) & (breaks < len(data))]
    first[breaks] = inside[breaks]
    starts = np.flatnonzero(first)
    up, down = powers(len(data) + 1)
    sums = np.cumsum(np.where(inside, _LETTER[data] * up[:len(data)], np.uint64(0)), dtype=np.uint64)
    ends = np.r_[starts[1:], len(data)] - 1  # separators add nothing
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mixed((sums[ends] - before) * down[starts]), starts


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row limits of a string column; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    limits = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[limits[0]:limits[-1]] if len(limits) else data[:0], limits - (limits[0] if len(limits) else 0)


def chunks(limits: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a longer text is a range of its own."""
    start, n = 0, len(limits) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(limits, limits[start] + size, side="right")) - 1)
        yield start, end
        start = end


def row_words(column: pa.Array, letters: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and word hashes, in order, of each text of a string column."""
    data, limits = texts_of(column)
    for start, end in chunks(limits):
        at, stop = limits[start], limits[end]
        if end == start + 1 and stop - at > CHUNK_BYTES:
            yield start, np.concatenate([*_long_words(data[at:stop], letters)])
            continue
        hashes, places = word_hashes(data[at:stop], limits[start:end] - at, letters)
        cuts = np.searchsorted(places, limits[start + 1:end] - at)
        yield from enumerate(np.split(hashes, cuts), start)


def _long_words(data: np.ndarray, letters: bool) -> Iterator[np.ndarray]:
    """Hashes of a long text, read in pieces that end at separators."""
    at = 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        if end < len(data):
            found = np.flatnonzero(separators(data[at:end]))
            while not len(found) and end < len(data):
                wide = min(len(data), end + CHUNK_BYTES)
                later = np.flatnonzero(separators(data[end:wide]))
                if len(later):
                    found, end = later[:1] + (end - at), end + int(later[0]) + 1
                else:
                    end = wide
            if len(found) and end < len(data):
                end = at + int(found[-1]) + 1
        yield word_hashes(data[at:end], np.empty(0, np.int64), letters)[0]
        at = end
