"""Arrow batches as flat NumPy arrays: whole texts, their words, and hashes of any substring."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step works on; a longer text makes a step of its own.
STEP_BYTES = 2 << 20

#: The multiplier of the substring hash and the constants of the 64-bit finaliser.
MULTIPLIER = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: The bytes between words.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SEPARATOR = np.isin(np.arange(256), SEPARATORS)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    ups = np.cumprod(np.full(size, MULTIPLIER, np.uint64))
    downs = np.cumprod(np.full(size, pow(MULTIPLIER, -1, 1 << 64), np.uint64))
    return ups, downs


class SubstringHash:
    """Hashes of substrings of one sequence that do not depend on where the substring stands."""

    def __init__(self, symbols: np.ndarray):
        size = 1 << max(16, int(len(symbols)).bit_length())
        ups, self._downs = _powers(size)
        self._sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(ups[: len(symbols)] * (symbols.astype(np.uint64) + np.uint64(1)), out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._downs[starts])

    def windows(self, length: int) -> np.ndarray:
        """The hash of every window of so many symbols, by its start."""
        count = max(0, len(self._sums) - length)
        return mix((self._sums[length:] - self._sums[:count]) * self._downs[:count])


class Texts(NamedTuple):
    """UTF-8 bytes of a run of texts, one after the other; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    def owner(self) -> np.ndarray:
        """The text of each byte."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])


def steps(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batches cut into runs of rows with about ``limit`` bytes of text in ``column``."""
    for batch in batches:
        texts = texts_of(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(texts.bounds, texts.bounds[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            low, high = texts.bounds[first], texts.bounds[last]
            yield batch.slice(first, last - first), Texts(texts.data[low:high], texts.bounds[first : last + 1] - low)
            first = last


class Words(NamedTuple):
    """Words of a run of texts: byte places, hash, and for each text its first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words_of(texts: Texts, substring: SubstringHash | None = None) -> Words:
    """Maximal runs of bytes other than white space; no word crosses texts."""
    inside = ~IS_SEPARATOR[texts.data]
    edges = texts.bounds[:-1][np.diff(texts.bounds) > 0]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[edges] = inside[edges]
    closes[:-1] &= ~inside[1:]
    lasts = texts.bounds[1:][np.diff(texts.bounds) > 0] - 1
    closes[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = (substring or SubstringHash(texts.data))(starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, texts.bounds, "left"))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def binary_column(data: np.ndarray, bounds: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Flat bytes and bounds as a binary (or text) column without copying each value."""
    data, bounds = np.ascontiguousarray(data, np.uint8), np.ascontiguousarray(bounds, np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return column.cast(kind or pa.binary())
