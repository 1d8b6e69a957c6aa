"""Whole texts as flat byte arrays inside Arrow tasks: slices, words and 64-bit hashes.

A slice is a run of rows whose texts fill about ``SLICE`` bytes (a longer text makes a slice of
its own), so that the arrays of a task stay small however many rows a batch has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U64 = np.uint64


def _random_words(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64)


BYTE_VALUES = _random_words(7, 256)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes within the closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, small letters, beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word (splitmix64)."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = np.ones(1, _U64)
        self.down = np.ones(1, _U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE + (SLICE >> 1))
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                factors = np.full(size, base, _U64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=_U64))
        return self.up, self.down


_powers = _Powers()


#: Substrings of this many bytes are hashed byte by byte by a digest.
LONG = 256


class Rolling:
    """Hashes of any substrings of one slice, from prefix sums of a polynomial hash.

    Modulo 2**64 there are structured strings of equal sums (such as a Thue-Morse word of 1,024 letters and
    its complement), whatever the base. They have to be long, so long substrings get a keyed digest.
    """

    def __init__(self, data: np.ndarray) -> None:
        up, self._down = _powers.get(len(data) + 1)
        self._data = data
        self._sums = np.zeros(len(data) + 1, _U64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(_U64))
        for k in np.flatnonzero(end - start >= LONG).tolist():
            digest = hashlib.blake2b(self._data[start[k] : end[k]], digest_size=8).digest()
            out[k] = int.from_bytes(digest, "little")
        return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values, bounds


def slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch, each with the bytes of the named column and the offsets of its rows."""
    if not len(batch):
        return
    values, bounds = utf8(batch.column(batch.schema.get_field_index(name)))
    low = 0
    while low < len(batch):
        high = int(np.searchsorted(bounds, bounds[low] + SLICE, side="right")) - 1
        high = min(max(high, low + 1), len(batch))
        yield batch.slice(low, high - low), values[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


class Words:
    """Words of a slice: byte bounds, the row of each word and the first word of each row."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> None:
        inside = table[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        cuts = bounds[:-1][bounds[:-1] < len(data)]
        before[cuts] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[cuts[cuts > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(bounds) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.start)


def windows(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a row, and the index of their first word."""
    if len(words) < n:
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    last = len(words) - n + 1
    at = np.flatnonzero(words.row[:last] == words.row[n - 1 :])
    out = np.zeros(len(at), _U64)
    for k in range(n):
        out = mix(out + hashes[at + k] + _U64(k + 1))
    return out, at


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values between the bounds of each row."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]
