"""Words of an Arrow text column as arrays: bounds, owning row and 64-bit hash, no Python object per word.

A word is a maximal run of bytes that a 256-entry table marks, within one row.
Its hash mixes eight bytes at a time: words of up to eight bytes never collide
with each other for equal lengths, others as rarely as random 64-bit values.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text handled at once; a single longer row is handled alone
CHUNK = 4 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: masks for the first 0 to 8 bytes of a little-endian word
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

#: A-Z to a-z, everything else as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _table(separators) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


#: words [^\x20\x09-\x0D]+
NOT_SPACE = _table([(0x20, 0x20), (0x09, 0x0D)])
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: words between single blanks
NOT_BLANK = _table([(0x20, 0x20)])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@dataclass
class Words:
    data: np.ndarray  # bytes of all rows
    offsets: np.ndarray  # row i has data[offsets[i]:offsets[i + 1]]
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # row i has the words first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight bytes at a time."""
        lengths = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 1, "<u8", padded.data, strides=(1,))
        h = mix((eight[self.start] & _FIRST[np.minimum(lengths, 8)]) ^ (lengths.astype(np.uint64) * _SPREAD))
        some, done = np.flatnonzero(lengths > 8), 8
        while len(some):
            block = eight[self.start[some] + done] & _FIRST[np.minimum(lengths[some] - done, 8)]
            h[some] = mix((h[some] * _SPREAD) ^ block)
            done += 8
            some = some[lengths[some] > done]
        return h

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets, from 0."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, cut: np.ndarray | None = None) -> Words:
    """Words of a text: runs of bytes with ``inside``; ``cut`` marks bytes that begin a new word besides."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(data, offsets, empty, empty, np.zeros(len(offsets), np.int64))
    edge = np.zeros(n + 1, bool)  # True where the byte doesn't continue the byte before
    edge[offsets] = True
    if cut is not None:
        edge[:n] |= cut
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def words(column: pa.Array, table: np.ndarray, lower: bool = True) -> Words:
    data, offsets = buffers(column)
    if lower:
        data = LOWER[data]
    return bounds(data, offsets, table[data])


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``size`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place where each comes first, and for every key its number among them."""
    import pandas as pd

    codes, unique = pd.factorize(keys)
    first = np.zeros(len(unique), np.int64)
    first[codes[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return unique, first, codes


class HashCache:
    """Values of hashes seen so far, as arrays sorted by hash; emptied when it holds more than ``most``."""

    def __init__(self, most: int = 1_000_000):
        self.most, self.keys, self.at = most, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key's value, -1 if not seen."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, self.at[i], -1)

    def add(self, keys: np.ndarray, at: np.ndarray) -> None:
        keys, at = np.concatenate([self.keys, keys]), np.concatenate([self.at, at])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at = keys[order], at[order]
