"""Words and word hashes of many texts at once, from the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are handled in slices of about this many bytes, which bounds a task's memory; a longer text is one slice.
SLICE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each byte: whether it belongs to a word, and its lower case.  Bytes from 128 up are parts of letters."""
    codes = np.arange(256)
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint8)
    inside = (codes >= 128) | ((lower >= 97) & (lower <= 122)) | ((codes >= 48) & (codes <= 57))
    return inside, lower


INSIDE, LOWER = _tables()


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The finalizer of SplitMix64 over x + salt."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(salt)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass(frozen=True)
class Words:
    """The words of a slice of rows: bytes in lower case, bounds and hashes of the words, and each row's range of words."""

    first_row: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each run of k words, and whether the run lies inside one row."""
        n = len(self.hash)
        if n < k:
            return np.empty(0, np.uint64), np.empty(0, bool)
        out = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            out = out * BASE + self.hash[i : n - k + 1 + i]
        whole = np.ones(len(out), bool)
        for back in range(1, k):
            cut = self.bounds[1:] - back
            whole[cut[(cut >= 0) & (cut < len(out))]] = False
        return mix(out), whole

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def words_of(data: np.ndarray, offsets: np.ndarray, first_row: int = 0, inside_word: np.ndarray = INSIDE) -> Words:
    """Words of the rows data[offsets[i]:offsets[i+1]]: maximal runs of letters and digits, A-Z as a-z.

    `inside_word` says for each byte whether it belongs to a word, for words of another kind.
    """
    low, high = int(offsets[0]), int(offsets[-1])
    data, offsets = LOWER[data[low:high]], offsets - low
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(first_row, data, none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    inside = inside_word[data]
    before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts], after[cuts - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    # A prefix polynomial modulo 2^64; a word's part of it, divided by the power at its start.
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)))
    prior = np.where(start > 0, sums[start - 1], np.uint64(0))
    hashes = mix((sums[end - 1] - prior) * _powers(BASE_INVERSE, len(data))[start])
    return Words(first_row, data, start, end, hashes, np.searchsorted(start, offsets))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; a null has none."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), bounds.astype(np.int64)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The column in slices of whole rows: (bytes, offsets, first row)."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    at = 0
    while at < len(offsets) - 1:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), len(offsets) - 1)
        yield data, offsets[at : to + 1], at
        at = to
