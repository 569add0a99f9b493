"""Hashed subwords (byte n-grams) of whole texts, and a sample's texts for training on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLANK = 32
#: Odd 64-bit multipliers, one for each length of n-gram.
FACTORS = {3: 0x9E3779B97F4A7C15, 4: 0xC2B2AE3D27D4EB4F}


def byte_table(keep: str, fold_case: bool) -> np.ndarray:
    """Bytes as they count in n-grams: those of `keep`, letters and parts of letters; all others are blanks."""
    codes = np.arange(256)
    letter = ((codes >= 65) & (codes <= 90)) | ((codes >= 97) & (codes <= 122)) | (codes >= 128) | np.isin(codes, [ord(c) for c in keep])
    folded = np.where((codes >= 65) & (codes <= 90), codes + 32, codes) if fold_case else codes
    return np.where(letter, folded, BLANK).astype(np.uint8)


@dataclass(frozen=True)
class Grams:
    """Buckets of all n-grams of some rows, with the row bounds."""

    buckets: np.ndarray
    bounds: np.ndarray

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct buckets of a row and their shares."""
        ids, counts = np.unique(self.buckets[self.bounds[i] : self.bounds[i + 1]], return_counts=True)
        return ids, (counts / max(1, counts.sum())).astype(np.float32)

    def means(self, table: np.ndarray) -> np.ndarray:
        """For each row the mean of its n-grams' rows in `table`; zero for a row without any."""
        sums = np.zeros((len(self.bounds) - 1, table.shape[1]))
        size = np.diff(self.bounds)
        some = np.flatnonzero(size)
        if len(some):
            for k in range(table.shape[1]):
                sums[some, k] = np.add.reduceat(table[:, k][self.buckets], self.bounds[some])
        return sums / np.maximum(size, 1)[:, None]


def grams(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, bits: int) -> Grams:
    """N-grams of 3 and 4 bytes whose inner bytes are no blanks, hashed to 2^bits buckets.

    Every row is set between blanks, so that the begin and end of a word show.
    """
    lengths = np.diff(offsets)
    n = len(lengths)
    padded = np.full(int(offsets[-1] - offsets[0]) + 2 * n, BLANK, np.uint8)
    inside = np.ones(len(padded), bool)
    edges = np.cumsum(lengths + 2)
    inside[edges - 1] = False
    inside[edges - lengths - 2] = False
    padded[inside] = table[data[offsets[0] : offsets[-1]]]
    solid = padded != BLANK
    code = padded.astype(np.uint32)
    three = code[:-2] | code[1:-1] << np.uint32(8) | code[2:] << np.uint32(16)
    at3 = np.flatnonzero(solid[1:-1])
    at4 = np.flatnonzero(solid[1:-2] & solid[2:-1])
    shift = np.uint64(64 - bits)
    b3 = (three[at3].astype(np.uint64) * np.uint64(FACTORS[3])) >> shift
    b4 = ((three[at4] | code[at4 + 3] << np.uint32(24)).astype(np.uint64) * np.uint64(FACTORS[4])) >> shift
    at = np.r_[at3, at4]
    order = np.argsort(at, kind="stable")
    begins = np.r_[0, edges]
    return Grams(np.r_[b3, b4][order].astype(np.int32), np.searchsorted(at[order], begins))
