"""Benchmark decontamination by SimHash of item-sized windows.

A window of a document has as many words as an item.  Its 128-bit SimHash is looked up in
a multi-index: 8 blocks of 16 bits, and since two fingerprints within RADIUS bits differ
in at most RADIUS // 8 bits of some block, probing each block with that many flips finds
all of them.  What is found is verified exactly: the share of the item's five-word
shingles, each weighing as often as it occurs, that the window has, must be SIMILARITY.
Bits of a shingle that an item repeats move together, so its windows may lie further off
than RADIUS; such items are verified against every window that holds enough shingles.

Windows that cannot pass are never fingerprinted: one that is similar enough holds at
least that share of positions whose shingle belongs to an item of its size, so the
others are left out by a look at the shingles, without loss.

The benchmark is the query set and is taken in blocks of BLOCK_ITEMS items, each
shipped to the tasks; the documents are never shuffled.

Words are runs of letters and digits, A-Z as a-z, so that punctuation does not hide a
passage.  Edge cases: items of fewer than five words cannot be told from prose and match
nothing, like null and empty ones; null and short texts match nothing; equal items each
report; repeated rows report again; other columns, of any name, pass through `drop_contaminated`.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.bytewords import Words, mix, slices, words_of
from perfmart.llm.shared import plain_names

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 8, 16
#: A similarity of 0.8 is an angle of 37 degrees, 26 of 128 bits; three standard deviations more are 39.
RADIUS = 39
BLOCK_ITEMS = 20_000
FILTER_BITS = 22
SALTS = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)

MATCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)


def needed(shingles: int) -> int:
    """Shingles of an item of so many that a window must share."""
    return int(np.ceil(SIMILARITY * shingles - 1e-9))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """128 bits for each hash, as a row of bytes 0 and 1."""
    both = np.stack([mix(hashes, salt) for salt in SALTS], axis=1)
    return np.unpackbits(both.view(np.uint8), axis=1, bitorder="little")


def _packed(ones: np.ndarray, shingles: int) -> np.ndarray:
    """Fingerprints as rows of BLOCKS 16-bit blocks."""
    return np.packbits(ones * 2 > shingles, axis=1, bitorder="little").view(np.uint16)


def flips(bits: int, most: int) -> np.ndarray:
    """All masks of at most `most` of `bits` bits."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint16)


@dataclass(frozen=True)
class Index:
    """A block of items: the shingles with the sizes of their items, and the multi-index."""

    ids: list[list[int]]
    shingles: list[Counter]
    sizes: np.ndarray
    fingerprints: np.ndarray
    keys: np.ndarray
    key_sizes: list[np.ndarray]
    filter: np.ndarray
    members: list[np.ndarray]
    starts: list[np.ndarray]
    probes: np.ndarray
    #: By size the items with a shingle that occurs more than once.
    repeating: dict[int, np.ndarray]

    def near(self, fingerprint: np.ndarray, size: int) -> np.ndarray:
        """Items of a size within RADIUS bits, and those that the radius says nothing about."""
        found = []
        for b in range(BLOCKS):
            values = (fingerprint[b] ^ self.probes).astype(np.int64)
            low, high = self.starts[b][values], self.starts[b][values + 1]
            found += [self.members[b][i:j] for i, j in zip(low[high > low], high[high > low], strict=True)]
        items = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        items = items[self.sizes[items] == size]
        apart = np.bitwise_count(self.fingerprints[items] ^ fingerprint).sum(axis=1)
        return np.union1d(items[apart <= RADIUS], self.repeating.get(size, items[:0]))

    def marked(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose shingle an item has, and the shingle's number."""
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[key] == hashes[at]
        return at[same], key[same]


def _shingle_counts(found: Words, first: int, size: int) -> Counter:
    ws = [found.word(i) for i in range(first, first + size)]
    return Counter(tuple(ws[i : i + SHINGLE]) for i in range(size - SHINGLE + 1))


def build_index(items: list[tuple[int, str | None]]) -> Index | None:
    """The index of (item_id, text) pairs; None if no item has SHINGLE words."""
    texts: dict[bytes, tuple[Words, list[int]]] = {}
    for item_id, text in items:
        raw = (text or "").encode()
        found = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if len(found.start) >= SHINGLE:
            texts.setdefault(b" ".join(found.word(i) for i in range(len(found.start))), (found, []))[1].append(item_id)
    if not texts:
        return None
    sizes_of: dict[int, set[int]] = defaultdict(set)
    prints, counts, sizes = [], [], []
    for found, _ in texts.values():
        hashes, size = found.runs(SHINGLE)[0], len(found.start)
        for h in hashes.tolist():
            sizes_of[h].add(size)
        prints.append(_packed(_bits(hashes).sum(axis=0, dtype=np.int64)[None, :], len(hashes))[0])
        counts.append(_shingle_counts(found, 0, size))
        sizes.append(size)
    keys = np.array(sorted(sizes_of), np.uint64)
    table = np.zeros(1 << FILTER_BITS, bool)
    table[keys >> np.uint64(64 - FILTER_BITS)] = True
    fingerprints = np.stack(prints)
    members = [np.argsort(fingerprints[:, b], kind="stable") for b in range(BLOCKS)]
    starts = [np.searchsorted(fingerprints[members[b], b].astype(np.int64), np.arange((1 << BLOCK_BITS) + 1)) for b in range(BLOCKS)]
    repeating: dict[int, list[int]] = defaultdict(list)
    for item, (size, of_item) in enumerate(zip(sizes, counts, strict=True)):
        if max(of_item.values()) > 1:
            repeating[size].append(item)
    return Index(
        [ids for _, ids in texts.values()],
        counts,
        np.array(sizes),
        fingerprints,
        keys,
        [np.array(sorted(sizes_of[k])) for k in keys.tolist()],
        table,
        members,
        starts,
        flips(BLOCK_BITS, RADIUS // BLOCKS),
        {size: np.array(items, np.int64) for size, items in repeating.items()},
    )


def window_starts(positions: np.ndarray, size: int, first: int, end: int) -> np.ndarray:
    """Starts of windows of `size` words within [first, end) that hold enough of the shingle positions."""
    span, need = size - SHINGLE, needed(size - SHINGLE + 1)
    if len(positions) < need:
        return np.empty(0, np.int64)
    low = np.maximum(positions[need - 1 :] - span, first)
    high = np.minimum(positions[: len(positions) - need + 1], end - size)
    runs = [np.arange(a, b + 1) for a, b in zip(low, high, strict=True) if a <= b]
    return np.unique(np.concatenate(runs)) if runs else np.empty(0, np.int64)


def find(found: Words, index: Index) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first word in the row, words): each row's best window for each item that it holds."""
    hashes, whole = found.runs(SHINGLE)
    if not len(hashes):
        return
    at, key = index.marked(hashes)
    at, key = at[whole[at]], key[whole[at]]
    if not len(at):
        return
    row = np.searchsorted(found.bounds, at, "right") - 1
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for r, p, k in zip(row.tolist(), at.tolist(), key.tolist(), strict=True):
        for size in index.key_sizes[k].tolist():
            places[r, size].append(p)
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for (r, size), positions in places.items():
        first, end = int(found.bounds[r]), int(found.bounds[r + 1])
        begins = window_starts(np.array(positions), size, first, end)
        if not len(begins):
            continue
        shingles = size - SHINGLE + 1
        for part in np.split(begins, np.flatnonzero(np.diff(begins) > shingles) + 1):
            low, high = int(part[0]), int(part[-1]) + shingles
            sums = np.vstack([np.zeros((1, 128), np.int64), _bits(hashes[low:high]).cumsum(axis=0, dtype=np.int64)])
            prints = _packed(sums[part - low + shingles] - sums[part - low], shingles)
            for begin, fingerprint in zip(part.tolist(), prints, strict=True):
                counts = None
                for item in index.near(fingerprint, size).tolist():
                    counts = counts or _shingle_counts(found, begin, size)
                    share = sum((counts & index.shingles[item]).values()) / shingles
                    if share >= SIMILARITY - 1e-9 and share > best.get((r, item), (0.0, 0))[0]:
                        best[r, item] = (share, begin - first)
    for (r, item), (share, begin) in sorted(best.items()):
        yield r, item, share, begin, int(index.sizes[item])


def _blocks(benchmark: DataFrame, block_items: int) -> Iterator[Index]:
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    parts = max(1, -(-items.count() // block_items))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        index = build_index([(r["item_id"], r["text"]) for r in rows])
        if index is not None:
            yield index


def contaminations(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """A row for each document and item that it contains: similarity and place of the best window."""
    out = docs.sparkSession.createDataFrame([], MATCHES)
    for index in _blocks(benchmark, block_items):

        def search(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for data, offsets, first_row in slices(batch.column(1)):
                    for r, item, share, begin, size in find(words_of(data, offsets, first_row), index):
                        doc_id = batch.column(0)[first_row + r].as_py()
                        rows += [(doc_id, item_id, share, begin, size) for item_id in index.ids[item]]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], MATCHES.names)

        out = out.unionByName(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, MATCHES))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns."""
    plain, restored = plain_names(docs, ("doc_id", "text"))
    at = docs.columns.index("text")
    for index in _blocks(benchmark, block_items):

        def keep(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for data, offsets, first_row in slices(batch.column(at)):
                    for r, *_ in find(words_of(data, offsets, first_row), index):
                        clean[first_row + r] = False
                yield batch.filter(pa.array(clean))

        plain = plain.mapInArrow(keep, plain.schema)
    return restored(plain)
