"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints are 64 bits; those at a Hamming distance of at most RADIUS are linked, and
linked documents form a group.  The index sorts fingerprints by Gray rank, so that
neighbours share bits, and keeps for each node of a tree the bits that all fingerprints
below it share.  A search adds up the differences on shared bits from the root down and
drops a whole node as soon as they exceed the radius.

The top of the tree is dealt over the cluster.  Two fingerprints within a radius of 3
agree in at least one of 4 blocks of 16 bits, so each is sent to its 4 top nodes (block,
value), and all further search stays inside a top node.  A top node with far more than its
share is dealt once more by the blocks of its remaining bits, which is exact for the same
reason.  Inside a node only a spanning forest of the links is emitted, never all pairs.

Edge cases: a text without words (null, empty, blank) has fingerprint zero and is linked
to others like any other; equal fingerprints count once in the search, whatever the number
of their documents; null ids never become a group's id unless the group has no other; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.components import components
from perfmart.llm.shared import plain_names, staged

RADIUS = 3
SHINGLE = 3
SEED = 42
BLOCKS = RADIUS + 1
BLOCK_BITS = 64 // BLOCKS
LEAF = 32
FAN = 16
#: A top node is dealt again beyond this many fingerprints plus HOT_SHARE times its share.
HOT_ROWS = 4096
HOT_SHARE = 8
#: Pairs of queries and fingerprints looked at in one step.
STEP = 1 << 20


def fingerprint(text: str | None) -> int:
    """The SimHash of a text's word shingles: a bit is set if over half of the hashes have it."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and exactly the six blanks.
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*[found[i:] for i in range(SHINGLE)], strict=False)
    hashes = np.fromiter((digest(join(run), SEED) for run in runs), np.uint64, len(found) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255 * 64):  # sums of 255 bits fit in a byte
        bits = np.unpackbits(hashes[at : at + 255 * 64].view(np.uint8), bitorder="little").reshape(-1, 64)
        whole = len(bits) // 255 * 255
        ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """`docs` with `_fp`, the fingerprint as a signed 64-bit integer."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = docs_columns.index("text")
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column(at)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], [*docs_columns, "_fp"])

    docs_columns = docs.columns
    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("_fp", T.LongType())]))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The position of each code word in the reflected Gray code; wide ones have a column for every 64 bits."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    if x.ndim == 2:
        for k in range(1, x.shape[1]):  # after an odd number of ones the code runs backwards
            x[:, k] ^= np.uint64(0) - (x[:, k - 1] & np.uint64(1))
    return x


def bits_set(x: np.ndarray) -> np.ndarray:
    """Set bits of each code word, wide ones included."""
    return np.bitwise_count(x) if x.ndim == 1 else np.bitwise_count(x).sum(axis=1, dtype=np.int64)


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] and b[i]: every label is the least index of its set."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def gray_index(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels from the leaves up: for each node the mask of shared bits, their pattern, and its end."""
    both, any_, ends = x, x, np.arange(1, len(x) + 1)
    levels, width = [], LEAF
    while True:
        starts = np.arange(0, len(both), width)
        both, any_ = np.bitwise_and.reduceat(both, starts, axis=0), np.bitwise_or.reduceat(any_, starts, axis=0)
        ends = ends[np.minimum(starts + width, len(ends)) - 1]
        levels.append((~(any_ ^ both), both, ends))
        if len(both) <= FAN:
            return levels
        width = FAN


def forest(x: np.ndarray, radius: int, may: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """For fingerprints in Gray order: the least position that each is linked with, over any number of steps.

    Queries descend together.  Only later positions are looked at, so that a pair meets once.
    Of the pairs within the radius `may`, if given, tells which count.
    """
    label = np.arange(len(x))
    levels = gray_index(x)
    tops = np.arange(len(levels[-1][0]))
    chunk = max(1, STEP // (LEAF * len(tops)))
    for at in range(0, len(x), chunk):
        query = np.arange(at, min(len(x), at + chunk))
        work = [(len(levels) - 1, np.repeat(query, len(tops)), np.tile(tops, len(query)))]
        while work:
            depth, q, node = work.pop()
            if len(q) > (STEP if depth < 0 else STEP // LEAF):
                half = len(q) // 2
                work += [(depth, q[:half], node[:half]), (depth, q[half:], node[half:])]
                continue
            if depth < 0:
                near = (node > q) & (bits_set(x[q] ^ x[node]) <= radius)
                if may is not None:
                    near &= may(q, node)
                label = merged(label, q[near], node[near])
                continue
            mask, pattern, ends = levels[depth]
            near = (ends[node] > q + 1) & (bits_set((x[q] ^ pattern[node]) & mask[node]) <= radius)
            q, node = q[near], node[near]
            if not len(q):
                continue
            width = FAN if depth else LEAF
            below = len(levels[depth - 1][0]) if depth else len(x)
            child = (node[:, None] * width + np.arange(width)).ravel()
            q = np.repeat(q, width)
            work.append((depth - 1, q[child < below], child[child < below]))
    return label


def _linked(block: np.ndarray, fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, one of its set) inside each group of a partition's rows."""
    # The block of the group leads, so that Gray order keeps a group's rows together.
    turn = (block * BLOCK_BITS).astype(np.uint64)
    turned = np.where(turn == 0, fp, (fp << turn) | (fp >> ((np.uint64(64) - turn) % np.uint64(64))))
    order = np.lexsort((gray_rank(turned), group))
    x, group = turned[order], group[order]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    root = np.arange(len(x))
    small = np.repeat(sizes <= LEAF, sizes)
    for step in range(1, int(min(LEAF, sizes.max(initial=1)))):  # a group that is one leaf
        a = np.flatnonzero(small[:-step] & (group[step:] == group[:-step]) & (np.bitwise_count(x[step:] ^ x[:-step]) <= radius))
        root = merged(root, a, a + step)
    for start, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF], strict=True):
        root[start : start + size] = start + forest(x[start : start + size], radius)
    moved = np.flatnonzero(root != np.arange(len(x)))
    return fp[order][moved], fp[order][root[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Links (node, parent) that connect all fingerprints within the radius, from distinct `_fp`."""
    if radius > RADIUS:
        raise ValueError(f"the blocks guarantee a radius of {RADIUS} at most")
    blocks = F.explode(F.array(*[F.lit(i) for i in range(BLOCKS)]))
    dealt = distinct.select("_fp", blocks.alias("_block")).withColumn(
        "_value", F.expr(f"shiftrightunsigned(_fp, {64 - BLOCK_BITS} - _block * {BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1}")
    )
    # At most BLOCKS * 2^BLOCK_BITS / HOT_SHARE top nodes can hold so much more than their share.
    limit = hot_rows + HOT_SHARE * (distinct.count() >> BLOCK_BITS)
    hot = staged(dealt.groupBy("_block", "_value").count().filter(F.col("count") > limit).select("_block", "_value"), "hot-nodes")
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    rest = 64 - BLOCK_BITS
    part = rest // BLOCKS
    # The bits besides the block, as one number, in BLOCKS parts; -1 stands for an undivided node.
    others = f"((_fp << ({BLOCK_BITS} * (_block + 1) % 64)) | CASE WHEN _block = {BLOCKS - 1} THEN 0L ELSE shiftrightunsigned(_fp, 64 - {BLOCK_BITS} * (_block + 1)) END)"
    keyed = (
        dealt.join(hot, ["_block", "_value"], "left")
        .withColumn("_part", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(BLOCKS - 1))).otherwise(F.array(F.lit(-1)))))
        .withColumn("_low", F.expr(f"CASE WHEN _part < 0 THEN -1L ELSE shiftrightunsigned({others}, 64 - {part} * (_part + 1)) & {(1 << part) - 1} END"))
        .withColumn("_group", F.xxhash64("_block", "_value", "_part", "_low"))
        .select("_block", "_group", "_fp")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One partition of top nodes: three numbers for each fingerprint.
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        block, group, fp = (column.to_numpy() for column in pa.Table.from_batches(held).columns)
        node, parent = _linked(block, fp.view(np.uint64), group, radius)
        yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(parent.view(np.int64))], ["node", "parent"])

    return keyed.repartition("_group").mapInArrow(search, "node long, parent long")


def groups(rows: DataFrame, radius: int = RADIUS, linked: DataFrame | None = None) -> DataFrame:
    """From staged rows (doc_id, _fp): for each fingerprint its group's id and its group's first row.

    `linked` has links (node, parent) of other values of `_fp` than fingerprints.

    `component_id` is the least doc_id of the group, and `_first_fp` a fingerprint that
    a document of that id has.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id"), F.col("_fp").alias("_first_fp")))
    distinct = staged(rows.groupBy("_fp").agg(first.alias("_first")), "fingerprints")
    roots = staged(components(links(distinct.select("_fp"), radius) if linked is None else linked), "roots").withColumnRenamed("node", "_fp")
    joined = distinct.join(roots, "_fp")
    of_root = joined.groupBy("root").agg(F.min("_first").alias("_least"))
    least = joined.join(of_root, "root").select("_fp", "_least")
    return distinct.join(least, "_fp", "left").select("_fp", F.coalesce("_least", "_first").alias("_first")).select(
        "_fp", F.col("_first.doc_id").alias("component_id"), F.col("_first._first_fp").alias("_first_fp")
    )


def simhash_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per document: doc_id, fingerprint in hex, component_id."""
    rows = staged(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "_fp"), "simhash")
    # Staged, so that this join reads plain shuffles, of which large ones can be split.
    decided = staged(groups(rows, radius), "simhash-groups")
    return rows.join(decided, "_fp").select("doc_id", as_hex(F.col("_fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group: that of the least id (of repeated rows, one)."""
    plain, restored = plain_names(docs, ("doc_id", "text"))
    rows = staged(with_fingerprints(plain.select("doc_id", "text")).select("doc_id", "_fp"), "simhash")
    return restored(keep_winners(with_fingerprints(plain), groups(rows, radius)))


def keep_winners(marked: DataFrame, decided: DataFrame) -> DataFrame:
    """Of rows with `_fp`, the first one of each group of `decided`, which is what groups() gives."""
    winners = decided.select(F.col("component_id").alias("_id"), F.col("_first_fp")).distinct()
    # One hash of both columns is the only key of the join, and the distinct keeps to it (the
    # exact comparison stands in a CASE, which is no key): the texts are shuffled once.
    marked = marked.withColumn("_key", F.xxhash64("_fp", "doc_id"))
    winners = staged(winners.withColumn("_winner", F.xxhash64("_first_fp", "_id")), "simhash-winners")
    same = (marked["_fp"] == winners["_first_fp"]) & marked["doc_id"].eqNullSafe(winners["_id"])
    kept = marked.join(winners, (marked["_key"] == winners["_winner"]) & F.when(same, True).otherwise(False), "left_semi")
    return kept.dropDuplicates(["_key", "_fp", "doc_id"]).drop("_key", "_fp")
