"""Near copies by operator 2's index of SimHash fingerprints in Gray order, checked exactly: the pipeline's stage.

Texts whose sets of five-word shingles have a Jaccard similarity of SIMILARITY or more are linked,
and linked ones form a group.  Fingerprints have 256 bits here, since at operator 2's own width
and radius (three-word shingles, 3 of 64 bits) few such pairs meet.  At the radius that 0.8 needs
no block of bits has to agree, so the top nodes of the index are shingles instead of blocks, which
loses none: in any one order of all shingles, similar sets share one among the first fifth of each.

1. Shingles are ordered by hash, but those that very many texts share come last, so that common
   lines deal nothing unless a text is made of them.
2. In a top node the fingerprints lie in Gray order.  Neighbours there, within the length of a
   leaf of the index, are looked at first, which joins much of a large group of near copies.
3. Then every top node that holds texts which no link has joined yet is searched by its Gray
   index: those that may be similar are connected, by a spanning forest and never by all pairs.
   Each connected set is compared as a whole in a task that holds its shingles, and again
   a spanning forest of the similar pairs comes out.  So rows grow with the texts of a group
   and not with its pairs.  A connected set of more than BLOCK_SHINGLES shingles is split into
   blocks, every two of which meet in a task of their own.
4. All comparisons that link are exact.  Before them sizes count and, for texts of
   LEAST_SHINGLES or more, SimHash fingerprints of 256 bits: at 0.8 they differ in 39 bits
   (deviation 6), and the radius is about 5 deviations wider.

Words are those of operator 2.  Edge cases: a text of fewer words than a shingle is one
shingle; a text without words (null, empty, blank) is linked to others like it; texts with
equal sets count once, whatever the number of their documents; columns may have any name;
an empty table gives an empty one.  64-bit hashes stand for shingles and for whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.bytewords import BASE, mix, slices, words_of
from perfmart.llm.components import components
from perfmart.llm.shared import BLANKS, plain_names, staged
from perfmart.llm.simhash import LEAF, bits_set, forest, gray_rank, groups, keep_winners, merged

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 66
WORDS = 4
#: Fingerprints of fewer shingles say too little.
LEAST_SHINGLES = 40
#: A shingle counts in a batch from this many texts on.
FREQUENT = 4
#: A shingle comes last beyond HOT_ROWS counted texts plus all shingles / 2^HOT_BITS, so there are at most 2^HOT_BITS.
HOT_ROWS = 200
HOT_BITS = 18
#: Small slices, whose arrays leave no gaps between the sets that a batch keeps.
SLICE_BYTES = 1 << 18
#: Shingles of a block, on average: what a task of two blocks holds.
BLOCK_SHINGLES = 1 << 20
#: Cells of a matrix of shared shingles that a task works on at once, and shingle occurrences counted into it.
CELLS = 1 << 21
#: A shingle of more than one in DENSE texts of a task is counted by a matrix product.
DENSE = 8
#: So many sets at most are picked by a broadcast; more take a shuffle join.
BROADCAST_ROWS = 1_000_000

NOT_BLANK = ~np.isin(np.arange(256), np.frombuffer(BLANKS.encode(), np.uint8))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text the hashes of its shingles, sorted, each once."""
    for data, offsets, first_row in slices(column, SLICE_BYTES):
        found = words_of(data, offsets, first_row, NOT_BLANK)
        hashes, _ = found.runs(SHINGLE)
        for begin, end in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist(), strict=True):
            if end - begin >= SHINGLE:
                yield np.unique(hashes[begin : end - SHINGLE + 1])
            else:
                one = np.array([end - begin], np.uint64)
                for word in range(begin, end):
                    one = one * BASE + found.hash[word]
                yield mix(one)


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    both = np.array([mix(shingles, 1).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(shingles, 2))], np.uint64)
    return int(mix(mix(both[:1]) + both[1:]).view(np.int64)[0])


def _fingerprint(shingles: np.ndarray) -> np.ndarray:
    """The SimHash of a set, in WORDS signed numbers of 64 bits."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(shingles), 1 << 12):
        some = np.stack([mix(shingles[at : at + (1 << 12)], salt) for salt in range(3, 3 + WORDS)], axis=1)
        ones += np.unpackbits(some.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(shingles), bitorder="little").view(np.int64)


def needed(shingles: int, similarity: float) -> int:
    """Shingles that a set of so many must share with any other that is similar enough."""
    return int(np.ceil(similarity * shingles - 1e-9))


def common_shingles(docs: DataFrame, hot_rows: int = HOT_ROWS) -> np.ndarray:
    """The shingles of very many texts, sorted.  They decide how the work is dealt, never a result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {set_hash(s): s for s in shingle_sets(batch.column(0))}
            if not sets:
                continue
            every = np.concatenate(list(sets.values()))
            del sets
            every.sort()
            ahead = every[FREQUENT - 1 :]
            shingle = np.unique(ahead[ahead == every[: len(ahead)]])
            rows = np.searchsorted(every, shingle, "right") - np.searchsorted(every, shingle)
            keys = pa.array([*shingle.view(np.int64).tolist(), None], pa.int64())  # null: all shingles
            yield pa.RecordBatch.from_arrays([keys, pa.array([*rows.tolist(), len(every)], pa.int64())], ["shingle", "rows"])

    counts = staged(docs.select("text").mapInArrow(run, "shingle long, rows long").groupBy("shingle").agg(F.sum("rows").alias("rows")), "common-shingles")
    total = counts.filter("shingle IS NULL").first()
    limit = hot_rows + ((total["rows"] if total else 0) >> HOT_BITS)
    found = counts.filter(F.col("shingle").isNotNull() & (F.col("rows") > limit)).select("shingle").toPandas()["shingle"]
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def with_set_hash(docs: DataFrame) -> DataFrame:
    """`docs` with `_fp`, the hash of the set of shingles."""
    names = docs.columns
    at = names.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pa.array([set_hash(s) for s in shingle_sets(batch.column(at))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, hashes], [*names, "_fp"])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("_fp", T.LongType())]))


PREFIXES = "doc_id {}, _fp long, n int, bits array<long>, keys array<long>"


def prefixes(docs: DataFrame, common: np.ndarray, similarity: float) -> DataFrame:
    """Per document its set's hash, size, fingerprint, and the shingles by which it is dealt (once in a batch for equal sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, seen = [], set()
            for s in shingle_sets(batch.column(1)):
                node = set_hash(s)
                if node in seen:
                    rows.append((node, None, None, None))
                    continue
                seen.add(node)
                last = np.isin(s, common, assume_unique=True) if len(common) else np.zeros(len(s), bool)
                keys = np.concatenate([s[~last], s[last]])[: len(s) - needed(len(s), similarity) + 1]
                rows.append((node, len(s), _fingerprint(s), keys.view(np.int64)))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "_fp", "n", "bits", "keys"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, PREFIXES.format(docs.schema["doc_id"].dataType.simpleString()))


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets (node, shingles) of the given nodes, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {set_hash(s): s.view(np.int64) for s in shingle_sets(batch.column(0))}
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array(list(sets.values()), pa.list_(pa.int64()))], ["node", "shingles"])

    nodes = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
    return docs.select("text").mapInArrow(run, "node long, shingles array<long>").join(nodes, "node", "left_semi").dropDuplicates(["node"])


def may_be_similar(pairs: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (node, parent) that sizes and fingerprints leave."""
    other = sizes.select(F.col("node").alias("parent"), F.col("n").alias("_n"), F.col("bits").alias("_bits"))
    apart = sum(F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("_bits")[i])) for i in range(WORDS))
    near = (F.least("n", "_n") < LEAST_SHINGLES) | (apart <= RADIUS)
    sized = F.least("n", "_n") >= similarity * F.greatest("n", "_n") - 1e-9
    return pairs.join(sizes, "node").join(other, "parent").filter(sized & near).select("node", "parent")


def similar(docs: DataFrame, pairs: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (node, parent) whose sets are similar enough, by an exact comparison."""
    pairs = staged(may_be_similar(pairs, sizes, similarity), "pairs")
    nodes = pairs.select("node").union(pairs.select("parent")).distinct()
    sets = staged(sets_of(docs, nodes), "shingle-sets")
    other = sets.select(F.col("node").alias("parent"), F.col("shingles").alias("_of_parent"))
    both = pairs.join(sets, "node").join(other, "parent").withColumn("_shared", F.size(F.array_intersect("shingles", "_of_parent")))
    union = F.size("shingles") + F.size("_of_parent") - F.col("_shared")
    return staged(both.filter(F.col("_shared") >= similarity * union - 1e-9).select("node", "parent"), "similar")


def meetings(keyed: DataFrame) -> DataFrame:
    """Of rows (key, node) those of keys with several nodes, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        key, node = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
        del held
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.r_[True, key[1:] != key[:-1]]
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], len(key)]
        several = np.repeat(node[starts] != node[ends - 1], ends - starts)
        kept = np.flatnonzero(several & (new | np.r_[True, node[1:] != node[:-1]]))
        yield pa.RecordBatch.from_arrays([pa.array(key[kept]), pa.array(node[kept])], ["key", "node"])

    return keyed.repartition("key").mapInArrow(run, "key long, node long")


GRAY_ROWS = "node long, parent long"


def in_gray_order(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...] | None:
    """A partition's rows (key, node, n, bits, root), each once, by key and then by the Gray rank of their fingerprints."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return None
    table = pa.Table.from_batches(held)
    key, node, n, root = (table.column(c).to_numpy() for c in ("key", "node", "n", "root"))
    bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)
    order = np.lexsort((node, *gray_rank(bits).T[::-1], key))
    order = order[np.r_[True, (key[order][1:] != key[order][:-1]) | (node[order][1:] != node[order][:-1])]]
    return tuple(c[order] for c in (key, node, n, bits, root))


def _may(a: np.ndarray, b: np.ndarray, n: np.ndarray, root: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs of different roots whose sizes allow them to be similar."""
    return (root[a] != root[b]) & (np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9)


def _linked_in_leaves(some: np.ndarray, key: np.ndarray, n: np.ndarray, bits: np.ndarray, root: np.ndarray, similarity: float) -> np.ndarray:
    """Labels after linking what may be similar among the LEAF next rows, in Gray order, of `some` rows and their key."""
    label, largest = np.arange(len(key)), int(np.diff(np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])).max())
    for step in range(1, min(LEAF, largest)):
        a = np.flatnonzero(some[:-step] & (key[step:] == key[:-step]))
        a = a[_may(a, a + step, n, root, similarity)]
        near = (np.minimum(n[a], n[a + step]) < LEAST_SHINGLES) | (bits_set(bits[a] ^ bits[a + step]) <= RADIUS)
        label = merged(label, a[near], a[near] + step)
    return label


def _searched(n: np.ndarray, bits: np.ndarray, root: np.ndarray, similarity: float) -> np.ndarray:
    """Labels after linking all that may be similar of one key, by searches of its Gray index; small texts have no radius."""
    label = np.arange(len(n))
    for part, radius in ((n >= LEAST_SHINGLES, RADIUS), (similarity * n < LEAST_SHINGLES, 64 * WORDS)):
        at = np.flatnonzero(part)
        if len(at) > 1:
            label = merged(label, at, at[forest(bits[at], radius, lambda a, b, at=at: _may(at[a], at[b], n, root, similarity))])
    return label


def _forest_of(node: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], ["node", "parent"])


def neighbour_edges(meeting: DataFrame, similarity: float) -> DataFrame:
    """From rows (key, node, n, bits, root): links (node, parent) between neighbours in the Gray order of a key, within a leaf's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = in_gray_order(batches)
        if found is not None:
            key, node, n, bits, root = found
            yield _forest_of(node, _linked_in_leaves(np.ones(len(key), bool), key, n, bits, root, similarity))

    return meeting.select("key", "node", "n", "bits", "root").repartition("key").mapInArrow(run, GRAY_ROWS).distinct()


def open_edges(meeting: DataFrame, similarity: float) -> DataFrame:
    """From rows (key, node, n, bits, root): links (node, parent) that connect, key by key, all nodes of different roots that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = in_gray_order(batches)
        if found is None:
            return
        key, node, n, bits, root = found
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        label = _linked_in_leaves(np.repeat(sizes <= LEAF, sizes), key, n, bits, root, similarity)
        for start, size in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
            rows = slice(start, start + size)
            label[rows] = start + _searched(n[rows], bits[rows], root[rows], similarity)
        yield _forest_of(node, label)

    return meeting.select("key", "node", "n", "bits", "root").repartition("key").mapInArrow(run, GRAY_ROWS).distinct()


def shared_shingles(ends: np.ndarray, values: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For sets values[ends[i]:ends[i+1]]: strips of `rows`, and how many values each has in common with every set."""
    m, n = len(ends) - 1, np.diff(ends)
    if not len(rows):
        return
    _, value, held = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), n)
    often = held * DENSE > m
    column = np.cumsum(often & (held > 1)) - 1
    dense = np.zeros((m, int((often & (held > 1)).sum())), np.float32)
    at = np.flatnonzero((often & (held > 1))[value])
    dense[owner[at], column[value[at]]] = 1
    rare = np.flatnonzero((~often & (held > 1))[value])
    owner, value = owner[rare], value[rare]
    by_value = owner[np.argsort(value, kind="stable")]
    first = np.r_[0, np.cumsum(np.bincount(value, minlength=len(held)))]
    begin = np.searchsorted(owner, np.arange(m + 1))
    size = held[value]
    work = np.bincount(owner, size, m)[rows] + m
    strip = np.cumsum(work) // max(CELLS, int(work.max(initial=1)))
    for some in np.split(rows, np.flatnonzero(np.diff(strip)) + 1):
        shared = (dense[some] @ dense.T).astype(np.float64)
        entries = np.concatenate([np.arange(begin[r], begin[r + 1]) for r in some.tolist()])
        times = size[entries]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        other = by_value[np.repeat(first[value[entries]], times) + inner]
        line = np.repeat(np.arange(len(some)), begin[some + 1] - begin[some])
        shared += np.bincount(np.repeat(line, times) * m + other, minlength=shared.size).reshape(shared.shape)
        yield some, shared


def similar_in_cell(root: np.ndarray, block: np.ndarray, low: int, high: int, ends: np.ndarray, values: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (position, position) that connect the similar sets of different roots, of block `low` with block `high`."""
    n, label = np.diff(ends), np.arange(len(ends) - 1)
    for some, shared in shared_shingles(ends, values, np.flatnonzero(block == low)):
        alike = shared >= similarity * (n[some][:, None] + n[None, :] - shared) - 1e-9
        i, j = np.nonzero(alike & (root[some][:, None] != root[None, :]) & (block == high)[None, :])
        label = merged(label, some[i], j)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return moved, label[moved]


def similar_in_groups(sets: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """Links (node, parent) that connect the similar sets of each group, from members (node, group, n, root)."""
    total = members.groupBy("group").agg(F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    block = members.join(total, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = block.withColumn("_other", other).select(
        "group", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "block", "node", "root"
    )
    cell = ["group", "low", "high"]
    held = met.join(sets, "node").select(*cell, "block", "node", "root", "shingles")

    def compare(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(parts).combine_chunks()
        if table.num_rows < 2:
            return None
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        block, node, root = (table.column(c).to_numpy() for c in ("block", "node", "root"))
        lists = table.column("shingles").combine_chunks()
        ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))]
        found, parent = similar_in_cell(root, block, low, high, ends, lists.flatten().to_numpy(), similarity)
        return pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(node[parent])], ["node", "parent"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of a cell come one after another, so one cell is held at a time.
        parts: list[pa.RecordBatch] = []
        now: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in cell], axis=1)
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                key = tuple(keys[a].tolist())
                if key != now and parts:
                    found = compare(parts)
                    parts = []
                    if found is not None:
                        yield found
                now = key
                parts.append(batch.slice(a, b - a))
        found = compare(parts) if parts else None
        if found is not None:
            yield found

    return held.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(run, "node long, parent long")


def links(docs: DataFrame, rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (node, parent) that connect all similar sets, from `rows` of prefixes()."""
    keyed = rows.filter("n IS NOT NULL").select(F.explode("keys").alias("key"), F.col("_fp").alias("node"))
    meeting = staged(meetings(keyed), "meetings")
    sizes = rows.filter("n IS NOT NULL").select(F.col("_fp").alias("node"), "n", "bits").dropDuplicates(["node"])
    alone = meeting.join(sizes, "node").withColumn("root", F.col("node"))
    first = similar(docs, neighbour_edges(alone, similarity), sizes, similarity)
    roots = staged(components(first), "neighbour-roots")
    rooted = meeting.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = rooted.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a <> _b").select("key")
    rooted = rooted.join(several, "key", "left_semi").join(sizes, "node")
    connected = staged(components(open_edges(rooted, similarity)).withColumnRenamed("root", "group"), "open-groups")
    members = connected.join(sizes.select("node", "n"), "node").join(roots, "node", "left").select("node", "group", "n", F.coalesce("root", "node").alias("root"))
    return first.unionByName(similar_in_groups(sets_of(docs, connected.select("node")), members, similarity))


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One document of each group: that of the least id (of repeated rows, one)."""
    plain, restored = plain_names(docs, ("doc_id", "text"))
    rows = staged(prefixes(plain, common_shingles(plain, hot_rows), similarity), "prefixes")
    return restored(keep_winners(with_set_hash(plain), groups(rows.select("doc_id", "_fp"), linked=links(plain, rows, similarity))))
