"""Ranked lexical search by bag deduplication.

A document's score for an item depends on its bag alone: how often it holds each term of
the items, and its length class m.  Documents are restricted to the items' terms and
grouped by a hash of the bag, and bags of one hash are compared in full; so each class of
equal bags is scored once, whatever the number of its members.  The best classes of an item
are its `top` best by score and least doc_id, for a document among the `top` best has fewer
than `top` classes before its own.  Only those classes are expanded, to their `top` least
doc_ids, which are ranked.

Items are searched in blocks of bounded size.  A block's terms and weights are broadcast, a
task scores a batch of classes for all items of the block in whole numbers and hands on the
best classes only; the limits of a class and of an item apply before each shuffle.  A class
that a third of all documents belong to is one row where it is scored, and `top` rows a
task where it is expanded.

Edge cases: a null text holds no term; documents without a term of an item have no score;
a null doc_id comes after all others; documents equal in all columns are ranked one by one;
equal rows of items count once, an item without a term has no result; empty tables give an
empty one.  Whole numbers are 64 bits wide, which holds while 90 * n * N is below 2^63.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfmart.llm.shared import staged
from perfmart.llm.terms import encoded, terms

TOP = 10
#: Items searched at once, on average.
BLOCK_ITEMS = 512
#: Share of the length in m, of 100.
LENGTH_SHARE = 90
#: Cells of the matrix (terms x classes) that a task holds.
CELLS = 1 << 21

RANKS = "item_id long, rank int, doc_id long, score long"
BAGS = "doc_id long, n long, terms array<int>, tfs array<int>"
BEST = "item int, score long, first long, hash long, m long, terms array<int>, tfs array<int>"
BAG = ["hash", "m", "terms", "tfs"]


@dataclass(frozen=True)
class Items:
    """A block of items: ids, the terms of each, and all their terms by number."""

    ids: list[int | None]
    terms: list[np.ndarray]
    number: dict[bytes, int]


def bag_of(text: bytes | None) -> tuple[int, Counter[bytes]]:
    """The number of terms of a text, and how often each occurs."""
    n, counts = 0, Counter()
    for found in terms(text):
        n += len(found)
        counts.update(found)
    return n, counts


def item_blocks(items: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator[Items]:
    """Items in blocks of about `block_items`, equal rows once; each block costs one scan of the documents."""
    rows = items.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL").distinct()
    parts = max(1, -(-rows.count() // block_items))
    for part in range(parts):
        block = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        found = [(r["item_id"], sorted(bag_of(r["text"].encode())[1])) for r in block]
        found = [(i, t) for i, t in found if t]
        number = {t: k for k, t in enumerate(sorted({t for _, ts in found for t in ts}))}
        if number:
            yield Items([i for i, _ in found], [np.array([number[t] for t in ts]) for _, ts in found], number)


def bags(docs: DataFrame, items: Items) -> DataFrame:
    """Of every document its number of terms, and how often it holds each of the items' terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, tfs, ends = [], [], [], [0]
            for text in encoded(batch.column(1)):
                n, counts = bag_of(text)
                held = sorted((number[t], tf) for t, tf in counts.items() if t in number)
                sizes.append(n)
                ids += [k for k, _ in held]
                tfs += [tf for _, tf in held]
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(c, pa.int32())) for c in (ids, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    number = items.number
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, BAGS)


def weights(holding: dict[int, int], size: int, documents: int) -> np.ndarray:
    """The weight of each term, from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(size)], np.int64)


def _scores(weight: np.ndarray, of_items: list[np.ndarray], m: np.ndarray, ends: np.ndarray, ids: np.ndarray, tfs: np.ndarray) -> np.ndarray:
    """The scores (items x classes) of some classes."""
    row = np.repeat(np.arange(len(m)), np.diff(ends))
    tf = tfs.astype(np.int64)
    each = np.zeros((len(weight), len(m)), np.int64)
    each[ids, row] = weight[ids] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
    return np.stack([each[t].sum(axis=0) for t in of_items])


def best_classes(classes: DataFrame, items: Items, weight: np.ndarray, top: int) -> DataFrame:
    """For each task and item its `top` best of the classes (first, hash, m, terms, tfs)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in of_items]
        least = np.ones(len(of_items), np.int64)
        for batch in batches:
            step = max(1, CELLS // len(weight))
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                first, hash_, m = (some.column(i) for i in range(3))
                ids, tfs = some.column(3), some.column(4)
                ends = ids.offsets.to_numpy()
                scores = _scores(weight, of_items, m.to_numpy(), ends, ids.flatten().to_numpy(), tfs.flatten().to_numpy())
                order = first.fill_null(np.iinfo(np.int64).max).to_numpy()
                for item in np.flatnonzero(scores.max(axis=1) >= least).tolist():
                    own = scores[item]
                    held = np.flatnonzero(own >= least[item])
                    held = held[np.lexsort((order[held], -own[held]))][:top]
                    new = [(-int(own[i]), int(order[i]), hash_[i].as_py(), first[i].as_py(), m[i].as_py(), ids[i], tfs[i]) for i in held.tolist()]
                    best[item] = sorted([*best[item], *new], key=lambda b: b[:3])[:top]
                    if len(best[item]) == top:
                        least[item] = -best[item][-1][0]
        rows = [(item, -b[0], b[3], b[2], b[4], b[5].as_py(), b[6].as_py()) for item, found in enumerate(best) for b in found]
        if rows:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["item", "score", "first", *BAG])

    of_items = items.terms
    return classes.select("first", *BAG).mapInArrow(score, BEST)


def _top(rows: DataFrame, by: list[str], order: list, top: int, rank: str) -> DataFrame:
    """The `top` first rows of each group; Spark applies the limit before the shuffle too."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= top)


def _ranks(docs: DataFrame, items: Items, top: int) -> DataFrame:
    rows = staged(bags(docs, items), "bags")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    documents, held = total["documents"], max(1, total["terms"])
    m = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {documents}L) div {held}L")
    bagged = rows.filter("size(terms) > 0").withColumn("m", m).withColumn("hash", F.xxhash64("m", "terms", "tfs")).select("doc_id", *BAG)
    classes = staged(bagged.groupBy(*BAG).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("members")), "bag-classes")
    holding = classes.select(F.explode("terms").alias("term"), "members").groupBy("term").agg(F.sum("members").alias("df"))
    weight = weights({r["term"]: r["df"] for r in holding.collect()}, len(items.number), documents)
    found = best_classes(classes, items, weight, top)
    best = staged(_top(found, ["item"], [F.desc("score"), F.asc_nulls_last("first"), "hash"], top, "_best").drop("_best", "first"), "best-classes")
    # At most `top` hashes for each item of the block; equal hashes are told apart by the bag, here and in the join.
    members = bagged.join(F.broadcast(best.select("hash").distinct()), "hash", "left_semi")
    members = _top(members, BAG, [F.asc_nulls_last("doc_id")], top, "_member").drop("_member")
    ranked = _top(best.join(members, BAG), ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], top, "rank")
    ids = F.element_at(F.array(*[F.lit(i).cast("long") for i in items.ids]), F.col("item") + 1)
    return ranked.select(ids.alias("item_id"), F.col("rank").cast("int"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The `top` best documents of each item: item_id, rank from 1, doc_id, score (above 0)."""
    out = docs.sparkSession.createDataFrame([], RANKS)
    for block in item_blocks(items, block_items):
        out = out.unionByName(_ranks(docs, block, top))
    return out
