"""Mixing sources to target weights by hash-threshold histograms, in built-in functions only.

Words are summed by source and hash bucket, the bucket in which a source's budget ends is
refined until it holds one hash, and rows are chosen by comparing their hash with their
source's threshold: nothing is sorted.  The thresholds for 1, 2 and 3 copies are nested: a
source that needs 1.4 times its words takes every row once and those below the threshold
twice.

Rows that are equal are counted, and the copies are numbered in parts of at most CHUNK;
the number enters the hash, so a threshold can end inside a row that is a third of the
table, and no task gets all its copies.

Edge cases: a null source is a source, the last in order; a null or blank text has size 0
and takes nothing; of rows equal in id, text and source only the number that is taken
counts, and one of them stands for all; columns may have any name; an empty table gives
an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfmart.llm.shared import plain_names, staged, words

HASH_BITS = 60
LEVEL_BITS = 10
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Sources whose plan is broadcast; more are joined by source and a part of the hash.
BROADCAST_SOURCES = 100_000
SALTS = 64
#: Copies of a row that a task makes at most.
CHUNK = 65_536


def with_sizes(docs: DataFrame) -> DataFrame:
    """`docs` with `_size` (words) and `_hash` (HASH_BITS bits of id and text)."""
    return docs.withColumn("_size", F.size(words(docs["text"])).cast("long")).withColumn(
        "_hash", F.shiftrightunsigned(F.xxhash64(docs["doc_id"], docs["text"]), 64 - HASH_BITS)
    )


def _repeated(rows: DataFrame, times: str, key: str, number: str) -> DataFrame:
    """Every row as often as its column `times` says, with a number from 0; long runs are spread over tasks."""
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / CHUNK).cast("long")))
    last = F.least(F.col(times), (F.col("_part") + 1) * CHUNK) - 1
    dealt = rows.filter(F.col(times) > 0).withColumn("_part", part).repartition(key, "_part")
    return dealt.withColumn(number, F.explode(F.sequence(F.col("_part") * CHUNK, last))).drop("_part", times)


def numbered_copies(rows: DataFrame) -> DataFrame:
    """`rows` with the hash of each but the first of equal rows changed by its number; `_own` tells a source's hashes before that."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_times"))
    again = F.shiftrightunsigned(F.xxhash64("_hash", "_copy"), 64 - HASH_BITS)
    return (
        _repeated(counted, "_times", "_hash", "_copy")
        .withColumn("_own", F.xxhash64("source", "_hash"))
        .withColumn("_hash", F.when(F.col("_copy") == 0, F.col("_hash")).otherwise(again))
        .drop("_copy")
    )


def targets(sums: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source: its target, whole copies and the words that a further copy must give.

    `sums` has a row for each source (source, source_size).  A level of water fills
    buckets of width `weight` and height `most` times the size: the level is the greatest
    of (rest of the words) / (rest of the weights) with the sources in order of height.
    The windows run over sources only, never over documents.
    """
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    by_height = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    above = by_height.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    below = by_height.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sums.withColumn("weight", weight)
        .withColumn("_cap", F.col("source_size") * most)
        .withColumn("_rest", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(below), F.lit(0)))
        .withColumn("_level", F.max(F.col("_rest") / F.sum("weight").over(above)).over(every))
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("weight")))
        .withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long"),
        )
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "weight", "target", "whole", "budget")
    )


def _histogram(rows: DataFrame, shift: int) -> DataFrame:
    return rows.groupBy("source", F.shiftright("_hash", shift).alias("_bucket")).agg(
        F.sum("_size").alias("_held"), F.min("_hash").alias("_least"), F.max("_hash").alias("_most")
    )


def _boundary(histogram: DataFrame, state: DataFrame) -> DataFrame:
    """For each source the bucket in which its budget ends, and the budget left at its start."""
    upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("budget") - (F.col("_sum") - F.col("_held"))
    return (
        histogram.filter("_held > 0")
        .withColumn("_sum", F.sum("_held").over(upto))
        .alias("h")
        .join(state.select("source", "budget").alias("s"), F.expr("h.source <=> s.source"))
        .filter((left >= 0) & (F.col("_sum") > F.col("budget")))
        .select("h.source", "_bucket", "_held", "_least", "_most", left.alias("budget"))
    )


def thresholds(rows: DataFrame, plan: DataFrame, first: DataFrame) -> DataFrame:
    """Per source the hash below which a row is taken once more.

    `first` is the histogram of the highest bits.  Each round reads only the rows of the
    boundary buckets; a bucket that holds one hash is taken if the larger part of it fits.
    """
    shift = HASH_BITS - LEVEL_BITS
    state = staged(_boundary(first, plan), "mix-boundary")
    while shift > 0 and not state.filter("_least < _most").isEmpty():
        inner = rows.alias("r").join(
            state.select("source", "_bucket").alias("s"),
            (F.expr("r.source <=> s.source")) & (F.shiftright(F.col("r._hash"), shift) == F.col("s._bucket")),
            "left_semi",
        )
        shift -= LEVEL_BITS
        state = staged(_boundary(_histogram(inner, shift), state), "mix-boundary")
    cut = F.col("_least") + F.when(F.col("budget") * 2 >= F.col("_held"), 1).otherwise(0)
    return state.select("source", cut.cast("long").alias("threshold"))


def plan_mix(rows: DataFrame) -> DataFrame:
    """The mix of rows (source, _size, _hash): a row for each source, with its threshold."""
    first = staged(_histogram(rows, HASH_BITS - LEVEL_BITS), "mix-histogram")
    plan = staged(targets(first.groupBy("source").agg(F.sum("_held").alias("source_size"))), "mix-plan")
    cuts = thresholds(rows, plan, first)
    return (
        plan.alias("p")
        .join(cuts.alias("c"), F.expr("p.source <=> c.source"), "left")
        .select("p.source", "source_size", "weight", "target", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    )


def apply_mix(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows` (with source and _hash) with their source's plan and `copies`."""
    plan = staged(plan, "mix-decided")
    facts = ["source_size", "weight", "target", "whole", "threshold"]
    if plan.count() <= BROADCAST_SOURCES:
        side, match = F.broadcast(plan.alias("p")), F.expr("r.source <=> p.source")
    else:
        salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
        side = plan.withColumn("_salt", salts).alias("p")
        match = F.expr(f"r.source <=> p.source AND pmod(r._hash, {SALTS}) = p._salt")
    joined = rows.alias("r").join(side, match).select(*[F.col(f"r.`{c}`") for c in rows.columns], *[F.col(f"p.{c}").alias(f"_{c}") for c in facts])
    return joined.withColumn("_copies", F.col("_whole") + F.when(F.col("_hash") < F.col("_threshold"), 1).otherwise(0))


def mix_table(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes of it."""
    rows = staged(numbered_copies(with_sizes(docs).select("doc_id", "source", "_size", "_hash")), "mix-rows")
    out = apply_mix(rows, plan_mix(rows))
    return out.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
        F.col("_copies").alias("copies"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of `docs` as often as it takes them, with the columns of `docs`."""
    plain, restored = plain_names(docs, ("doc_id", "text", "source"))
    hashed = with_sizes(plain)
    rows = staged(numbered_copies(hashed.select("source", "_size", "_hash")), "mix-rows")
    plan = staged(plan_mix(rows), "mix-plan")
    several = rows.groupBy("_own").count().filter("count > 1").select("_own")
    repeated = staged(apply_mix(rows.join(several, "_own", "left_semi"), plan).groupBy("_own").agg(F.sum("_copies").alias("_times")), "mix-repeated")
    if repeated.isEmpty():
        return restored(_copied(apply_mix(hashed, plan)))
    hashed = hashed.withColumn("_own", F.xxhash64("source", "_hash"))
    once = _copied(apply_mix(hashed.join(repeated, "_own", "left_anti"), plan))
    first = hashed.join(repeated, "_own").dropDuplicates(["_own"])
    return restored(once.select(*plain.columns).unionByName(_repeated(first, "_times", "_hash", "_copy").select(*plain.columns)))


def _copied(taken: DataFrame) -> DataFrame:
    """Rows as often as `_copies` says, 0 to MOST_COPIES times."""
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return taken.filter("_copies > 0").withColumn("_copy", again)
