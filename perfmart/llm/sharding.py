"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in built-in functions only.

A key and the number of shards decide the shard: no ring table, and one shard more takes
its 1/(n+1) of the rows from the others and moves nothing else.

Edge cases: a null key hashes to a shard like any other; a null text has size 1 and a null
checksum; repeated rows share their shard and get slots of their own; an empty table gives
an empty one; other columns pass through `assign_shards` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: FIXED VALUE: the multiplier of the paper's 64-bit generator.
MULTIPLIER = 2862933555777941757
HIGH, LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
MASK = 0xFFFFFFFF
#: Jumps tried before the exact but longer loop; a key needs about ln(shards) of them.
USUAL_JUMPS = 64


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2^64, in 32-bit halves that no product overflows."""
    low16, high16 = lo.bitwiseAND(0xFFFF), F.shiftright(lo, 16)
    inner = high16 * LOW
    total = low16 * LOW + F.shiftleft(inner.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(total, 32) + F.shiftright(inner, 16)
    cross = (
        (lo * HIGH).bitwiseAND(MASK)
        + (hi.bitwiseAND(0xFFFF) * LOW).bitwiseAND(MASK)
        + F.shiftleft((F.shiftright(hi, 16) * LOW).bitwiseAND(0xFFFF), 16)
    )
    return (carry + cross).bitwiseAND(MASK), total.bitwiseAND(MASK)


def _jumps(start: Column, shards: int, most: int) -> Column:
    """`start` after up to `most` jumps, or after the first that leaves the shards."""

    def jump(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        draw = let_pair(hi, lo, s["j"])
        return F.when(s["j"] < shards, draw).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, jump)


def let_pair(hi: Column, lo: Column, at: Column) -> Column:
    """The state after a jump from shard `at`; the new halves are computed once."""
    return F.transform(
        F.array(F.struct(hi.alias("hi"), lo.alias("lo"))),
        lambda n: F.struct(
            n["hi"].alias("hi"),
            n["lo"].alias("lo"),
            at.alias("b"),
            F.floor((at + 1) * (F.lit(float(1 << 31)) / (F.shiftright(n["hi"], 1) + 1))).cast("long").alias("j"),
        ),
    )[0]


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (0 to shards-1) of a 64-bit integer key."""
    if shards < 1:
        raise ValueError("at least one shard")
    start = F.struct(
        F.shiftright(key, 32).bitwiseAND(MASK).alias("hi"),
        key.bitwiseAND(MASK).alias("lo"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
    )
    usual = _jumps(start, shards, min(shards, USUAL_JUMPS))
    if shards <= USUAL_JUMPS:
        return usual["b"].cast("int")
    # Every jump goes forward, so `shards` jumps always suffice.
    return F.transform(
        F.array(usual),
        lambda s: F.when(s["j"] < shards, _jumps(s, shards, shards)["b"]).otherwise(s["b"]),
    )[0].cast("int")


def assign_shards(df: DataFrame, key: str, shards: int, grow: bool = True) -> DataFrame:
    """`df` with `shard`, and with `grown_shard` for one shard more.  No shuffle.

    The key's XXH64 seeds the generator, so that runs of ids are mixed well and keys of
    any type will do.
    """
    seed = F.xxhash64(df[key])
    out = df.withColumn("shard", jump_shard(seed, shards))
    return out.withColumn("grown_shard", jump_shard(seed, shards + 1)) if grow else out


def number_slots(rows: DataFrame, shard: str = "shard", buckets: int = 4096, chunk: int = 65536) -> DataFrame:
    """`rows` with `slot`: 0, 1, 2, ... within each shard, the same in every run.

    Equal rows are counted before the shuffle and dealt in chunks of at most `chunk`, so a
    row that makes up a third of the table is spread too.  A shard is numbered in `buckets`
    hash buckets, each offset by the sizes of those before it: no task holds a shard, and
    the sums of the buckets are at most shards x buckets rows.
    """
    names = rows.columns
    dealt = (
        rows.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk).cast("long"))))
        .withColumn("_n", F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_part") * chunk))
        .withColumn("_bucket", F.pmod(F.xxhash64(*names, "_part"), F.lit(buckets)))
    )
    sums = dealt.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_held"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(shard, "_bucket", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(shard, "_bucket").orderBy(*names, "_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(offsets, [shard, "_bucket"])
        .withColumn("_first", F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .select(*names, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("slot"))
    )
