"""Carry-forward of accounts missing from a batch, and the distinct merge."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.session import checkpointed

# A bigint key set of this size is a few tens of megabytes as a broadcast relation.
BROADCAST_KEYS = 1_000_000
# Bitmaps of accounts are broadcast up to this size; each covers 32,768 ids with 4 KB.
BITMAP_BYTES = 256 << 20
_BITMAP_SIZE = 4096 + 64
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# With so few bitmaps the published rows are also tested by a condition, which reaches below their projection.
CONDITION_BITMAPS = 64
# So few hashes are looked for by a condition, likewise.
CONDITION_HASHES = 1000
# Rows of one write task.
TASK_ROWS = 8_000_000


@dataclass(frozen=True)
class KeyProfile:
    """What the carry-forward must know about a batch's keys before it is planned."""

    distinct: int
    has_null: bool
    rows: int = field(default=0, compare=False)
    #: The distinct keys, where the profile holds them for the carry-forward.
    keys: DataFrame | None = field(default=None, compare=False, repr=False)

    def release(self) -> None:
        """Let go of the held keys."""
        if self.keys is not None:
            self.keys.unpersist()

    @property
    def empty(self) -> bool:
        return self.distinct == 0 and not self.has_null


def profile_keys(fresh: DataFrame, key: str, hold: bool = False, store: bool = False) -> KeyProfile:
    """Count a batch's distinct keys: one job that reads only what the key needs.

    With ``hold`` the keys, one row for each account, are kept for the carry-forward, so
    that they are worked out once; the caller releases them.  With ``store`` they are kept
    in the checkpoint folder instead, for a result that is read later.
    """
    counted = fresh.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    if hold:
        counted = counted.persist()
    elif store:
        counted = checkpointed(counted)
    row = counted.agg(
        F.count(key).alias("keys"), F.count(F.lit(1)).alias("groups"), F.sum("_rows").alias("rows")
    ).first()
    return KeyProfile(row["keys"], row["groups"] > row["keys"], row["rows"] or 0, counted if hold or store else None)


def in_window(mart: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of an inclusive range of the partition column."""
    return mart.where(F.col("data_date").between(start, end))


def carry_forward(
    fresh: DataFrame,
    mart: DataFrame,
    key: str,
    start: str,
    end: str,
    profile: KeyProfile | None = None,
    max_broadcast: int = BROADCAST_KEYS,
    max_bitmap_bytes: int = BITMAP_BYTES,
    below: bool = False,
) -> DataFrame:
    """Published rows of the window whose account is not in the batch.

    The result is that of ``key NOT IN (batch keys)``: an empty batch keeps every
    row, a NULL key in the batch keeps none, and a NULL published key is kept only
    by an empty batch.  Spark can run a literal ``NOT IN`` only by broadcasting
    the keys whatever their number.  Here the profile settles the NULL cases, and
    what is left is a plain anti-join, broadcast while the keys are few.  Beyond that
    whole numbers become bitmaps of 32,768 ids each: while these fit ``max_bitmap_bytes``,
    they are broadcast, and the published rows are tested where they lie; a billion ids
    without large gaps take 130 MB.  What does not fit is a sort-merge join, whose
    published side adaptive execution splits where one account holds too much of it; no
    side is copied.  ``below`` is for published rows that are projected on the way: few
    bitmaps then also make a condition, which reaches below the projection.
    """
    profile = profile or profile_keys(fresh, key)
    window = in_window(mart, start, end)
    if profile.empty:
        return window
    if profile.has_null:
        return window.where(F.lit(False))
    keys = fresh.select(key).distinct() if profile.keys is None else profile.keys.select(key)
    known = window.where(F.col(key).isNotNull())
    if below and isinstance(keys.schema[key].dataType, _INTEGRAL):
        known = _outside(known, account_bitmaps(keys, key), key)
    if profile.distinct <= max_broadcast:
        keys = F.broadcast(keys)
    elif isinstance(keys.schema[key].dataType, _INTEGRAL):
        bitmaps = account_bitmaps(keys, key)
        if bitmaps.count() * _BITMAP_SIZE <= max_bitmap_bytes:
            return without_accounts(known, bitmaps, key).select(*mart.columns)
    return known.join(keys, key, "left_anti").select(*mart.columns)


def account_bitmaps(keys: DataFrame, key: str) -> DataFrame:
    """``(bucket, bits)``: the ids as bitmaps, one for each 32,768 numbers that hold any."""
    known = keys.where(F.col(key).isNotNull())
    return known.groupBy(F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")
    )


def without_accounts(df: DataFrame, bitmaps: DataFrame, key: str) -> DataFrame:
    """Rows whose id is in none of the bitmaps; ``bitmaps`` must fit a broadcast."""
    side = F.broadcast(bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")))
    joined = df.join(side, F.bitmap_bucket_number(key) == F.col("_bucket"), "left")
    return joined.where(~F.coalesce(_has_bit(F.col("_bits"), F.bitmap_bit_position(key)), F.lit(False))).drop("_bucket", "_bits")


def _outside(df: DataFrame, bitmaps: DataFrame, key: str, most: int = CONDITION_BITMAPS) -> DataFrame:
    """Rows whose id is in none of the bitmaps where these are few; else all rows.

    Spark moves a condition below a projection that works out the id, but not a join: rows
    that are not carried are then never typed.
    """
    if bitmaps.limit(most + 1).count() > most:
        return df
    found = bitmaps.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits")))).scalar()
    bits = F.try_element_at(found, F.bitmap_bucket_number(key))
    return df.where(~F.coalesce(_has_bit(bits, F.bitmap_bit_position(key)), F.lit(False)))


def _has_bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def merge_rows(fresh: DataFrame, carried: DataFrame) -> DataFrame:
    """Union by position."""
    if len(fresh.columns) != len(carried.columns):
        raise ValueError("both sides need the same columns in the same order")
    return fresh.union(carried)


def merge_distinct(fresh: DataFrame, carried: DataFrame) -> DataFrame:
    """Union by position, then distinct over whole rows.

    One shuffle, hashed on the whole row, so no account or date can make a hot
    task; copies are collapsed in the map tasks before it.
    """
    return merge_rows(fresh, carried).distinct()


def merge_distinct_by(fresh: DataFrame, carried: DataFrame, telling: Sequence[str], max_broadcast: int = BROADCAST_KEYS) -> DataFrame:
    """:func:`merge_distinct` without a shuffle of whole rows, where few rows are alike in the ``telling`` columns.

    Equal rows have equal telling columns, so a row that is alone with the hash of these is
    distinct as it stands.  Planning counts the hashes, 8 bytes a row; the rows of those
    found more than once are compared as a whole, and all others stay where they lie.  Rows
    alike in the telling columns cost time and never a result; with more than
    ``max_broadcast`` such hashes all rows take the shuffle of :func:`merge_distinct`.
    """
    both, digest = merge_rows(fresh, carried), F.xxhash64(*telling)
    repeated = checkpointed(repeated_hashes(both, telling))
    found = repeated.count()
    if found > max_broadcast:
        return both.distinct()
    if not found:
        return as_grouped(both)
    few = [r["_digest"] for r in repeated.limit(CONDITION_HASHES + 1).collect()]
    marked, repeated = both.withColumn("_digest", digest), F.broadcast(repeated)
    alone = as_grouped(marked.join(repeated, "_digest", "left_anti").select(*both.columns))
    if len(few) <= CONDITION_HASHES:
        # A condition reaches below the projection, a join does not: only these rows are typed once more.
        compared = both.where(digest.isin(few))
    else:
        compared = marked.join(repeated, "_digest", "left_semi").select(*both.columns)
    return alone.union(compared.distinct())


def repeated_hashes(both: DataFrame, telling: Sequence[str]) -> DataFrame:
    """``(_digest)``: the hashes of the ``telling`` columns that more than one row has."""
    hashes = both.select(F.xxhash64(*telling).alias("_digest"))
    return hashes.groupBy("_digest").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_digest")


def as_grouped(df: DataFrame) -> DataFrame:
    """The rows as grouping gives them, which makes -0.0 the zero it equals."""
    return df.select(*[(F.col(c) + F.lit(0.0)).cast(t).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def write_tasks(rows: Mapping[str | None, int], task_rows: int, tasks: int) -> tuple[dict[str | None, tuple[int, int]], int]:
    """Where the rows of each date are written: date -> (first task, number of tasks), and the tasks in all.

    A date of more than ``task_rows`` rows gets as many tasks of its own as they fill.
    Smaller ones stay whole and share tasks, largest first into the emptiest, in at least
    ``tasks`` of them while there are so many dates.  ``None`` stands for all other dates.
    """
    out, used = {}, 0
    for date, n in rows.items():
        if n > task_rows or date is None:
            out[date] = (used, max(1, -(-n // task_rows)))
            used += out[date][1]
    small = sorted((d for d in rows if d not in out), key=lambda d: (-rows[d], d))
    shared = min(len(small), max(tasks, -(-sum(rows[d] for d in small) // task_rows)))
    loads = [(0, used + i) for i in range(shared)]
    for date in small:
        load, task = heapq.heappop(loads)
        out[date] = (task, 1)
        heapq.heappush(loads, (load + rows[date], task))
    return out, used + shared


def merge_clustered(
    fresh: DataFrame,
    carried: DataFrame,
    by: str,
    rows: int | Mapping[str | None, int],
    task_rows: int = TASK_ROWS,
    distinct: bool = False,
) -> DataFrame:
    """:func:`merge_distinct`, laid out for a write partitioned by ``by``, in one shuffle.

    ``rows`` are upper bounds of the rows by date, or of all of them as one number.  They
    decide which tasks write which date, see :func:`write_tasks`; a row of a large date is
    dealt by a hash of the whole row, so copies meet, and a date gets a file for each of
    its tasks.  Copies are not collapsed before the shuffle; a batch in which one row is
    repeated very often should take :func:`merge_distinct` and a clustered write.  With
    ``distinct`` the caller knows that no two rows are equal (see :func:`repeated_hashes`):
    then no task has to hold its wide rows to compare them.
    """
    both = merge_rows(fresh, carried)
    rows = {None: rows} if isinstance(rows, int) else {None: 0, **rows}
    places, tasks = write_tasks(rows, task_rows, int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.lit(places[None][0]), F.lit(places[None][1])
    if len(places) > 1:
        known = {date: F.struct(*map(F.lit, p)) for date, p in places.items() if date is not None}
        found = F.create_map(*[x for date, p in known.items() for x in (F.lit(date), p)])[F.col(by).cast("string")]
        place = F.coalesce(found["col1"], place[0]), F.coalesce(found["col2"], place[1])
    task = (place[0] + F.pmod(F.xxhash64(*both.columns), place[1])).cast("int")
    dealt = both.withColumn("_task", task).repartitionById(tasks, "_task")
    return as_grouped(dealt.drop("_task")) if distinct else dealt.distinct().drop("_task")
