"""Names of locations, by inner join to one dimension per level."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.functions.casts import legacy_long
from perfmart.operators.joins import BROADCAST_ROWS, fits
from perfmart.session import checkpointed, compiled

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Stands for text that is no number.  With a key that is never NULL, the inner
# join adds no null test, which would work out every key a second time per row.
_NO_LOCATION = -(2**63)


def dims_fit(dims: dict[str, DataFrame], max_rows: int = BROADCAST_ROWS) -> dict[str, bool]:
    """Which dimensions are small enough to broadcast (one job for all of them)."""
    rows = [d.select(F.lit(level).alias("level")).limit(max_rows + 1) for level, d in dims.items()]
    counted = {r["level"]: r["count"] for r in reduce(DataFrame.union, rows).groupBy("level").count().collect()}
    return {level: counted.get(level, 0) <= max_rows for level in dims}


def lookup_names(
    df: DataFrame,
    dims: dict[str, DataFrame],
    keys: dict[str, Column],
    broadcast: Mapping[str, bool] | bool | None = None,
    max_rows: int = BROADCAST_ROWS,
    keep: Sequence[Column] | None = None,
) -> DataFrame:
    """Add ``<level>_name`` for every level; keep rows that resolve at all of them.

    ``dims`` are ``(id, cannonicalname)``.  ``keys`` are text; they are compared as
    numbers where the dimension's id is a number.  A dimension that fits is broadcast.
    For the larger ones the distinct tuples of their ids that ``df`` has are worked out
    and kept: a job that reads these columns of ``df`` and shuffles tuples.  While what a
    level's ids resolve to fits ``max_rows``, it is broadcast, and the wide rows are not
    shuffled.  All other levels are resolved in one shuffle, see :func:`_by_tuples`.
    ``keep`` are the columns to return beside the names, in place of ``df``'s; they are
    worked out before that shuffle, so that it moves no others.
    """
    keep = [F.col(f"`{c}`") for c in df.columns] if keep is None else keep
    used = {level: dims[level] for level in keys}
    if broadcast is None:
        broadcast = dims_fit(used)
    if isinstance(broadcast, bool):
        broadcast = dict.fromkeys(keys, broadcast)
    large = {}
    for level, key in sorted(keys.items(), key=lambda k: not broadcast[k[0]]):
        dim = used[level].select(
            F.col("id").alias("_key"), F.col("cannonicalname").alias(f"{level}_name")
        )
        if isinstance(dim.schema["_key"].dataType, _INTEGRAL):
            dim = dim.withColumn("_key", F.col("_key").cast("bigint"))
            dim = dim.where(F.col("_key") != _NO_LOCATION)
            key = F.coalesce(legacy_long(key), F.lit(_NO_LOCATION))
        if broadcast[level]:
            df = df.withColumn("_key", key).join(F.broadcast(dim), "_key").drop("_key")
        else:
            df = df.withColumn(f"_{level}_key", key)
            large[f"_{level}_key"] = dim.withColumnRenamed("_key", f"_{level}_key")
    if not large:
        return df.select(*keep, *_names(keys))
    with compiled(df.sparkSession):
        # The dimensions have no such key; without the rows that do, no task gets them all.
        tuples = checkpointed(df.select(*large).where(_located(large)).distinct())
        for key, dim in [*large.items()]:
            found = dim.join(tuples.select(key).distinct(), key, "left_semi")
            if fits(found, max_rows):
                df = df.join(F.broadcast(found), key)
                del large[key]
        if not large:
            return df.select(*keep, *_names(keys))
        here = [*keep, *_names(level for level in keys if f"_{level}_key" not in large)]
        return _by_tuples(df, tuples, large, here, max_rows)


def _names(levels: Iterable[str]) -> list[Column]:
    return [F.col(f"{level}_name") for level in levels]


def _located(dims: Mapping[str, DataFrame]) -> Column:
    numbers = [F.col(k) != _NO_LOCATION for k, dim in dims.items() if isinstance(dim.schema[k].dataType, T.LongType)]
    return reduce(Column.__and__, numbers, F.lit(True))


def _by_tuples(
    df: DataFrame, tuples: DataFrame, dims: Mapping[str, DataFrame], keep: Sequence[Column], max_rows: int
) -> DataFrame:
    """Resolve several large levels, whose keys are columns of ``df``, in one shuffle of ``df``'s rows.

    The ``tuples`` of keys meet the dimensions one after the other, and are kept with their names.
    The rows then meet the tuples as a whole, as the streamed side of a hash join: they are not
    sorted, so that wide rows do not spill.  Those that will not resolve are dropped before, see
    :func:`_among`, and of the others ``keep`` is shuffled.
    """
    named = tuples.select(*dims).distinct()
    for key, dim in dims.items():
        named = named.join(dim, key)
    named = checkpointed(named)
    for key, dim in dims.items():
        if isinstance(dim.schema[key].dataType, T.LongType):
            df = _among(df, named, key, max_rows)
    return df.select(*keep, *dims).join(named.hint("shuffle_hash"), [*dims]).drop(*dims)


def _among(df: DataFrame, named: DataFrame, key: str, max_rows: int) -> DataFrame:
    """Rows whose number is one of ``named``'s, which are broadcast as words of 64 bits; where
    these are too many, all rows that have a number."""
    word, bit = F.shiftright(key, 6), F.col(key).bitwiseAND(F.lit(63)).cast("int")
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    words = checkpointed(named.groupBy(word.alias("_word")).agg(bits.alias("_bits")))
    if not fits(words, max_rows):
        return df.where(F.col(key) != _NO_LOCATION)
    joined = df.join(F.broadcast(words), word == F.col("_word"))
    return joined.where(F.getbit("_bits", bit) == 1).drop("_word", "_bits")
