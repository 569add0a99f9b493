"""Equi-joins whose right side may or may not be small.

The right side is broadcast only after its row count is checked.  Beyond the
bound both sides are shuffled on the key plus a salt, so a key that holds a
third of the left side is spread over ``salts`` tasks; the right side, one row
per key or nearly so, is repeated once per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
SALTS = 16


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than one beyond."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def row_salt(df: DataFrame, salts: int) -> Column:
    """A salt that a rerun of the same task repeats.

    The partition id is mixed in so that copies of one row held by different
    tasks do not all get the same salt.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(salts))


def bounded_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    broadcast: bool,
    salts: int = SALTS,
) -> DataFrame:
    """Join on one column that both sides have.

    ``how`` must keep no unmatched right rows: inner, left, left_semi, left_anti.
    ``broadcast`` says that the caller has checked the size of ``right``.
    """
    if broadcast:
        return left.join(F.broadcast(right), on, how)
    salted = left.withColumn("_salt", row_salt(left, salts))
    spread = right.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return salted.join(spread, [on, "_salt"], how).drop("_salt")
