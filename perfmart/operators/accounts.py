"""Account status: who is fetched, and who is reported as deactivated."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENABLED = "2"


def is_active() -> Column:
    """Status 2 is enabled; every other status, also a missing one, is not."""
    return F.coalesce(F.col("status").cast("string") == ENABLED, F.lit(False))


def account_status(accounts: DataFrame) -> DataFrame:
    """Every account with ``state``: active or deactivated."""
    return accounts.withColumn("state", F.when(is_active(), "active").otherwise("deactivated"))


def active_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.where(is_active())


def deactivated_accounts(accounts: DataFrame, feeds: Iterable[str] | None = None) -> DataFrame:
    """Deactivated accounts, one row per ``(feed, account_id)`` where feeds are given.

    The feeds are a short fixed list, so each account row is repeated in place:
    no join, no shuffle, and no list that holds all accounts of a feed.
    """
    off = accounts.where(~is_active())
    if feeds is None:
        return off
    names = F.array(*[F.lit(f) for f in feeds])
    return off.select(F.explode(names).alias("feed"), "account_id")
