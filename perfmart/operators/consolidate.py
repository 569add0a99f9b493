"""One wide table from the criteria slices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from perfmart.operators.carry import in_window


def consolidate(slices: list[DataFrame], start: str, end: str) -> DataFrame:
    """Rows of the window from every slice, by column name; absent columns are NULL.

    The range is applied to each slice, so it prunes that slice's partitions.
    Nothing is deduplicated and nothing is shuffled.
    """
    windows = [in_window(s, start, end) for s in slices]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), windows)
