"""Connected components of links in Spark: large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart.llm.shared import staged


def _least_parents(links: DataFrame) -> DataFrame:
    return links.groupBy("node").agg(F.min("parent").alias("_least"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node, and its other parents, to its least parent."""
    met = links.join(_least_parents(links), "node")
    to_least = F.array(
        F.struct(F.col("node").alias("node"), F.col("_least").alias("parent")),
        F.struct(F.col("parent").alias("node"), F.col("_least").alias("parent")),
    )
    return met.select(F.inline(to_least)).filter("node <> parent").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every node to the least parent of its parent; roots have none, so their rows stay."""
    up = _least_parents(links).withColumnRenamed("node", "parent")
    return links.join(up, "parent", "left").select("node", F.coalesce("_least", "parent").alias("parent")).distinct()


def components(links: DataFrame) -> DataFrame:
    """The root, which is the least node, of every node that has a link.

    `links` has rows (node, parent) of one type, in either direction; self links and nulls
    count for nothing.  Each round costs shuffles of the links alone, minima are combined
    before them, and a root with very many members is on the side of a join that adaptive
    execution can split.  Each round is staged, so a lost executor costs one round at most.
    """
    links = staged(
        links.filter("node <> parent").select(F.greatest("node", "parent").alias("node"), F.least("node", "parent").alias("parent")).distinct(),
        "links",
    )
    while True:
        links = staged(_large_star(_small_star(links)), "links")
        nested = links.join(links.select(F.col("node").alias("parent")), "parent", "left_semi")
        several = links.groupBy("node").count().filter("count > 1")
        if nested.isEmpty() and several.isEmpty():
            break
    roots = links.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return links.select("node", F.col("parent").alias("root")).unionByName(roots)
