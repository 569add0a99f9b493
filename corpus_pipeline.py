"""A training corpus from `documents`: rules, near-duplicates, benchmark, mix, shards.

Each stage works on what its predecessor kept, and its result is written and read again.
The stages are the operators of perfmart.llm with their own parameters; the near-duplicate
stage searches operator 2's Gray index with wider fingerprints, of five-word shingles, and
links what an exact similarity of 0.8 confirms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perfmart.llm import decontaminate, mixing, near_copies, quality_rules, sharding
from perfmart.llm.shared import read_table, staged

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    rules = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_copies.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them: 0 to 3 times."""
    return mixing.mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, and with the shard it would have if there were one more."""
    return sharding.assign_shards(docs, "doc_id", SHARDS)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

#: The learned rules and the hashes of the later stages are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
