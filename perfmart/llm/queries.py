"""One query for each operator of this folder, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm import (
    decontaminate,
    language,
    lexical,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    resampling,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
)
from perfmart.llm.shared import read_table

SHARDS = 8


def op1_jump_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in SHARDS shards by jump consistent hashing of doc_id."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    placed = sharding.assign_shards(docs, "doc_id", SHARDS)
    return sharding.number_slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op2_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents, and the groups that links of up to 3 bits form."""
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op3_subword_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; the fold crc32(doc_id) mod 4 = 2 is never learned from."""
    docs = read_table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op4_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents to the weights 1, 2, 3 of their sources."""
    return mixing.mix_table(read_table(spark, sf_dir, "documents"))


def op5_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of personal data in all documents."""
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"))


def op6_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents by a scorer that weak labels train; `labels` is not read."""
    docs = read_table(spark, sf_dir, "documents")
    return quality_model.score_documents(docs, quality_model.fit(docs))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without the 50-byte strings that start in earlier ones."""
    return suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents"))


def op8_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a passage of `benchmark`, with the item and the place."""
    return decontaminate.contaminations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of secrets in all documents, told apart by how many sources hold each value."""
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op10_learned_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of all documents, and the verdict of a decision list learned from labels."""
    docs = read_table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    m = F.col("_m")
    return quality_rules.judged(docs, rules).select(
        "doc_id",
        m["n_words"].alias("n_words"),
        m["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"),
        m["n_dup_lines"].alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"),
        F.col("_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.when(F.col("_rule") > 0, F.col("_rule")).alias("rule"),
    )


def op11_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_bag_class_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each item of `benchmark`."""
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draw of a tenth of all documents towards the words of `benchmark`."""
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_jump_hash_sharding,
        op2_gray_simhash,
        op3_subword_language_id,
        op4_hash_threshold_mix,
        op5_weak_supervision_pii,
        op6_weak_label_quality,
        op7_suffix_array_dedup,
        op8_simhash_decontamination,
        op9_ownership_secrets,
        op10_learned_decision_list,
        op11_minimum_bin_slack,
        op12_bag_class_search,
        op13_importance_resampling,
    )
}

_LOWERED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"unnest(regexp_extract_all({_LOWERED.format(text='text')}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'))"

#: The other results are not plain SQL: they rest on checksums, 64-bit hashes, tokenizers and learned models.
ORACLE: dict[str, str] = {
    "op12_bag_class_search": f"""
WITH words AS (SELECT doc_id, {_TERMS} AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS documents, cast(sum(n) AS BIGINT) AS terms FROM lengths),
asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, cast(floor(1000 * ln(cast(2 * any_value(documents) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, total GROUP BY term
),
classes AS (SELECT doc_id, 10 + (90 * n * documents) // terms AS m FROM lengths, total),
scores AS (
  SELECT item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN classes USING (doc_id) GROUP BY ALL
)
SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
""",
}
