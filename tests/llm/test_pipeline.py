from collections import Counter, defaultdict

import corpus_pipeline
from perfmart.llm import quality_rules, sharding
from perfmart.llm.shared import staged
from pyspark.sql import functions as F
from test_decontaminate import brute as leaks
from test_mixing import shares
from test_near_copies import brute as first_copies
from data import docs, none, small  # noqa: F401


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = [staged(docs, "start")]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], small), "stage"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == docs.columns
    texts = [{r["doc_id"]: r["text"] for r in k.collect()} for k in kept]

    rules = quality_rules.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    passed = {r["doc_id"] for r in quality_rules.judged(docs, rules).filter("_kept").collect()}
    assert set(texts[1]) == passed

    assert set(texts[2]) == first_copies(texts[1])

    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    assert set(texts[3]) == set(texts[2]) - {d for d, _ in leaks(texts[2], items)}

    source = {r["doc_id"]: r["source"] for r in kept[3].collect()}
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    copies = Counter(r["doc_id"] for r in kept[4].collect())
    assert set(copies) <= set(texts[3]) and max(copies.values()) <= 3
    for i, t in texts[3].items():
        n = len(t.encode().split())
        sizes[source[i]] += n
        taken[source[i]] += n * copies[i]
        largest[source[i]] = max(largest[source[i]], n)
    assert all(abs(taken[s] - want) <= largest[s] / 2 + 1 for s, want in shares(sizes).items())

    placed = kept[4].withColumn("want", sharding.jump_shard(F.xxhash64("doc_id"), 8)).select("doc_id", "want").distinct()
    assert kept[5].join(placed, "doc_id").filter("shard <> want").isEmpty()
    assert kept[5].count() == kept[4].count()


def test_run_applies_the_stages(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0


def test_edge_rows_and_empty_tables(spark, docs, none, small):
    plain = docs.drop("shard")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, plain, small)
        assert set(plain.columns) <= set(out.columns) and out.count() <= 3 * docs.count()
        assert stage(spark, none.drop("shard"), small).count() == 0


def test_columns_of_any_name_pass_through(spark, docs, small):
    names = ["_fp", "_key", "_hash", "_size", "_copy", "_copies", "_m", "_w", "_l", "_c", "_kept", "_rule", "column_3", "a.b"]
    clash = docs.drop("shard", "slot")
    for i, name in enumerate(names):
        clash = clash.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    clash = staged(clash, "clash")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, clash, small)
        assert kept.columns == clash.columns
        plain = stage(spark, clash.select("doc_id", "text", "lang", "source", "n_chars"), small)
        ids = lambda df: Counter(r["doc_id"] for r in df.collect())
        assert ids(kept) == ids(plain), name
        for r in kept.collect():
            assert [r[n] for n in names] == [f"{i}:{'none' if r['doc_id'] is None else r['doc_id']}" for i in range(len(names))]
