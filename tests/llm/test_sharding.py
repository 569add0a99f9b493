import struct
import zlib
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from perfmart.llm import sharding
from perfmart.llm.queries import QUERIES
from data import docs, none, small  # noqa: F401


def jump(key, shards):
    """The paper's loop."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def seed(n):
    return xxhash.xxh64_intdigest(struct.pack("<q", n), 42)


def test_jump_shard_equals_the_paper(spark):
    for shards in (1, 2, 8, 64, 65, 1000):
        got = spark.range(200).select("id", sharding.jump_shard(F.xxhash64("id"), shards).alias("x")).collect()
        assert all(r["x"] == jump(seed(r["id"]), shards) for r in got)


def test_beyond_the_usual_jumps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "USUAL_JUMPS", 2)
    got = spark.range(300).select("id", sharding.jump_shard(F.xxhash64("id"), 50).alias("x")).collect()
    assert all(r["x"] == jump(seed(r["id"]), 50) for r in got)


def test_one_shard_more_moves_rows_only_there(spark):
    got = sharding.assign_shards(spark.range(5000), "id", 8).collect()
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    assert 350 < sum(r["grown_shard"] == 8 for r in got) < 800


def test_query_over_all_documents(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    slots = defaultdict(list)
    for r in QUERIES["op1_jump_hash_sharding"](spark, small).collect():
        raw = texts.pop(r["doc_id"]).encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (jump(seed(r["doc_id"]), 8), jump(seed(r["doc_id"]), 9))
        slots[r["shard"]].append(r["slot"])
    assert not texts
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_slots_of_repeated_rows(spark, none):
    rows = spark.createDataFrame([(1, 0)] * 50 + [(2, 0), (None, 0), (None, 0), (3, 1)], "k long, shard int")
    first = sorted(map(str, sharding.number_slots(rows, buckets=3, chunk=7).collect()))
    assert first == sorted(map(str, sharding.number_slots(rows.repartition(5), buckets=3, chunk=7).collect()))
    slots = [r["slot"] for r in sharding.number_slots(rows, buckets=3, chunk=7).collect() if r["shard"] == 0]
    assert sorted(slots) == list(range(53))
    assert sharding.number_slots(rows.limit(0)).count() == 0


def test_edge_rows_keep_their_columns(docs, none):
    placed = sharding.assign_shards(docs.drop("shard"), "doc_id", 8)
    assert placed.count() == docs.count()
    assert placed.filter("doc_id IS NULL").select("shard").distinct().count() == 1
    assert sharding.assign_shards(none.drop("shard"), "doc_id", 8).count() == 0
