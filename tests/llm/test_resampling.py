import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from perfmart.llm import resampling
from perfmart.llm.queries import QUERIES
from perfmart.llm.resampling import Plan
from data import docs, none, small  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, plan=Plan()):
    """(doc_id, n_features, weight, score, rank) of every row by the definition."""
    bucket = lambda f: zlib.crc32(f.encode()) % plan.buckets
    held = [(i, *grams(t, plan.longest)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in held for f in fs)
    t = Counter(bucket(f) for x in target for f in grams(x, plan.longest)[1])
    S, T, B = sum(s.values()), sum(t.values()), plan.buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + B) / ((s[b] + 1) * (T + B))))
    out = []
    for i, words, fs in held:
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{plan.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= plan.least_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = able[: plan.percent * len(able) // 100]
    ranks = [(r[0], r[2], r[3], r[4], k) for k, r in enumerate(drawn, 1)]
    left = Counter(out) - Counter(drawn)
    return sorted(ranks + [(r[0], r[2], r[3], r[4], None) for r in left.elements()], key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_query_over_all_documents(spark, small):
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = QUERIES["op13_importance_resampling"](spark, small)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert result(found) == brute(rows, target)


@pytest.mark.parametrize(("longest", "piece"), [(1, 5), (2, 1 << 20), (3, 5)])
def test_edge_rows_and_longer_runs(spark, docs, none, monkeypatch, longest, piece):
    import perfmart.llm.terms as module

    monkeypatch.setattr(module, "PIECE_BYTES", piece)
    plan = Plan(buckets=50, longest=longest, least_words=2, percent=40)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 5000]
    target = spark.createDataFrame([("The small DOG",), (None,), ("",)], "text string")
    some = docs.filter("coalesce(length(text), 0) < 5000")
    assert result(resampling.resample(some, target, plan=plan)) == brute(rows, ["The small DOG", None, ""], plan)
    assert result(resampling.resample(some, target.limit(0), plan=plan)) == brute(rows, [], plan)
    assert resampling.resample(none, target, plan=plan).count() == 0


def test_columns_that_are_kept(spark, docs):
    plan = Plan(least_words=2, percent=50)
    clash = docs.withColumnRenamed("shard", "_part").withColumnRenamed("slot", "_nth")
    found = resampling.resample(clash, docs, ["doc_id", "_part", "_nth"], plan)
    assert found.columns == ["doc_id", "_part", "_nth", "n_features", "weight", "score", "rank"]
    assert found.count() == docs.count()


def rows_of_scores(spark, scores):
    made = [(s, i % 50 if i % 7 else None, i % 3, i) for i, s in enumerate(scores)]
    return spark.createDataFrame(made, "score long, doc_id long, _part int, _nth long"), sorted(made, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2], r[3]))


@pytest.mark.parametrize("accuracy", [1, 1000])
def test_the_cutoff_with_sketches_of_any_accuracy(spark, accuracy):
    rng = random.Random(5)
    for scores in ([rng.randrange(5) for _ in range(400)], [7] * 200, [rng.randrange(10**6) for _ in range(300)] + [3] * 150):
        frame, want = rows_of_scores(spark, scores)
        for k in (1, 40, len(scores)):
            low, high, above = resampling.bracket(frame, k, len(scores), accuracy, 0.01)
            assert above == sum(s > high for s in scores) and low <= want[k - 1][0] <= high
        assert tuple(resampling.cutoff(frame, 40, len(scores), accuracy, 0.01))[:4] == want[39]


def test_a_row_that_is_half_of_the_table(spark):
    text = " ".join(["same"] * 30)
    frame = spark.range(400).select(F.when(F.col("id") < 250, 1).otherwise(F.col("id")).alias("doc_id"), F.lit(text).alias("text")).repartition(5)
    found = resampling.resample(frame, frame)
    ranks = sorted(r["rank"] for r in found.filter("rank IS NOT NULL").collect())
    assert ranks == list(range(1, 41)) and found.count() == 400
    assert result(found) == brute([(r["doc_id"], text) for r in frame.collect()], [text] * 400)
