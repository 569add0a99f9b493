import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from perfmart.llm import quality_model, quality_rules
from perfmart.llm.queries import QUERIES
from perfmart.llm.shared import staged
from data import docs, naive_buckets, none, small  # noqa: F401


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, inside = Counter(runs), set()
    for i, run in enumerate(runs):
        if seen[run] > 1:
            inside |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_query_over_all_documents(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op10_learned_decision_list"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, _, _, _, repeated = want = base(texts[r["doc_id"]])
        assert tuple(r[c] for c in BASE) == want
        assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_edge_texts(docs, none):
    for r in quality_rules.judged(docs, []).collect():
        assert tuple(r["_m"][c] for c in BASE) == base(r["text"])
    assert quality_rules.judged(none, []).count() == 0


def test_rules_are_learned_and_ordered(spark):
    good = [(i, "plain prose goes on here and there with many a different word " + " ".join(f"w{i}x{k}" for k in range(20))) for i in range(300)]
    bad = [(i, " ".join(f"b{i}{k}###" for k in range(30))) for i in range(300, 400)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    rules = quality_rules.fit(docs, labels)
    assert rules
    kept = {r["doc_id"] for r in quality_rules.judged(docs, rules).filter("_kept").collect()}
    assert kept == {i for i, _ in good}
    assert quality_rules.fit(docs, labels.limit(0)) == []
    sample = staged(quality_rules.labelled_sample(docs, labels, 50), "sample")
    assert sample.count() == 50


def test_weak_labels_find_faults(spark, small, docs, none):
    rows = QUERIES["op6_weak_label_quality"](spark, small).join(spark.read.parquet(f"{small}/labels.parquet"), "doc_id")
    shares = {r["quality"]: r["kept"] for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.95 and shares[0] < 0.3
    model = quality_model.fit(docs)
    scored = quality_model.score_documents(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert all(not r["kept"] for r in scored if r["doc_id"] in (5, 6))
    assert quality_model.score_documents(none, quality_model.fit(none)).count() == 0


def test_sample_stays_small_with_null_and_equal_ids(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_model, "train", lambda examples: seen.append(len(examples)))
    texts = spark.range(2000).selectExpr("concat('plain words of a text number ', id) as text", "id")
    quality_model.fit(texts.selectExpr("cast(null as bigint) as doc_id", "text"), size=100)
    quality_model.fit(texts.selectExpr("7L as doc_id", "text"), size=100)
    # One row over and over: it is drawn as a whole or not at all.
    for word in "abcdefgh":
        quality_model.fit(texts.selectExpr("7L as doc_id", f"'{word} b' as text"), size=500)
    assert 40 < seen[0] <= 100 and 40 < seen[1] <= 100
    assert max(seen[2:]) <= 1


def naive_em(rows):
    """Dawid and Skene's model on single documents, in plain Python; the chances of each labeller and the prior."""
    doubt = [0.1 if min(r) < 0 else 0.95 if max(r) > 0 else 0.5 for r in rows]
    for _ in range(quality_model.ROUNDS):
        prior = min(max(sum(doubt) / len(rows), 0.01), 0.99)
        chances = []
        for k in range(len(rows[0])):
            expected = quality_model.PRIOR_FAULTS if k < quality_model.FAULTS else quality_model.PRIOR_PROSE
            of = []
            for y in (0, 1):
                seen = [quality_model.PRIOR_DOCUMENTS * e for e in expected[y]]
                for r, g in zip(rows, doubt, strict=True):
                    seen[r[k] + 1] += g if y else 1 - g
                of.append([s / sum(seen) for s in seen])
            chances.append(of)
        doubt = []
        for r in rows:
            bad, good = 1 - prior, prior
            for k, v in enumerate(r):
                bad, good = bad * chances[k][0][v + 1], good * chances[k][1][v + 1]
            doubt.append(good / (bad + good))
    return prior, chances, doubt


def drawn_votes(rates, n=3000, bad=0.2, seed=1):
    """Votes of labellers with known shares of votes on bad and on good texts."""
    rng = np.random.default_rng(seed)
    is_bad = rng.random(n) < bad
    out = np.zeros((n, len(rates)), int)
    for k, (on_bad, on_good) in enumerate(rates):
        out[:, k] = (rng.random(n) < np.where(is_bad, on_bad, on_good)) * (-1 if k < quality_model.FAULTS else 1)
    return out, is_bad


def estimated(votes):
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    return quality_model.estimate(patterns, counts.astype(float))


def test_em_over_patterns_is_em_over_documents():
    votes, _ = drawn_votes([(0.4, 0.01), (0.3, 0.0), (0.2, 0.01), (0.05, 0.0), (0.1, 0.9), (0.2, 0.85)], n=400)
    labels = estimated(votes)
    prior, chances, doubt = naive_em(votes.tolist())
    assert abs(labels.prior - prior) < 1e-9 and np.allclose(labels.chances, chances, atol=1e-9)
    assert np.allclose(labels.posterior(votes), doubt, atol=1e-9)


@pytest.mark.parametrize("rate", [0.05, 0.3, 0.6, 0.9])
def test_estimates_follow_a_labellers_true_rate(rate):
    votes, _ = drawn_votes([(rate, 0.005), (0.5, 0.005), (0.4, 0.005), (0.3, 0.0), (0.1, 0.9), (0.15, 0.85)], n=20_000)
    assert abs(estimated(votes).chances[0, 0, 0] - rate) < 0.04


def test_a_labeller_that_turns_worthless_loses_its_weight():
    sharp = [(0.5, 0.002), (0.5, 0.005), (0.4, 0.005), (0.3, 0.0), (0.1, 0.9), (0.15, 0.85)]
    blind = [(0.3, 0.3), *sharp[1:]]
    told = {}
    for name, rates in (("sharp", sharp), ("blind", blind)):
        chances = estimated(drawn_votes(rates, n=20_000)[0]).chances
        told[name] = chances[0, 0, 0] / chances[0, 1, 0]
    assert told["sharp"] > 30 and told["blind"] < 1.5


def test_scores_against_means_of_ngrams(spark, small):
    """The query's scores of all documents, worked out n-gram by n-gram from the same model."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels, scorer = quality_model.fit(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_model.score_documents(docs, (labels, scorer)).collect():
        text = texts[r["doc_id"]] or ""
        raw = np.frombuffer(text.encode(), np.uint8)
        m = quality_model.measures(raw, np.array([0, len(raw)]))
        buckets = naive_buckets(text, quality_model.TABLE, quality_model.BITS)
        z = sum(scorer.buckets[b] for b in buckets) / max(len(buckets), 1) + float((quality_model._shape(m) @ scorer.dense)[0])
        assert abs(r["score"] - (1 / (1 + math.exp(-z)) if text else 0.0)) < 1e-9
        assert abs(r["weak_label"] - labels.posterior(quality_model.votes(m).astype(int))[0]) < 1e-9
        assert r["kept"] == (r["score"] >= quality_model.KEEP_FROM)
