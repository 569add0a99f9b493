import math
import zlib

import numpy as np

from perfmart.llm import language
from perfmart.llm.queries import QUERIES
from data import docs, naive_buckets, none, small  # noqa: F401


def test_held_out_accuracy(spark, small):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op3_subword_language_id"](spark, small).collect()
    assert len(rows) == len(truth)
    right = total = 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            total += 1
            right += r["lang_pred"] == truth[r["doc_id"]]["lang"]
    assert right >= 0.9 * total > 0


def test_edge_texts(spark, docs, none):
    model = language.fit(docs)
    got = language.predict(docs, model).collect()
    assert len(got) == docs.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (5, 6, 7)} == {"und"}
    assert {r["lang_pred"] for r in got if r["doc_id"] in (0, 13)} == {"en"}
    few = spark.createDataFrame([(1, "12 + 3 — !"), (2, "é"), (3, "z")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.predict(few, model).orderBy("doc_id").collect()] == ["und", "en", "en"]
    assert {r["lang_pred"] for r in language.predict(few, None).collect()} == {"und"}
    assert language.fit(none) is None and language.predict(none, None).count() == 0


def test_the_held_out_fold_is_never_learned_from(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert language.labelled_sample(docs).filter("fold = 2").isEmpty()


def test_scores_against_means_of_ngrams(spark, small):
    """The query's prediction for every document, worked out n-gram by n-gram from the same model."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.fit(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language.predict(docs, model).collect():
        text = texts[r["doc_id"]] or ""
        buckets = naive_buckets(text, language.TABLE, language.BITS)
        if not language.has_letter(text):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
            continue
        mean = [sum(model.weights[b][k] for b in buckets) / len(buckets) / model.temperature for k in range(len(model.languages))]
        top = max(range(len(mean)), key=mean.__getitem__)
        score = 1 / sum(math.exp(x - mean[top]) for x in mean)
        assert r["lang_pred"] == model.languages[top] and abs(r["score"] - score) < 1e-9
        assert r["accepted"] == (r["score"] >= model.threshold)


def test_temperature_and_threshold():
    rng = np.random.default_rng(3)
    truth = rng.integers(0, 3, 600)
    logits = rng.normal(size=(600, 3)) + 2 * np.eye(3)[truth]
    temperature, threshold = language.calibrate(logits * 4, truth)
    loss = lambda t: -np.log(language._softmax(logits * 4 / t)[np.arange(600), truth]).mean()
    assert all(loss(temperature) <= loss(t) + 1e-12 for t in np.geomspace(0.02, 5, 40))
    p = language._softmax(logits * 4 / temperature)
    sure = p.max(axis=1) >= threshold
    assert sure.sum() > 20 and (p.argmax(axis=1) == truth)[sure].mean() >= language.PRECISION
    assert language.calibrate(np.empty((0, 3)), np.empty(0, int)) == (1.0, 0.0)


def test_the_sample_is_bounded(spark):
    repeated = spark.range(500).selectExpr("8L as doc_id", "'the same text' as text", "'en' as lang")
    many = spark.range(300).selectExpr("id as doc_id", "concat('text ', id) as text", "concat('l', id % 40) as lang")
    for frame in (repeated, many, repeated.union(many)):
        assert language.labelled_sample(frame, 30).count() <= 30
    assert language.labelled_sample(many, 1000).select("lang").distinct().count() == 40
