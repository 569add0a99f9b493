import random
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from perfmart.llm import near_copies, simhash
from data import docs, none, small  # noqa: F401


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def brute(texts):
    """The ids that stay: of documents linked by a five-word Jaccard of 0.8 or more, the least."""
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        if min(len(sets[a]), len(sets[b])) * 5 >= max(len(sets[a]), len(sets[b])) * 4:
            shared = len(sets[a] & sets[b])
            if shared * 5 >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {top(i) for i in texts}


def edited(seed=1):
    """Documents of random words with copies of 1 to 8 changed words, chains of copies, and a common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(50_000)}"
    passage = " ".join(word() for _ in range(60))
    out = []
    for size, changes in [(12, 1), (40, 1), (100, 1), (100, 2), (200, 1), (200, 2), (200, 4), (400, 4), (400, 8)] * 6:
        text = [word() for _ in range(size)]
        out.append(" ".join(text))
        for _ in range(3):
            for at in rng.sample(range(size), changes):
                text[at] = word()
            out.append(" ".join(text))
    out += [f"{passage} " + " ".join(word() for _ in range(rng.randrange(5, 40))) for _ in range(60)]
    rng.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("hot_rows", [3, 200])
def test_the_stage_finds_every_pair_of_a_similarity(spark, monkeypatch, hot_rows):
    texts = edited()
    monkeypatch.setattr(near_copies.drop_near_copies, "__defaults__", (near_copies.SIMILARITY, hot_rows))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()} == brute(texts)


def test_all_documents(spark, small):
    frame = spark.read.parquet(f"{small}/documents.parquet")
    kept = near_copies.drop_near_copies(frame)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == brute({r["doc_id"]: r["text"] for r in frame.collect()})


def test_edge_rows(docs, none):
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    kept = near_copies.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(brute(texts))
    assert near_copies.drop_near_copies(none).count() == 0


def test_common_shingles_come_last(spark):
    frame = spark.createDataFrame(list(edited().items()), "doc_id long, text string").repartition(1)
    common = near_copies.common_shingles(frame, 30)
    assert len(common) == 56 and np.all(np.diff(common.astype(object)) > 0)


def large_group(size=150, seed=2):
    """Copies of one text with three of 100 words changed: few pairs of them are similar, all are to the text, which comes last."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(50_000)}" for _ in range(100)]
    out = []
    for _ in range(size):
        text = list(base)
        for at in rng.sample(range(100), 3):
            text[at] = f"w{rng.randrange(50_000)}"
        out.append(" ".join(text))
    return dict(enumerate([*out, *[" ".join(f"v{rng.randrange(99)}" for _ in range(8)) for _ in range(40)], " ".join(base)]))


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_a_large_group_gives_a_forest(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", block)
    texts = large_group()
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    seen = []
    edges = near_copies.open_edges
    monkeypatch.setattr(near_copies, "open_edges", lambda *a: seen.append((a[0].count(), edges(*a).count())) or edges(*a))
    kept = {r["doc_id"] for r in near_copies.drop_near_copies(frame).collect()}
    assert kept == brute(texts)
    [(rows, links)] = seen
    assert links <= rows


def test_shared_shingles_against_sets(monkeypatch):
    monkeypatch.setattr(near_copies, "CELLS", 40)
    rng = np.random.default_rng(4)
    for dense in (1, 4, 100):
        monkeypatch.setattr(near_copies, "DENSE", dense)
        sets = [np.unique(rng.integers(0, 60, rng.integers(1, 30))) for _ in range(25)]
        ends = np.r_[0, np.cumsum([len(s) for s in sets])]
        got = {}
        for some, shared in near_copies.shared_shingles(ends, np.concatenate(sets), np.arange(3, 25)):
            shared[np.arange(len(some)), some] = 0  # a set beside itself is of no interest
            got |= dict(zip(some.tolist(), shared.tolist(), strict=True))
        assert got == {i: [float(len(np.intersect1d(sets[i], s))) * (k != i) for k, s in enumerate(sets)] for i in range(3, 25)}


def test_wide_fingerprints_in_gray_order():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, (70, 4), dtype=np.uint64)
    whole = [sum(int(w) << (64 * (3 - k)) for k, w in enumerate(row)) for row in x]
    rank = [sum(int(w) << (64 * (3 - k)) for k, w in enumerate(row)) for row in simhash.gray_rank(x)]
    assert all(r ^ (r >> 1) == w for r, w in zip(rank, whole, strict=True))
    near = np.concatenate([x, x ^ (rng.random((70, 4)) < 0.5).astype(np.uint64)])
    near = near[sorted(range(140), key=lambda i: [int(w) for w in simhash.gray_rank(near)[i]])]
    for radius in (3, 66, 256):
        label = simhash.forest(near, radius)
        root = np.arange(140)
        i, j = np.nonzero(np.triu(np.bitwise_count(near[:, None] ^ near[None]).sum(axis=2) <= radius, 1))
        assert (label == simhash.merged(root, i, j)).all()


@pytest.mark.parametrize("texts", [edited(), large_group()])
def test_the_stage_searches_the_gray_index(spark, monkeypatch, texts):
    # Without the searches nothing is linked: no plainer path stands beside them.
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    none_found = lambda meeting, similarity: meeting.select("node", F.col("node").alias("parent")).limit(0)
    monkeypatch.setattr(near_copies, "neighbour_edges", none_found)
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()} == brute(texts)
    monkeypatch.setattr(near_copies, "open_edges", none_found)
    assert len(brute(texts)) < corpus_pipeline.near_duplicates(spark, frame, "").count() == len({frozenset(shingles(t)) for t in texts.values()})
