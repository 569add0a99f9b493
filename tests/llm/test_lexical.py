import math
import re
from collections import Counter

import pytest

from perfmart.llm import lexical
from perfmart.llm.queries import ORACLE, QUERIES
from perfmart.llm.terms import terms
from data import docs, none, small  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, top=10):
    """(item, rank, doc, score) by the definition, from lists of (id, text)."""
    held = [(i, Counter(words(t))) for i, t in rows]
    n = sum(bool(c) for _, c in held)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 10 + 90 * sum(c.values()) * n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words(text)) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def both(spark, rows, items, **more):
    frames = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert result(lexical.search(*frames, **more)) == brute(rows, items, more.get("top", 10))


def test_query_over_all_documents(spark, small):
    tables = [[tuple(r)[:2] for r in spark.read.parquet(f"{small}/{t}.parquet").collect()] for t in ("documents", "benchmark")]
    found = QUERIES["op12_bag_class_search"](spark, small)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(found) == brute(*tables)
    assert "op12_bag_class_search" in ORACLE


@pytest.mark.parametrize("block", [2, 512])
def test_ties_copies_and_blocks(spark, block):
    rows = [(i, "alpha beta") for i in range(30)] + [(i, "Alpha beta, other words") for i in range(30, 45)] + [(100, "gamma"), (100, "gamma"), (None, "gamma"), (101, "delta " * 3)]
    items = [(1, "alpha"), (2, "beta gamma"), (3, "nowhere"), (4, None), (5, ""), (6, "DELTA delta"), (1, "delta alpha")]
    both(spark, rows, items[:6], block_items=block)
    both(spark, rows, items[:6], block_items=block, top=3)
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert lexical.search(spark.createDataFrame(rows, "doc_id long, text string"), frame.union(frame), block_items=block).count() == 10 + 10 + 1 + 10


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(lexical.F, "xxhash64", lambda *c: lexical.F.lit(7).cast("long"))
    both(spark, [(i, "a b " * (i % 5 + 1)) for i in range(40)], [(1, "a"), (2, "b c")])


def test_edge_rows(spark, docs, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "the cat and one word"), (2, "ünï cödé"), (3, None)]
    frame = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, score int")
    assert result(lexical.search(docs, frame)) == brute(rows, items)
    assert lexical.search(none, frame).count() == 0 and lexical.search(docs, frame.limit(0)).count() == 0


def test_small_matrices_give_the_same(spark, monkeypatch, small):
    want = result(QUERIES["op12_bag_class_search"](spark, small))
    monkeypatch.setattr(lexical, "CELLS", 1)
    assert result(QUERIES["op12_bag_class_search"](spark, small)) == want


def test_terms_of_long_texts(monkeypatch):
    import perfmart.llm.terms as module

    text = "ab, Cdé" * 40 + " " + "x" * 100 + "  " + "y z" * 9
    want = [w.encode() for w in words(text)]
    for size in (1, 3, 7, 64, 1 << 20):
        monkeypatch.setattr(module, "PIECE_BYTES", size)
        assert [w for part in terms(text.encode()) for w in part] == want
    assert list(terms(None)) == [] and list(terms(b"")) == []
