from collections import defaultdict

import pytest

from perfmart.llm import mixing
from perfmart.llm.queries import QUERIES
from data import docs, none, small  # noqa: F401


def shares(sizes, most=3):
    """Targets by resharing the excess until no source is above `most` times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        each = rest / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if each * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else each * weight[s] for s in order}
        capped |= above


def hold(rows, docs):
    source = {r["doc_id"]: r["source"] for r in docs}
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs}
    sums, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["taken"] in [r["size"] * k for k in range(4)]
        sums[s] += r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    want = shares(sums)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sums[s] and r["target"] == pytest.approx(want[s])
    for s in sums:
        # The boundary is one document: the nearer side of it is at most half of it away.
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1


def test_query_over_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = QUERIES["op4_hash_threshold_mix"](spark, small).collect()
    hold(rows, docs)
    again = QUERIES["op4_hash_threshold_mix"](spark, small).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}


def test_small_sources_are_capped(spark):
    docs = [(i, "w " * (1 + i % 3), None if i % 50 == 0 else ("big" if i % 10 else "a")) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    hold(mixing.mix_table(frame).collect(), frame.collect())


def test_many_sources_join_by_a_part_of_the_hash(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "a b c " * (i % 5), f"s{i % 7}") for i in range(300)], "doc_id long, text string, source string")
    wide = {tuple(r) for r in mixing.mix_table(frame).collect()}
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert {tuple(r) for r in mixing.mix_table(frame).collect()} == wide


def test_the_mix_repeats_rows(docs, none):
    table, mixed = mixing.mix_table(docs), mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in table.collect())
    assert table.count() == docs.count()
    assert mixing.mix_table(none).count() == 0 and mixing.mix_documents(none).count() == 0


@pytest.mark.parametrize("chunk", [7, 65_536])
def test_a_threshold_ends_inside_equal_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = [(7, "one two three " * 20, "a")] * 300 + [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(100, 300)] + [(9, "x y", None)] * 40
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    table = mixing.mix_table(frame).collect()
    hold(table, frame.collect())
    assert len(table) == len(rows) and len({r["taken"] for r in table if r["doc_id"] == 7}) == 2
    mixed = mixing.mix_documents(frame)
    words, want = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        words[r["source"]] += len(r["text"].split())
    for r in table:
        want[{r2[0]: r2[2] for r2 in rows}[r["doc_id"]]] += r["taken"]
    target = {r["source_size"]: r["target"] for r in table}
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("a", "b", None)}
    assert all(abs(words[s] - target[sizes[s]]) <= 31 and abs(want[s] - target[sizes[s]]) <= 31 for s in sizes)
    copies = defaultdict(int)
    for r in mixed.collect():
        copies[r["doc_id"]] += 1
    assert copies[7] <= 900 and all(n <= 3 for i, n in copies.items() if i not in (7, 9))
