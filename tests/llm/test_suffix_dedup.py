import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from perfmart.llm import suffix_dedup
from perfmart.llm.queries import QUERIES
from data import none, small  # noqa: F401


def brute(rows):
    """For each row what the definition says: every window against all windows of smaller documents."""
    least = {}
    for i, t in rows:
        raw = (t or "").encode()
        for at in range(len(raw) - 49 if i is not None else 0):
            least[raw[at : at + 50]] = min(i, least.get(raw[at : at + 50], i))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 49 if i is not None else 0):
            if least[raw[at : at + 50]] < i:
                gone[at : at + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone)))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r)[:5] for r in frame.collect()), key=str)


def hard_rows(seed=3):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(10, None), (11, ""), (12, "x" * 49), (13, "y" * 300), (14, "y" * 120), (15, base), (16, base), (17, base[:100] + "ZZ" + base[100:151] + "é" + base[150:])]
    rows += [(18, base[20:70]), (19, base[20:69]), (5, "q" + base[30:80] + base[300:] + base[30:80]), (None, base), (16, base), (21, base[::-1] * 2)]
    for i in range(30, 60):
        a, b = sorted(rng.sample(range(400), 2))
        rows.append((i, base[a:b] + "".join(rng.choice("xyz") for _ in range(9)) + base[:b]))
    return rows


def test_query_over_all_documents(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert result(QUERIES["op7_suffix_array_dedup"](spark, small)) == brute(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_overlapping_copies(spark, seed):
    rows = hard_rows(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(suffix_dedup.deduplicate(frame)) == brute(rows)


def test_hot_prefixes_are_split_without_a_change(spark):
    rng = random.Random(7)
    shared = "a passage of sixty bytes that very many of the documents have"
    own = lambda: "".join(rng.choice("klmnopq") for _ in range(60))
    rows = [(i, own() + shared[: rng.choice((50, 61))] + own()) for i in range(200)] + hard_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    checked = frame.withColumn("_check", F.lit(0).cast("long"))
    assert suffix_dedup.hot_prefixes(checked, 8).count() > 0
    assert suffix_dedup.hot_prefixes(checked, 10_000).count() == 0
    assert result(suffix_dedup.deduplicate(frame, hot_rows=8)) == result(suffix_dedup.deduplicate(frame)) == brute(rows)


def test_kept_bytes_and_empty_tables(spark, none):
    frame = spark.createDataFrame(hard_rows(), "doc_id long, text string")
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in suffix_dedup.deduplicate(frame, True).collect())
    assert suffix_dedup.deduplicate(none).count() == 0


def test_long_texts_in_parts(monkeypatch):
    raw = np.random.default_rng(1).integers(97, 101, 5000).astype(np.uint8)
    offsets = np.array([0, 3000, 3010, 5000])

    def covered():
        found = suffix_dedup.stretches(raw, offsets)
        out = {}
        for k in range(len(found["row"])):
            for start in range(found["first"][k], found["last"][k] + 1):
                out[found["row"][k], start] = (found["at"][k], found["gram"][k])
        return out

    whole = covered()
    monkeypatch.setattr(suffix_dedup, "LONG_BYTES", 1024)
    assert covered() == whole


def test_levels_merge_by_size():
    rng = np.random.default_rng(5)
    levels, found = [], []
    for k in range(9):
        gram = np.sort(rng.integers(0, 50, 40).astype(np.uint64))
        new = (gram, gram % np.uint64(3), np.full(40, k), np.full(40, k), np.arange(40))
        suffix_dedup.add_level(levels, new, found)
    sizes = [len(level[0]) for level in levels]
    assert sizes == sorted(sizes, reverse=True) and len(levels) <= 5


def test_stretches_with_equal_sides_differ_in_64_bits():
    """A passage whose minimizer has 50 equal bytes around it, while the stretch reaches into each document's own text."""
    rng = random.Random(11)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    wholes = []
    while not wholes:
        shared = draw(60)
        raws = [f"{draw(60)}{shared}{draw(60)}".encode() for _ in range(8_000)]
        data = np.frombuffer(b"".join(raws), np.uint8)
        p = suffix_dedup.stretches(data, np.arange(len(raws) + 1) * 180)
        inside = (p["at"] >= 77) & (p["at"] <= 87) & ((p["first"] < 60) | (p["last"] + 50 > 120))
        wholes = [raws[r][f : last + 50] + bytes([a - f]) for r, a, f, last in zip(*(p[k][inside].tolist() for k in ("row", "at", "first", "last")), strict=True)]
    doc = p["row"][inside].astype(np.int64)
    order, known = suffix_dedup.settle(p["gram"][inside], p["whole"][inside], doc)
    least = {}
    for w, d in zip(wholes, doc.tolist(), strict=True):
        least[w] = min(d, least.get(w, d))
    assert len(set(wholes)) > 6_000
    assert known.tolist() == [bool(doc[k] > least[wholes[k]]) for k in order.tolist()]


def test_repeated_rows_cost_no_more_than_being_read(spark, monkeypatch):
    rng = random.Random(13)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    shared = draw(120)
    rows = [(1, draw(50) + shared + draw(50)), (2, draw(70) + shared[10:110] + draw(30)), (3, draw(200))]
    repeated = rows[0]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    many = frame.union(spark.range(20_000).select(F.lit(repeated[0]), F.lit(repeated[1]))).repartition(4)
    asked, windows = [], suffix_dedup.windows
    monkeypatch.setattr(suffix_dedup, "windows", lambda *a: asked.append(windows(*a)) or asked[-1])
    want = {r[0]: r for r in brute(rows)}
    found = suffix_dedup.deduplicate(many).groupBy("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").count().collect()
    assert {tuple(r)[0]: tuple(r)[:5] for r in found} == want
    assert {r["doc_id"]: r["count"] for r in found} == {1: 20_001, 2: 1, 3: 1}
    assert asked[0].count() < 500
