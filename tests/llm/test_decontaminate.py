import re
from collections import Counter

import numpy as np

from perfmart.llm import decontaminate
from perfmart.llm.queries import QUERIES
from data import none, small  # noqa: F401


def words(text):
    return [m.group().lower() for m in re.finditer(rb"[A-Za-z0-9\x80-\xff]+", (text or "").encode())]


def shingles(ws):
    return Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))


def brute(docs, items):
    """The best similarity of every document and item, over all windows."""
    out = {}
    for item, text in items.items():
        want, n = shingles(words(text)), len(words(text))
        if n < 5:
            continue
        for doc, body in docs.items():
            ws = words(body)
            if not set(want) & set(shingles(ws)):
                continue
            best = max((sum((shingles(ws[i : i + n]) & want).values()) / (n - 4) for i in range(len(ws) - n + 1)), default=0)
            if best >= 0.8 - 1e-9:
                out[doc, item] = best
    return out


def test_query_over_all_documents(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    rows = QUERIES["op8_simhash_decontamination"](spark, small).collect()
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows} == brute(docs, items)


def test_changed_and_moved_passages(spark, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega one two three four five six"
    changed = item.split()
    changed[15] = "changed"
    docs = {
        1: f"before it {item} after it",
        2: item.upper().replace(" ", ", "),
        3: " ".join(changed),
        4: " ".join(changed[:10]),
        5: None,
        6: "",
        7: "alpha beta",
        8: f"x {item} y {item}",
        9: " ".join(reversed(item.split())),
    }
    items = {1: item, 2: "alpha beta gamma", 3: None, 4: item, 5: ""}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = brute(docs, items)
    assert {d for d, _ in want} == {1, 2, 3, 8}
    for block in (1, 100):
        got = decontaminate.contaminations(frame, bench, block).collect()
        assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in got} == want
        kept = decontaminate.drop_contaminated(frame, bench, block)
        assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7, 9]
    assert decontaminate.drop_contaminated(none, bench).count() == 0
    assert decontaminate.contaminations(frame, bench.limit(0)).count() == 0


def test_the_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(1)
    items = [(i, " ".join(f"w{rng.integers(0, 3000)}" for _ in range(30))) for i in range(200)]
    index = decontaminate.build_index(items)
    for target in range(0, 200, 20):
        bits = np.unpackbits(index.fingerprints[target].view(np.uint8), bitorder="little")
        bits[rng.choice(128, decontaminate.RADIUS, replace=False)] ^= 1
        turned = np.packbits(bits, bitorder="little").view(np.uint16)
        apart = np.bitwise_count(index.fingerprints ^ turned).sum(axis=1)
        assert sorted(index.near(turned, 30)) == np.flatnonzero(apart <= decontaminate.RADIUS).tolist()


def test_window_starts_lose_nothing():
    rng = np.random.default_rng(2)
    for _ in range(200):
        size = int(rng.integers(5, 20))
        at = np.flatnonzero(rng.random(40) < 0.8)
        need = decontaminate.needed(size - 4)
        want = [s for s in range(0, 44 - size + 1) if ((at >= s) & (at <= s + size - 5)).sum() >= need]
        assert decontaminate.window_starts(at, size, 0, 44).tolist() == want


def test_items_that_repeat_a_shingle(spark):
    """A window of exactly 0.8 whose missing fifth is one shingle over and over: far off in bits, but similar."""
    docs, items = {}, {}
    for i, repeats in enumerate((15, 25, 35)):
        own = [f"a{i}w{k}" for k in range(4 * repeats)]
        items[i] = " ".join([*own, *["again"] * (repeats + 4)])
        docs[i] = "before " + " ".join([*own, *[f"b{i}w{k}" for k in range(repeats + 4)]]) + " after"
        docs[10 + i] = " ".join([*own[repeats:], *["again"] * (repeats + 4)])
    want = brute(docs, items)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminations(frame, bench).collect()} == want
