import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from perfmart.llm import components, simhash
from perfmart.llm.queries import QUERIES
from perfmart.llm.shared import staged
from data import docs, none, small  # noqa: F401


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    runs = [words[i : i + 3] for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(prints, radius=3):
    """The least id reachable, by comparing all pairs."""
    ids = sorted(prints)
    x = np.array([prints[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(x[a + 1 :] ^ x[a]) <= radius) + a + 1:
            p, q = sorted((top(a), top(int(b))))
            root[q] = p
    return {ids[a]: ids[top(a)] for a in range(len(ids))}


def clusters(seed, n, centres=4, most=9):
    rng = np.random.default_rng(seed)
    middle = rng.integers(0, 1 << 63, centres, dtype=np.uint64)
    out = {}
    for i in range(n):
        x = int(middle[i % centres])
        for b in rng.integers(0, 64, rng.integers(0, most + 1)).tolist():
            x ^= 1 << b
        out[i] = x
    return out


def test_query_over_all_documents(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_groups(prints)
    rows = QUERIES["op2_gray_simhash"](spark, small).collect()
    assert len(rows) == len(texts)
    assert all((r["fingerprint"], r["component_id"]) == (f"{prints[r['doc_id']]:016x}", want[r["doc_id"]]) for r in rows)


def test_dense_clusters_and_hot_nodes(spark, monkeypatch):
    prints = clusters(3, 1500)
    want = brute_groups(prints)
    values = np.array([prints[i] for i in sorted(prints)], np.uint64).view(np.int64).tolist()
    rows = staged(spark.createDataFrame(list(enumerate(values)), "doc_id long, _fp long"), "rows")
    for hot in (simhash.HOT_ROWS, 5):
        plain = simhash.links
        monkeypatch.setattr(simhash, "links", lambda d, radius, hot=hot, plain=plain: plain(d, radius, hot))
        got = rows.join(simhash.groups(rows), "_fp").collect()
        monkeypatch.setattr(simhash, "links", plain)
        assert all(r["component_id"] == want[r["doc_id"]] for r in got) and len(got) == len(prints)


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 1000), st.integers(1, 400), st.integers(0, 3))
def test_forest_equals_all_pairs(seed, n, radius):
    x = np.unique(np.array(list(clusters(seed, n, 3, 7).values()), np.uint64))
    x = x[np.argsort(simhash.gray_rank(x))]
    want = brute_groups({i: int(v) for i, v in enumerate(x)}, radius)
    assert simhash.forest(x, radius).tolist() == [want[i] for i in range(len(x))]


def test_gray_rank():
    code = np.arange(64, dtype=np.uint64)
    assert simhash.gray_rank(code ^ (code >> np.uint64(1))).tolist() == code.tolist()


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 100 + i) for i in range(1, 80)]
    links = spark.createDataFrame([*chain, *star, *star, (7, 7), (None, 3)], "node long, parent long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100 + i: 100 for i in range(80)}
    assert components.components(links.limit(0)).count() == 0


def test_edge_rows(docs, none):
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["fingerprint"] for i in (5, 6, 7)} == {"0" * 16} and {by_id[i]["component_id"] for i in (5, 6, 7)} == {5}
    assert by_id[None]["component_id"] in (0, 5)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in got})
    assert simhash.simhash_groups(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0
