import random
import zlib
from collections import defaultdict
from itertools import combinations_with_replacement
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perfmart.llm import packing
from perfmart.llm.queries import QUERIES
from data import docs, none, small  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, texts, tokenizer, capacity):
    """Pieces rebuild each text's ids, and sequences have no gap and no overlap; returns the number of sequences."""
    want = sorted((i, p, s, len(ids[s : s + capacity]), crc(ids[s : s + capacity])) for i, ids in ((i, ids_of(tokenizer, t)) for i, t in texts) for p, s in enumerate(range(0, len(ids), capacity)))
    assert sorted(tuple(r[c] for c in NAMES[:5]) for r in rows) == want
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in at.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(at)


def test_query_over_all_documents(spark, small, tokenizer):
    rows = QUERIES["op11_minimum_bin_slack"](spark, small).collect()
    assert rows[0].asDict().keys() == set(NAMES)
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    used = check(rows, texts, tokenizer, 2048)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_edge_rows_and_real_sequences(docs, none, tokenizer):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    packed = packing.pack(docs, PATH, ["doc_id", "shard"], 100, with_ids=True)
    assert packed.columns == ["doc_id", "shard", *NAMES[1:5], "ids", "sequence_id", "offset"]
    rows = packed.collect()
    check([r for r in packing.pack(docs.filter("doc_id IS NOT NULL"), PATH, None, 100).collect()], texts, tokenizer, 100)
    assert sum(r["doc_id"] is None and r["length"] == 1 for r in rows) == 1
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert all(whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"] for r in rows)
    assert sum(map(len, whole.values())) == sum(r["length"] for r in rows)
    assert packing.pack(none, PATH).count() == 0


def test_words_seen_before_give_the_ids_of_the_whole_text(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SPLIT_CHARS", 50)
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    texts = ["It's  a\ttest, isn't it?", "ÀÉ ŒUVRE don't Σίσυφος ΟΔΟΣ", "a<|endoftext|>b <|startoftext|> c", "x" * 300, None, "", " a b\x0bc\x1cd", "é é ́x", "1234 5.6 日本語 🙂🙂!", "a\u00a0b\u2003\u0301c\u3000d\x85e\u2028f\u180eg\u200bh", "a\x1cb c\x1fd"]
    texts += [" ".join(random.Random(1).choices("the of and in WORLD, isn't 42 %% naïve".split(), k=500)), " lead and trail \n"] * 3
    encoder = packing.Encoder(Path(PATH).read_text(), True)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.ids(texts)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_tokenizer_that_keeps_blanks(spark):
    other = Tokenizer.from_file(BYTES)
    texts = [(1, " two  blanks and\nlines "), (2, None)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), BYTES, None, 8, drops_blanks=False).collect()
    check(rows, texts, other, 8)


def test_the_fullest_combination():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.randrange(5, 40)
        counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        first = max(counts)
        found = dict(packing.fullest(counts, first, capacity))
        assert found[first] >= 1 and all(n <= counts[x] for x, n in found.items())
        left = counts | {first: counts[first] - 1}
        pool = sorted(left)
        best = max(
            (first + sum(c) for k in range(capacity // pool[0] + 1) for c in combinations_with_replacement(pool, k) if all(c.count(x) <= left[x] for x in pool) and first + sum(c) <= capacity),
            default=first,
        )
        assert sum(x * n for x, n in found.items()) == best


@pytest.mark.parametrize("seed", range(5))
def test_bins_hold_all_pieces(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 2049): rng.randrange(1, 10 ** rng.randrange(1, 9)) for _ in range(400)}
    bins = packing.fill_bins(counts, 2048)
    held = defaultdict(int)
    for b in bins:
        assert sum(x * n for x, n in b.lengths) <= 2048
        for x, n in b.lengths:
            held[x] += n * b.times
    assert held == counts and packing.fill_bins({}, 2048) == []
    least = -(-sum(x * n for x, n in counts.items()) // 2048)
    assert least <= sum(b.times for b in bins)


def test_a_length_that_most_pieces_have(spark, tokenizer):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text")).repartition(7)
    rows = packing.pack(frame, PATH, None, 10).collect()
    assert check(rows, [(i, "one two three") for i in range(3000)], tokenizer, 10) == 1500
