"""Small hand-made documents with the cases that the operators define, and fixtures."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot string"

PROSE = "the cat sat on the mat while a small dog ran over the green hill and looked for its ball near the old stone wall"
OTHER = "one may well ask why seven rivers meet below this town when every map draws them apart from here to the wide sea"


def rows():
    """Nulls in every column, empty and blank and very long texts, ties, repeated rows, and columns with clashing names."""
    texts = [
        PROSE,
        PROSE,
        PROSE.upper(),
        PROSE.replace("ball", "bone"),
        OTHER,
        None,
        "",
        " \t\n",
        "word",
        "two words",
        "x" * 3000,
        " ".join(f"w{i}" for i in range(30_000)),
        f"{OTHER} {PROSE} tail",
        "é" * 70 + " ünï cödé " + PROSE,
        "spam " * 200,
    ]
    out = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or ""), "a", "b") for i, t in enumerate(texts)]
    return [*out, out[4], out[4], (None, PROSE, None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def naive_buckets(text, table, bits):
    """The buckets of all n-grams of 3 and 4 bytes of a text between blanks whose inner bytes are no blanks, one by one."""
    from perfmart.llm.subwords import FACTORS

    raw = bytes([32, *(int(table[b]) for b in text.encode()), 32])
    out = []
    for at in range(len(raw)):
        for n in (3, 4):
            gram = raw[at : at + n]
            if len(gram) == n and 32 not in gram[1:-1]:
                out.append((int.from_bytes(gram, "little") * FACTORS[n] % 2**64) >> (64 - bits))
    return out
