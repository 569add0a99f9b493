"""Quality classifier: a weak-label model and a hashed linear scorer.

Heuristic labellers vote good, bad or nothing on every document.  Expectation-maximisation
estimates how reliable each is from the counts of all vote patterns, without any gold
label, and gives each pattern a probability of being good.  These labels train a linear
model on hashed subwords and a few measures of the text, which then scores every text, so
that it also judges where the labellers are silent.

The votes of all documents are summed by pattern (at most 3^LABELLERS rows); the linear
model is trained on a bounded sample.

Edge cases: a null or empty text scores 0 and is not kept; repeated rows score equally;
rows without an id are drawn by their text alone; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.bytewords import slices, words_of
from perfmart.llm.shared import staged
from perfmart.llm.subwords import byte_table, grams

MARKS = "#*$%&|<>!"
BITS = 15
#: Texts that train the linear model at most, the first by a hash of id and text.
SAMPLE = 6000
#: Passes over the sample; a small sample gets more, for so many steps at least.
EPOCHS = 8
LEAST_STEPS = 500
BATCH = 32
RATE = 1.0
ROUNDS = 60
KEEP_FROM = 0.5
#: The prior weighs as much as so many documents, whatever their number.
PRIOR_DOCUMENTS = 30.0
SLICE_BYTES = 1 << 20

TABLE = byte_table(MARKS, fold_case=False)
_CODES = np.arange(256)
CAPITAL = ((_CODES >= 65) & (_CODES <= 90)).astype(np.uint8)
LETTER = (((_CODES | 32) >= 97) & ((_CODES | 32) <= 122) | (_CODES >= 128)).astype(np.uint8)
MARK = np.isin(_CODES, [ord(c) for c in MARKS]).astype(np.uint8)
LINE_END = (_CODES == 10).astype(np.uint8)

MEASURES = ("words", "capitals", "marks", "repeats", "word_length", "line_words")


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row: words, share of capitals among letters, marks per word, share of words equal to the one before, letters per word, words per line."""
    found = words_of(data, offsets)
    raw = data[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]

    def total(table: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(table[raw], dtype=np.int64)][at])

    n = np.diff(found.bounds)
    again = np.r_[False, found.hash[1:] == found.hash[:-1]][: len(found.hash)]
    again[found.bounds[:-1][found.bounds[:-1] < len(again)]] = False
    words, letters = np.maximum(n, 1), total(LETTER)
    return np.stack(
        [
            n,
            total(CAPITAL) / np.maximum(letters, 1),
            total(MARK) / words,
            np.diff(np.r_[0, np.cumsum(again)][found.bounds]) / words,
            letters / words,
            n / (total(LINE_END) + 1),
        ],
        axis=1,
    ).astype(np.float64)


def votes(m: np.ndarray) -> np.ndarray:
    """A row of votes for each row of measures: 1 good, -1 bad, 0 none.

    Four labellers each know one fault and are silent otherwise; two know good prose.
    """
    words, capitals, marks, repeats, length, line = m.T
    bad = [capitals > 0.15, marks > 0.1, repeats > 0.1, (length < 2) | (length > 14)]
    good = [
        (words > 0) & (capitals < 0.12) & (marks < 0.02) & (repeats < 0.03) & (length > 2.5) & (length < 12),
        (words >= 50) & (line > 6) & (line < 200) & (marks < 0.1),
    ]
    return np.stack([*(-x.astype(np.int8) for x in bad), *(x.astype(np.int8) for x in good)], axis=1)


FAULTS, LABELLERS = 4, 6
#: Expected shares of bad, no and good votes on bad and on good texts, of fault-finders and of the others.
PRIOR_FAULTS = ((0.3, 0.7, 1e-6), (0.003, 0.997, 1e-6))
PRIOR_PROSE = ((1e-6, 0.8, 0.2), (1e-6, 0.2, 0.8))


@dataclass(frozen=True)
class Labels:
    """What EM found: the prior of good, and for each labeller its chances of each vote on bad and good texts."""

    prior: float
    chances: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = [
            np.log(p) + sum(np.log(self.chances[k, y, patterns[:, k] + 1]) for k in range(patterns.shape[1]))
            for y, p in ((0, 1 - self.prior), (1, self.prior))
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def estimate(patterns: np.ndarray, counts: np.ndarray) -> Labels:
    """Dawid and Skene's model by EM over vote patterns, started from the doubt that any bad vote casts.

    A prior of PRIOR_DOCUMENTS says what the labellers were written for, so that the classes
    keep their meaning; how reliable each is, the votes decide.
    """
    bad, good = (patterns < 0).any(axis=1), (patterns > 0).any(axis=1)
    good = np.where(bad, 0.1, np.where(good, 0.95, 0.5))
    labels = Labels(0.5, np.full((patterns.shape[1], 2, 3), 1 / 3))
    for _ in range(ROUNDS):
        prior = float(np.clip((good * counts).sum() / counts.sum(), 0.01, 0.99))
        chances = np.empty((patterns.shape[1], 2, 3))
        for k in range(patterns.shape[1]):
            expected = PRIOR_FAULTS if k < FAULTS else PRIOR_PROSE
            for y, share in ((0, (1 - good) * counts), (1, good * counts)):
                seen = np.array([share[patterns[:, k] == v].sum() for v in (-1, 0, 1)]) + PRIOR_DOCUMENTS * np.array(expected[y])
                chances[k, y] = seen / seen.sum()
        labels = Labels(prior, chances)
        good = labels.posterior(patterns)
    return labels


def _shape(m: np.ndarray) -> np.ndarray:
    """Measures in a range that suits gradient descent, and a constant."""
    return np.stack([np.log1p(m[:, 0]) / 8, m[:, 1], np.minimum(m[:, 2], 2), m[:, 3], np.minimum(m[:, 4], 20) / 10, np.log1p(m[:, 5]) / 6, np.ones(len(m))], axis=1)


@dataclass(frozen=True)
class Scorer:
    buckets: np.ndarray
    dense: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text = grams(data, offsets, TABLE, BITS).means(self.buckets[:, None])[:, 0]
        z = text + _shape(measures(data, offsets)) @ self.dense
        return np.where(np.diff(offsets) > 0, 1 / (1 + np.exp(-np.clip(z, -60, 60))), 0.0)


def train(examples: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]], seed: int = 11) -> Scorer:
    """Logistic regression on soft labels; examples are (buckets, shares, shaped measures, label)."""
    rng = np.random.default_rng(seed)
    buckets, dense = np.zeros(1 << BITS), np.zeros(len(MEASURES) + 1)
    if not examples:
        return Scorer(buckets, dense)
    batches = -(-len(examples) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    steps, step = epochs * batches, 0
    for _ in range(epochs):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            picked = [examples[i] for i in order[at : at + BATCH]]
            ids, share = np.concatenate([x[0] for x in picked]), np.concatenate([x[1] for x in picked])
            owner = np.repeat(np.arange(len(picked)), [len(x[0]) for x in picked])
            shaped = np.stack([x[2] for x in picked])
            z = np.bincount(owner, buckets[ids] * share, len(picked)) + shaped @ dense
            error = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - np.array([x[3] for x in picked])
            rate = RATE * (1 - step / steps)
            np.subtract.at(buckets, ids, rate * 40 * share * error[owner])
            dense -= rate * error @ shaped / len(picked)
            step += 1
    return Scorer(buckets, dense)


def _voted(docs: DataFrame) -> DataFrame:
    """The vote pattern of each document, as a number in base 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int32)
            for data, offsets, first in slices(batch.column(0), SLICE_BYTES):
                v = votes(measures(data, offsets)).astype(np.int32) + 1
                out[first : first + len(v)] = v @ 3 ** np.arange(LABELLERS)
            yield pa.RecordBatch.from_arrays([pa.array(out)], ["pattern"])

    return docs.select("text").mapInArrow(run, "pattern int")


def fit(docs: DataFrame, size: int = SAMPLE) -> tuple[Labels, Scorer] | None:
    """Labeller reliabilities from the votes on all documents, and the scorer that they train; None without documents."""
    counted = staged(_voted(docs).groupBy("pattern").count(), "quality-votes").collect()
    if not counted:
        return None
    numbers = np.array([r["pattern"] for r in counted])
    counts = np.array([r["count"] for r in counted], float)
    labels = estimate(numbers[:, None] // 3 ** np.arange(LABELLERS) % 3 - 1, counts)
    share = min(1.0, size / counts.sum())
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    examples = []
    drawn = docs.filter(draw < share).filter("text <> ''").select("text", draw.alias("draw")).distinct()
    for r in drawn.orderBy("draw", "text").limit(size).toLocalIterator():
        raw = np.frombuffer(r["text"].encode(), np.uint8)
        offsets = np.array([0, len(raw)])
        m = measures(raw, offsets)
        ids, part = grams(raw, offsets, TABLE, BITS).row(0)
        examples.append((ids, part, _shape(m)[0], float(labels.posterior(votes(m).astype(int))[0])))
    return labels, train(examples)


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("weak_label", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def score_documents(docs: DataFrame, model: tuple[Labels, Scorer] | None) -> DataFrame:
    """For each document the scorer's probability of being good, that of the labellers alone, and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, weak = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for data, offsets, first in slices(batch.column(1), SLICE_BYTES) if model else ():
                rows = slice(first, first + len(offsets) - 1)
                score[rows] = model[1].scores(data, offsets)
                weak[rows] = model[0].posterior(votes(measures(data, offsets)).astype(int))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(weak), pa.array(score >= KEEP_FROM)], RESULT.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)
