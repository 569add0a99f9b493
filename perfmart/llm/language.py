"""Language identification by averaged hashed subword embeddings and a linear softmax.

Stochastic gradient descent in numpy trains the model on the driver, from a bounded sample
of labelled texts; the model then scores every whole text in tasks.  A temperature and a
threshold are fitted on labelled texts that it was not trained on: a prediction below the
threshold is marked as not accepted.

Edge cases: a null text, and one without a letter, is `und` with score 0; without labelled
rows everything is `und`; ties go to the language that is first in order; repeated rows get
equal predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.bytewords import slices
from perfmart.llm.subwords import Grams, byte_table, grams

UNKNOWN = "und"
BITS = 15
DIMENSIONS = 16
#: Passes over the sample; a small sample gets more, for so many steps at least.
EPOCHS = 6
LEAST_STEPS = 500
BATCH = 32
RATE = 4.0
#: Labelled texts for training and calibration at most, in all languages together, and the languages.
SAMPLE = 4000
MOST_LANGUAGES = 1000
CALIBRATION_FOLD = 1
HELD_OUT_FOLD = 2
FOLDS = 4
#: Share of accepted predictions that must be right on the calibration fold.
PRECISION = 0.995
#: No task holds the n-grams of more text at a time, but for a single longer text.
SLICE_BYTES = 1 << 20

TABLE = byte_table("", fold_case=True)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray
    temperature: float
    threshold: float

    def scores(self, rows: Grams) -> np.ndarray:
        return _softmax(rows.means(self.weights) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def fold(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def labelled_sample(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most `size` labelled texts outside the held-out fold: about the same number of each language, by a hash of the id."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold() != HELD_OUT_FOLD))
    usual = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = {r["lang"]: r["count"] for r in usual.collect()}
    if not counts:
        return known.select("text", "lang", fold().alias("fold")).limit(0)
    each = max(1, size // len(counts))
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    drawn = known.filter(draw < shares[F.col("lang")]).select("text", "lang", fold().alias("fold"), draw.alias("draw")).distinct()
    return drawn.orderBy("draw", "text", "lang").limit(size).select("text", "lang", "fold")


def train(examples: list[tuple[tuple[np.ndarray, np.ndarray], int]], classes: int, seed: int = 7) -> np.ndarray:
    """Bucket weights (embeddings times softmax weights) after SGD with a falling rate."""
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, classes), np.float32)
    batches = -(-len(examples) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    steps, step = epochs * batches, 0
    for _ in range(epochs):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            picked = [examples[i] for i in order[at : at + BATCH]]
            ids = np.concatenate([x[0] for x, _ in picked])
            share = np.concatenate([x[1] for x, _ in picked])
            owner = np.repeat(np.arange(len(picked)), [len(x[0]) for x, _ in picked])
            hidden = np.zeros((len(picked), DIMENSIONS), np.float32)
            np.add.at(hidden, owner, embed[ids] * share[:, None])
            error = _softmax(hidden @ out)
            error[np.arange(len(picked)), [y for _, y in picked]] -= 1
            rate = RATE * (1 - step / steps)
            back = error @ out.T
            out -= rate * hidden.T @ error / len(picked)
            np.subtract.at(embed, ids, rate * share[:, None] * back[owner])
            step += 1
    return (embed @ out).astype(np.float64)


def calibrate(logits: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the least score at which enough predictions are right."""
    if not len(truth):
        return 1.0, 0.0
    grid = np.geomspace(0.02, 5, 40)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    probability = _softmax(logits / temperature)
    score, right = probability.max(axis=1), probability.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    enough = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION)
    return temperature, float(score[order][enough[-1]]) if len(enough) else 1.0


def fit(docs: DataFrame, size: int = SAMPLE) -> Model | None:
    """The model, from texts and languages outside the held-out fold; None without any."""
    rows = []
    for r in labelled_sample(docs, size).toLocalIterator():
        raw = r["text"].encode()
        found = grams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), TABLE, BITS)
        if found.bounds[-1]:
            rows.append((found.row(0), r["lang"], r["fold"]))
    if not rows:
        return None
    languages = sorted({lang for _, lang, _ in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    learned = [(x, number[lang]) for x, lang, part in rows if part != CALIBRATION_FOLD]
    kept_back = [(x, number[lang]) for x, lang, part in rows if part == CALIBRATION_FOLD]
    weights = train(learned or kept_back, len(languages))
    logits = np.array([(weights[ids] * share[:, None]).sum(axis=0) for (ids, share), _ in kept_back]).reshape(-1, len(languages))
    return Model(languages, weights, *calibrate(logits, np.array([y for _, y in kept_back], int)))


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """For each document its predicted language, the score, and whether the score is high enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(2)
            name, score, sure = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for data, offsets, first in slices(text, SLICE_BYTES) if model else ():
                p = model.scores(grams(data, offsets, TABLE, BITS))
                best = p.argmax(axis=1)
                plain = ((data[offsets[0] : offsets[-1]] | 32) >= 97) & ((data[offsets[0] : offsets[-1]] | 32) <= 122)
                letters = np.r_[0, np.cumsum(plain)][offsets - offsets[0]]
                for i in range(len(best)):
                    # ASCII letters are counted; only a text without one is looked at letter by letter.
                    if letters[i + 1] > letters[i] or has_letter(text[first + i].as_py()):
                        name[first + i] = model.languages[best[i]]
                        score[first + i] = p[i, best[i]]
                        sure[first + i] = p[i, best[i]] >= model.threshold
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(name, pa.string()), pa.array(score), pa.array(sure)], RESULT.names
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(fold() == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, RESULT)
