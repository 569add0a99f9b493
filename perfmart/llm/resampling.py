"""Importance resampling towards a target distribution, with a cutoff from a bracketed quantile.

Features are runs of consecutive words, hashed into buckets.  One pass counts the buckets of
the corpus, another those of the target; the logarithms of their ratios, an array of BUCKETS
whole numbers, weigh each document by the mean over its features.  With Gumbel noise drawn
from its id, the highest scores are a sample without replacement in proportion to the weights.

The cutoff is found without sorting the corpus.  A quantile sketch gives a bracket of scores
around it.  Exact counts of the rows above and inside the bracket tell whether the cutoff
lies inside; if not, the bracket is widened.  Only the bracket is sorted, over the
cluster, and its row at the remaining position is the cutoff.  Rows are then chosen by
comparing them with it.  The drawn ones are numbered by ranges of their order.

Edge cases: a null or blank text has no features, weight 0 and is never drawn; a null id has
the noise of an empty one and comes after others of its score; rows equal in all columns are
drawn one by one; without a target every gain is that of its count of zero; an empty table
gives an empty one.  Columns that are kept ride along in one struct, so clashing names cannot
matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.numbering import PLACE, numbered, places
from perfmart.llm.shared import staged
from perfmart.llm.terms import encoded, terms

BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Rows that the sketch may misplace are one in ACCURACY; the bracket has MARGIN times as many on either side.
ACCURACY = 10_000
MARGIN = 2
#: Features whose buckets a task keeps.
KEPT_FEATURES = 500_000


@dataclass(frozen=True)
class Plan:
    """What decides the features and the draw."""

    buckets: int = BUCKETS
    longest: int = LONGEST_RUN
    least_words: int = LEAST_WORDS
    percent: int = PERCENT
    seed: int = SEED


class _Buckets(dict):
    """The bucket of each feature, worked out when first asked for."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KEPT_FEATURES:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def features(text: bytes | None, longest: int) -> Iterator[list[bytes]]:
    """The runs of 1 to `longest` words of a text, in parts, and in each part its words first."""
    before: list[bytes] = []
    for words in terms(text):
        yield words
        for length in range(2, longest + 1):
            run = before[len(before) - length + 1 :] + words if length - 1 <= len(before) else before + words
            yield [b" ".join(run[i : i + length]) for i in range(len(run) - length + 1)]
        before = (before + words)[max(0, len(before) + len(words) - longest + 1) :]


def bucket_counts(texts: DataFrame, plan: Plan) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = _Buckets(plan.buckets), np.zeros(plan.buckets, np.int64)
        for batch in batches:
            for text in encoded(batch.column(0)):
                for part in features(text, plan.longest):
                    held += np.bincount(np.fromiter(map(bucket.__getitem__, part), np.int64, len(part)), minlength=plan.buckets)
        found = np.flatnonzero(held)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(held[found])], ["bucket", "n"])

    out = np.zeros(plan.buckets, np.int64)
    for r in texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket the logarithm of its share in the target over that in the corpus, in thousandths, floored."""
    s, t, buckets = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + buckets) / ((a + 1.0) * (t + buckets)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, plan: Plan, keep: list[str]) -> DataFrame:
    """Of every document `row` (the columns `keep`), doc_id, n_features, n_words, weight, and its place."""
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), "doc_id", "text")
    schema = T.StructType([*rows.schema.fields[:2], *[T.StructField(c, T.LongType()) for c in ("n_features", "n_words", "weight")], *PLACE])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, first = _Buckets(plan.buckets), 0
        for batch in batches:
            found = []
            for text in encoded(batch.column(2)):
                n, words, total = 0, 0, 0
                for i, part in enumerate(features(text, plan.longest)):
                    n += len(part)
                    words += 0 if i % plan.longest else len(part)
                    total += int(gain[np.fromiter(map(bucket.__getitem__, part), np.int64, len(part))].sum())
                found.append((n, words, total // n if n else 0))
            if found:
                numbers = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *numbers, *places(first, batch.num_rows)], schema.names)
            first += batch.num_rows

    return rows.mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


PLACES = ["score", "doc_id", "_part", "_nth"]


def _order() -> list:
    """The highest score first, of equal ones the least doc_id; the place tells equal rows apart."""
    return [F.desc("score"), F.asc_nulls_last("doc_id"), "_part", "_nth"]


def _before_or_at(rows: DataFrame, cutoff) -> Column:
    """Whether a row comes before the row `cutoff` in order, or is it."""
    def key(value):
        return F.struct(-value("score"), value("doc_id").isNull(), value("doc_id"), value("_part"), value("_nth"))

    return key(lambda c: rows[c]) <= key(lambda c: F.lit(cutoff[c]).cast(rows.schema[c].dataType))


def bracket(rows: DataFrame, k: int, n: int, accuracy: int = ACCURACY, margin: float = MARGIN) -> tuple[int, int, int]:
    """Scores (low, high) between which the k-th highest of n lies, and the number of rows above."""
    width = margin / accuracy
    while True:
        ends = [max(0.0, 1 - k / n - width), min(1.0, 1 - k / n + width)]
        some = rows.agg(F.percentile_approx("score", F.array(*map(F.lit, ends)), F.lit(accuracy)).alias("q"), F.min("score").alias("min"), F.max("score").alias("max")).first()
        low = some["q"][0] if ends[0] > 0 else some["min"]
        high = some["q"][1] if ends[1] < 1 else some["max"]
        held = rows.agg(F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score").between(low, high)).alias("inside")).first()
        if held["above"] < k <= held["above"] + held["inside"]:
            return low, high, held["above"]
        width *= 4


def cutoff(rows: DataFrame, k: int, n: int, accuracy: int = ACCURACY, margin: float = MARGIN):
    """The k-th of n rows in order; only the rows of the bracket are sorted."""
    low, high, above = bracket(rows, k, n, accuracy, margin)
    inside = numbered(rows.filter(F.col("score").between(low, high)).select(*PLACES), _order(), "bracket", "_rank")
    return inside.filter(F.col("_rank") == k - above).first()


def resample(docs: DataFrame, target: DataFrame, keep: list[str] | None = None, plan: Plan = Plan(), accuracy: int = ACCURACY, margin: float = MARGIN) -> DataFrame:
    """Every document's columns `keep` (by default doc_id), n_features, weight, score, and rank if it is drawn.

    The draw takes `plan.percent` of the documents with `plan.least_words` words.
    """
    gain = gains(bucket_counts(docs, plan), bucket_counts(target, plan))
    scored = weighed(docs, gain, plan, keep or ["doc_id"])
    rows = staged(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), plan.seed)), "scored")
    eligible = rows.filter(F.col("n_words") >= plan.least_words)
    n = eligible.count()
    k = plan.percent * n // 100
    shown = ["row.*", "n_features", "weight", "score"]
    if not k:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= plan.least_words) & _before_or_at(rows, cutoff(eligible, k, n, accuracy, margin))
    ranked = numbered(rows.filter(drawn), _order(), "drawn", "rank").select(*shown, "rank")
    return rows.filter(~drawn).select(*shown, F.lit(None).cast("long").alias("rank")).unionByName(ranked)
