"""Quality rules: base statistics and a learned decision list, in built-in functions only.

Sequential covering (as in RIPPER) grows conjunctions of thresholds on one part of the
labelled documents, prunes them on the other, removes what a rule covers and goes on.  The
rules come out as an ordered Spark CASE expression.

Edge cases: a null text has no words, so it fails the base rule; without labels, or where
no rule is precise enough, only the base rule rejects; repeated rows get equal verdicts;
other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfmart.llm.shared import BLANKS, let, plain_names, staged, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Labelled documents used for learning at most: those of the smallest hash of their id.
SAMPLE = 20_000
BINS = 64
MOST_RULES = 12
MOST_CONDITIONS = 3
LEAST_COVERED = 15
LEAST_PRECISION = 0.97

FEATURES = (
    "n_words",
    "word_length",
    "symbols_per_word",
    "exclamations_per_word",
    "capitals_per_char",
    "duplicate_lines",
    "repeated_words",
    "distinct_words",
    "words_per_line",
)


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(ws: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more; windows compare by XXH64."""

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            ordered,
            lambda o: F.filter(
                F.transform(
                    o, lambda p, k: F.when((p["h"] == F.get(o, k - 1)["h"]) | (p["h"] == F.get(o, k + 1)["h"]), p["i"])
                ),
                lambda i: i.isNotNull(),
            ),
        )
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sort_array(twice),
            zero,
            lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n")),
            lambda a: a["n"],
        )

    windows = F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))
    return F.when(F.size(ws) < WINDOW + 1, F.lit(0)).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
    )


def measure(docs: DataFrame) -> DataFrame:
    """`docs` with a struct `_m` of base statistics and features of the whole text."""
    text = F.coalesce(docs["text"], F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.size(F.array_distinct(ws)).cast("long").alias("n_distinct"),
            _repeat_words(ws).cast("long").alias("n_repeat_words"),
        )

    counts = docs.withColumn("_w", let(words(docs["text"]), of_words)).withColumn(
        "_l",
        let(
            lines,
            lambda ls: F.struct(
                F.size(ls).cast("long").alias("n_lines"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            ),
        ),
    )
    n = F.greatest(F.col("_w.n_words"), F.lit(1))
    chars = (F.length(text) - _count_of(text, BLANKS)).cast("long")
    symbols = _count_of(text, SYMBOLS).cast("long")
    capitals = _count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    out = counts.withColumn(
        "_c",
        F.struct(
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            capitals.alias("capitals"),
            _count_of(text, "!").alias("exclamations"),
        ),
    )
    measured = F.struct(
        F.col("_w.n_words").alias("n_words"),
        F.col("_c.word_chars").alias("word_chars"),
        F.col("_c.n_symbols").alias("n_symbols"),
        F.col("_l.n_dup_lines").alias("n_dup_lines"),
        F.col("_w.n_repeat_words").alias("n_repeat_words"),
        (F.col("_c.word_chars") / n).alias("word_length"),
        (F.col("_c.n_symbols") / n).alias("symbols_per_word"),
        (F.col("_c.exclamations") / n).alias("exclamations_per_word"),
        (F.col("_c.capitals") / F.greatest(F.col("_c.word_chars"), F.lit(1))).alias("capitals_per_char"),
        (F.col("_l.n_dup_lines") / F.greatest(F.col("_l.n_lines"), F.lit(1))).alias("duplicate_lines"),
        (F.col("_w.n_repeat_words") / n).alias("repeated_words"),
        (F.col("_w.n_distinct") / n).alias("distinct_words"),
        (n / F.greatest(F.col("_l.n_lines"), F.lit(1))).alias("words_per_line"),
    )
    return out.withColumn("_m", measured).drop("_w", "_l", "_c")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (m["n_repeat_words"] * 100 > m["n_words"] * 30)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    value: float

    def of(self, m: Column) -> Column:
        return m[self.feature] >= self.value if self.at_least else m[self.feature] < self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.value:g}"


Rule = tuple[Condition, ...]


def holds(rule: Sequence[Condition], m: Column) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.of(m)
    return out


def verdict(rules: Sequence[Rule], m: Column) -> Column:
    """The number of the first rule that holds, from 1; 0 where none does."""
    out = F.when(F.lit(False), F.lit(0))
    for k, rule in enumerate(rules, 1):
        out = out.when(holds(rule, m), F.lit(k))
    return out.otherwise(F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """Measured labelled documents.  The labels chosen are at most `bound`, hence broadcast."""
    chosen = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .select("doc_id", (F.col("quality") == 0).alias("_bad"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_bad")
        .limit(bound)
    )
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return measure(joined).select("doc_id", "_bad", "_m")


def learn_rules(sample: DataFrame) -> list[Rule]:
    """The decision list for rejecting, from a staged sample (doc_id, _bad, _m).

    The driver only ever gets FEATURES x BINS sums; the rows stay in Spark.
    """
    cuts = _cut_points(sample)
    m = F.col("_m")
    left = sample.filter(~base_failed(m)).withColumn("_grow", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) < 2)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        rest = left.filter(verdict(rules, m) == 0)
        grown = _grow(rest.filter("_grow"), cuts)
        rule = _prune(rest.filter("NOT _grow"), grown) if grown else ()
        if not rule:
            break
        rules.append(rule)
    return rules


def _cut_points(sample: DataFrame) -> dict[str, list[float]]:
    shares = [i / BINS for i in range(1, BINS)]
    row = sample.agg(*[F.percentile_approx(F.col(f"_m.{f}").cast("double"), shares, 10_000).alias(f) for f in FEATURES]).first()
    return {f: sorted(set(row[f] or [])) for f in FEATURES}


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """For each feature and bin (values from one cut up to the next) the bad and good rows."""

    def bin_of(f: str) -> Column:
        value = F.col(f"_m.{f}")
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[f]]), lambda cut: cut <= value))

    bins = [F.struct(F.lit(f).alias("f"), bin_of(f).alias("b")) for f in FEATURES if cuts[f]]
    out = {f: [[0] * (len(cuts[f]) + 1), [0] * (len(cuts[f]) + 1)] for f in FEATURES}
    if bins:
        sums = rows.select("_bad", F.explode(F.array(*bins)).alias("x")).groupBy("x.f", "x.b", "_bad").count()
        for r in sums.collect():
            out[r["f"]][0 if r["_bad"] else 1][r["b"]] = r["count"]
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Adds the condition of the greatest information gain until a rule is pure or full."""
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS:
        best: tuple[float, Condition | None, int] = (0.0, None, 0)
        for f, (bad, good) in _histogram(rows.filter(holds(rule, F.col("_m"))), cuts).items():
            p, n = sum(bad), sum(good)
            if p == 0 or n == 0:
                continue
            before = math.log2(p / (p + n))
            for k, cut in enumerate(cuts[f], 1):
                for at_least in (True, False):
                    x, y = (sum(bad[k:]), sum(good[k:])) if at_least else (sum(bad[:k]), sum(good[:k]))
                    gain = x * (math.log2(x / (x + y)) - before) if x >= LEAST_COVERED else 0.0
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(f, at_least, cut), y)
        if best[1] is None:
            break
        rule += (best[1],)
        if best[2] == 0:
            break
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of `rule` that does best on rows it was not grown on; empty if none is precise."""
    m, sums = F.col("_m"), []
    for k in range(1, len(rule) + 1):
        hit = holds(rule[:k], m)
        sums += [F.count_if(hit & F.col("_bad")).alias(f"p{k}"), F.count_if(hit & ~F.col("_bad")).alias(f"n{k}")]
    row = rows.agg(*sums).first()
    worth = {}
    for k in range(1, len(rule) + 1):
        p, n = row[f"p{k}"], row[f"n{k}"]
        if p + n >= LEAST_COVERED // 2 and p >= LEAST_PRECISION * (p + n):
            worth[k] = (p - n) / (p + n + 1)
    return rule[: max(worth, key=lambda k: (worth[k], -k))] if worth else ()


def judged(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`docs` with `_m`, `_failed`, `_rule` (0: none holds) and `_kept`."""
    m = F.col("_m")
    return (
        measure(docs)
        .withColumn("_failed", base_failed(m))
        .withColumn("_rule", verdict(rules, m))
        .withColumn("_kept", ~F.col("_failed") & (F.col("_rule") == 0))
    )


def kept_documents(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows of `docs` that the base rule and `rules` keep; its columns may have any name."""
    plain, restored = plain_names(docs, ("doc_id", "text"))
    return restored(judged(plain, rules).filter("_kept"))


def fit(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    return learn_rules(staged(labelled_sample(docs, labels), "quality-sample"))
