"""Personal data by weak supervision.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; wider patterns
find further candidates.  Labelling functions of three kinds - the form of the candidate,
word lists beside it, its context - vote on every candidate.  Expectation-maximisation over
the counts of all vote patterns estimates how reliable each is, and the resulting labels
train a span classifier on hashed features of the span and its surroundings.  Base spans
are always reported; a wider candidate is added where the classifier is sure of it.

Edge cases: a null text counts as empty; repeated rows report the same spans; without
candidates nothing is trained and only base spans are reported; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.shared import staged

KINDS = ("email", "ip", "card", "phone")
#: FIXED VALUES: the base patterns.
DOMAIN = re.compile(r"@([A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+)")
#: An address is four numbers between points; runs of digits and points are cut at the points.
NUMBERS = re.compile(r"[0-9.]+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Wider candidates: written-out addresses, national phone numbers, and grouped card numbers.
WIDER = (
    ("phone", re.compile(r"(?<![0-9+.])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])00[1-9][0-9]{0,2}[\x20-][0-9]{2,4}[\x20-][0-9\x20-]{5,9}[0-9](?![0-9])")),
    ("card", re.compile(r"(?<![0-9-])[0-9]{4}[.\x20-][0-9]{4}[.\x20-][0-9]{4}[.\x20-][0-9]{4}(?![0-9-])")),
)
#: A written-out address is a name, one of AT, and a domain; it is found from its AT.
AT = re.compile(r"\(at\)|\[at\]|\sat\s")
WRITTEN_DOMAIN = re.compile(r"\s?[A-Za-z0-9-]+(?:\s?(?:\(dot\)|\[dot\]|\sdot\s|\.)\s?[A-Za-z0-9-]+)+")
BOUNDARY = re.compile(r"\b")
#: Word lists for the labelling functions; a word before the candidate is compared in lower case.
BESIDE = {
    "email": {"email", "e-mail", "mail", "mailto", "contact", "correo", "courriel"},
    "ip": {"ip", "host", "address", "server", "addr"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "payment", "karte", "tarjeta", "carte"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"},
}
AGAINST = {"version", "release", "isbn", "order", "invoice", "section", "id", "no", "number", "v"}
ENDINGS = {"com", "org", "net", "edu", "gov", "de", "fr", "es", "io", "uk", "info"}

LABELLERS = 7
BITS = 14
#: Candidates that train the classifier at most, the first by a hash of document and span.
SAMPLE = 20_000
ROUNDS = 40
EPOCHS = 5
RATE = 0.5
ADD_FROM = 0.9
CONTEXT = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses that do not overlap, found from their @ rather than from every letter."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        first = at
        while first > done and text[first - 1] in LOCAL_CHARS:
            first -= 1
        tail = DOMAIN.match(text, at) if first < at else None
        if tail:
            yield first, tail.end()
            done = at = tail.end()
        else:
            at += 1


def addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    """Leftmost runs of four numbers between points that do not overlap, and whether no number is above 255."""
    for run in NUMBERS.finditer(text):
        parts, at, k = run.group().split("."), run.start(), 0
        while k + 3 < len(parts):
            four = parts[k : k + 4]
            taken = 4 if all(four) else 1
            if taken == 4:
                yield at, at + sum(map(len, four)) + 3, all(map(_at_most_255, four))
            at += sum(map(len, parts[k : k + taken])) + taken
            k += taken


def written_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a written-out @ that do not overlap."""
    done = 0
    for found in AT.finditer(text):
        end = found.start()
        if end > done and text[end - 1].isspace():
            end -= 1
        first = end
        while first > done and text[first - 1] in LOCAL_CHARS:
            first -= 1
        while first < end and not BOUNDARY.match(text, first):
            first += 1
        tail = WRITTEN_DOMAIN.match(text, found.end()) if first < end else None
        if tail:
            yield first, tail.end()
            done = tail.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans by kind, then start; matches that fail their test are dropped."""
    out = [("email", a, b) for a, b in emails(text)]
    if any(d in text for d in "0123456789"):
        out += [("ip", a, b) for a, b, small in addresses(text) if small]
        for m in CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def _at_most_255(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def wider_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further candidates that overlap neither a base span nor one another."""
    out: list[tuple[str, int, int]] = []
    taken = bytearray(len(text))
    for _, first, last in base:
        taken[first:last] = b"\1" * (last - first)
    found = [("email", a, b) for a, b in written_emails(text) if _ending(text[a:b]) in ENDINGS]
    if any(d in text for d in "0123456789"):
        found += [(kind, m.start(), m.end()) for kind, pattern in WIDER for m in pattern.finditer(text)]
    for kind, first, last in found:
        if not any(taken[first:last]):
            taken[first:last] = b"\1" * (last - first)
            out.append((kind, first, last))
    return out


def _ending(address: str) -> str:
    return re.split(r"[.\s()\[\]]+", address.rstrip(")] "))[-1].lower()


def votes(text: str, kind: str, first: int, last: int) -> list[int]:
    """The labelling functions: 1 personal, -1 not, 0 no vote."""
    span, before, after = text[first:last], text[max(0, first - CONTEXT) : first], text[last : last + CONTEXT]
    beside = re.findall(r"[^\W\d_][\w-]*", before.lower())[-3:]
    digits = _digits(span)
    # Form of the candidate.
    if kind == "email":
        ending = _ending(span)
        form = 1 if "@" in span else 0
        known = 1 if ending in ENDINGS else -1
    elif kind == "ip":
        form = 1 if all(_at_most_255(p) for p in span.split(".")) else -1
        known = -1 if span.startswith(("0.", "127.", "255.")) or re.fullmatch(r"[0-9]\.[0-9]\.[0-9]\.[0-9]", span) else 1
    elif kind == "card":
        form = 1 if luhn(digits) else -1
        known = 1 if digits[:1] in "3456" else -1
    else:
        form = 1 if 9 <= len(digits) <= 15 else -1
        known = 1 if span[:1] in "+(" else 0
    return [
        form,
        known,
        -1 if len(set(digits)) <= 2 and len(digits) > 6 else (1 if len(set(digits)) > 3 else 0),  # not a filler
        1 if any(w in BESIDE[kind] for w in beside) else 0,  # word lists
        -1 if any(w in AGAINST for w in beside[-1:]) else 0,
        -1 if before[-1:].isalnum() or after[:1].isalnum() else 1,  # context: stands by itself
        -1 if re.search(r"[0-9][.,\x20-]?\Z", before) or re.match(r"[.,\x20-]?[0-9]", after) else 1,  # part of a longer number
    ]


def features(text: str, kind: str, first: int, last: int) -> list[int]:
    """Hashed features of a span and its surroundings."""
    span = text[first:last]
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]", "9", span))
    beside = re.findall(r"[^\W\d_]+", text[max(0, first - CONTEXT) : first].lower())[-2:]
    names = [f"k{kind}", f"s{kind}{shape}", f"n{kind}{len(_digits(span))}", f"b{text[max(0, first - 1) : first]}", f"a{text[last : last + 1]}"]
    names += [f"w{w}" for w in beside] + [f"l{kind}{i}{v}" for i, v in enumerate(votes(text, kind, first, last)) if v]
    return [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=4).digest(), "little") % (1 << BITS) for n in names]


SCANNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("base", T.StringType()),
        T.StructField(
            "found",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("span", T.StringType()),
                        T.StructField("base", T.BooleanType()),
                        T.StructField("pattern", T.IntegerType()),
                        T.StructField("features", T.ArrayType(T.IntegerType())),
                    ]
                )
            ),
        ),
    ]
)


def scan(docs: DataFrame) -> DataFrame:
    """For each document its base spans as text, and all candidates with their votes and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            bases, founds = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                found = [(s, True) for s in base] + [(s, False) for s in wider_spans(text, base)]
                bases.append(",".join(f"{k}:{a}:{b}" for k, a, b in base))
                founds.append(
                    [
                        {
                            "span": f"{k}:{a}:{b}",
                            "base": is_base,
                            # Votes are counted for each kind of data apart.
                            "pattern": sum((v + 1) * 3**i for i, v in enumerate(votes(text, k, a, b))) * len(KINDS) + kinds[k],
                            "features": features(text, k, a, b),
                        }
                        for (k, a, b), is_base in found
                    ]
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, pa.string()), pa.array(founds, ARROW)], SCANNED.names)

    ARROW = pa.list_(pa.struct([("span", pa.string()), ("base", pa.bool_()), ("pattern", pa.int32()), ("features", pa.list_(pa.int32()))]))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCANNED)


@dataclass(frozen=True)
class Labels:
    """The prior of personal, and for each labelling function its chances of -1 and 1 on others and on personal data."""

    prior: float
    chances: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = []
        for y, p in ((0, 1 - self.prior), (1, self.prior)):
            log = np.full(len(patterns), np.log(p))
            for k in range(patterns.shape[1]):
                log += np.where(patterns[:, k] == 0, 0.0, np.log(self.chances[k, y, (patterns[:, k] > 0).astype(int)]))
            logs.append(log)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def estimate(patterns: np.ndarray, counts: np.ndarray) -> Labels:
    """EM over vote patterns, started from the share of votes in favour."""
    good = np.clip(0.5 + patterns.sum(axis=1) / (2.0 * np.maximum((patterns != 0).sum(axis=1), 1)), 0.05, 0.95)
    labels = Labels(0.5, np.full((patterns.shape[1], 2, 2), 0.5))
    for _ in range(ROUNDS):
        prior = float(np.clip((good * counts).sum() / counts.sum(), 0.02, 0.98))
        chances = np.empty((patterns.shape[1], 2, 2))
        for k in range(patterns.shape[1]):
            for y, share in ((0, (1 - good) * counts), (1, good * counts)):
                # Two pseudo-votes for better than chance keep the meaning of the classes.
                seen = np.array([share[patterns[:, k] == v].sum() for v in (-1, 1)]) + (np.array([1.5, 0.5]) if y == 0 else np.array([0.5, 1.5]))
                chances[k, y] = seen / seen.sum()
        labels = Labels(prior, chances)
        good = labels.posterior(patterns)
    return labels


def train(examples: list[tuple[list[int], float]], seed: int = 5) -> np.ndarray:
    """Weights of a logistic classifier on hashed features and soft labels."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(1 << BITS)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(examples)):
            ids, label = examples[i]
            z = weights[ids].sum()
            weights[ids] -= rate * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - label)
    return weights


def fit(scanned: DataFrame, size: int = SAMPLE) -> np.ndarray | None:
    """Classifier weights from scanned documents; None without candidates."""
    spans = scanned.select("doc_id", F.explode("found").alias("s"))
    counted = spans.groupBy("s.pattern").count().collect()
    if not counted:
        return None
    numbers = np.array([r["pattern"] for r in counted]) // len(KINDS)
    counts = np.array([r["count"] for r in counted], float)
    labels = estimate(numbers[:, None] // 3 ** np.arange(LABELLERS) % 3 - 1, counts)
    draw = F.pmod(F.xxhash64("doc_id", "s.span"), F.lit(1 << 30)) / (1 << 30)
    drawn = spans.filter(draw < min(1.0, size / counts.sum())).select("s.pattern", "s.features", draw.alias("draw"))
    rows = drawn.orderBy("draw", "pattern").limit(size).collect()
    if not rows:
        return None
    patterns = np.array([r["pattern"] for r in rows])[:, None] // len(KINDS) // 3 ** np.arange(LABELLERS) % 3 - 1
    rows = [(r["features"], float(p)) for r, p in zip(rows, labels.posterior(patterns), strict=True)]
    return train(sorted(rows))


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_added", T.LongType()),
    ]
)


def decide(scanned: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """The report of each document: base spans, and the wider candidates that the classifier accepts."""
    order = {k: i for i, k in enumerate(KINDS)}

    def key(span: str) -> tuple[int, int]:
        kind, first, _ = span.split(":")
        return order[kind], int(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in RESULT.names[1:]]
            for base, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = base.split(",") if base else []
                added = [
                    s["span"]
                    for s in found
                    if not s["base"] and weights is not None and 1 / (1 + np.exp(-np.clip(weights[s["features"]].sum(), -60, 60))) >= ADD_FROM
                ]
                counts = [sum(s.startswith(k + ":") for s in own) for k in KINDS]
                values = [*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(sorted(own + added, key=key)), len(added)]
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in columns]], schema=ARROW)

    ARROW = pa.schema([(n, pa.string() if n in ("base_sha256", "spans") else pa.int64()) for n in RESULT.names])
    return scanned.mapInArrow(run, RESULT)


def find_personal_data(docs: DataFrame) -> DataFrame:
    scanned = staged(scan(docs), "pii")
    return decide(scanned, fit(scanned))
