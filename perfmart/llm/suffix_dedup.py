"""Removal of repeated 50-byte strings by a logarithmic family of sparse suffix arrays.

A byte goes if a string of WINDOW bytes that covers it also starts in a document with a
smaller id.  Every window of WINDOW bytes is led by its minimizer, the suffix whose first
PREFIX bytes hash least; equal windows have equal minimizers at equal places, so only
these suffixes, about one in 18, are indexed.  Suffixes are ordered by a hash of their
prefix and then by hashes of their surroundings, which brings equal ones together.

1. Each batch of documents gets its suffix array.  A suffix whose whole stretch of windows
   also occurs in the batch with a smaller id is settled there and not passed on, so a
   passage that very many documents share leaves each batch once.  A pass before counts the
   prefixes that are frequent in batches; those with far more than their share are hot.
2. The arrays are dealt by prefix, those of a hot prefix by their surroundings too.  Each
   task adds them one after another to a family of levels; levels of equal size are merged, and each merge settles the suffixes whose
   stretch is in the other level with a smaller id.  What is left meets where prefix and
   at least WINDOW - PREFIX over 2 further bytes on one side agree, as they must if any
   window does: these suffixes are asked for byte by byte, and so are all of a hot prefix.
3. For these, the hashes of all windows of the stretch are compared over the corpus: the
   least document of each window.  Those of a hot prefix are dealt window by window, and a
   window leaves each batch once, so that no task gets all documents that share a string.
4. The settled stretches of each document are put together, and the rest of it is kept.

Hashes of 64 bits stand for strings, always two independent ones (prefix and whole stretch,
or prefix and window), 128 bits in all.

Edge cases: a null text counts as empty; a document without an id is neither changed nor
compared; rows of one id are one document and do not remove each other's text; of rows
equal in id and text each task looks at one, so they cost no more than being read; texts
shorter than WINDOW stay; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.bytewords import BASE, BASE_INVERSE, mix, slices
from perfmart.llm.shared import staged

WINDOW = 50
PREFIX = 16
SIDE = (WINDOW - PREFIX) // 2
#: Windows in which a suffix can be the minimizer.
REACH = WINDOW - PREFIX + 1
SLICE_BYTES = 1 << 20
#: Rows of other tasks that are made one array before they join the levels.
ARRAY_ROWS = 1 << 17
#: A prefix counts in a batch from this many suffixes on.
FREQUENT = 4
#: A prefix is hot beyond HOT_ROWS counted suffixes plus all suffixes / 2^HOT_BITS, so there are at most 2^HOT_BITS.
HOT_ROWS = 4096
HOT_BITS = 18
#: Positions beside 40 bits of a hash.
POSITION_BITS = 24
#: A text of so many bytes goes in parts.
LONG_BYTES = 1 << POSITION_BITS

#: What a row is: a suffix or stretch in question, a settled stretch, or one in question whose prefix is hot.
OPEN, SETTLED, HOT = 0, 1, 2
#: Room for a state beside a place, of two bits.
STATES = 4
SUFFIX = T.StructType([T.StructField(n, T.LongType()) for n in ("gram", "whole", "doc_id", "check", "place", "around")] + [T.StructField("state", T.ByteType())])
FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "check", "gram", "first", "last")] + [T.StructField("state", T.ByteType())])


class Prefixes:
    """Hashes of any stretch of a slice's bytes, from sums of a polynomial modulo 2^64."""

    _powers: dict[int, np.ndarray] = {}

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        for base in (BASE, BASE_INVERSE):
            if len(self._powers.get(int(base), ())) < n:
                out = np.full(n, base, np.uint64)
                out[0] = 1
                self._powers[int(base)] = np.multiply.accumulate(out)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._powers[int(BASE)][: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self._powers[int(BASE_INVERSE)][start]

    def every(self, length: int) -> np.ndarray:
        """The hash of the `length` bytes from each position on."""
        count = len(self.sums) - length
        return (self.sums[length:] - self.sums[:count]) * self._powers[int(BASE_INVERSE)][:count]


def stretches(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray] | None:
    """The minimizers of a slice: row, position, first and last window start (from the row's begin), and hashes."""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if len(data) < WINDOW:
        return None
    if len(data) >= LONG_BYTES:
        return _in_parts(data, offsets)
    hashes = Prefixes(data)
    grams = hashes.every(PREFIX)
    # The hash's 40 upper bits and the position below them: the least of a run is its first minimum.
    order = ((grams ^ (grams >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(POSITION_BITS)
    least = (order << np.uint64(POSITION_BITS)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (REACH - width)], least[REACH - width :])
    at = (least & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    inside = np.ones(len(at), bool)
    for back in range(1, WINDOW):
        cut = offsets[1:] - back
        inside[cut[(cut >= 0) & (cut < len(at))]] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return None
    new = np.r_[True, (np.diff(starts) > 1) | (np.diff(at[starts]) != 0)]
    first = starts[new]
    last = np.r_[starts[np.flatnonzero(new)[1:] - 1], starts[-1]]
    at = at[first]
    row = np.searchsorted(offsets, first, "right") - 1
    begin, end = offsets[row], offsets[row + 1]
    alone = mix(np.arange(len(at), dtype=np.uint64) + grams[at])  # no room for a side: nothing to meet there
    left = np.where(at - SIDE >= begin, mix(hashes.of(np.maximum(at - SIDE, 0), at), 1), alone)
    over = np.minimum(at + PREFIX + SIDE, len(data))
    right = np.where(at + PREFIX + SIDE <= end, mix(hashes.of(at + PREFIX, over), 2), mix(alone))
    whole = mix(hashes.of(first, last + WINDOW) + (at - first).astype(np.uint64))
    # Two short hashes of the sides: equal ones only ask a question, the whole stretch decides.
    around = (left >> np.uint64(48) << np.uint64(16)) | (right >> np.uint64(48))
    return {"row": row, "at": at - begin, "first": first - begin, "last": last - begin, "gram": mix(grams[at]), "whole": whole, "around": around}


def _in_parts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray] | None:
    """Texts too long for one pass, in parts of window starts.

    A part is looked at with the bytes around it, so its suffixes and their surroundings
    are those of the whole text; only their stretches end where the part does.
    """
    out = []
    step = LONG_BYTES // 2
    for row in range(len(offsets) - 1):
        begin, end = int(offsets[row]), int(offsets[row + 1])
        for low in range(begin, end, step):
            from_, to = max(begin, low - WINDOW), min(end, low + step + 2 * WINDOW)
            part = stretches(data[from_:to], np.array([0, to - from_]))
            if part is not None:
                shift = from_ - begin
                part = {k: v + shift if k in ("at", "first", "last") else v for k, v in part.items()}
                first, last = np.maximum(part["first"], low - begin), np.minimum(part["last"], low - begin + step - 1)
                here = first <= last
                out.append({k: v[here] for k, v in (part | {"row": part["row"] + row, "first": first, "last": last}).items()})
    return {k: np.concatenate([p[k] for p in out]) for k in out[0]} if out else None


def settle(first_key: np.ndarray, second_key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by the first key, and which in that order have equal keys of a smaller document."""
    order = np.argsort(first_key)
    known = np.zeros(len(order), bool)
    at = np.flatnonzero(_several(first_key[order]))
    if len(at):
        # Most keys occur once; only the others are sorted by everything.
        rows = order[at]
        inner = np.lexsort((doc[rows], second_key[rows], first_key[rows]))
        f, s, d = first_key[rows][inner], second_key[rows][inner], doc[rows][inner]
        new = np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])]
        order[at] = rows[inner]
        known[at] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, known


def _several(sorted_: np.ndarray) -> np.ndarray:
    """Which of some sorted values occur more than once."""
    same = sorted_[1:] == sorted_[:-1]
    return np.r_[False, same] | np.r_[same, False] if len(sorted_) else np.empty(0, bool)


def _joined(doc: np.ndarray, check: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of window starts, those that touch put together."""
    order = np.lexsort((first, check, doc))
    doc, check, first, last = doc[order], check[order], first[order], last[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (check[1:] != check[:-1]) | (first[1:] > last[:-1] + 1)] if len(doc) else np.empty(0, bool)
    at = np.flatnonzero(new)
    return (doc[at], check[at], first[at], np.maximum.reduceat(last, at)) if len(at) else (doc, check, first, last)


def _array(batch: pa.RecordBatch) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray] | None:
    """The suffix array of a batch of (doc_id, check, text): suffixes, their order, and which in it the batch settles."""
    ids, checks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    parts = []
    for data, offsets, first_row in slices(batch.column(2), SLICE_BYTES):
        part = stretches(data, offsets)
        if part is not None:
            parts.append(part | {"row": part["row"] + first_row})
    if not parts:
        return None
    p = {k: np.concatenate([x[k] for x in parts]) for k in parts[0]}
    p |= {"doc": ids[p["row"]].astype(np.int64), "check": checks[p["row"]].astype(np.int64)}
    return p, *settle(p["gram"], p["whole"], p["doc"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "_check", F.coalesce("text", F.lit("")).alias("text")).filter("doc_id IS NOT NULL")


def _once(batch: pa.RecordBatch, seen: set[tuple[int, int]]) -> pa.RecordBatch:
    """The rows of (doc_id, check, ...) that the task has not seen: what is repeated is the same document."""
    new = []
    for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        new.append(key not in seen)
        seen.add(key)
    return batch if all(new) else batch.filter(pa.array(new))


def hot_prefixes(docs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The prefixes (gram) of far more suffixes than their share, at most 2^HOT_BITS of them.

    Only prefixes that are frequent in a batch are counted, so what escapes has fewer than
    FREQUENT suffixes a batch.  Which prefixes are hot decides how the work is dealt, never a result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            array = _array(_once(batch, seen))
            if array is None:
                continue
            p, order, known = array
            gram = p["gram"][order[~known]]
            starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
            size = np.diff(np.r_[starts, len(gram)])
            often = size >= FREQUENT
            grams = pa.array([*gram[starts[often]].view(np.int64).tolist(), None], pa.int64())  # null: all suffixes
            yield pa.RecordBatch.from_arrays([grams, pa.array([*size[often].tolist(), len(gram)], pa.int64())], ["gram", "rows"])

    counts = staged(_texts(docs).mapInArrow(run, "gram long, rows long").groupBy("gram").agg(F.sum("rows").alias("rows")), "prefixes")
    total = counts.filter("gram IS NULL").first()
    limit = hot_rows + ((total["rows"] if total else 0) >> HOT_BITS)
    return counts.filter(F.col("gram").isNotNull() & (F.col("rows") > limit)).select("gram")


def suffix_arrays(docs: DataFrame) -> DataFrame:
    """Each batch's suffixes that it does not settle itself, and the stretches that it does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            array = _array(_once(batch, seen))
            if array is None:
                continue
            p, order, known = array
            doc, check, kept = p["doc"], p["check"], order[~known]
            place = (p["at"] << 16) | ((p["at"] - p["first"]) << 8) | (p["at"] - p["last"])
            yield _suffix_rows(p["gram"][kept], p["whole"][kept], doc[kept], check[kept], place[kept], p["around"][kept], OPEN)
            done = order[known]
            d, c, first, last = _joined(doc[done], check[done], p["first"][done], p["last"][done])
            # Settled stretches travel with the suffixes, dealt by document.
            yield _suffix_rows(mix(d.view(np.uint64)), first.astype(np.uint64), d, c, last, np.zeros(len(d), np.uint64), SETTLED)

    return _texts(docs).mapInArrow(run, SUFFIX)


def _suffix_rows(gram: np.ndarray, whole: np.ndarray, doc: np.ndarray, check: np.ndarray, place: np.ndarray, around: np.ndarray, state: int) -> pa.RecordBatch:
    columns = [pa.array(c.view(np.int64)) for c in (gram, whole)] + [pa.array(c) for c in (doc, check, place)] + [pa.array(around.view(np.int64))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(doc), state, np.int8))], SUFFIX.names)


Level = tuple[np.ndarray, ...]


def add_level(levels: list[Level], new: Level, found: list[Level]) -> None:
    """Adds an array to the family.  While the last level is no larger than it, they are merged."""
    levels.append(new)
    while len(levels) > 1 and len(levels[-2][0]) <= len(levels[-1][0]):
        merge_last(levels, found)


def _add_rows(levels: list[Level], held: list[Level]) -> list[Level]:
    """Makes one array of rows from several batches and adds it; what was settled on the way."""
    new = tuple(np.concatenate(c) for c in zip(*held, strict=True))
    order, known = settle(*new[:3])
    found = [tuple(c[order[known]] for c in new)]
    add_level(levels, tuple(c[order[~known]] for c in new), found)
    return found


def merge_last(levels: list[Level], found: list[Level]) -> None:
    """Merges the last two levels; suffixes with an equal of a smaller document are settled and leave."""
    pair = [np.concatenate(c) for c in zip(levels.pop(), levels.pop(), strict=True)]
    order, known = settle(pair[0], pair[1], pair[2])
    levels.append(tuple(c[order[~known]] for c in pair))
    found.append(tuple(c[order[known]] for c in pair))


def open_questions(level: Level) -> np.ndarray:
    """Which suffixes of a sorted array share the prefix and one side with another document."""
    out = np.zeros(len(level[0]), bool)
    rows = np.flatnonzero(_several(level[0]))
    if not len(rows):
        return out
    gram, doc, around = (level[k][rows] for k in (0, 2, 5))
    for side in (around >> np.uint64(16), around & np.uint64((1 << 16) - 1)):
        order = np.lexsort((doc, side, gram))
        g, s, d = gram[order], side[order], doc[order]
        new = np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])]
        at = np.flatnonzero(new)
        several = d[at] != d[np.r_[at[1:], len(d)] - 1]
        out[rows[order[several[np.cumsum(new) - 1]]]] = True
    return out


def _found_rows(doc: np.ndarray, check: np.ndarray, gram: np.ndarray, first: np.ndarray, last: np.ndarray, state: int | np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (doc, check, gram, first, last)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(doc), state, np.int8))], FOUND.names)


def match(suffixes: DataFrame, hot: DataFrame) -> DataFrame:
    """Settled stretches of window starts, and stretches to be compared byte by byte.

    Equal suffixes have equal surroundings, so they meet however a hot prefix is dealt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: list[Level] = []
        held: list[Level] = []
        for batch in batches:
            gram, whole, doc, check, place, around, state = (batch.column(i).to_numpy() for i in range(7))
            settled = state == SETTLED
            if settled.any():
                yield _found_rows(doc[settled], check[settled], gram[settled], whole[settled], place[settled], SETTLED)
            held.append(tuple(c[~settled] for c in (gram.view(np.uint64), whole.view(np.uint64), doc, check, place, around.view(np.uint64), state)))
            if sum(len(x[0]) for x in held) >= ARRAY_ROWS:
                yield from _settled(_add_rows(levels, held))
                held = []
        found = _add_rows(levels, held) if held else []
        while len(levels) > 1:
            merge_last(levels, found)
        yield from _settled(found)
        if levels:
            asked = open_questions(levels[0]) | (levels[0][6] == HOT)
            gram, _, doc, check, place, _, state = (c[asked] for c in levels[0])
            at = place >> 16
            yield _found_rows(doc, check, gram, at - ((place >> 8) & 255), at - (place & 255), state)

    is_hot = (F.col("state") == OPEN) & F.col("_hot").isNotNull()
    state = F.when(is_hot, F.lit(HOT)).otherwise(F.col("state"))
    # Short numbers share a column while they are shuffled: check (32 bits) and around (32 bits), place and state.
    packed = suffixes.join(F.broadcast(hot.select("gram", F.lit(True).alias("_hot"))), "gram", "left").select(
        "gram",
        "whole",
        "doc_id",
        F.shiftleft("check", 32).bitwiseOR(F.col("around")).alias("sides"),
        (F.col("place") * STATES + state).alias("place"),
    )
    around, state = F.col("sides").bitwiseAND(F.lit((1 << 32) - 1)), F.pmod("place", F.lit(STATES))
    dealt = packed.repartition(F.xxhash64("gram", F.when(state == HOT, around)))
    unpacked = dealt.select(
        "gram", "whole", "doc_id", F.shiftrightunsigned("sides", 32).alias("check"), F.shiftright("place", 2).alias("place"), around.alias("around"), state.cast("byte").alias("state")
    )
    return unpacked.mapInArrow(run, FOUND)


def _settled(found: list[Level]) -> Iterator[pa.RecordBatch]:
    for _, _, doc, check, place, *_ in found:
        at = place >> 16
        yield _found_rows(doc, check, np.zeros(len(doc), np.int64), at - ((place >> 8) & 255), at - (place & 255), SETTLED)


WINDOWS = T.StructType([T.StructField(n, T.LongType()) for n in ("gram", "doc_id", "check", "first", "last")] + [T.StructField("hashes", T.ArrayType(T.LongType()))])


def _window_rows(gram, doc, check, first, last, hashes: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*map(pa.array, (gram, doc, check, first, last)), hashes], WINDOWS.names)


def _hot_rows(hot: list[Level]) -> Iterator[pa.RecordBatch]:
    """A row for each window, its least document in the batch; the others are settled stretches, without hashes."""
    window, gram, doc, check, first = (np.concatenate(c) for c in zip(*hot, strict=True))
    order, known = settle(window, gram, doc)
    kept, rest = order[~known], order[known]
    ones = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32)), pa.array(window[kept].view(np.int64)))
    # Equal windows get one key, and those of one prefix different ones.
    key = mix(gram[kept] ^ mix(window[kept])).view(np.int64)
    yield _window_rows(key, doc[kept], check[kept], first[kept], first[kept], ones)
    d, c, first, last = _joined(doc[rest], check[rest], first[rest], first[rest])
    yield _window_rows(mix(d.view(np.uint64)).view(np.int64), d, c, first, last, pa.nulls(len(d), pa.list_(pa.int64())))


def windows(docs: DataFrame, questions: DataFrame) -> DataFrame:
    """The hashes of all windows of the stretches in question: a row for each stretch, of a hot prefix for each window.

    `gram` is the key by which equal windows meet.
    """
    asked = questions.groupBy("doc_id", F.col("check").alias("_check")).agg(F.collect_set(F.struct("gram", "first", "last", "state")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            batch = _once(batch, seen)
            hot: list[Level] = []
            for i in np.flatnonzero(np.asarray(batch.column(3).is_valid())).tolist():
                sums = Prefixes(np.frombuffer(batch.column(2)[i].as_py().encode(), np.uint8))
                stretch = batch.column(3)[i].values
                gram, first, last, state = (stretch.field(k).to_numpy() for k in range(4))
                doc, check = (batch.column(k)[i].as_py() for k in (0, 1))
                for of_hot in (False, True):
                    rows = np.flatnonzero((state == HOT) == of_hot)
                    if not len(rows):
                        continue
                    size = last[rows] - first[rows] + 1
                    ends = np.cumsum(size)
                    start = np.repeat(first[rows] - (ends - size), size) + np.arange(ends[-1])
                    hashes = mix(sums.of(start, start + WINDOW))
                    n = ends[-1] if of_hot else len(rows)
                    same = np.full(n, doc), np.full(n, check)
                    if of_hot:
                        hot.append((hashes, np.repeat(gram[rows].view(np.uint64), size), *same, start))
                    else:
                        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(hashes.view(np.int64)))
                        yield _window_rows(gram[rows], *same, first[rows], last[rows], lists)
            if hot:
                yield from _hot_rows(hot)

    return docs.join(asked, ["doc_id", "_check"], "left").select("doc_id", "_check", "text", "asked").mapInArrow(run, WINDOWS)


STRETCH = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "check", "first", "last")])


def repeated_windows(asked: DataFrame) -> DataFrame:
    """The stretches of windows that also start in a document with a smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            settled = batch.column(5).is_null()
            if batch.column(5).null_count:
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(settled) for i in (1, 2, 3, 4)], STRETCH.names)
                batch = batch.filter(pc.invert(settled))
            size = batch.column(5).value_lengths().to_numpy().astype(np.int64)
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            gram, doc, check, first = (np.repeat(batch.column(i).to_numpy(), size) for i in range(4))
            held.append((batch.column(5).flatten().to_numpy().view(np.uint64), gram.view(np.uint64), doc, check, first + inner))
        if held:
            window, gram, doc, check, first = (np.concatenate(c) for c in zip(*held, strict=True))
            order, known = settle(window, gram, doc)
            rows = order[known]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _joined(doc[rows], check[rows], first[rows], first[rows])], STRETCH.names)

    return asked.repartition("gram").mapInArrow(run, STRETCH)


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)
ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.string())


def removed_bytes(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which bytes the windows that start in the given stretches cover."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + WINDOW, -1)
    return np.cumsum(steps[:-1]) > 0


def deduplicate(docs: DataFrame, with_bytes: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per row of `docs`: doc_id, its bytes, how many go in how many spans, a digest of the others.

    `with_bytes` adds them too, as `kept`: bytes, since a cut may fall inside a character.
    `hot_rows` is the bound beyond which a prefix is split over tasks; results do not depend on it.
    """
    schema = T.StructType([*RESULT.fields, *([T.StructField("kept", T.BinaryType())] if with_bytes else [])])
    kinds = (*ARROW, pa.binary()) if with_bytes else ARROW
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_check")
    )
    found = staged(match(suffix_arrays(rows), hot_prefixes(rows, hot_rows)), "repeats")
    repeated = repeated_windows(windows(rows, found.filter(F.col("state") != SETTLED)))
    settled = found.filter(F.col("state") == SETTLED).select("doc_id", "check", "first", "last")
    gone = (
        settled.unionByName(repeated)
        .groupBy("doc_id", F.col("check").alias("_check"))
        .agg(F.collect_list(F.struct("first", "last")).alias("gone"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in kinds]
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode()
                out = np.zeros(len(raw), bool)
                if batch.column(2)[i].is_valid:
                    stretch = batch.column(2)[i].values
                    out = removed_bytes(len(raw), stretch.field(0).to_numpy(), stretch.field(1).to_numpy())
                kept = np.frombuffer(raw, np.uint8)[~out].tobytes()
                spans = int(np.count_nonzero(out[1:] & ~out[:-1]) + (len(out) > 0 and out[0]))
                for column, value in zip(columns, (len(raw), int(out.sum()), spans, hashlib.sha256(kept).hexdigest(), kept), strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], schema.names)

    return rows.join(gone, ["doc_id", "_check"], "left").select("doc_id", "text", "gone").mapInArrow(run, schema)
