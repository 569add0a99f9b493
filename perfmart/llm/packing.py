"""Packing of tokenized documents into sequences of a fixed length by minimum bin slack.

Each bin starts with the longest piece that is left.  A dynamic program over the lengths
still available, whose set of reachable sums is one integer used as a bitset, finds the
fullest combination that fits; it is taken out, and the next bin begins.  The program looks
at long pieces first and stops once the bin is full, so short pieces, which fit anywhere,
stay for later bins.

Only lengths decide, and there are at most `capacity` of them.  So the program runs over a
histogram, of constant size whatever the corpus, and a combination is taken as often as its
lengths last: a corpus of any size has some thousands of different bins.  Documents are
tokenized once, in the tasks.  Each task numbers its pieces of one length, sums of the tasks
before offset them, and a piece's number among those of its length decides its place: no
piece is compared with another, and a length that a third of all pieces have is no hot key.

A document is the ids of its text and an end id.  One that is longer than a sequence is cut
into whole sequences and a rest; all others stay in one piece.

Edge cases: a null or empty text is the end id alone; rows equal in all columns are
documents of their own; ids need not be unique, and null ids are kept; an empty table gives
an empty one.  Only the columns named are read, so clashing names cannot matter.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.numbering import PLACE, places
from perfmart.llm.shared import staged

CAPACITY = 2048
END_ID = 0
#: Words whose ids a worker keeps, in two generations.
CACHE_WORDS = 1_000_000
#: Characters of a text that are split into words at once.
SPLIT_CHARS = 1 << 20
ROWS_AT_ONCE = 64
BLANK = re.compile("[ \t\n\r]")
WORDS = re.compile("[^ \t\n\r]+")
#: What str.split() takes for blanks besides white space.
SEPARATORS = "\x1c\x1d\x1e\x1f"
ID = np.dtype("<u4")


class Encoder:
    """Ids of texts as bytes, by a tokenizer given as JSON text.

    With `drops_blanks` the tokenizer must never look across white space and give it no
    id.  Then a text's ids are those of its words, and words seen before are not encoded again.
    """

    def __init__(self, json: str, drops_blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.drops_blanks = Tokenizer.from_str(json), drops_blanks
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        unknown = []
        for word in words:
            if word in self.old:
                self.young[word] = self.old[word]
            else:
                unknown.append(word)
        if unknown:
            found = self.tokenizer.encode(unknown, is_pretokenized=True, add_special_tokens=False)
            cuts = (np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(unknown) + 1)) * ID.itemsize).tolist()
            ids = np.array(found.ids, ID).tobytes()
            self.young.update(zip(unknown, (ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)), strict=True))

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        if not self.drops_blanks:
            return [np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, ID).tobytes() for p in parts]
        if len(self.young) > CACHE_WORDS:
            self.young, self.old = {}, self.young
        words = [WORDS.findall(p) if any(c in p for c in SEPARATORS) else p.split() for p in parts]
        self._learn(list(set().union(*words).difference(self.young)))
        return [b"".join(map(self.young.__getitem__, found)) for found in words]

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """For each text its ids, as little-endian unsigned 32-bit numbers."""
        short: list[str] = []
        for text in texts:
            if self.drops_blanks and len(text or "") > SPLIT_CHARS:
                yield from self._of_parts(short)
                short = []
                yield b"".join(self._of_parts([part])[0] for part in _parts(text))
            else:
                short.append(text or "")
        yield from self._of_parts(short)


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end at blanks."""
    at = 0
    while at < len(text):
        blank = BLANK.search(text, min(len(text), at + SPLIT_CHARS))
        end = blank.end() if blank else len(text)
        yield text[at:end]
        at = end


_kept: dict[tuple[str, bool], Encoder] = {}


def _encoder(json: str, drops_blanks: bool) -> Encoder:
    """The worker's encoder, kept over its tasks."""
    key = (hashlib.sha256(json.encode()).hexdigest(), drops_blanks)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Encoder(json, drops_blanks)
    return _kept[key]


@dataclass(frozen=True)
class Combination:
    """The lengths of a bin, longest first, with how often each occurs, and the number of such bins."""

    lengths: tuple[tuple[int, int], ...]
    times: int


def fullest(counts: Mapping[int, int], first: int, capacity: int) -> tuple[tuple[int, int], ...]:
    """The fullest combination of available lengths that holds `first`, the longest of them."""
    room = capacity - first
    sums, mask, seen = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left = min(counts[length] - (length == first), room // length)
        if left < 1:
            continue
        seen.append((length, sums))
        step = 1
        while left > 0:
            step = min(step, left)
            sums |= sums << (step * length)
            left -= step
            step *= 2
        sums &= mask
        if sums >> room:
            break
    total = sums.bit_length() - 1
    taken = {first: 1}
    for length, before in reversed(seen):
        while not before >> total & 1:
            taken[length] = taken.get(length, 0) + 1
            total -= length
    return tuple(sorted(taken.items(), reverse=True))


def fill_bins(counts: Mapping[int, int], capacity: int) -> list[Combination]:
    """All lengths in bins: each as full as the lengths left allow."""
    left = {length: n for length, n in counts.items() if n > 0}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("lengths must be between 1 and the capacity")
    out = []
    while left:
        lengths = fullest(left, max(left), capacity)
        times = min(left[length] // n for length, n in lengths)
        out.append(Combination(lengths, times))
        for length, n in lengths:
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return out


#: A length and the number among the pieces of that length, as one integer.
NUMBER_BITS = 40


def _seats(bins: list[Combination]) -> tuple[np.ndarray, ...]:
    """Runs of pieces of one length that lie alike: first piece, first sequence, pieces in a sequence, offset of the first there."""
    rows, used, sequence = [], {}, 0
    for bin_ in bins:
        offset = 0
        for length, n in bin_.lengths:
            first = used.get(length, 0)
            rows.append(((length << NUMBER_BITS) + first, sequence, n, offset))
            used[length] = first + n * bin_.times
            offset += n * length
        sequence += bin_.times
    return tuple(np.array(sorted(rows), np.int64).reshape(-1, 4).T)


def pieces(docs: DataFrame, json: str, keep: list[str], capacity: int = CAPACITY, end_id: int = END_ID, drops_blanks: bool = True, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: `row` (the columns `keep`), piece, start, length, ids_crc32, and with `with_ids` ids.

    `_part` and `_nth` tell the task that made a piece, and how many of its length it had made before.
    """
    row = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), "text")
    fields = [
        row.schema["row"],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        *PLACE,
    ]
    end, most = np.array([end_id], ID).tobytes(), capacity * ID.itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, made = _encoder(json, drops_blanks), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                found, own = [], []
                for i, ids in enumerate(encoder.ids(some.column(1).to_pylist())):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), most)):
                        part = ids[start : start + most]
                        length = len(part) // ID.itemsize
                        found.append((i, piece, start // ID.itemsize, length, zlib.crc32(part), int(made[length])))
                        made[length] += 1
                        if with_ids:
                            own.append(np.frombuffer(part, ID).view(np.int32))
                i, piece, start, length, crc, nth = (np.array(c, np.int64) for c in zip(*found, strict=True))
                columns = [some.column(0).take(pa.array(i)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
                columns += [pa.array(own, pa.list_(pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays([*columns, places(0, len(i))[0], pa.array(nth)], [f.name for f in fields])

    return row.mapInArrow(cut, T.StructType(fields))


def pack(docs: DataFrame, tokenizer: str, keep: list[str] | None = None, capacity: int = CAPACITY, end_id: int = END_ID, drops_blanks: bool = True, with_ids: bool = False) -> DataFrame:
    """`keep` of each piece's document (by default doc_id), piece, start, length, ids_crc32, sequence_id, offset.

    `tokenizer` is the path of a tokenizer file, which the driver reads; `ids` come with `with_ids`.
    """
    json = Path(tokenizer).read_text(encoding="utf-8")
    made = staged(pieces(docs, json, keep or ["doc_id"], capacity, end_id, drops_blanks, with_ids), "pieces")
    sums = made.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(sums.select("length", "_part", "_held", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before")), "piece-offsets")
    counts = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("_held").alias("n")).collect()}
    seats = _seats(fill_bins(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, sequence, held, offset = seats
        for batch in batches:
            length, number = batch.column(at_length).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            key = (length << NUMBER_BITS) + number
            seat = np.searchsorted(first, key, "right") - 1
            nth = key - first[seat]
            where = [sequence[seat] + nth // held[seat], offset[seat] + nth % held[seat] * length]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, where)], [*names, "sequence_id", "offset"])

    names = ["row", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    at_length = names.index("length")
    numbered = made.join(offsets.drop("_held"), ["length", "_part"]).select(*names, (F.col("_before") + F.col("_nth")).alias("_number"))
    schema = T.StructType([*numbered.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(place, schema).select("row.*", *schema.names[1:])


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in order, from pack(..., with_ids=True): sequence_id, ids (at most `capacity`)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
