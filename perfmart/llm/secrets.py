"""Secret scan with corpus-wide ownership frequency, in built-in functions only.

Base patterns find assignments, access keys and hex strings; a wider pattern finds other
tokens that look random.  Every candidate's hash is counted over the corpus by distinct
owner (`source`) and distinct repository (`doc_id`).  A value that many owners hold is a
widely copied example; one that a single owner holds is live-looking.  The wider tokens are
reported only where they are live-looking; base spans are always reported, with the verdict.

Positions come from splitting the text at the matches: the lengths of the pieces and of the
matches add up to the starts, in code points.

Edge cases: a null text counts as empty and has no span; a null owner is an owner like any
other; repeated rows are one repository and report the same spans; documents without
candidates never enter the counts; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfmart.llm.shared import let, staged

#: FIXED VALUES: the base patterns, and the characters that a match must have at least.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: Maximal hex runs that are long enough: the same spans as dropping short ones from all runs.
LONG_HEX = rf"[0-9a-f]{{{LEAST_HEX},}}"
#: Wider tokens: this many characters or more, with letters of both cases and several digits.
WIDE = r"[A-Za-z0-9+/_=-]{24,}"
WIDE_KIND = "generic"
#: A value that so many owners hold is an example.
EXAMPLE_OWNERS = 3
#: So is one that its only owner has in so many repositories.
EXAMPLE_REPOSITORIES = 10

SPAN = "array<struct<kind:string,rank:int,first:int,last:int,value:string>>"


def _running(numbers: Column) -> Column:
    """Running sums of an array of whole numbers.

    They are summed in about as many blocks as a block has numbers, so that no array is
    copied more than that often: a text may hold very many matches.
    """
    none = F.array().cast("array<bigint>")

    def upto(first: Column, of: Column) -> Column:
        zero = F.struct(first.alias("at"), none.alias("out"))

        def add(a: Column, x: Column) -> Column:
            return F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out"))

        return F.aggregate(of, zero, add, lambda a: a["out"])

    def in_blocks(n: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(n))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), width - 1), lambda b: F.slice(n, b * width + 1, width))
        zero = F.lit(0).cast("bigint")
        return let(
            blocks,
            lambda bs: let(
                upto(zero, F.transform(bs, lambda block: F.aggregate(block, zero, lambda a, x: a + x))),
                lambda ends: F.flatten(F.transform(bs, lambda block, i: upto(F.coalesce(F.get(ends, i - 1), zero), block))),
            ),
        )

    return F.when(F.size(numbers) == 0, none).otherwise(let(numbers, in_blocks))


def _spans(text: Column, kind: str, rank: int, pattern: str, group: int = 0) -> Column:
    """All leftmost matches that do not overlap, with start, end (exclusive) and the value of a group."""
    quoted = F.lit(pattern)

    def placed(m: Column) -> Column:
        lengths = F.transform(m["f"], lambda f, i: (F.length(F.get(m["p"], i)) + F.length(f)).cast("bigint"))
        return let(
            _running(lengths),
            lambda ends: F.transform(
                m["f"],
                lambda f, i: F.struct(
                    F.lit(kind).alias("kind"),
                    F.lit(rank).alias("rank"),
                    (F.get(ends, i) - F.length(f)).cast("int").alias("first"),
                    F.get(ends, i).cast("int").alias("last"),
                    F.get(m["v"], i).alias("value"),
                ),
            ),
        )

    return let(
        F.struct(
            F.split(text, pattern).alias("p"),
            F.regexp_extract_all(text, quoted, F.lit(0)).alias("f"),
            F.regexp_extract_all(text, quoted, F.lit(group)).alias("v"),
        ),
        placed,
    )


def _if(seen: Column, spans: Column) -> Column:
    return F.when(seen, spans).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame) -> DataFrame:
    """`docs` with `_base` and `_wide`: arrays of spans.  Cheap tests keep most texts from the patterns."""
    text = F.coalesce(docs["text"], F.lit(""))
    assign = _if(
        text.contains(":") | text.contains("="),
        F.filter(_spans(text, "assign", 0, ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_VALUE),
    )
    access = _if(
        text.contains("AKIA"),
        F.filter(_spans(text, "access", 1, ACCESS), lambda s: F.length(s["value"]) >= LEAST_ACCESS),
    )
    hexes = _if(text.rlike(LONG_HEX), _spans(text, "hex", 2, LONG_HEX))
    random_looking = _if(
        text.rlike(r"[0-9]"),
        F.filter(
            _spans(text, WIDE_KIND, 3, WIDE),
            lambda s: s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]") & (F.length(F.regexp_replace(s["value"], "[^0-9]", "")) >= 3),
        ),
    )
    return docs.withColumn("_base", F.concat(assign, access, hexes)).withColumn("_wide", random_looking)


def ownership(candidates: DataFrame) -> DataFrame:
    """For each value's hash its distinct owners and repositories, from rows (_hash, owner, repository).

    Nulls are an owner and a repository of their own.  Copies are combined before each
    shuffle, so a value that a third of the corpus holds is spread over the tasks first.
    """
    return candidates.groupBy("_hash").agg(
        F.count_distinct(F.struct("owner")).alias("owners"), F.count_distinct(F.struct("repository")).alias("repositories")
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")


def _in_order(spans: Column) -> Column:
    """By start, then by kind as listed."""
    return F.transform(
        F.sort_array(
            F.transform(
                spans,
                lambda s: F.struct(s["first"].alias("first"), s["rank"].alias("rank"), s["last"].alias("last"), s["kind"].alias("kind")),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last")),
    )


def find_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Per row of `docs`: its base spans, all spans, and how many of them are live-looking or examples."""
    rows = staged(
        scan(docs).select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(repository).alias("doc_id"),
            F.col(owner).alias("owner"),
            "_base",
            "_wide",
        ),
        "secrets",
    )
    held = rows.select("_row", F.col("doc_id").alias("repository"), "owner", F.explode(F.concat("_base", "_wide")).alias("_span")).withColumn(
        "_hash", F.sha2("_span.value", 256)
    )
    judged = held.join(ownership(held), "_hash").select("_row", "_span", "owners", "repositories")
    example = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    live = (F.col("owners") == 1) & ~example
    wide = F.col("_span.kind") == WIDE_KIND
    by_row = judged.groupBy("_row").agg(
        F.collect_list(F.when(wide & live, F.col("_span"))).alias("_added"),
        F.count_if(~wide & live).alias("n_live"),
        F.count_if(example).alias("n_example"),
    )
    base = F.coalesce("_base", F.array().cast(SPAN))
    apart = F.filter(
        F.coalesce("_added", F.array().cast(SPAN)),
        lambda s: ~F.exists(base, lambda b: (b["first"] < s["last"]) & (s["first"] < b["last"])),
    )

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.join(by_row, "_row", "left").select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(_listed(_in_order(base)), 256).alias("base_sha256"),
        _listed(_in_order(F.concat(base, apart))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )
