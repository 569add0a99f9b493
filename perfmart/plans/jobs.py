"""The jobs a scheduler calls: fetch records in, load a report, consolidate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from perfmart.operators.carry import (
    KeyProfile,
    carry_forward,
    in_window,
    merge_clustered,
    merge_distinct,
    merge_distinct_by,
    merge_rows,
    profile_keys,
    repeated_hashes,
)
from perfmart.operators.consolidate import consolidate
from perfmart.operators.lookup import dims_fit
from perfmart.operators.project import project
from perfmart.operators.quality import missing_dates, partition_readiness, rows_by_date
from perfmart.operators.records import (
    flatten_records,
    raw_name,
    record_filter,
    source_filter,
    stringify,
)
from perfmart.operators.windows import (
    assign_chunks,
    date_chunks,
    lookback_of,
    run_date_of,
    window_bounds,
)
from perfmart.plans.columns import ENUM_FIELDS, FETCHED_FIELDS
from perfmart.plans.reports import (
    BACKFILLS,
    CONVERSION_SLICES,
    PERFORMANCE_SLICES,
    ReportSpec,
    Window,
)
from perfmart.session import compiled, tuned
from perfmart.sources import tables
from perfmart.sources.raw import BAD_RECORD, read_mart, read_raw

DAILY_LOOKBACK = 30
CONSOLIDATION_LOOKBACK = 100


class IncompleteData(RuntimeError):
    """A run must not be published: dates, inputs or account ids are missing."""


@dataclass(frozen=True)
class Fetched:
    """What was counted while a run was written; a task that had to be repeated may count twice."""

    rows: int
    dates: frozenset[str]
    bad_records: int
    #: Enum codes without a name, by raw field.
    codes_lost: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Loaded:
    """What was counted while a report was loaded: texts that a cast turned to NULL, by column."""

    casts_lost: Mapping[str, int]


@dataclass(frozen=True)
class Store:
    """Where the tables live: one folder per report under each root."""

    raw: str
    mart: str
    backfill: str

    def raw_path(self, spec: ReportSpec) -> str:
        return f"{self.raw}/{spec.name}"

    def mart_path(self, spec: ReportSpec) -> str:
        return f"{self.mart}/{spec.name}"

    def backfill_path(self, spec: ReportSpec) -> str:
        return f"{self.backfill}/{spec.name}"


def run_report(
    raw: DataFrame,
    mart: DataFrame,
    spec: ReportSpec,
    run_date: str,
    lookback: int = DAILY_LOOKBACK,
    inclusive_start: bool = False,
    dims: dict[str, DataFrame] | None = None,
    guard_null_keys: bool = False,
) -> DataFrame:
    """A daily report: this run's rows, plus carried accounts, without duplicates.

    The batch's accounts, and which rows may be duplicates, are worked out while the report
    is planned, and its rows when the report is read.  ``guard_null_keys`` refuses a batch with a NULL account, which
    would carry nothing and so erase the absent accounts when written.
    """
    fresh = _fresh(raw, spec, run_date, dims, _fits(spec, dims))
    with compiled(raw.sparkSession):
        profile = profile_keys(fresh, spec.account, store=True)
        if guard_null_keys:
            _guard(profile, spec, run_date)
        start, end = window_bounds(run_date, lookback, inclusive_start)
        carried = carry_forward(fresh, mart, spec.account, start, end, profile, below=True)
        return merge_distinct_by(fresh, carried, _telling(spec))


def _telling(spec: ReportSpec) -> list[str]:
    """The columns that tell most rows apart: ids, clicks and impressions, the date and the other segments."""
    counts = ("metrics_clicks", "metrics_impressions")
    told = [c for c in spec.columns if c.kind == "bigint" and (c.raw.endswith("_id") or c.raw in counts)]
    return [c.name for c in [*told, *(c for c in spec.columns if c.kind in ("string", "date") and c.raw.startswith("segments_"))]]


def _fresh(
    raw: DataFrame,
    spec: ReportSpec,
    run_date: str,
    dims: dict[str, DataFrame] | None,
    fits: Mapping[str, bool] | None,
    lost: Observation | None = None,
) -> DataFrame:
    return project(raw, spec, run_date, dims, fits, lost)


def _fits(spec: ReportSpec, dims: dict[str, DataFrame] | None) -> Mapping[str, bool] | None:
    return dims_fit(dims) if spec.lookups else None


def _guard(profile: KeyProfile, spec: ReportSpec, run_date: str) -> None:
    if profile.has_null:
        raise IncompleteData(f"{spec.name}: the batch of {run_date} has a row without an account")


def backfill_report(
    raw: DataFrame,
    spec: ReportSpec,
    run_date: str,
    dims: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """A backfilled report: this run's rows only, duplicates included.

    ``spec`` is one of ``BACKFILLS``.
    """
    return project(raw, spec, run_date, dims)


Decode = Callable[[DataFrame, Mapping[str, str]], DataFrame]


@dataclass
class _Counters:
    """What an extract counts while it is written."""

    bad: Observation | None = None
    codes: Observation = field(default_factory=Observation)
    rows: Observation = field(default_factory=Observation)
    coded: list[str] = field(default_factory=list)

    def fetched(self) -> Fetched:
        rows, codes = self.rows.get, self.codes.get if self.coded else {}
        return Fetched(rows["rows"], frozenset(rows["dates"] or ()), self.bad.get["bad"] if self.bad else 0, codes)


def _extract(
    records: DataFrame, spec: ReportSpec, decode: Decode, run_date: str, window: Window, reported: Collection[int] | None
) -> tuple[DataFrame, _Counters]:
    """Raw rows with their task and chunk, and the counters that whoever writes them fills."""
    unknown = [f for f in spec.raw_fields if f not in FETCHED_FIELDS]
    if unknown:
        raise ValueError(f"{spec.name}: no record has the fields {', '.join(unknown)}")
    lookback = lookback_of(window)
    count = _Counters()
    if BAD_RECORD in records.columns:
        count.bad = Observation()
        records = records.observe(count.bad, F.count_if(F.col(BAD_RECORD).isNotNull()).alias("bad"))
        records = records.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    if reported is not None:
        records = record_filter(records, spec, run_date, lookback, reported)
    flat = flatten_records(records)
    enums = {raw_name(f): enum for f, enum in ENUM_FIELDS.items()}
    count.coded = [f for f in enums if f in flat.columns and f in spec.raw_fields]
    wanted = decode(flat.withColumns({f"_code_{f}": F.col(f) for f in count.coded}), enums)
    if count.coded:
        lost = [F.count_if(F.col(f"_code_{f}").isNotNull() & F.col(f).isNull()).alias(f) for f in count.coded]
        wanted = wanted.observe(count.codes, *lost)
    if reported is None:
        wanted = source_filter(wanted, spec, run_date, lookback)
    absent = {f: F.lit(None).cast("string") for f in spec.raw_fields if f not in wanted.columns}
    rows = stringify(wanted.withColumns(absent).select(*spec.raw_fields))
    rows = rows.observe(count.rows, F.count(F.lit(1)).alias("rows"), F.collect_set("segments_date").alias("dates"))
    return assign_chunks(rows, "segments_date", run_date, lookback, window.tasks, window.chunks), count


def _customer(spec: ReportSpec) -> str | None:
    return spec.account_raw if spec.account_raw in spec.raw_fields else None


def ingest(
    records: DataFrame,
    spec: ReportSpec,
    decode: Decode,
    path: str,
    run_date: str,
    monthly: bool = False,
    reported: Collection[int] | None = None,
    check: bool = False,
) -> Fetched:
    """Nested records to one run of the raw extract; what it counted on the way.

    ``decode`` takes the flat records and the enum of each column; pass
    ``decode_enums`` or ``decode_enums_by_table`` with its enums filled in.  A field
    that the records lack was not set in any of them and becomes ``'None'``; one that no
    feed fetches is an error of the spec.  With ``reported``, the codes of the reported
    statuses, rows are chosen before anything is decoded.

    Dates, broken records and codes without a name are counted by the write itself.
    ``check`` fails after it, naming the dates that the fetch lacks, unless the spec
    skips that check.
    """
    window = spec.monthly if monthly else spec.daily
    placed, count = _extract(records, spec, decode, run_date, window, reported)
    chunk = F.concat_ws("-", "task", "chunk")
    tables.write_run(placed.select(*spec.raw_fields, chunk.alias("chunk")), path, run_date, _customer(spec))
    fetched = count.fetched()
    if check and spec.check_dates:
        gaps = sorted(_days(run_date, lookback_of(window)) - fetched.dates)
        if gaps:
            raise IncompleteData(f"{spec.name}: no data for {', '.join(gaps)}")
    return fetched


def _days(run_date: str, lookback: int) -> set[str]:
    last = dt.date.fromisoformat(run_date)
    return {(last - dt.timedelta(days=n)).isoformat() for n in range(lookback)}


def ingest_customers(
    records: DataFrame,
    spec: ReportSpec,
    decode: Decode,
    path: str,
    run_date: str,
    chunk: str,
    monthly: bool = False,
    reported: Collection[int] | None = None,
) -> Fetched:
    """Fetch some customers of one chunk of a run again: their rows are replaced, all others stay.

    ``records`` are those of the customers; what lies outside the chunk's dates is left out.
    """
    window = spec.monthly if monthly else spec.daily
    placed, count = _extract(records, spec, decode, run_date, window, reported)
    inside = placed.where(F.concat_ws("-", "task", "chunk") == chunk).select(*spec.raw_fields)
    tables.replace_customers(inside, path, run_date, chunk, spec.account_raw)
    return count.fetched()


def check_dates(
    raw: DataFrame,
    spec: ReportSpec,
    run_date: str,
    lookback: int,
    window: Window | None = None,
    present: Collection[str] | None = None,
) -> None:
    """Fail naming the dates of the window that the run has no rows for.

    With the fetch window that the run was made with, each gap comes with the task and
    chunk that has to be fetched again.  ``present`` are the dates found, where they are
    known; else ``raw`` is read for them.
    """
    if not spec.check_dates:
        return
    spark = raw.sparkSession
    start, end = window_bounds(run_date, lookback)
    chunks = window and date_chunks(spark, run_date, lookback, window.tasks, window.chunks)
    dates = raw if present is None else spark.createDataFrame([(d,) for d in present], "segments_date string")
    gaps = missing_dates(dates, "segments_date", start, end, chunks).collect()
    if gaps:
        places = sorted(f"{r['date']} ({r['task']}-{r['chunk']})" if window else str(r["date"]) for r in gaps)
        raise IncompleteData(f"{spec.name}: no data for {', '.join(places)}")


def _bounds_by_date(fresh: Mapping[str | None, int], mart: DataFrame, start: str, end: str) -> dict[str | None, int]:
    """Upper bounds of the rows that a load writes, by date.

    Counting published rows by the partition column reads only the footers of the files.
    """
    out = dict(fresh)
    for r in in_window(mart, start, end).groupBy("data_date").agg(F.count(F.lit(1)).alias("rows")).collect():
        out[r["data_date"]] = out.get(r["data_date"], 0) + r["rows"]
    return out


def load_report(
    spark: SparkSession,
    spec: ReportSpec,
    store: Store,
    run_date: str,
    lookback: int = DAILY_LOOKBACK,
    dims: dict[str, DataFrame] | None = None,
    inclusive_start: bool = False,
    guard_null_keys: bool = True,
    window: Window | None = None,
    many_copies: bool = False,
) -> Loaded:
    """Check a run, merge it into the published table and replace its dates.

    One job counts the run's rows by date, which tells the dates that are missing and
    how many tasks each date is written by.  Another works out the accounts of the run,
    once.  Merge and write share one shuffle, and what the casts lose is counted on the
    way.  A job before it reads the columns that tell rows apart: where no two rows agree in
    them, no task has to hold its rows to compare them.  ``many_copies`` is for a run in which one row is repeated very often: copies are
    then collapsed before a shuffle of their own.
    """
    raw = read_raw(spark, spec, store.raw_path(spec), run_date)
    start, end = window_bounds(run_date, lookback, inclusive_start)
    by_date = rows_by_date(raw, "segments_date", start, end)
    check_dates(raw, spec, run_date, lookback, window, [d for d in by_date if d is not None])
    mart = read_mart(spark, spec, store.mart_path(spec))
    fits, lost = _fits(spec, dims), Observation()
    with tuned(spark, spec):
        profile = profile_keys(_fresh(raw, spec, run_date, dims, fits), spec.account, hold=True)
        try:
            if guard_null_keys:
                _guard(profile, spec, run_date)
            fresh = _fresh(raw, spec, run_date, dims, fits, lost)
            carried = carry_forward(fresh, mart, spec.account, start, end, profile)
            if many_copies:
                merged = merge_distinct(fresh, carried)
            else:
                # Apart from ``fresh``, whose counters count what every job reads.
                counted = _fresh(raw, spec, run_date, dims, fits)
                distinct = repeated_hashes(merge_rows(counted, carried), _telling(spec)).isEmpty()
                bounds = _bounds_by_date(by_date, mart, start, end)
                merged = merge_clustered(fresh, carried, "data_date", bounds, distinct=distinct)
            tables.overwrite_partitions(merged, store.mart_path(spec), cluster=many_copies)
        finally:
            profile.release()
    return Loaded(lost.get)


def load_scheduled(
    spark: SparkSession,
    spec: ReportSpec,
    store: Store,
    schedule_date: str,
    monthly: bool = False,
    dims: dict[str, DataFrame] | None = None,
) -> None:
    """The load of a schedule date: run date, window and chunks are those of the spec.

    A report that is fetched some days late is loaded for the run date it was fetched
    for; the monthly load restates the spec's longer window.
    """
    window = spec.monthly if monthly else spec.daily
    run_date = run_date_of(schedule_date, spec.run_lag_days)
    load_report(spark, spec, store, run_date, lookback_of(window), dims, window=window)


def load_backfill(
    spark: SparkSession,
    name: str,
    store: Store,
    run_date: str,
    dims: dict[str, DataFrame] | None = None,
    lookback: int | None = None,
) -> None:
    """Check one run of a backfill report and write it.

    ``lookback`` are the days that the run was asked for, by default the spec's window.
    The two variants of a report (``ads_ad_hoc``, ``paid_organic_temp``) write to the
    folder of their report, as published.
    """
    spec = BACKFILLS[name]
    raw = read_raw(spark, spec, store.raw_path(spec), run_date)
    check_dates(raw, spec, run_date, lookback or lookback_of(spec.daily))
    rows = backfill_report(raw, spec, run_date, dims)
    with tuned(spark, spec):
        tables.overwrite_partitions(rows, store.backfill_path(spec))


def _consolidate(
    spark: SparkSession,
    slices: dict[str, ReportSpec],
    store: Store,
    table: str,
    path: str,
    run_date: str,
    start: str | None,
) -> None:
    end = run_date
    start = start or window_bounds(run_date, CONSOLIDATION_LOOKBACK, inclusive_start=True)[0]
    late = partition_readiness(spark, {n: store.mart_path(s) for n, s in slices.items()}, run_date)
    late = late.where(~F.col("ready")).collect()
    if late:
        names = ", ".join(sorted(r["table"] for r in late))
        raise IncompleteData(f"{table}: no rows of {run_date} in {names}")
    inputs = [read_mart(spark, s, store.mart_path(s)) for s in slices.values()]
    tables.overwrite_table(consolidate(inputs, start, end), table, path)


def consolidate_performance(
    spark: SparkSession, store: Store, table: str, path: str, run_date: str, start: str | None = None
) -> None:
    """Publish the consolidated criteria performance table for a window."""
    _consolidate(spark, PERFORMANCE_SLICES, store, table, path, run_date, start)


def consolidate_conversions(
    spark: SparkSession, store: Store, table: str, path: str, run_date: str, start: str | None = None
) -> None:
    """Publish the consolidated criteria conversions table for a window."""
    _consolidate(spark, CONVERSION_SLICES, store, table, path, run_date, start)
