"""Every query of the catalogue: a Spark callable and, beside it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle, views
from checks.scratch import scratch_path
from checks.views import LOOKBACK, RUN_DATE, START, Tables
from perfmart.functions import casts
from perfmart.operators import accounts, quality, records, windows
from perfmart.operators.carry import carry_forward, in_window, merge_distinct
from perfmart.operators.consolidate import consolidate
from perfmart.operators.lookup import lookup_names
from perfmart.operators.project import criteria_text, drop_header_rows, location_keys, project
from perfmart.plans.jobs import (
    IncompleteData,
    Store,
    backfill_report,
    check_dates,
    ingest,
    load_report,
    run_report,
)
from perfmart.plans.reports import (
    AUDIENCE,
    BACKFILLS,
    CONVERSION_SLICES,
    PERFORMANCE_SLICES,
    PLACEMENT,
    REPORTS,
    ReportSpec,
    Window,
)
from perfmart.session import tune, tuned
from perfmart.sources import tables
from perfmart.sources.raw import BAD_RECORD, read_accounts, read_location_dims, read_mart, read_raw, read_records

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], None]:
    def register(build: Callable[[Tables], DataFrame]) -> None:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql

    return register


# --- reports ---------------------------------------------------------------


def daily(spec: ReportSpec, t: Tables) -> DataFrame:
    tune(t.spark, spec)
    raw, mart = views.raw_batch(t, spec), views.mart_history(t, spec)
    return run_report(raw, mart, spec, RUN_DATE, LOOKBACK, dims=views.dims_of(t, spec))


def backfilled(spec: ReportSpec, t: Tables) -> DataFrame:
    tune(t.spark, spec)
    return backfill_report(views.raw_batch(t, spec), spec, RUN_DATE, views.dims_of(t, spec))


for _name, _spec in REPORTS.items():
    query(f"report_{_name}", oracle.report(_spec))(partial(daily, _spec))

for _name, _spec in BACKFILLS.items():
    query(f"backfill_{_name}", oracle.backfill(_spec))(partial(backfilled, _spec))


# --- projections and predicates ---------------------------------------------

AGE = REPORTS["age"]
CAMPAIGN = REPORTS["campaign"]
CONV = REPORTS["age_conv"]
GEO = REPORTS["geo"]
SEARCH = REPORTS["search_query"]


@query("typed_projection", oracle.projected(AGE, oracle.raw(AGE, "TRUE")))
def _(t):
    tune(t.spark, AGE)
    return project(views.raw_all(t, AGE), AGE, RUN_DATE)


@query(
    "micros_to_currency",
    "SELECT l_orderkey, l_linenumber, TRY_CAST(m AS DOUBLE) / 1000000 AS cost FROM "
    "(SELECT *, cast(cast(round(l_extendedprice * 1000000) AS BIGINT) AS VARCHAR) AS m FROM lineitem)",
)
def _(t):
    micros = F.round(F.col("l_extendedprice") * 1000000).cast("bigint").cast("string")
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", casts.micros_to_currency(micros).alias("cost")
    )


@query(
    "decimal_cpm",
    "SELECT l_orderkey, l_linenumber, TRY_CAST(c AS DECIMAL(30,6)) AS average_cpm FROM "
    "(SELECT *, cast(cast(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '.1234567' AS c"
    " FROM lineitem)",
)
def _(t):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        casts.to_decimal(F.concat(cents, F.lit(".1234567"))).alias("average_cpm"),
    )


def _criteria_sql(spec: ReportSpec) -> str:
    return (
        "SELECT ad_group_criterion_type_ AS criteria_type, ad_group_id, "
        f"{oracle.criteria(spec)} AS criteria FROM ({oracle.raw(spec, 'TRUE')})"
    )


def _criteria(spec: ReportSpec, t: Tables) -> DataFrame:
    return views.raw_all(t, spec).select(
        F.col("ad_group_criterion_type_").alias("criteria_type"),
        "ad_group_id",
        criteria_text(spec.criteria).alias("criteria"),
    )


for _spec, _rule in ((REPORTS["user"], AUDIENCE), (REPORTS["placement"], PLACEMENT)):
    assert _spec.criteria is _rule
    query(f"case_criteria_{_spec.name}", _criteria_sql(_spec))(partial(_criteria, _spec))


@query(
    "header_sentinel_filter",
    f"SELECT ad_group_id, ad_group_name, customer_id, segments_date FROM ({oracle.raw(AGE, 'TRUE', headers=True)}) "
    "WHERE ad_group_name <> 'ad_group_name'",
)
def _(t):
    rows = views.raw_all(t, AGE).union(views.header_rows(t, AGE))
    return drop_header_rows(rows, AGE.sentinel).select(
        "ad_group_id", "ad_group_name", "customer_id", "segments_date"
    )


@query(
    "mart_range_scan",
    f"SELECT * FROM ({oracle.history(CONV)}) WHERE data_date BETWEEN '1996-01-01' AND '{RUN_DATE}'",
)
def _(t):
    return in_window(views.mart_history(t, CONV), "1996-01-01", RUN_DATE)


@query(
    "source_status_filter",
    "SELECT campaign_status, ad_group_status, ad_group_criterion_status, ad_group_id, segments_date "
    f"FROM ({oracle.raw(AGE, 'TRUE')}) WHERE segments_date BETWEEN '{START}' AND '{RUN_DATE}' "
    "AND campaign_status IN ('ENABLED', 'PAUSED', 'REMOVED') "
    "AND ad_group_status IN ('ENABLED', 'PAUSED', 'REMOVED') "
    "AND ad_group_criterion_status IN ('ENABLED', 'PAUSED', 'REMOVED')",
)
def _(t):
    kept = records.source_filter(views.raw_all(t, AGE), AGE, RUN_DATE, LOOKBACK)
    return kept.select(
        "campaign_status",
        "ad_group_status",
        "ad_group_criterion_status",
        "ad_group_id",
        "segments_date",
    )


@query(
    "nested_source_filter",
    "SELECT l_partkey AS campaign_id, l_linenumber + 1 AS campaign_status, "
    "cast(cast(l_shipdate AS DATE) AS VARCHAR) AS segments_date FROM lineitem "
    f"WHERE cast(l_shipdate AS DATE) BETWEEN DATE '{START}' AND DATE '{RUN_DATE}' AND l_linenumber + 1 IN (2, 3, 4)",
)
def _(t):
    # The records as files of a columnar source; 2, 3 and 4 are the reported statuses' codes.
    path, delivered = scratch_path(t.spark, "records"), nested(t)
    delivered.write.parquet(path)
    stored = read_records(t.spark, delivered.schema, path, "parquet")
    kept = records.record_filter(stored, CAMPAIGN, RUN_DATE, LOOKBACK, (2, 3, 4))
    return records.flatten_records(kept, ["campaign.id", "campaign.status", "segments.date"])


# --- joins -------------------------------------------------------------------

_LEVELS = ("city", "country", "metro", "most_specific", "region")


_LOOKUP_SQL = (
    "SELECT ad_group_id, id, city_criteria_name, country_criteria_name, metro_criteria_name, "
    "most_specific_criteria_name, region_criteria_name FROM "
    f"(SELECT raw.ad_group_id, raw.metrics_clicks AS id, "
    + ", ".join(f"{c.raw}.{views.DIMS[c.raw][2]} AS {c.name}" for c in GEO.lookups)
    + f" FROM ({oracle.raw(GEO, 'TRUE')}) AS raw {oracle._lookups(GEO)})"
)


def _looked_up(t: Tables, broadcast: bool | None = None) -> DataFrame:
    named = lookup_names(views.raw_all(t, GEO), views.location_dims(t), location_keys(), broadcast)
    return named.select(
        "ad_group_id",
        F.col("metrics_clicks").alias("id"),
        *[F.col(f"{level}_name").alias(f"{level}_criteria_name") for level in _LEVELS],
    )


query("geo_lookup_inner5", _LOOKUP_SQL)(_looked_up)
# As if no dimension were small: the ids of the extract are looked up first.
query("geo_lookup_reduced", _LOOKUP_SQL)(partial(_looked_up, broadcast=False))


@query(
    "location_dims_scan",
    " UNION ALL ".join(
        f"SELECT '{level}' AS level, cast({key} AS BIGINT) AS id, {name} AS cannonicalname FROM {table}"
        for level, (table, key, name) in views.DIMS.items()
    ),
)
def _(t):
    paths = {}
    for level, dim in views.location_dims(t).items():
        paths[level] = scratch_path(t.spark, level)
        dim.withColumn("id", F.col("id").cast("bigint")).write.parquet(paths[level])
    dims = read_location_dims(t.spark, paths)
    return reduce(DataFrame.union, [dim.select(F.lit(level).alias("level"), "id", "cannonicalname") for level, dim in dims.items()])


def _carry_sql(batch: str, start: str = START) -> str:
    return (
        f"WITH fresh AS ({batch}), mart AS ({oracle.history(CONV)}) "
        f"{oracle.carried(CONV, start)}"
    )


def _carry(t: Tables, fresh: DataFrame, start: str = START, **limits: int) -> DataFrame:
    return carry_forward(
        fresh, views.mart_history(t, CONV), CONV.account, start, RUN_DATE, **limits
    )


@query("carry_forward_absent", _carry_sql(oracle.fresh(CONV)))
def _(t):
    return _carry(t, project(views.raw_batch(t, CONV), CONV, RUN_DATE))


@query("carry_forward_bitmaps", _carry_sql(oracle.fresh(CONV)))
def _(t):
    # As if there were too many accounts for a broadcast of their ids.
    return _carry(t, project(views.raw_batch(t, CONV), CONV, RUN_DATE), max_broadcast=0)


# The longer window of the original load: the published table's first day is the
# one before the fetch window, where the fresh accounts' rows are lost on overwrite.
_SHORT = LOOKBACK - 1


@query(
    "carry_forward_inclusive_start",
    f"WITH fresh AS (SELECT * FROM ({oracle.fresh(CONV)}) WHERE data_date > '{START}'), "
    f"mart AS ({oracle.history(CONV)}) SELECT * FROM fresh UNION {oracle.carried(CONV)}",
)
def _(t):
    first, _ = windows.window_bounds(RUN_DATE, _SHORT)
    raw = views.raw_batch(t, CONV).where(F.col("segments_date") >= first)
    return run_report(
        raw, views.mart_history(t, CONV), CONV, RUN_DATE, _SHORT, inclusive_start=True
    )


@query(
    "carry_forward_null_key",
    f"WITH fresh AS ({oracle.fresh(SEARCH, headers=True)}), mart AS ({oracle.history(SEARCH)}), "
    f"merged AS (SELECT * FROM fresh UNION {oracle.carried(SEARCH)}) "
    "SELECT * FROM merged",
)
def _(t):
    # Header rows that the report keeps: their account is NULL, so nothing is carried.
    raw = views.raw_batch(t, SEARCH, headers=True)
    return run_report(raw, views.mart_history(t, SEARCH), SEARCH, RUN_DATE, LOOKBACK)


@query(
    "carry_forward_empty_batch",
    _carry_sql(f"SELECT * FROM ({oracle.fresh(CONV)}) WHERE FALSE"),
)
def _(t):
    # No run has that date, so the batch is empty.
    return _carry(t, project(views.raw_batch(t, CONV), CONV, "1900-01-01"))


# --- set operations ----------------------------------------------------------

_NARROW = ("ad_network_type", "device", "conversions", "report_dt", "external_customer_id")


@query(
    "merge_union_distinct",
    f"WITH fresh AS ({oracle.fresh(CONV)}), mart AS ({oracle.history(CONV)}) "
    f"SELECT {', '.join(_NARROW)} FROM fresh UNION SELECT {', '.join(_NARROW)} FROM mart",
)
def _(t):
    fresh = project(views.raw_batch(t, CONV), CONV, RUN_DATE)
    return merge_distinct(fresh.select(*_NARROW), views.mart_history(t, CONV).select(*_NARROW))


@query(
    "distinct_accounts",
    f"SELECT DISTINCT external_customer_id FROM ({oracle.fresh(CONV)})",
)
def _(t):
    fresh = project(views.raw_batch(t, CONV), CONV, RUN_DATE)
    return fresh.select("external_customer_id").distinct()


def _consolidated(slices: dict[str, ReportSpec], t: Tables) -> DataFrame:
    tune(t.spark, AGE)
    inputs = [views.slice_history(t, s, k, len(slices)) for k, s in enumerate(slices.values())]
    return consolidate(inputs, START, RUN_DATE)


query("consolidate_criteria_performance", oracle.consolidated(PERFORMANCE_SLICES))(
    partial(_consolidated, PERFORMANCE_SLICES)
)
query("consolidate_criteria_conv", oracle.consolidated(CONVERSION_SLICES))(
    partial(_consolidated, CONVERSION_SLICES)
)


# --- records -----------------------------------------------------------------


def nested(t: Tables) -> DataFrame:
    """Report records as a fetch delivers them: nested, with enum codes."""
    return t["lineitem"].select(
        F.struct(
            F.col("l_partkey").alias("id"),
            F.concat(F.lit("Campaign "), F.col("l_partkey").cast("string")).alias("name"),
            (F.col("l_linenumber") + 1).alias("status"),
        ).alias("campaign"),
        F.struct(
            F.col("l_orderkey").alias("id"),
            F.struct(F.col("l_linenumber").alias("type")).alias("age_range"),
        ).alias("ad_group_criterion"),
        F.struct(
            F.col("l_quantity").cast("bigint").alias("clicks"),
            (F.col("l_discount") > 0.05).alias("discounted"),
            F.col("l_tax").alias("rate"),
        ).alias("metrics"),
        F.struct(
            F.col("l_shipdate").cast("date").cast("string").alias("date"),
            F.col("l_returnflag").alias("device"),
        ).alias("segments"),
    )


_FLAT_SQL = (
    "SELECT l_partkey AS campaign_id, 'Campaign ' || l_partkey AS campaign_name, "
    "l_linenumber + 1 AS campaign_status, l_orderkey AS ad_group_criterion_id, "
    "l_linenumber AS ad_group_criterion_age_range_type_, "
    "cast(l_quantity AS BIGINT) AS metrics_clicks, l_discount > 0.05 AS metrics_discounted, "
    "l_tax AS metrics_rate, cast(cast(l_shipdate AS DATE) AS VARCHAR) AS segments_date, "
    "l_returnflag AS segments_device FROM lineitem"
)


@query("flatten_records", _FLAT_SQL)
def _(t):
    return records.flatten_records(nested(t))


# Statuses 2, 3 and 4 have names; the records also hold codes that have none.
_STATUS_NAMES = {0: "UNSPECIFIED", 1: "UNKNOWN", 2: "ENABLED", 3: "PAUSED", 4: "REMOVED"}
_REPORTED_NAMES = {code: name for code, name in _STATUS_NAMES.items() if code > 1}
_STATUS_ENUM = {"campaign_status": "CampaignStatusEnum"}


@query(
    "decode_enums",
    "SELECT campaign_id, CASE campaign_status WHEN 2 THEN 'ENABLED' WHEN 3 THEN 'PAUSED' "
    "WHEN 4 THEN 'REMOVED' END AS campaign_status, ad_group_criterion_age_range_type_, "
    f"segments_date FROM ({_FLAT_SQL})",
)
def _(t):
    decoded = records.decode_enums(
        records.flatten_records(nested(t)), {"CampaignStatusEnum": _STATUS_NAMES}, _STATUS_ENUM
    )
    return decoded.select(
        "campaign_id", "campaign_status", "ad_group_criterion_age_range_type_", "segments_date"
    )


_BY_TABLE_SQL = (
    "SELECT c_custkey, n_name AS c_nationkey, c_mktsegment FROM customer LEFT JOIN nation "
    "ON CASE WHEN c_mktsegment = 'MACHINERY' THEN c_nationkey + 100 ELSE c_nationkey END = n_nationkey"
)


def _by_table(t: Tables, **limits: int) -> DataFrame:
    # Nation names stand for an enum's names; one segment's codes are unknown.
    dim = t["nation"].select(
        F.lit("NationEnum").alias("enum"), F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")
    )
    coded = t["customer"].selectExpr(
        "c_custkey",
        "case when c_mktsegment = 'MACHINERY' then c_nationkey + 100 else c_nationkey end as c_nationkey",
        "c_mktsegment",
    )
    return records.decode_enums_by_table(coded, dim, {"c_nationkey": "NationEnum"}, **limits)


query("decode_enums_by_table", _BY_TABLE_SQL)(_by_table)
# As if there were too many codes for a map, or for a broadcast.
query("decode_enums_by_join", _BY_TABLE_SQL)(partial(_by_table, max_codes=0, max_rows=0))


@query(
    "decode_loss_counts",
    "SELECT 'campaign_status' AS \"column\", cast(count(*) AS BIGINT) AS lost FROM lineitem "
    "WHERE l_linenumber + 1 NOT IN (2, 3, 4)",
)
def _(t):
    flat = records.flatten_records(nested(t))
    return quality.decode_loss_counts(
        flat,
        lambda df: records.decode_enums(df, {"CampaignStatusEnum": _STATUS_NAMES}, _STATUS_ENUM),
        ["campaign_status"],
    )


@query(
    "stringify_raw",
    "SELECT cast(campaign_id AS VARCHAR) AS campaign_id, campaign_name, "
    "CASE WHEN campaign_status BETWEEN 2 AND 4 THEN cast(campaign_status AS VARCHAR) ELSE 'None' END"
    " AS campaign_status, cast(metrics_clicks AS VARCHAR) AS metrics_clicks, "
    "CASE WHEN metrics_discounted THEN 'True' ELSE 'False' END AS metrics_discounted, "
    f"segments_date FROM ({_FLAT_SQL})",
)
def _(t):
    flat = records.flatten_records(nested(t))
    status = F.when(F.col("campaign_status").between(2, 4), F.col("campaign_status"))
    return records.stringify(
        flat.withColumn("campaign_status", status).select(
            "campaign_id",
            "campaign_name",
            "campaign_status",
            "metrics_clicks",
            "metrics_discounted",
            "segments_date",
        )
    )


# --- windows and data quality --------------------------------------------------

_TASKS, _CHUNKS = 6, 3
_DAYS = LOOKBACK // (_TASKS * _CHUNKS)
_BACK = f"date_diff('day', cast(l_shipdate AS DATE), DATE '{RUN_DATE}')"
_CHUNK_SQL = (
    f"SELECT cast(i // {_CHUNKS} AS INTEGER) AS task, cast(i % {_CHUNKS} AS INTEGER) AS chunk, "
    f"cast(DATE '{RUN_DATE}' - cast(i * {_DAYS} + {_DAYS - 1} AS INTEGER) AS DATE) AS s, "
    f"cast(DATE '{RUN_DATE}' - cast(i * {_DAYS} AS INTEGER) AS DATE) AS e FROM range({_TASKS * _CHUNKS}) AS r(i)"
)
_DATES_SQL = "SELECT DISTINCT cast(l_shipdate AS DATE) AS d FROM lineitem"


@query(
    "date_chunks",
    f"WITH c AS ({_CHUNK_SQL}), n AS (SELECT cast(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1) "
    'SELECT task, chunk, s AS "start", e AS "end", cast(coalesce(sum(n), 0) AS BIGINT) AS n_rows '
    "FROM c LEFT JOIN n ON d BETWEEN s AND e GROUP BY ALL",
)
def _(t):
    chunks = windows.date_chunks(t.spark, RUN_DATE, LOOKBACK, _TASKS, _CHUNKS)
    placed = windows.assign_chunks(
        t["lineitem"].select("l_shipdate"), "l_shipdate", RUN_DATE, LOOKBACK, _TASKS, _CHUNKS
    )
    n_rows = placed.groupBy("task", "chunk").agg(F.count(F.lit(1)).alias("n_rows"))
    return chunks.join(n_rows, ["task", "chunk"], "left").fillna(0, ["n_rows"])


@query(
    "missing_dates",
    f"SELECT cast(g AS DATE) AS date FROM generate_series(DATE '{START}', DATE '{RUN_DATE}', INTERVAL 1 DAY) AS s(g) "
    f"WHERE cast(g AS DATE) NOT IN ({_DATES_SQL})",
)
def _(t):
    raw = views.raw_all(t, CONV)
    return quality.missing_dates(raw, "segments_date", START, RUN_DATE)


@query(
    "missing_dates_by_chunk",
    f"WITH c AS ({_CHUNK_SQL}) SELECT task, chunk, cast(g AS DATE) AS date FROM "
    "(SELECT task, chunk, unnest(generate_series(s, e, INTERVAL 1 DAY)) AS g FROM c) "
    f"WHERE cast(g AS DATE) NOT IN ({_DATES_SQL})",
)
def _(t):
    chunks = windows.date_chunks(t.spark, RUN_DATE, LOOKBACK, _TASKS, _CHUNKS)
    return quality.missing_dates(
        views.raw_all(t, CONV), "segments_date", START, RUN_DATE, by_chunk=chunks
    )


@query(
    "completeness_opt_out",
    f"WITH d AS ({_DATES_SQL}) SELECT feed, feed <> 'topic' AND (SELECT count(*) FROM d WHERE d BETWEEN DATE '{START}' "
    f"AND DATE '{RUN_DATE}') < {LOOKBACK} AS refused FROM (SELECT unnest(['age', 'topic', 'campaign']) AS feed)",
)
def _(t):
    # Topic reports may have gaps; a gap in any other keeps it from being published.
    def refused(spec: ReportSpec) -> bool:
        try:
            check_dates(views.raw_all(t, spec), spec, RUN_DATE, LOOKBACK)
        except IncompleteData:
            return True
        return False

    feeds = [(name, refused(REPORTS[name])) for name in ("age", "topic", "campaign")]
    return t.spark.createDataFrame(feeds, "feed string, refused boolean")


@query("distinct_dates", "SELECT DISTINCT cast(ts AS DATE) AS date FROM events")
def _(t):
    return quality.distinct_dates(t["events"], "ts")


@query(
    "count_dates",
    "SELECT count(DISTINCT cast(ts AS DATE)) AS found, 31 AS expected FROM events "
    "WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'",
)
def _(t):
    return quality.count_dates(t["events"], "ts", "2024-01-01", "2024-01-31")


# A late date, on which not every slice has rows at the smaller scales.
_READY_DATE = "2001-11-04"


@query(
    "input_readiness",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) > 0 AS ready FROM lineitem WHERE {views.slice_condition(k)} "
        f"AND cast(l_shipdate AS DATE) = DATE '{_READY_DATE}'"
        for k, name in enumerate(PERFORMANCE_SLICES)
    ),
)
def _(t):
    inputs = {
        name: views.slice_history(t, s, k) for k, (name, s) in enumerate(PERFORMANCE_SLICES.items())
    }
    return quality.input_readiness(inputs, _READY_DATE)


@query(
    "readiness_by_partition",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) > 0 AS ready FROM lineitem WHERE {views.slice_condition(k)} "
        f"AND cast(l_shipdate AS DATE) = DATE '{_READY_DATE}'"
        for k, name in enumerate(CONVERSION_SLICES)
    ),
)
def _(t):
    # The slices as stored tables, of which only the folders are looked at.
    paths = {name: scratch_path(t.spark, name) for name in CONVERSION_SLICES}
    late = F.col("data_date") >= "2001-11-01"
    for k, (name, spec) in enumerate(CONVERSION_SLICES.items()):
        tables.overwrite_partitions(views.slice_history(t, spec, k).where(late), paths[name])
    return quality.partition_readiness(t.spark, paths, _READY_DATE)


def _lost_sql(spec: ReportSpec, where: str = "TRUE") -> str:
    parts = []
    for c in spec.columns:
        if c.kind in ("string", "criteria", "lookup"):
            continue
        cast = oracle._TYPED[c.kind].format(x=f"raw.{c.raw}")
        parts.append(
            f"SELECT '{c.name}' AS \"column\", count(*) FILTER (WHERE {c.raw} <> 'None' AND {cast} IS NULL)"
            f" AS lost FROM raw WHERE {spec.sentinel} <> '{spec.sentinel}'"
        )
    return f"WITH raw AS ({oracle.raw(spec, where, headers=True)}) " + " UNION ALL ".join(parts)


KEYWORD = REPORTS["keyword"]

_FETCH = replace(CAMPAIGN, daily=Window(1, 1, LOOKBACK))


@query(
    "ingest_counts",
    "SELECT count(*) AS n_rows, count(DISTINCT l_shipdate) AS n_dates, 0 AS n_bad, "
    "(SELECT count(*) FROM lineitem WHERE l_linenumber + 1 NOT IN (2, 3, 4)) AS n_codes_lost FROM lineitem "
    f"WHERE cast(l_shipdate AS DATE) BETWEEN DATE '{START}' AND DATE '{RUN_DATE}' AND l_linenumber + 1 IN (2, 3, 4)",
)
def _(t):
    # What the write of a run counts on its way.
    def decode(df, fields):
        return records.decode_enums(df, {"CampaignStatusEnum": _REPORTED_NAMES}, {"campaign_status": fields["campaign_status"]})

    delivered = nested(t).select("campaign", "segments")
    path = scratch_path(t.spark, "raw")
    fetched = ingest(delivered, _FETCH, decode, path, RUN_DATE)
    stored = read_raw(t.spark, _FETCH, path, RUN_DATE)
    return stored.groupBy().agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(fetched.dates)).cast("bigint").alias("n_dates"),
        F.lit(fetched.bad_records).alias("n_bad"),
        F.lit(fetched.codes_lost["campaign_status"]).cast("bigint").alias("n_codes_lost"),
    )


@query(
    "broken_records",
    "SELECT count(*) AS records, count(*) FILTER (WHERE l_linenumber = 7) AS bad, 0 AS without FROM lineitem",
)
def _(t):
    # One line in seven was cut off before it was stored.
    line = F.to_json(F.struct("*"))
    delivered, path = nested(t), scratch_path(t.spark, "records")
    cut = F.when(F.col("ad_group_criterion.age_range.type") == 7, F.substr(line, F.lit(1), F.length(line) - 3)).otherwise(line)
    delivered.select(cut.alias("value")).write.text(path)
    return quality.record_counts(read_records(t.spark, delivered.schema, path, keep_bad=True), BAD_RECORD, "campaign")


@query("cast_loss_counts", _lost_sql(KEYWORD))
def _(t):
    tune(t.spark, KEYWORD)
    raw = views.raw_all(t, KEYWORD).union(views.header_rows(t, KEYWORD))
    return quality.cast_loss_counts(raw, KEYWORD)


# --- accounts ------------------------------------------------------------------

_CUSTOMER_ACCOUNTS = (
    "SELECT cast(c_custkey AS VARCHAR) AS account_id, "
    "CASE WHEN c_acctbal >= 0 THEN '2' ELSE '3' END AS status FROM customer"
)


def _accounts(t: Tables) -> DataFrame:
    """The account list as it is stored, read back."""
    path = scratch_path(t.spark, "accounts")
    t["customer"].select(
        F.col("c_custkey").cast("string").alias("account_id"),
        F.when(F.col("c_acctbal") >= 0, "2").otherwise("3").alias("status"),
    ).write.parquet(path)
    return read_accounts(t.spark, path)


@query(
    "account_status_split",
    "SELECT *, CASE WHEN status = '2' THEN 'active' ELSE 'deactivated' END AS state "
    f"FROM ({_CUSTOMER_ACCOUNTS})",
)
def _(t):
    return accounts.account_status(_accounts(t))


@query(
    "deactivated_accounts_by_feed",
    "SELECT feed, account_id FROM (SELECT unnest(["
    + ", ".join(f"'{name}'" for name in REPORTS)
    + f"]) AS feed) CROSS JOIN ({_CUSTOMER_ACCOUNTS}) WHERE status <> '2'",
)
def _(t):
    return accounts.deactivated_accounts(_accounts(t), REPORTS)


# --- tables --------------------------------------------------------------------

_SPLIT_DATE = "1998-01-01"
_MONTHLY_HISTORY = oracle.history(CONV, monthly=True)


def _revised(t: Tables) -> DataFrame:
    """The later months once more, with every conversion counted twice."""
    later = views.mart_history(t, CONV, monthly=True).where(F.col("data_date") >= _SPLIT_DATE)
    return later.withColumn("conversions", F.col("conversions") * 2)


_REVISED_SQL = (
    f"SELECT * FROM ({_MONTHLY_HISTORY}) WHERE data_date < '{_SPLIT_DATE}' UNION ALL "
    f"SELECT * REPLACE (conversions * 2 AS conversions) FROM ({_MONTHLY_HISTORY}) "
    f"WHERE data_date >= '{_SPLIT_DATE}'"
)


@query("dynamic_partition_overwrite", _REVISED_SQL)
def _(t):
    path = scratch_path(t.spark, "mart")
    tables.overwrite_partitions(views.mart_history(t, CONV, monthly=True), path)
    tables.overwrite_partitions(_revised(t), path)
    return read_mart(t.spark, CONV, path)


def _new_table(t: Tables, name: str) -> tuple[str, str]:
    """A catalog table's name and its path."""
    path = scratch_path(t.spark, name)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


def _contents(t: Tables, table: str) -> DataFrame:
    """What the catalog shows of a table, written apart; the table leaves the catalog."""
    shown, path = t.spark.table(table), scratch_path(t.spark, "contents")
    shown.write.parquet(path)
    t.spark.sql("DROP TABLE IDENTIFIER(:table)", args={"table": table})
    return t.spark.read.schema(shown.schema).parquet(path)


@query("saveastable_window_overwrite", _REVISED_SQL)
def _(t):
    table, path = _new_table(t, "consolidated")
    tables.overwrite_table(views.mart_history(t, CONV, monthly=True), table, path)
    tables.overwrite_table(_revised(t), table, path)
    return _contents(t, table)


@query("insert_into_overwrite", _REVISED_SQL)
def _(t):
    table, path = _new_table(t, "inserted")
    tables.overwrite_table(views.mart_history(t, CONV, monthly=True), table, path)
    tables.insert_partitions(_revised(t), table)
    return _contents(t, table)


@query("window_published_at_once", _REVISED_SQL)
def _(t):
    view, root = _new_table(t, "window")
    tables.publish_window(views.mart_history(t, CONV, monthly=True), view, root)
    tables.publish_window(_revised(t), view, root)
    shown, path = t.spark.table(view), scratch_path(t.spark, "contents")
    shown.write.parquet(path)
    t.spark.sql("DROP VIEW IDENTIFIER(:view)", args={"view": view})
    return t.spark.read.schema(shown.schema).parquet(path)


def _partly_registered(t: Tables, name: str) -> str:
    """A table whose later months were written by path, past the catalog."""
    table, path = _new_table(t, name)
    history = views.mart_history(t, CONV, monthly=True)
    tables.overwrite_table(history.where(F.col("data_date") < _SPLIT_DATE), table, path)
    tables.overwrite_partitions(history.where(F.col("data_date") >= _SPLIT_DATE), path)
    return table


@query("add_partition", f"SELECT * FROM ({_MONTHLY_HISTORY}) WHERE data_date <= '{_SPLIT_DATE}'")
def _(t):
    # Of the months that the catalog does not know, one is registered, twice.
    table = _partly_registered(t, "registered")
    for _ in range(2):
        tables.add_partition(t.spark, table, _SPLIT_DATE)
    return _contents(t, table)


@query("recover_partitions", f"SELECT * FROM ({_MONTHLY_HISTORY})")
def _(t):
    table = _partly_registered(t, "recovered")
    tables.recover_partitions(t.spark, table)
    return _contents(t, table)


@query("empty_run_writes_nothing", f"SELECT * FROM ({_MONTHLY_HISTORY})")
def _(t):
    # The second run has no rows: it leaves no file, and the published months as they are.
    path = scratch_path(t.spark, "mart")
    history = views.mart_history(t, CONV, monthly=True)
    tables.overwrite_partitions(history, path)
    tables.overwrite_partitions(history.where(F.col("data_date").isNull()), path)
    return read_mart(t.spark, CONV, path)


@query(
    "self_read_overwrite",
    f"WITH mart AS ({_MONTHLY_HISTORY}), fresh AS (SELECT * FROM ({oracle.fresh(CONV, monthly=True)})"
    f" WHERE data_date >= '{_SPLIT_DATE}') SELECT * FROM mart WHERE data_date < '{_SPLIT_DATE}' UNION ALL "
    f"SELECT * FROM (SELECT * FROM fresh UNION {oracle.carried(CONV, _SPLIT_DATE)})",
)
def _(t):
    root = scratch_path(t.spark, "store")
    store = Store(raw=f"{root}/raw", mart=f"{root}/mart", backfill=f"{root}/backfill")
    later = F.col("segments_date") >= _SPLIT_DATE
    batch = views.raw_batch(t, CONV, monthly=True).where(later)
    tables.write_run(batch.withColumn("chunk", F.lit("0-0")), store.raw_path(CONV), RUN_DATE)
    tables.overwrite_partitions(views.mart_history(t, CONV, monthly=True), store.mart_path(CONV))
    days = LOOKBACK - 1095  # back to the split date
    load_report(t.spark, replace(CONV, check_dates=False), store, RUN_DATE, days)
    return read_mart(t.spark, CONV, store.mart_path(CONV))


@query("casts_lost_in_load", _lost_sql(KEYWORD, oracle.IS_ACTIVE))
def _(t):
    # What the load of a run counts on its way.
    root = scratch_path(t.spark, "store")
    store = Store(raw=f"{root}/raw", mart=f"{root}/mart", backfill=f"{root}/backfill")
    batch = views.raw_batch(t, KEYWORD, monthly=True, by_customer=True).withColumn("chunk", F.lit("0-0"))
    with tuned(t.spark, KEYWORD):
        tables.write_run(batch, store.raw_path(KEYWORD), RUN_DATE, KEYWORD.account_raw, cluster=False)
    loaded = load_report(t.spark, replace(KEYWORD, check_dates=False), store, RUN_DATE, LOOKBACK)
    return t.spark.createDataFrame(list(loaded.casts_lost.items()), "column string, lost bigint")


_AGAIN = "s_nationkey = 7"


@query(
    "rerun_one_customer",
    f"WITH raw AS ({oracle.raw(CONV, 'TRUE')}), again AS (SELECT cast(s_suppkey AS VARCHAR) AS c FROM supplier WHERE {_AGAIN}) "
    "SELECT * FROM raw WHERE customer_id NOT IN (SELECT c FROM again) OR segments_device <> 'R' UNION ALL "
    "SELECT * REPLACE ('7' AS metrics_conversions) FROM raw WHERE customer_id IN (SELECT c FROM again) AND segments_device = 'R'",
)
def _(t):
    # Returned lines are one chunk.  The accounts of one nation are fetched again there.
    path = scratch_path(t.spark, "raw")
    chunk = F.when(F.col("segments_device") == "R", "0-0").otherwise("0-1")
    tables.write_run(views.raw_all(t, CONV).withColumn("chunk", chunk), path, RUN_DATE, CONV.account_raw)
    again = t["supplier"].where(_AGAIN).select(F.col("s_suppkey").cast("string").alias("customer_id"))
    fetched = views.raw_all(t, CONV).where("segments_device = 'R'").join(again, "customer_id", "left_semi")
    fetched = fetched.withColumn("metrics_conversions", F.lit("7")).select(*CONV.raw_fields)
    tables.replace_customers(fetched, path, RUN_DATE, "0-0", CONV.account_raw)
    return read_raw(t.spark, CONV, path, RUN_DATE)


@query(
    "clear_run_partition",
    "SELECT l_orderkey, l_partkey, l_returnflag, CASE WHEN l_linestatus = 'F' THEN '2001-12-30' "
    "ELSE '2001-12-31' END AS data_date FROM lineitem WHERE l_linestatus = 'F' OR l_returnflag = 'A'",
)
def _(t):
    # Two runs are written; the second is cleared and fetched again with fewer rows.
    path = scratch_path(t.spark, "raw")
    lines = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", F.lit("0-0").alias("chunk")
    )
    first = lines.where("l_linestatus = 'F'").drop("l_linestatus")
    second = lines.where("l_linestatus = 'O'").drop("l_linestatus")
    tables.write_run(first, path, "2001-12-30")
    tables.write_run(second, path, RUN_DATE)
    schema = first.drop("chunk").schema
    tables.clear_run(t.spark, schema, path, RUN_DATE)
    tables.write_chunk(second.where("l_returnflag = 'A'"), path, RUN_DATE, "0-0")
    stored = schema.add("data_date", "string")
    return t.spark.read.schema(stored).parquet(path).select(*stored.names)
