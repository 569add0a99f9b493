"""Report inputs derived from the test tables.

Each view is a projection of whole tables.  The expressions are SQL text that
Spark and DuckDB read alike, so both engines start from the same raw extract:
all text, ``'None'`` for a missing value.  What is done with it afterwards is
written twice, once in ``perfmart`` and once in ``checks.oracle``.

An account is a supplier; those with a low balance are deactivated, so the batch
lacks them while the published history still has them.  The window covers every
ship date of the tables.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.operators.accounts import active_accounts
from perfmart.operators.joins import BROADCAST_ROWS, bounded_join, fits
from perfmart.operators.project import project
from perfmart.plans.reports import ReportSpec, TypedCriteria
from perfmart.sources.tables import cluster_for_write, customer_bucket

RUN_DATE = "2001-12-31"
LOOKBACK = 2556
START = "1995-01-02"

ACTIVE = "s_acctbal >= 1000"

# Fields with a meaning of their own; the rest follow _field() below.
_FIELDS = {
    "customer_id": "cast(l_suppkey as string)",
    "customer_descriptive_name": "concat('Account ', cast(l_suppkey as string))",
    "customer_currency_code": "'USD'",
    "customer_time_zone": "'UTC'",
    "campaign_id": "cast(l_partkey as string)",
    "campaign_name": "concat('Campaign ', cast(l_partkey as string))",
    "campaign_status": "case l_returnflag when 'A' then 'ENABLED' when 'N' then 'PAUSED' else 'REMOVED' end",
    "ad_group_id": "cast(l_orderkey as string)",
    "ad_group_name": "concat('Group ', cast(l_orderkey as string))",
    "ad_group_status": "case l_linestatus when 'O' then 'ENABLED' else 'PAUSED' end",
    "ad_group_criterion_status": "case l_linenumber when 6 then 'UNKNOWN' when 7 then 'UNSPECIFIED' else 'ENABLED' end",
    "segments_date": "cast(cast(l_shipdate as date) as string)",
    "segments_device": "l_returnflag",
    "segments_ad_network_type": "l_linestatus",
    "metrics_clicks": "cast(cast(l_quantity as bigint) as string)",
    "metrics_impressions": "cast(cast(l_quantity as bigint) * 10 as string)",
    "metrics_conversions": "cast(cast(round(l_discount * 100) as bigint) as string)",
    "metrics_all_conversions": "cast(cast(round(l_tax * 100) as bigint) as string)",
    "metrics_cost_micros": "cast(cast(round(l_extendedprice * 1000000) as bigint) as string)",
    "metrics_average_cpm": "concat(cast(cast(round(l_extendedprice * 100) as bigint) as string), '.1234567')",
    "ad_group_criterion_criterion_id": "cast(l_linenumber as string)",
    "segments_geo_target_city": "case when l_linenumber = 7 then '' else concat('geoTargetConstants/', cast(l_partkey as string)) end",
    "segments_geo_target_metro": "concat('geoTargetConstants/', cast(l_suppkey as string))",
    "segments_geo_target_most_specific_location": "concat('geoTargetConstants/', cast(l_partkey as string))",
    "segments_geo_target_region": "concat('geoTargetConstants/', cast(l_linenumber - 1 as string))",
    "geographic_view_country_criterion_id": "cast(l_linenumber as string)",
}

# Location dimensions: level -> (table, id, name).
DIMS = {
    "city": ("part", "p_partkey", "p_name"),
    "country": ("nation", "n_nationkey", "n_name"),
    "metro": ("supplier", "s_suppkey", "s_name"),
    "most_specific": ("customer", "c_custkey", "c_name"),
    "region": ("region", "r_regionkey", "r_name"),
}

_NUMBER = "cast(cast(l_quantity as bigint) + {n} as string)"
_OR_NONE = "case when l_linenumber = 7 then 'None' else {text} end"


def _field(spec: ReportSpec, raw_field: str, n: int) -> str:
    """Text of one raw field; ``n`` keeps fields of the same kind apart."""
    if raw_field == "ad_group_criterion_type_" and isinstance(spec.criteria, TypedCriteria):
        whens = " ".join(
            f"when {i} then '{kind}'" for i, (kind, _) in enumerate(spec.criteria.choices, 1)
        )
        return f"case l_linenumber {whens} else 'OTHER' end"
    if raw_field in _FIELDS:
        return _FIELDS[raw_field]
    kinds = {c.kind for c in spec.columns if c.raw == raw_field}
    if "creative_quality_score" in raw_field:
        text = "'ABOVE_AVERAGE'"  # an enum's name, also where the report casts it to int
    elif kinds & {"bigint", "int"}:
        text = _NUMBER.format(n=n)
    elif "double" in kinds:
        text = f"concat({_NUMBER.format(n=n)}, '.25')"
    else:
        text = f"concat('{n}:', cast(l_linenumber as string))"
    return _OR_NONE.format(text=text)


def raw_texts(spec: ReportSpec, monthly: bool = False) -> dict[str, str]:
    """Text of every column of a raw extract over ``lineitem``, run-date partition included.

    ``monthly`` dates every row to the first of its month: fewer partitions, for
    the queries that write tables.
    """
    fields = {f: _field(spec, f, n) for n, f in enumerate(spec.raw_fields)}
    if monthly:
        fields["segments_date"] = "concat(substr(cast(cast(l_shipdate as date) as string), 1, 7), '-01')"
    return fields | {"data_date": f"'{RUN_DATE}'"}


def raw_expressions(spec: ReportSpec, monthly: bool = False) -> list[str]:
    """Select list of a raw extract."""
    return [f"{text} as {f}" for f, text in raw_texts(spec, monthly).items()]


def header_expressions(spec: ReportSpec) -> list[str]:
    """Select list of stray header rows: every column holds its own name."""
    return [f"'{f}' as {f}" for f in spec.raw_fields] + [f"'{RUN_DATE}' as data_date"]


@dataclass(frozen=True)
class Tables:
    """The test tables of one scale."""

    spark: SparkSession
    folder: str

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def lines(t: Tables, inputs: int = 1) -> DataFrame:
    """Line items, dealt over the tasks while they are narrow: the views make wide text rows of them.

    ``inputs`` is how many parts of the table a query reads side by side.  Each task compiles its wide
    projections anew, so the parts together take three times the tasks of one read, not one read's each.
    """
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return t["lineitem"].repartition(min(tasks, math.ceil(3 * tasks / inputs)), "l_orderkey")


def lines_as_read(t: Tables) -> DataFrame:
    """Line items where they are read, if that is in twice as many tasks as there are cores; else :func:`lines`.

    Dealing them would only shuffle the whole table once for every job.
    """
    table = t["lineitem"]
    return table if table.rdd.getNumPartitions() >= 2 * t.spark.sparkContext.defaultParallelism else lines(t)


def lines_by_customer(t: Tables) -> DataFrame:
    """Line items dealt by the bucket of their customer, for the queries that write a run of one chunk."""
    bucket = customer_bucket(F.col("l_suppkey").cast("string"))
    return cluster_for_write(t["lineitem"].withColumn("_bucket", bucket), "_bucket").drop("_bucket")


def accounts(t: Tables) -> DataFrame:
    return t["supplier"].selectExpr(
        "s_suppkey as account_id", f"case when {ACTIVE} then '2' else '3' end as status"
    )


def active_lines(t: Tables, *parts: DataFrame) -> list[DataFrame]:
    """Line items of active accounts, what a fetch would return, of each of ``parts``."""
    active = active_accounts(accounts(t)).select(F.col("account_id").alias("l_suppkey"))
    small = fits(active, BROADCAST_ROWS)
    return [bounded_join(lines, active, "l_suppkey", "left_semi", small) for lines in parts]


# Most fields of a wide report are texts of a line's number and quantity alone.
_PAIR = ("l_linenumber", "l_quantity")
_PAIR_FIELDS = 20
_MAX_PAIRS = 20_000


def _of_pair(text: str) -> bool:
    used = set(re.findall(r"\bl_\w+", text))
    return bool(used) and used <= set(_PAIR)


def extract(rows: DataFrame, narrow: DataFrame, spec: ReportSpec, monthly: bool = False) -> DataFrame:
    """Raw extract of line items; ``narrow`` are the same lines, not dealt yet.

    Texts that many lines share are made once for each pair of number and quantity, and every line
    looks its own up.  They stay one array, so that a row copies them as a whole.  Where the pairs
    are too many for a broadcast, each line makes its texts itself.
    """
    texts = raw_texts(spec, monthly)
    shared = [f for f, text in texts.items() if _of_pair(text)]
    pairs = narrow.select(*_PAIR).distinct()
    if len(shared) < _PAIR_FIELDS or not fits(pairs, _MAX_PAIRS):
        return rows.selectExpr(*raw_expressions(spec, monthly))
    made = F.array(*[F.expr(texts[f]) for f in shared]).alias("_shared")
    looked_up = F.broadcast(pairs.select(made, *[F.col(c).alias(f"_{c}") for c in _PAIR]))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _PAIR]
    own = [F.expr(text).alias(f) for f, text in texts.items() if f not in shared]
    both = rows.select(*own, *_PAIR).join(looked_up, same)
    made_of = {f: F.get("_shared", F.lit(i)) for i, f in enumerate(shared)}
    return both.select(*[made_of.get(f, F.col(f)).alias(f) for f in texts])


def _lines_of(t: Tables, spec: ReportSpec) -> DataFrame:
    return lines_as_read(t) if spec.lookups else lines(t)


def raw_all(t: Tables, spec: ReportSpec, monthly: bool = False) -> DataFrame:
    """Extract of every account."""
    return extract(_lines_of(t, spec), t["lineitem"], spec, monthly)


def header_rows(t: Tables, spec: ReportSpec) -> DataFrame:
    return t["region"].selectExpr(*header_expressions(spec))


def raw_batch(
    t: Tables, spec: ReportSpec, headers: bool | None = None, monthly: bool = False, by_customer: bool = False
) -> DataFrame:
    """Extract of the active accounts, with header rows where the report drops them."""
    dealt = lines_by_customer(t) if by_customer else _lines_of(t, spec)
    rows = extract(*active_lines(t, dealt, t["lineitem"]), spec, monthly)
    with_headers = spec.sentinel is not None if headers is None else headers
    return rows.union(header_rows(t, spec)) if with_headers else rows


def location_dims(t: Tables) -> dict[str, DataFrame]:
    return {
        level: t[table].selectExpr(f"{key} as id", f"{name} as cannonicalname")
        for level, (table, key, name) in DIMS.items()
    }


def dims_of(t: Tables, spec: ReportSpec) -> dict[str, DataFrame] | None:
    return location_dims(t) if spec.lookups else None


def mart_history(t: Tables, spec: ReportSpec, monthly: bool = False) -> DataFrame:
    """The published table after an earlier load, when every account was active."""
    return project(raw_all(t, spec, monthly), spec, RUN_DATE, dims_of(t, spec))


# A line's tax is a whole percentage from 0 to 8: nine slices that cover the table.
def slice_condition(k: int) -> str:
    return f"l_tax >= {k - 0.5} / 100 and l_tax < {k + 0.5} / 100"


def slice_history(t: Tables, spec: ReportSpec, k: int, inputs: int = 1) -> DataFrame:
    """Published rows of one criteria slice, one of ``inputs`` that are read side by side."""
    rows = lines(t, inputs).where(slice_condition(k)).selectExpr(*raw_expressions(spec))
    return project(rows, spec, RUN_DATE)
