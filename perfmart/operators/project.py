"""Typed projection of a raw extract, driven by a report spec."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from perfmart.functions.casts import CASTS, MISSING
from perfmart.operators.lookup import lookup_names
from perfmart.plans.columns import LOCATION_FIELDS, LOCATION_PREFIX_LENGTH
from perfmart.plans.reports import ReportSpec, TypedCriteria


#: Kinds of columns that no cast fills.
UNCAST = ("string", "criteria", "lookup")


def criteria_text(criteria: str | TypedCriteria) -> Column:
    """The criteria column: a raw field, or one chosen by the criterion type."""
    if isinstance(criteria, str):
        return F.col(criteria)
    kind = F.col(criteria.type_field)
    (first_type, first_field), *others = criteria.choices
    text = F.when(kind == first_type, F.col(first_field))
    for criterion_type, raw_field in others:
        text = text.when(kind == criterion_type, F.col(raw_field))
    return text.otherwise(criteria.otherwise)


def location_keys() -> dict[str, Column]:
    """Key of each location level, as text."""
    keys = {}
    for level, raw_field in LOCATION_FIELDS.items():
        if level == "country":
            keys[level] = F.col(raw_field)
        else:
            keys[level] = F.substr(F.col(raw_field), F.lit(LOCATION_PREFIX_LENGTH + 1))
    return keys


def drop_header_rows(raw: DataFrame, sentinel: str | None) -> DataFrame:
    """Drop rows whose sentinel column holds its own name, and rows where it is NULL."""
    return raw if sentinel is None else raw.where(F.col(sentinel) != sentinel)


def project(
    raw: DataFrame,
    spec: ReportSpec,
    run_date: str | None = None,
    dims: dict[str, DataFrame] | None = None,
    broadcast_dims: Mapping[str, bool] | bool | None = None,
    lost: Observation | None = None,
) -> DataFrame:
    """Rows of one run, typed and renamed as the report publishes them.

    ``raw`` may hold many runs; ``run_date`` picks one of its partitions.  A
    report with location columns needs ``dims``, one dimension per level.
    With ``lost`` the action that reads the rows also counts, by column, the texts that
    a cast turned to NULL.
    """
    rows = raw if run_date is None else raw.where(F.col("data_date") == run_date)
    rows = drop_header_rows(rows, spec.sentinel)
    typed = [_output(c, spec).alias(c.name) for c in spec.columns if c.kind != "lookup"]
    cast = [] if lost is None else [c for c in spec.columns if c.kind not in UNCAST]
    beside = [*typed, *[F.col(c.raw).alias(f"_raw_{c.name}") for c in cast]]
    if spec.lookups:
        keys = {c.raw: location_keys()[c.raw] for c in spec.lookups}
        named = lookup_names(rows, dims, keys, broadcast_dims, keep=beside)
        rows = named.withColumnsRenamed({f"{c.raw}_name": c.name for c in spec.lookups})
    else:
        rows = rows.select(*beside)
    if lost is not None:
        counts = [F.count_if(is_lost(F.col(f"_raw_{c.name}"), F.col(c.name))).alias(c.name) for c in cast]
        rows = rows.observe(lost, *counts)
    return rows.select(*spec.names)


def is_lost(raw: Column, typed: Column) -> Column:
    """Whether a text that is not missing became NULL."""
    return raw.isNotNull() & (raw != MISSING) & typed.isNull()


def _output(column, spec: ReportSpec) -> Column:
    if column.kind == "criteria":
        return criteria_text(spec.criteria)
    return CASTS[column.kind](F.col(column.raw))
