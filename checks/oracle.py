"""The same queries as plain SQL for DuckDB."""

from __future__ import annotations

from checks.views import (
    ACTIVE,
    DIMS,
    RUN_DATE,
    START,
    header_expressions,
    raw_expressions,
    slice_condition,
)
from perfmart.plans.columns import LOCATION_FIELDS
from perfmart.plans.reports import ReportSpec, TypedCriteria

_TYPED = {
    "string": "{x}",
    "bigint": "TRY_CAST({x} AS BIGINT)",
    "int": "TRY_CAST({x} AS INTEGER)",
    "double": "TRY_CAST({x} AS DOUBLE)",
    "decimal": "TRY_CAST({x} AS DECIMAL(30,6))",
    "date": "TRY_CAST({x} AS DATE)",
    "currency": "TRY_CAST({x} AS DOUBLE) / 1000000",
}

IS_ACTIVE = f"l_suppkey IN (SELECT s_suppkey FROM supplier WHERE {ACTIVE})"


def criteria(spec: ReportSpec) -> str:
    c = spec.criteria
    if not isinstance(c, TypedCriteria):
        return c
    whens = " ".join(f"WHEN '{kind}' THEN {raw}" for kind, raw in c.choices)
    return f"CASE {c.type_field} {whens} ELSE '{c.otherwise}' END"


def typed(spec: ReportSpec) -> str:
    """Select list of the typed projection."""
    out = []
    for c in spec.columns:
        if c.kind == "criteria":
            text = criteria(spec)
        elif c.kind == "lookup":
            text = f"{c.raw}.{DIMS[c.raw][2]}"
        else:
            text = _TYPED[c.kind].format(x=f"raw.{c.raw}")
        out.append(f"{text} AS {c.name}")
    return ", ".join(out)


def _lookups(spec: ReportSpec) -> str:
    joins = []
    for c in spec.lookups:
        table, key, _ = DIMS[c.raw]
        field = LOCATION_FIELDS[c.raw]
        text = f"raw.{field}" if c.raw == "country" else f"substr(raw.{field}, 20)"
        joins.append(f"JOIN {table} AS {c.raw} ON TRY_CAST({text} AS BIGINT) = {c.raw}.{key}")
    return " ".join(joins)


def raw(spec: ReportSpec, where: str, monthly: bool = False, headers: bool = False) -> str:
    body = f"SELECT {', '.join(raw_expressions(spec, monthly))} FROM lineitem WHERE {where}"
    if headers:
        body += f" UNION ALL SELECT {', '.join(header_expressions(spec))} FROM region"
    return body


def projected(spec: ReportSpec, source: str) -> str:
    """Typed rows of a raw extract given as SQL."""
    keep = "TRUE" if spec.sentinel is None else f"raw.{spec.sentinel} <> '{spec.sentinel}'"
    return f"SELECT {typed(spec)} FROM ({source}) AS raw {_lookups(spec)} WHERE {keep}"


def fresh(spec: ReportSpec, headers: bool | None = None, monthly: bool = False) -> str:
    with_headers = spec.sentinel is not None if headers is None else headers
    return projected(spec, raw(spec, IS_ACTIVE, monthly, with_headers))


def history(spec: ReportSpec, monthly: bool = False) -> str:
    return projected(spec, raw(spec, "TRUE", monthly))


def carried(spec: ReportSpec, start: str = START, end: str = RUN_DATE) -> str:
    """Needs ``fresh`` and ``mart`` in scope."""
    return (
        f"SELECT * FROM mart WHERE data_date BETWEEN '{start}' AND '{end}' "
        f"AND {spec.account} NOT IN (SELECT {spec.account} FROM fresh)"
    )


def report(spec: ReportSpec) -> str:
    return (
        f"WITH fresh AS ({fresh(spec)}), mart AS ({history(spec)}) "
        f"SELECT * FROM fresh UNION {carried(spec)}"
    )


def backfill(spec: ReportSpec) -> str:
    return fresh(spec)


def consolidated(slices: dict[str, ReportSpec], start: str = START, end: str = RUN_DATE) -> str:
    parts = []
    for k, spec in enumerate(slices.values()):
        rows = projected(spec, raw(spec, slice_condition(k)))
        parts.append(f"SELECT * FROM ({rows}) WHERE data_date BETWEEN '{start}' AND '{end}'")
    return " UNION ALL BY NAME ".join(parts)

