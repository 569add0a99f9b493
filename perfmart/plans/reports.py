"""Report specifications: what each report reads, types, filters and emits."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from perfmart.functions.casts import SPARK_TYPES
from perfmart.plans import columns as tables


@dataclass(frozen=True)
class Column:
    """One output column: its name, the raw field it comes from and its type."""

    name: str
    raw: str
    kind: str


@dataclass(frozen=True)
class TypedCriteria:
    """Criteria text chosen by the criterion type; ``'--'`` for any other type."""

    type_field: str
    choices: tuple[tuple[str, str], ...]  # (criterion type, raw field)
    otherwise: str = "--"


@dataclass(frozen=True)
class Window:
    """How a report's window is fetched: tasks x chunks per task x days per task."""

    tasks: int
    chunks: int
    days: int


@dataclass(frozen=True)
class ReportSpec:
    """A report.

    ``criteria`` is a raw field or a :class:`TypedCriteria` and fills the column
    of kind ``criteria``.  ``sentinel`` is the raw field whose header rows are
    dropped.  ``statuses`` are the raw status fields the source restricts.
    """

    name: str
    columns: tuple[Column, ...]
    sentinel: str | None
    account: str = "external_customer_id"
    account_raw: str = "customer_id"
    criteria: str | TypedCriteria | None = None
    statuses: tuple[str, ...] = ()
    daily: Window = Window(1, 1, 30)
    monthly: Window = Window(1, 1, 90)
    run_lag_days: int = 0
    check_dates: bool = True
    backfill_drops: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def lookups(self) -> list[Column]:
        return [c for c in self.columns if c.kind == "lookup"]

    @property
    def raw_fields(self) -> list[str]:
        """Raw fields read by the report, in order of first use."""
        fields: list[str] = []
        for c in self.columns:
            if c.kind == "criteria":
                if isinstance(self.criteria, TypedCriteria):
                    fields += [self.criteria.type_field, *(f for _, f in self.criteria.choices)]
                else:
                    fields.append(self.criteria)
            elif c.kind != "lookup":
                fields.append(c.raw)
        return list(dict.fromkeys(fields))

    @property
    def schema(self) -> T.StructType:
        """Schema of the published table, partition column last."""
        ddl = ", ".join(f"{c.name} {SPARK_TYPES[c.kind]}" for c in self.columns)
        return T.StructType.fromDDL(ddl)

    @property
    def raw_schema(self) -> T.StructType:
        """Schema of the raw extract: text only, plus the run-date partition."""
        return T.StructType([T.StructField(f, T.StringType()) for f in [*self.raw_fields, "data_date"]])

    def backfill(self) -> ReportSpec:
        """The same report as the backfill writes it.

        A backfill is fetched in one task and one chunk whatever the daily feed's split,
        and its dates are always checked.
        """
        kept = tuple(c for c in self.columns if c.name not in self.backfill_drops)
        return replace(
            self,
            columns=kept,
            backfill_drops=(),
            daily=Window(1, 1, 30),
            monthly=Window(1, 1, 90),
            check_dates=True,
        )


def _columns(text: str) -> tuple[Column, ...]:
    return tuple(Column(*line.split()) for line in text.strip().splitlines())


def _insert_after(cols: tuple[Column, ...], name: str, extra: str) -> tuple[Column, ...]:
    at = [c.name for c in cols].index(name) + 1
    return cols[:at] + _columns(extra) + cols[at:]


CRITERIA = _columns(tables.CRITERIA)
CRITERIA_WIDE = _insert_after(CRITERIA, "approval_status", tables.CRITERIA_WIDE_EXTRA)
CRITERIA_CONV = _columns(tables.CRITERIA_CONV)

_CRITERION_STATUSES = ("campaign_status", "ad_group_criterion_status", "ad_group_status")
_AD_STATUSES = ("campaign_status", "ad_group_status", "ad_group_ad_status")

AUDIENCE = TypedCriteria("ad_group_criterion_type_", tables.AUDIENCE_CHOICES)
PLACEMENT = TypedCriteria("ad_group_criterion_type_", tables.PLACEMENT_CHOICES)


def _performance(name: str, criteria: str | TypedCriteria, cols=CRITERIA, **kw) -> ReportSpec:
    return ReportSpec(
        name, cols, "ad_group_name", criteria=criteria, statuses=_CRITERION_STATUSES, **kw
    )


def _conversions(name: str, **kw) -> ReportSpec:
    return ReportSpec(
        f"{name}_conv",
        CRITERIA_CONV,
        "segments_ad_network_type",
        statuses=_CRITERION_STATUSES,
        **kw,
    )


_SPLIT = {"daily": Window(1, 2, 30), "monthly": Window(3, 2, 30)}

# The slices of the consolidated tables, in the order they are combined.
PERFORMANCE_SLICES: dict[str, ReportSpec] = {
    s.name: s
    for s in (
        _performance("age", "ad_group_criterion_age_range_type_", **_SPLIT),
        _performance("gender", "ad_group_criterion_gender_type_", **_SPLIT),
        _performance("user", AUDIENCE),
        _performance("topic", "ad_group_criterion_topic_path", check_dates=False),
        _performance("webpage", "ad_group_criterion_webpage_criterion_name", CRITERIA_WIDE),
        _performance("keyword_criteria", "ad_group_criterion_keyword_text", CRITERIA_WIDE, **_SPLIT),
        _performance(
            "parent", "ad_group_criterion_parental_status_type_", monthly=Window(2, 1, 45)
        ),
        _performance("income", "ad_group_criterion_income_range_type_", **_SPLIT),
        _performance("placement", PLACEMENT, check_dates=False),
    )
}

CONVERSION_SLICES: dict[str, ReportSpec] = {
    s.name: s
    for s in (
        _conversions("age", monthly=Window(1, 3, 90)),
        _conversions("gender"),
        _conversions("user"),
        _conversions("topic", check_dates=False),
        _conversions("webpage"),
        _conversions("keyword_criteria"),
        _conversions("parent"),
        _conversions("income"),
        _conversions("placement", check_dates=False),
    )
}

OTHER_REPORTS: dict[str, ReportSpec] = {
    s.name: s
    for s in (
        ReportSpec(
            "ad_conv",
            _columns(tables.AD_CONV),
            "segments_ad_network_type",
            statuses=_AD_STATUSES,
            # The backfilled table never had the account column.
            backfill_drops=("external_customer_id",),
        ),
        ReportSpec(
            "campaign",
            _columns(tables.CAMPAIGN),
            "customer_currency_code",
            statuses=("campaign_status",),
        ),
        ReportSpec(
            "ads",
            _columns(tables.ADS),
            "customer_descriptive_name",
            statuses=_AD_STATUSES,
            daily=Window(1, 3, 30),
            monthly=Window(3, 3, 30),
        ),
        ReportSpec(
            "keyword",
            _columns(tables.KEYWORD),
            "ad_group_criterion_keyword_text",
            daily=Window(3, 1, 10),
            monthly=Window(3, 2, 30),
        ),
        ReportSpec(
            "geo",
            _columns(tables.GEO),
            "customer_currency_code",
            daily=Window(3, 2, 10),
            monthly=Window(6, 3, 15),
        ),
        ReportSpec(
            "search_query",
            _columns(tables.SEARCH_QUERY),
            None,
            daily=Window(3, 2, 10),
            monthly=Window(6, 3, 15),
        ),
        ReportSpec(
            "keywordless",
            _columns(tables.KEYWORDLESS),
            None,
            account="customer_id",
            monthly=Window(2, 1, 45),
        ),
        ReportSpec(
            "paid_organic",
            _columns(tables.PAID_ORGANIC),
            None,
            daily=Window(15, 2, 2),
            monthly=Window(30, 3, 3),
            run_lag_days=2,
        ),
    )
}

REPORTS: dict[str, ReportSpec] = {**PERFORMANCE_SLICES, **CONVERSION_SLICES, **OTHER_REPORTS}

# Backfill variants.  Two of them repeat another report's backfill under a second name.
BACKFILLS: dict[str, ReportSpec] = {
    **{name: spec.backfill() for name, spec in REPORTS.items()},
    "ads_ad_hoc": REPORTS["ads"].backfill(),
    "paid_organic_temp": REPORTS["paid_organic"].backfill(),
}
