import pytest

from perfmart.operators.windows import chunk_days, lookback_of
from perfmart.plans.columns import ENUM_FIELDS, FETCHED_FIELDS, raw_name
from perfmart.plans.reports import BACKFILLS, CONVERSION_SLICES, PERFORMANCE_SLICES, REPORTS, Window

WIDTHS = {
    "ad_conv": 10, "ads": 85, "campaign": 108, "geo": 55, "keyword": 83, "keywordless": 33,
    "paid_organic": 31, "search_query": 49,
    **{name: 40 if name in ("webpage", "keyword_criteria") else 38 for name in PERFORMANCE_SLICES},
    **{name: 11 for name in CONVERSION_SLICES},
}


def test_there_are_26_reports_and_28_backfills():
    assert len(REPORTS) == 26 and len(BACKFILLS) == 28
    assert len(PERFORMANCE_SLICES) == len(CONVERSION_SLICES) == 9


@pytest.mark.parametrize("name", REPORTS)
def test_columns(spark, name):
    spec = REPORTS[name]
    assert len(spec.columns) == WIDTHS[name]
    assert len(set(spec.names)) == len(spec.names)
    assert spec.names[-1] == "data_date" and spec.schema["data_date"].dataType.typeName() == "string"
    assert spec.account in spec.names
    assert spec.sentinel is None or spec.sentinel in spec.raw_fields


@pytest.mark.parametrize("name", REPORTS)
def test_windows_cover_the_lookback_and_divide_evenly(name):
    spec = REPORTS[name]
    for window, lookback in ((spec.daily, 30), (spec.monthly, 90)):
        assert lookback_of(window) == lookback
        assert chunk_days(lookback, window.tasks, window.chunks) > 0


def test_type_differences_between_reports():
    kind = {(s.name, c.name): c.kind for s in REPORTS.values() for c in s.columns}
    assert kind["age", "cost"] == "currency" and kind["keywordless", "cost"] == "bigint"
    assert kind["search_query", "cost_micros"] == "bigint"
    assert kind["campaign", "average_cpm"] == "decimal" and kind["search_query", "average_cpm"] == "double"
    assert kind["age", "quality_score"] == "bigint" and kind["keyword", "quality_score"] == "int"
    assert kind["geo", "video_views"] == "bigint" and kind["campaign", "video_views"] == "int"


def test_backfilled_ad_conversions_lack_the_account():
    assert "external_customer_id" not in BACKFILLS["ad_conv"].names
    assert len(BACKFILLS["ad_conv"].columns) == 9
    assert BACKFILLS["ads_ad_hoc"].columns == REPORTS["ads"].columns


def test_skipped_checks_and_enums():
    assert {s.name for s in REPORTS.values() if not s.check_dates} == {
        "topic", "placement", "topic_conv", "placement_conv"
    }
    assert len(ENUM_FIELDS) == 32 and len(set(ENUM_FIELDS.values())) == 28


def test_raw_fields_are_fetched():
    assert len(FETCHED_FIELDS) == 200
    for spec in [*REPORTS.values(), *BACKFILLS.values()]:
        assert set(spec.raw_fields) | set(spec.statuses) <= FETCHED_FIELDS, spec.name
    assert {raw_name(f) for f in ENUM_FIELDS} <= FETCHED_FIELDS
    assert "campaign_nmae" not in FETCHED_FIELDS and "ad_group_criterion_type_" in FETCHED_FIELDS
    assert REPORTS["topic"].criteria == "ad_group_criterion_topic_path"


def test_backfills_are_fetched_in_one_piece_and_checked():
    for spec in BACKFILLS.values():
        assert (spec.daily, spec.monthly, spec.check_dates) == (Window(1, 1, 30), Window(1, 1, 90), True)
