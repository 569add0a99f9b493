"""A part of the catalogue against DuckDB; ``checks.compare`` runs all of it."""

import pytest

from checks.compare import differences, oracle_connection
from checks.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "report_age", "report_user_conv", "report_keywordless", "backfill_ad_conv",
    "case_criteria_placement", "geo_lookup_inner5", "carry_forward_absent",
    "carry_forward_inclusive_start", "carry_forward_empty_batch", "merge_union_distinct",
    "consolidate_criteria_conv", "flatten_records", "decode_enums", "stringify_raw", "date_chunks",
    "missing_dates_by_chunk", "deactivated_accounts_by_feed", "self_read_overwrite",
    "insert_into_overwrite", "clear_run_partition",
]


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    assert differences(spark, oracle, FOLDER, name) is None


def test_carried_and_fresh_accounts_are_apart(spark):
    from checks.queries import CONV
    from checks.views import RUN_DATE, Tables, raw_batch
    from perfmart.operators.project import project

    t = Tables(spark, FOLDER)
    fresh = project(raw_batch(t, CONV), CONV, RUN_DATE).select("external_customer_id").distinct()
    carried = QUERIES["carry_forward_absent"](spark, FOLDER).select("external_customer_id").distinct()
    assert carried.count() > 0
    assert fresh.join(carried, "external_customer_id").count() == 0
