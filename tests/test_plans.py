"""Plans of a daily load on stored tables."""

import re

import pytest
from pyspark.sql import Observation

from perfmart.operators.carry import carry_forward, merge_clustered, profile_keys
from perfmart.operators.project import project
from perfmart.operators.records import decode_enums, flatten_records, record_filter
from perfmart.plans import jobs
from perfmart.plans.jobs import Store, run_report
from perfmart.plans.reports import REPORTS
from perfmart.sources import tables
from perfmart.sources.raw import read_mart, read_raw, read_records
from test_jobs import RUN, day, put_run

SPEC = REPORTS["age_conv"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    store = Store(raw=f"{root}/raw", mart=f"{root}/mart", backfill=f"{root}/backfill")
    put_run(spark, SPEC, store, RUN, day(RUN, "1"))
    raw = read_raw(spark, SPEC, store.raw_path(SPEC), RUN)
    tables.overwrite_partitions(project(raw, SPEC), store.mart_path(SPEC))
    return raw, read_mart(spark, SPEC, store.mart_path(SPEC))


def test_daily_load_prunes_partitions_and_shuffles_rows_once(stored):
    raw, mart = stored
    text = plan(run_report(raw, mart, SPEC, RUN))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert len(filters) == 2 and all("data_date" in f for f in filters)
    assert text.count("Exchange hashpartitioning(ad_network_type") == 1
    assert "Scan ExistingRDD" in text  # the accounts, kept from the job that counted them
    assert "LeftAnti" in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_merge_and_write_share_one_shuffle_and_the_keys_are_held(stored):
    raw, mart = stored
    fresh = project(raw, SPEC, RUN)
    profile = profile_keys(fresh, SPEC.account, hold=True)
    try:
        carried = carry_forward(fresh, mart, SPEC.account, RUN, RUN, profile)
        text = plan(merge_clustered(fresh, carried, "data_date", {"2020-01-30": 30_000_000, RUN: 5}))
    finally:
        profile.release()
    # Below the relation is the one job of the keys; above it all that is left of the load.
    load, held, _ = text.partition("InMemoryRelation")
    assert held and load.count("FileScan") == 2
    assert len(re.findall(r"Exchange \w+\(.*_task", load)) == 1
    assert re.findall(r"(\w*Exchange) ", load) == ["Exchange", "BroadcastExchange"]


def test_key_profile_reads_only_the_key_and_the_sentinel(stored):
    raw, _ = stored
    text = plan(project(raw, SPEC, RUN).select(SPEC.account).distinct())
    assert "ReadSchema: struct<segments_ad_network_type:string,customer_id:string>" in text


def test_conditions_on_nested_records_reach_the_scan(spark, tmp_path):
    made = spark.range(3).selectExpr(
        "struct(cast(id as int) as status, id, 'x' as name) as campaign", f"struct('{RUN}' as date, id as device) as segments"
    )
    made.write.parquet(str(tmp_path / "records"))
    stored = read_records(spark, made.schema, str(tmp_path / "records"), "parquet")
    kept = flatten_records(record_filter(stored, REPORTS["campaign"], RUN, 30, (2, 3, 4)), ["campaign.id"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # or the plan's text is cut
    try:
        text = plan(kept)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "campaign.status" in pushed and "segments.date" in pushed
    assert "ReadSchema: struct<campaign:struct<status:int,id:bigint>,segments:struct<date:string>>" in text
    assert kept.count() == 1


def test_writes_are_rebalanced_by_date(stored):
    _, mart = stored
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(tables.cluster_for_write(mart))


def test_counts_of_a_fetch_and_a_load_take_no_scan_of_their_own(spark, stored, tmp_path):
    made = spark.range(3).selectExpr(
        "struct(cast(id as int) as status, id) as campaign", f"struct('{RUN}' as date, id as device) as segments", "cast(null as string) as _bad_record"
    )
    made.write.parquet(str(tmp_path / "records"))
    records = read_records(spark, made.schema, str(tmp_path / "records"), "parquet")
    decode = lambda df, fields: decode_enums(df, {"CampaignStatusEnum": {2: "ENABLED"}}, {"campaign_status": "CampaignStatusEnum"})
    placed, _ = jobs._extract(records, REPORTS["campaign"], decode, RUN, REPORTS["campaign"].daily, None)
    text = plan(placed)
    # Broken records, codes without a name, and rows with their dates.
    assert text.count("FileScan") == 1 and text.count("CollectMetrics") == 3
    raw, _ = stored
    text = plan(project(raw, SPEC, RUN, lost=Observation()))
    assert text.count("FileScan") == 1 and text.count("CollectMetrics") == 1


def test_slices_of_a_consolidation_share_the_tasks(spark):
    from checks.queries import QUERIES

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        text = plan(QUERIES["consolidate_criteria_conv"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    dealt = [int(n) for n in re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L?, (\d+)\)", text)]
    assert dealt == [10] * 9
