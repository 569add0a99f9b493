"""Writers and jobs on stored tables."""

import datetime as dt
import pathlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from perfmart.operators import quality
from perfmart.operators.carry import merge_clustered, repeated_hashes, write_tasks
from perfmart.operators.records import decode_enums
from perfmart.plans import jobs
from perfmart.plans.columns import ENUM_FIELDS
from perfmart.plans.reports import BACKFILLS, CONVERSION_SLICES, REPORTS, Window
from perfmart.sources import tables
from perfmart.sources.raw import BAD_RECORD, read_mart, read_raw, read_records
from test_operators import raw_rows

RUN = "2020-01-31"
CONV = replace(REPORTS["age_conv"], check_dates=False)


@pytest.fixture
def store(tmp_path):
    return jobs.Store(raw=f"{tmp_path}/raw", mart=f"{tmp_path}/mart", backfill=f"{tmp_path}/backfill")


def put_run(spark, spec, store, run_date, *changes):
    raw = raw_rows(spark, spec, *changes).withColumn("chunk", F.lit("0-0"))
    tables.write_run(raw, store.raw_path(spec), run_date)


def day(date, account, **more):
    return {"segments_date": date, "customer_id": account, **more}


def published(spark, spec, store):
    return rows(read_mart(spark, spec, store.mart_path(spec)), "external_customer_id", "data_date")


def test_overwrite_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02")], "v int, data_date string")
    tables.overwrite_partitions(first, path)
    tables.overwrite_partitions(first.where("v = 2").withColumn("v", F.lit(9)), path, cluster=False)
    stored = spark.read.schema("v int, data_date string").parquet(path)
    assert rows(stored) == [(1, "2020-01-01"), (9, "2020-01-02")]
    assert spark.read.parquet(path).schema["data_date"].dataType.typeName() == "date"


def test_catalog_writes_restore_the_session_mode(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    first = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02")], "v int, data_date string")
    tables.overwrite_table(first, "catalog_t", str(tmp_path / "t"))
    tables.overwrite_table(first.where("v = 2").withColumn("v", F.lit(9)), "catalog_t", str(tmp_path / "t"))
    assert rows(spark.table("catalog_t")) == [(1, "2020-01-01"), (9, "2020-01-02")]
    tables.insert_partitions(first.where("v = 1").withColumn("v", F.lit(5)), "catalog_t")
    assert rows(spark.table("catalog_t")) == [(5, "2020-01-01"), (9, "2020-01-02")]
    with pytest.raises(ValueError):
        tables.insert_partitions(first.select("data_date", "v"), "catalog_t")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    tables.add_partition(spark, "catalog_t", "2020-01-03")
    tables.add_partition(spark, "catalog_t", "2020-01-03")
    assert spark.sql("SHOW PARTITIONS catalog_t").count() == 3
    late = first.where("v = 1").withColumn("data_date", F.lit("2020-01-04"))
    tables.overwrite_partitions(late, str(tmp_path / "t"))
    assert (1, "2020-01-04") not in rows(spark.table("catalog_t"))
    tables.recover_partitions(spark, "catalog_t")
    assert (1, "2020-01-04") in rows(spark.table("catalog_t"))
    spark.sql("DROP TABLE catalog_t")


def test_raw_runs_and_chunks(spark, store):
    path = store.raw_path(CONV)
    put_run(spark, CONV, store, RUN, day(RUN, "1"), day(RUN, "2"))
    put_run(spark, CONV, store, "2020-01-30", day("2020-01-30", "3"))
    tables.write_chunk(raw_rows(spark, CONV, day(RUN, "8")), path, RUN, "1-0")
    tables.write_chunk(raw_rows(spark, CONV, day(RUN, "9")), path, RUN, "1-0")
    assert rows(read_raw(spark, CONV, path, RUN), "customer_id") == [("1",), ("2",), ("9",)]
    put_run(spark, CONV, store, RUN, day(RUN, "5"))
    assert rows(read_raw(spark, CONV, path, RUN), "customer_id", "data_date") == [("5", RUN)]
    tables.clear_run(spark, CONV.raw_schema, path, RUN)
    assert read_raw(spark, CONV, path, RUN).count() == 0
    assert read_raw(spark, CONV, path, "2020-01-30").count() == 1
    assert read_raw(spark, CONV, path, "2019-01-01").count() == 0
    assert read_raw(spark, CONV, path + "-none", RUN).count() == 0


def test_daily_load_carries_merges_and_is_idempotent(spark, store):
    put_run(spark, CONV, store, RUN, day(RUN, "1"), day(RUN, "2"), day("2019-12-31", "2"))
    jobs.load_report(spark, CONV, store, RUN)
    assert published(spark, CONV, store) == [(1, RUN), (2, "2019-12-31"), (2, RUN)]
    # The next run lacks account 2 and holds one row twice.
    put_run(spark, CONV, store, "2020-02-01", day(RUN, "1"), day(RUN, "1"), day("2020-02-01", "1"))
    for many_copies in (False, True, False):
        jobs.load_report(spark, CONV, store, "2020-02-01", many_copies=many_copies)
        assert published(spark, CONV, store) == [
            (1, RUN), (1, "2020-02-01"), (2, "2019-12-31"), (2, RUN)
        ]


def test_longer_window_loses_fresh_rows_of_its_first_day(spark, store):
    edge = "2020-01-01"  # run date less the lookback of 30
    put_run(spark, CONV, store, edge, day(edge, "1"), day(edge, "2"))
    first = read_raw(spark, CONV, store.raw_path(CONV), edge)
    history = jobs.run_report(first, read_mart(spark, CONV, store.mart_path(CONV)), CONV, edge)
    tables.overwrite_partitions(history, store.mart_path(CONV))
    put_run(spark, CONV, store, RUN, day(RUN, "1"))
    jobs.load_report(spark, CONV, store, RUN)
    assert published(spark, CONV, store) == [(1, edge), (1, RUN), (2, edge)]
    jobs.load_report(spark, CONV, store, RUN, inclusive_start=True)
    assert published(spark, CONV, store) == [(1, RUN), (2, edge)]


def test_null_account_is_refused(spark, store):
    put_run(spark, CONV, store, RUN, day(RUN, "1"), day(RUN, "None"))
    with pytest.raises(jobs.IncompleteData, match="without an account"):
        jobs.load_report(spark, CONV, store, RUN)
    jobs.load_report(spark, CONV, store, RUN, guard_null_keys=False)
    assert published(spark, CONV, store) == [(1, RUN), (None, RUN)]


def test_empty_run_writes_nothing(spark, store):
    put_run(spark, CONV, store, RUN, day(RUN, "1"))
    jobs.load_backfill(spark, "age_conv", store, RUN, lookback=1)
    empty = read_mart(spark, CONV, store.backfill_path(CONV)).where("FALSE")
    tables.overwrite_partitions(empty, store.backfill_path(CONV))
    tables.overwrite_partitions(empty, store.mart_path(CONV))
    assert read_mart(spark, CONV, store.backfill_path(CONV)).count() == 1
    assert published(spark, CONV, store) == []


def test_missing_dates_block_the_load(spark, store):
    spec = REPORTS["age_conv"]
    put_run(spark, spec, store, RUN, day(RUN, "1"), day("2020-01-29", "1"))
    with pytest.raises(jobs.IncompleteData, match="2020-01-30"):
        jobs.load_report(spark, spec, store, RUN, lookback=3)
    put_run(spark, spec, store, RUN, *[day(d, "1") for d in (RUN, "2020-01-30", "2020-01-29")])
    jobs.load_report(spark, spec, store, RUN, lookback=3)
    assert len(published(spark, spec, store)) == 3


def test_backfill_keeps_copies_and_carries_nothing(spark, store):
    put_run(spark, CONV, store, RUN, day(RUN, "1"), day(RUN, "1"))
    jobs.load_backfill(spark, "age_conv", store, RUN, lookback=1)
    stored = read_mart(spark, CONV, store.backfill_path(CONV))
    assert rows(stored, "external_customer_id", "data_date") == [(1, RUN), (1, RUN)]


def test_consolidation_waits_for_all_inputs(spark, store, tmp_path):
    for i, spec in enumerate(CONVERSION_SLICES.values()):
        if i == 8:
            with pytest.raises(jobs.IncompleteData, match=spec.name):
                jobs.consolidate_conversions(spark, store, "wide_t", str(tmp_path / "wide"), RUN)
        put_run(spark, spec, store, RUN, day(RUN, str(i)), day("2019-01-01", "1"))
        raw = read_raw(spark, spec, store.raw_path(spec), RUN)
        mart = read_mart(spark, spec, store.mart_path(spec))
        tables.overwrite_partitions(jobs.run_report(raw, mart, spec, RUN), store.mart_path(spec))
    jobs.consolidate_conversions(spark, store, "wide_t", str(tmp_path / "wide"), RUN)
    assert rows(spark.table("wide_t"), "external_customer_id", "data_date") == [(i, RUN) for i in range(9)]
    spark.sql("DROP TABLE wide_t")


def test_ingest_records(spark, store):
    spec = REPORTS["age_conv"]
    days = spark.range(40).select(F.date_sub(F.lit(RUN).cast("date"), F.col("id").cast("int")).alias("d"), "id")
    status = F.struct(F.when(F.col("id") == 3, 1).otherwise(2).alias("status"), F.lit(5).alias("id"))
    nested = days.select(
        status.alias("campaign"),
        status.alias("ad_group"),
        F.struct(F.lit(2).alias("status"), F.lit(7).alias("criterion_id")).alias("ad_group_criterion"),
        F.struct(F.col("d").cast("string").alias("date"), F.lit(4).alias("device")).alias("segments"),
        F.struct(F.lit(1).alias("id")).alias("customer"),
        F.struct(F.lit(2.0).alias("conversions")).alias("metrics"),
    )
    names = {enum: {1: "UNKNOWN", 2: "ENABLED", 4: "TABLET"} for enum in ENUM_FIELDS.values()}
    decode = lambda df, fields: decode_enums(df, names, fields)
    jobs.ingest(nested, spec, decode, store.raw_path(spec), RUN)
    raw = read_raw(spark, spec, store.raw_path(spec), RUN)
    assert raw.count() == 29  # 30 dates, one of them of an unknown status
    by_code = store.raw_path(spec) + "-by-code"
    jobs.ingest(nested, spec, decode, by_code, RUN, reported=(2, 3, 4))
    assert rows(read_raw(spark, spec, by_code, RUN)) == rows(raw)
    [row] = raw.where(F.col("segments_date") == RUN).collect()
    assert (row["segments_device"], row["metrics_conversions"], row["ad_group_criterion_type_"]) == (
        "TABLET", "2.0", "None"
    )
    jobs.load_report(spark, replace(spec, check_dates=False), store, RUN)
    assert min(d for _, d in published(spark, spec, store)) == "2020-01-02"
    assert dt.date.fromisoformat(RUN) - dt.date(2020, 1, 2) == dt.timedelta(29)


def test_topic_path_arrives_in_the_criteria(spark, store):
    spec = REPORTS["topic"]
    nested = spark.createDataFrame([(RUN, ["a", "b"], 2, "g")], "day string, path array<string>, status int, name string").selectExpr(
        "struct(status, 5 as id) as campaign",
        "struct(status, 5 as id, name) as ad_group",
        "struct(status, 7 as criterion_id, struct(path) as topic) as ad_group_criterion",
        "struct(day as date) as segments",
        "struct(1 as id) as customer",
    )
    names = {enum: {2: "ENABLED"} for enum in ENUM_FIELDS.values()}
    jobs.ingest(nested, spec, lambda df, fields: decode_enums(df, names, fields), store.raw_path(spec), RUN)
    raw = read_raw(spark, spec, store.raw_path(spec), RUN)
    assert rows(jobs.backfill_report(raw, spec, RUN), "criteria") == [('["a","b"]',)]
    with pytest.raises(ValueError, match="topic_path"):
        jobs.ingest(nested, replace(spec, criteria="topic_path"), None, store.raw_path(spec), RUN)


def test_backfill_waits_for_all_dates(spark, store):
    spec = BACKFILLS["topic_conv"]
    put_run(spark, spec, store, RUN, day(RUN, "1"), day("2020-01-29", "1"))
    with pytest.raises(jobs.IncompleteData, match="2020-01-30"):
        jobs.load_backfill(spark, "topic_conv", store, RUN, lookback=3)
    jobs.load_backfill(spark, "topic_conv", store, RUN, lookback=1)


def test_scheduled_load_takes_lag_and_window_from_the_spec(spark, store):
    spec = replace(CONV, run_lag_days=2, monthly=Window(2, 1, 2), check_dates=True)
    put_run(spark, spec, store, "2020-01-31", *[day(f"2020-01-{d}", "1") for d in (28, 29, 31)])
    with pytest.raises(jobs.IncompleteData, match=r"2020-01-30 \(0-0\)"):
        jobs.load_scheduled(spark, spec, store, "2020-02-02", monthly=True)
    put_run(spark, spec, store, "2020-01-31", *[day(f"2020-01-{d}", "1") for d in (28, 29, 30, 31)])
    jobs.load_scheduled(spark, spec, store, "2020-02-02", monthly=True)
    assert len(published(spark, spec, store)) == 4


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_rerun_of_some_customers_leaves_the_others_alone(spark, store, tmp_path):
    path = store.raw_path(CONV)
    first = raw_rows(spark, CONV, *[day(RUN, str(i)) for i in range(200)], day(RUN, None))
    chunked = first.withColumn("chunk", F.when(F.col("customer_id") < "5", "0-0").otherwise("0-1"))
    tables.write_run(chunked, path, RUN, "customer_id")
    before, was = files_of(tmp_path), rows(read_raw(spark, CONV, path, RUN))
    again = raw_rows(spark, CONV, day(RUN, "17", metrics_conversions="8"), day(RUN, "17", metrics_conversions="9"), day(RUN, "new"), day(RUN, None))
    for _ in range(2):
        tables.replace_customers(again, path, RUN, "0-0", "customer_id")
        tables.replace_customers(again.where("FALSE"), path, RUN, "0-0", "customer_id")
    got = rows(read_raw(spark, CONV, path, RUN), "customer_id", "metrics_conversions")
    assert sum(c not in ("17", "new", None) for c, _ in got) == 199 and len(got) == len(was) + 3
    assert [v for c, v in got if c == "17"] == ["8", "9"]
    kept = [f for f in before if f in files_of(tmp_path)]
    assert len(kept) >= len(before) - 3 and all(files_of(tmp_path)[f] == before[f] for f in kept)
    tables.replace_customers(again, path, RUN, "7-0", "customer_id")  # a chunk without a row so far
    assert read_raw(spark, CONV, path, RUN).count() == len(got) + 4


def records_of(spark, tmp_path, days, broken=0):
    lines = [f'{{"campaign":{{"id":{i},"status":{2 + 7 * (i % 5 == 4)}}},"customer":{{"id":{i % 3}}},"segments":{{"date":"{d}"}}}}' for i, d in enumerate(days)]
    (tmp_path / "records.json").write_text("\n".join([*lines, *['{"campaign":{"id":1,'] * broken]))
    schema = "campaign struct<id: bigint, status: int>, customer struct<id: bigint>, segments struct<date: string>"
    return read_records(spark, schema, str(tmp_path / "records.json"), keep_bad=True)


def decode_status(df, fields):
    return decode_enums(df, {"CampaignStatusEnum": {2: "ENABLED"}}, {"campaign_status": "CampaignStatusEnum"})


def test_a_fetch_counts_dates_broken_records_and_codes(spark, store, tmp_path):
    spec = replace(REPORTS["campaign"], daily=Window(3, 1, 1))
    days = [RUN, "2020-01-30", RUN, "2020-01-30", RUN, "2019-12-01"]
    records = records_of(spark, tmp_path, days, broken=3)
    fetched = jobs.ingest(records, spec, decode_status, store.raw_path(spec), RUN)
    assert fetched == jobs.Fetched(4, frozenset({RUN, "2020-01-30"}), 3, {"campaign_status": 1})
    assert read_raw(spark, spec, store.raw_path(spec), RUN).count() == 4
    assert rows(quality.record_counts(records, BAD_RECORD, "campaign")) == [(9, 3, 0)]
    with pytest.raises(jobs.IncompleteData, match="2020-01-29"):
        jobs.ingest(records, spec, decode_status, store.raw_path(spec), RUN, check=True)
    plain = jobs.ingest(records.drop(BAD_RECORD), spec, decode_status, store.raw_path(spec), RUN)
    assert plain.bad_records == 0 and plain.rows == 4


def test_customers_fetched_again(spark, store, tmp_path):
    spec = replace(REPORTS["campaign"], daily=Window(1, 2, 2))
    jobs.ingest(records_of(spark, tmp_path, [RUN, RUN, "2020-01-30"]), spec, decode_status, store.raw_path(spec), RUN)
    again = records_of(spark, tmp_path, [RUN, RUN, "2020-01-30"]).where("customer.id = 1").drop(BAD_RECORD)
    again = again.withColumn("campaign", F.struct(F.lit(77).alias("id"), F.lit(2).alias("status")))
    jobs.ingest_customers(again, spec, decode_status, store.raw_path(spec), RUN, "0-0")
    got = rows(read_raw(spark, spec, store.raw_path(spec), RUN), "customer_id", "campaign_id")
    assert got == [("0", "0"), ("1", "77"), ("2", "2")]


def test_a_load_counts_what_its_casts_lose(spark, store):
    put_run(spark, CONV, store, RUN, day(RUN, "1", metrics_conversions="x"), day(RUN, "2", metrics_conversions="1.5"), day(RUN, "3"))
    lost = jobs.load_report(spark, CONV, store, RUN).casts_lost
    assert lost["conversions"] == 1 and sum(lost.values()) == 1
    assert len(published(spark, CONV, store)) == 3


def test_files_by_date(spark, store):
    made = spark.range(4000).select(
        F.when(F.col("id") < 2000, F.lit("2020-01-01")).otherwise(F.date_add(F.lit("2020-01-02"), (F.col("id") % 29).cast("int")).cast("string")).alias("data_date"),
        "id",
    ).select("id", "data_date")
    none = made.where("FALSE")
    by_date = {r["data_date"]: r["count"] for r in made.groupBy("data_date").count().collect()}
    merged = merge_clustered(made, none, "data_date", by_date, task_rows=300)
    path = store.mart + "/t"
    tables.overwrite_partitions(merged, path, cluster=False)
    files = {d: len(list((pathlib.Path(path) / f"data_date={d}").glob("*.parquet"))) for d in by_date}
    assert files.pop("2020-01-01") == 7 and set(files.values()) == {1}  # 2000 rows, 300 each
    assert merged.count() == 4000 and merged.rdd.getNumPartitions() == 7 + 7 + 1  # one for dates not counted


def test_rows_dealt_while_narrow_are_written_without_a_shuffle(spark, tmp_path):
    # Each bucket is in one task, so the folders get one file each, as after a shuffle of the wide rows.
    narrow = spark.range(200).select((F.col("id") % 20).cast("string").alias("customer_id"))
    dealt = tables.cluster_for_write(narrow.withColumn("b", tables.customer_bucket(F.col("customer_id"))), "b").drop("b")
    wide = dealt.selectExpr("customer_id", "concat('x', customer_id) as text", "'0-0' as chunk")
    for name, df, cluster in (("dealt", wide, False), ("clustered", wide, True)):
        tables.write_run(df, str(tmp_path / name), RUN, "customer_id", cluster=cluster)
    found = {n: {str(f.parent.relative_to(tmp_path / n)) for f in (tmp_path / n).rglob("*.parquet")} for n in ("dealt", "clustered")}
    assert found["dealt"] == found["clustered"]
    assert len(files_of(tmp_path / "dealt")) == len(found["dealt"])
    assert rows(spark.read.parquet(str(tmp_path / "dealt"))) == rows(spark.read.parquet(str(tmp_path / "clustered")))


def test_rows_known_to_differ_are_dealt_without_comparing_them(spark):
    a = spark.createDataFrame([(1, 0.0, "2020-01-01"), (2, -0.0, "2020-01-02")], "id long, x double, data_date string")
    by_date, empty = {"2020-01-01": 1, "2020-01-02": 1}, a.limit(0)
    assert repeated_hashes(a, ["id"]).isEmpty()
    assert repeated_hashes(a.union(a.limit(1)), ["id"]).count() == 1
    known = merge_clustered(a, empty, "data_date", by_date, distinct=True)
    assert "Aggregate" not in known._jdf.queryExecution().optimizedPlan().toString()
    assert [str(r) for r in rows(known)] == [str(r) for r in rows(merge_clustered(a, empty, "data_date", by_date))]


def test_the_tasks_of_a_write():
    places, tasks = write_tasks({None: 0, "a": 25, "b": 9, "c": 3, "d": 2, "e": 10}, 10, 2)
    assert places == {None: (0, 1), "a": (1, 3), "e": (4, 1), "b": (5, 1), "c": (6, 1), "d": (6, 1)} and tasks == 7
    assert write_tasks({None: 25}, 10, 8) == ({None: (0, 3)}, 3)


def test_readiness_opens_no_file(spark, store):
    day_of = lambda n, d: pathlib.Path(f"{store.mart}/{n}/data_date={d}")
    for name, day_, file in (("full", RUN, "part-0.parquet"), ("empty", RUN, None), ("late", "2020-01-30", "part-0.parquet")):
        day_of(name, day_).mkdir(parents=True)
        if file:
            (day_of(name, day_) / file).write_text("no parquet")
    paths = {n: f"{store.mart}/{n}" for n in ("full", "empty", "late", "nowhere")}
    want = {"full": True, "empty": False, "late": False, "nowhere": False}
    assert dict(rows(quality.partition_readiness(spark, paths, RUN))) == want
    assert dict(rows(quality.partition_readiness(spark, paths, RUN, empty_is_ready=True))) == want | {"empty": True}


def test_a_window_is_published_whole_or_not_at_all(spark, store, monkeypatch):
    rows_of = lambda v, *dates: spark.createDataFrame([(v, d) for d in dates], "v int, data_date string")
    tables.publish_window(rows_of(1, "2020-01-01", "2020-01-02", "2020-01-03"), "window_v", store.mart)
    old = [(1, "2020-01-01"), (1, "2020-01-02"), (1, "2020-01-03")]
    assert rows(spark.table("window_v")) == old
    later = rows_of(2, "2020-01-02", "2020-01-03", "2020-01-04")
    switch = tables._switch

    def killed(*a):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "_switch", killed)
    with pytest.raises(KeyboardInterrupt):
        tables.publish_window(later, "window_v", store.mart)
    assert rows(spark.table("window_v")) == old
    monkeypatch.setattr(tables, "_switch", switch)
    tables.publish_window(later.where("FALSE"), "window_v", store.mart)
    assert rows(spark.table("window_v")) == old
    tables.publish_window(later, "window_v", store.mart)
    assert rows(spark.table("window_v")) == [old[0], (2, "2020-01-02"), (2, "2020-01-03"), (2, "2020-01-04")]
    assert len(set(tables.published_loads(spark, "window_v").values())) == 2
    text = spark.table("window_v").where("data_date = '2020-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "data_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert len(spark.table("window_v").where("data_date = '2020-01-02'").select("v").collect()) == 1
    # The published table is read while its window is replaced.
    tables.publish_window(spark.table("window_v").withColumn("v", F.col("v") + 1), "window_v", store.mart)
    assert rows(spark.table("window_v"), "v") == [(2,), (3,), (3,), (3,)]
    spark.sql("DROP VIEW window_v")
