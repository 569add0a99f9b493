"""Operators on literal frames, with the edge rows each must get right."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from perfmart.operators import accounts, joins, lookup, quality, windows
from perfmart.operators.carry import KeyProfile, carry_forward, merge_clustered, merge_distinct, merge_distinct_by, profile_keys
from perfmart.operators.consolidate import consolidate
from perfmart.operators.lookup import dims_fit, lookup_names
from perfmart.operators.project import location_keys, project
from perfmart.operators.windows import assign_chunks
from perfmart.plans.reports import BACKFILLS, REPORTS

RUN = "2020-01-31"


def raw_rows(spark, spec, *changes):
    """Raw rows of a spec: 'None' everywhere but for the given fields."""
    base = {f: "None" for f in spec.raw_fields} | {
        "customer_id": "1", "segments_date": RUN, "data_date": RUN
    }
    if spec.sentinel:
        base[spec.sentinel] = "x"
    data = [tuple((base | c)[f] for f in spec.raw_schema.names) for c in changes]
    return spark.createDataFrame(data, spec.raw_schema)


# --- projection


def test_projection_types_and_order(spark):
    for name in ("age", "webpage", "campaign", "keywordless"):
        spec = REPORTS[name]
        got = project(raw_rows(spark, spec, {}), spec, RUN)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in spec.schema]


def test_header_rows_nulls_and_other_runs(spark):
    spec = REPORTS["age"]
    header = {f: f for f in spec.raw_fields}
    raw = raw_rows(
        spark,
        spec,
        {"ad_group_name": "kept"},
        header,
        {"ad_group_name": None},
        {"ad_group_name": "old", "data_date": "2020-01-30"},
    )
    assert rows(project(raw, spec, RUN), "ad_group_name") == [("kept",)]


def test_header_rows_stay_where_the_report_has_no_sentinel(spark):
    spec = REPORTS["search_query"]
    raw = raw_rows(spark, spec, {f: f for f in spec.raw_fields})
    [row] = project(raw, spec, RUN).collect()
    assert row["external_customer_id"] is None and row["report_dt"] is None
    assert row["currency_code"] == "customer_currency_code"


def test_micros_and_text_casts(spark):
    spec = REPORTS["age"]
    raw = raw_rows(
        spark, spec, {"metrics_cost_micros": "2500000", "metrics_clicks": "12.7", "metrics_conversions": "1.0E7"}
    )
    [row] = project(raw, spec, RUN).collect()
    assert (row["cost"], row["clicks"], row["conversions"]) == (2.5, 12, 1.0e7)
    assert row["report_dt"] == dt.date(2020, 1, 31) and row["data_date"] == RUN


@pytest.mark.parametrize("name", ["user", "placement"])
def test_criteria_follow_the_criterion_type(spark, name):
    spec = REPORTS[name]
    changes = [
        {"ad_group_criterion_type_": kind, field: f"text of {kind}"} for kind, field in spec.criteria.choices
    ]
    raw = raw_rows(spark, spec, *changes, {"ad_group_criterion_type_": "OTHER"}, {"ad_group_criterion_type_": None})
    got = {r["criteria_type"]: r["criteria"] for r in project(raw, spec, RUN).collect()}
    assert got == {kind: f"text of {kind}" for kind, _ in spec.criteria.choices} | {"OTHER": "--", None: "--"}


# --- lookups


@pytest.mark.parametrize("id_type", ["bigint", "int", "string"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_locations_must_resolve_at_every_level(spark, id_type, broadcast):
    spec = REPORTS["geo"]
    good = {f: "geoTargetConstants/1023191" for f in (
        "segments_geo_target_city", "segments_geo_target_metro",
        "segments_geo_target_most_specific_location", "segments_geo_target_region",
    )}
    good["geographic_view_country_criterion_id"] = "2840"
    raw = raw_rows(
        spark,
        spec,
        good | {"ad_group_name": "all"},
        good | {"ad_group_name": "no city", "segments_geo_target_city": ""},
        good | {"ad_group_name": "no metro", "segments_geo_target_metro": "geoTargetConstants/7"},
        good | {"ad_group_name": "no country", "geographic_view_country_criterion_id": "None"},
        good | {"ad_group_name": "no region", "segments_geo_target_region": None},
    )
    dims = {
        level: spark.createDataFrame(
            [("2840" if level == "country" else "1023191", f"name of {level}")], "id string, cannonicalname string"
        ).withColumn("id", F.col("id").cast(id_type))
        for level in location_keys()
    }
    got = project(raw, spec, RUN, dims, broadcast)
    assert rows(got, "ad_group_name", "city_criteria_name", "region_criteria_name") == [
        ("all", "name of city", "name of region")
    ]


def test_long_location_ids_are_read_whole(spark):
    field = location_keys()["city"]
    df = spark.createDataFrame([("geoTargetConstants/10231915",)], "segments_geo_target_city string")
    dim = spark.createDataFrame([(1023191, "short"), (10231915, "long")], "id bigint, cannonicalname string")
    for broadcast in (True, False):
        assert rows(lookup_names(df, {"city": dim}, {"city": field}, broadcast), "city_name") == [("long",)]


def test_dates_that_are_no_dates_get_no_chunk(spark):
    df = spark.createDataFrame([("2020-01-3x",), (RUN,)], "d string")
    assert rows(assign_chunks(df, "d", RUN, 30, 1, 2), "task", "chunk") == [(0, 0), (None, None)]


def test_repeated_dimension_ids_multiply_rows_in_both_ways(spark):
    df = spark.createDataFrame([("5",)] * 3, "k string")
    dim = spark.createDataFrame([(5, "a"), (5, "b")], "id bigint, cannonicalname string")
    results = [
        rows(lookup_names(df, {"city": dim}, {"city": F.col("k")}, b), "city_name") for b in (True, False)
    ]
    assert results[0] == results[1] == [("a",)] * 3 + [("b",)] * 3


def test_size_checks(spark):
    assert joins.fits(spark.range(10), 10) and not joins.fits(spark.range(11), 10)
    dims = {"a": spark.range(6), "b": spark.range(5)}
    assert all(dims_fit(dims, 11).values()) and not all(dims_fit(dims, 1).values())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    # One key holds a third of the left side.
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    left = left.union(spark.createDataFrame([(None, -1)], "k bigint, id bigint"))
    right = spark.createDataFrame([(7, "x"), (8, "y"), (99, "z")], "k bigint, v string")
    plain = rows(joins.bounded_join(left, right, "k", how, broadcast=True))
    assert rows(joins.bounded_join(left, right, "k", how, broadcast=False)) == plain
    plan = joins.bounded_join(left, right, "k", how, broadcast=False)
    assert "_salt" not in plan.columns


# --- carry-forward and merge


def mart(spark, *pairs):
    return spark.createDataFrame(list(pairs), "acct bigint, data_date string")


HISTORY = [(1, RUN), (2, RUN), (2, "2019-12-01"), (None, RUN)]


@pytest.mark.parametrize("max_broadcast", [1000, 0])
@pytest.mark.parametrize(
    "batch, expected",
    [
        ([1], [(2, RUN)]),
        ([1, 2], []),
        ([], [(1, RUN), (2, RUN), (None, RUN)]),
        ([1, None], []),
        ([None], []),
    ],
)
def test_carry_forward_is_not_in(spark, batch, expected, max_broadcast):
    fresh = spark.createDataFrame([(a, RUN) for a in batch], "acct bigint, data_date string")
    got = carry_forward(fresh, mart(spark, *HISTORY), "acct", "2020-01-02", RUN, max_broadcast=max_broadcast)
    assert rows(got) == sorted(expected, key=lambda r: tuple(str(v) for v in r))
    fresh.createOrReplaceTempView("batch")
    mart(spark, *HISTORY).createOrReplaceTempView("published")
    literal = spark.sql(
        f"SELECT * FROM published WHERE data_date BETWEEN '2020-01-02' AND '{RUN}' "
        "AND acct NOT IN (SELECT acct FROM batch)"
    )
    assert rows(got) == rows(literal)


def test_key_profile(spark):
    fresh = spark.createDataFrame([(1,), (1,), (2,), (None,)], "acct bigint")
    assert profile_keys(fresh, "acct") == KeyProfile(2, True)
    assert profile_keys(fresh.where("acct > 5"), "acct").empty


def test_no_broadcast_of_many_keys(spark):
    fresh = spark.range(100).selectExpr("id AS acct", f"'{RUN}' AS data_date")
    few, mapped, many = [
        carry_forward(fresh, mart(spark, *HISTORY), "acct", RUN, RUN, KeyProfile(100, False), most, size)
        for most, size in ((100, 0), (99, 1 << 20), (99, 0))
    ]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(few) and "broadcast" not in plan(many)
    # The bitmaps are broadcast, so the published rows are not shuffled.
    assert "bitmap_construct_agg" in plan(mapped) and "LeftAnti" not in plan(mapped)
    text = mapped._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") <= 2  # distinct ids, then their bitmaps


@pytest.mark.parametrize("size", [0, 1 << 20])
def test_bitmaps_equal_a_literal_not_in(spark, size):
    ids = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 10**10, 10**10 + 5, -1, -5, -32768, -32769, 2**62, None]
    fresh = spark.createDataFrame([(i,) for i in ids[::2]] * 2, "acct bigint").where("acct IS NOT NULL")
    history = spark.createDataFrame([(i, str(i), RUN) for i in ids], "acct bigint, name string, data_date string")
    got = carry_forward(fresh, history, "acct", RUN, RUN, max_broadcast=0, max_bitmap_bytes=size)
    fresh.createOrReplaceTempView("batch")
    history.createOrReplaceTempView("published")
    assert rows(got) == rows(spark.sql("SELECT * FROM published WHERE acct NOT IN (SELECT acct FROM batch)"))
    as_text = lambda df: df.withColumn("acct", F.col("acct").cast("string"))
    assert rows(carry_forward(as_text(fresh), as_text(history), "acct", RUN, RUN, max_broadcast=0), "name") == rows(got, "name")


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_a_large_dimension_meets_distinct_ids_only(spark, max_rows):
    fact = spark.range(200).selectExpr("cast(id % 50 as string) as city", "id", "repeat('x', 100) as wide")
    fact = fact.union(spark.createDataFrame([("None", -1, ""), (None, -2, "")], "city string, id bigint, wide string"))
    dim = spark.createDataFrame([(i, f"c{i}") for i in range(5, 60)] + [(7, "again")], "id bigint, cannonicalname string")
    named = lookup_names(fact, {"city": dim}, {"city": F.col("city")}, False, max_rows)
    assert named.count() == 45 * 4 + 4 and rows(named.where("id = 7"), "city_name") == [("again",), ("c7",)]
    text = named._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in text.splitlines() if "Exchange" in line and "wide" in line]
    assert ("BroadcastExchange" in text) == (max_rows > 0)
    if max_rows:
        # All exchanges are below the broadcast; the wide rows are on the other side of the join.
        assert text.count("Exchange hashpartitioning") <= 2 and not wide


@pytest.mark.parametrize("kept", [True, False])
@pytest.mark.parametrize("id_type", ["bigint", "string"])
def test_large_dimensions_share_one_shuffle_of_the_wide_rows(spark, id_type, kept, monkeypatch):
    if not kept:  # as without a checkpoint folder on a cluster
        monkeypatch.setattr(lookup, "checkpointed", lambda df: df)
    fact = spark.range(300).selectExpr(
        "cast(id % 50 - 10 as string) as city", "cast(id % 7 * 1000 as string) as metro", "id", "repeat('x', 100) as wide"
    )
    odd = [("None", "0", -1, ""), (None, "0", -2, ""), ("5", "", -3, ""), ("5", None, -4, ""), ("-64", "0", -5, ""), ("-64", "0", -5, "")]
    fact = fact.union(spark.createDataFrame(odd, "city string, metro string, id bigint, wide string")).repartition(3)
    ids = [*range(-8, 30), 7, -64, 10**12, None]
    dims = {
        "city": spark.createDataFrame([(i, f"c{n}") for n, i in enumerate(ids)], "id bigint, cannonicalname string"),
        "metro": spark.createDataFrame([(i * 1000, f"m{i}") for i in range(6)] + [(1, "m")], "id bigint, cannonicalname string"),
    }
    dims = {level: dim.withColumn("id", F.col("id").cast(id_type)) for level, dim in dims.items()}
    keys = {level: F.col(level) for level in dims}
    named = lookup_names(fact, dims, keys, False, 0)
    want = rows(lookup_names(fact, dims, keys, True), "id", "city_name", "metro_name", "wide")
    assert rows(named, "id", "city_name", "metro_name", "wide") == want and len(want) > 180
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = [line for line in plan(named) if "hashpartitioning" in line]
    if kept:
        assert len(moved) == 2 and "SortMergeJoin" not in "".join(plan(named))  # the rows, and the names of the tuples
    assert "ShuffledHashJoin" in "".join(plan(named))
    narrow = lookup_names(fact, dims, keys, False, 0, [F.col("id"), F.length("wide").alias("n")])
    assert rows(narrow, "id", "city_name", "metro_name") == [r[:3] for r in want] and narrow.columns[:2] == ["id", "n"]
    # What a report keeps is worked out before that shuffle.
    text = "\n".join(plan(narrow))
    assert text.index("hashpartitioning") < text.index("length(wide")


def test_locations_of_too_many_words_are_resolved_too(spark):
    fact = spark.range(100).selectExpr("cast(id * 1000 as string) as city", "id")
    dim = spark.range(90).selectExpr("id * 1000 as id", "concat('c', id) as cannonicalname")
    for most in (0, 89, 90):
        assert rows(lookup_names(fact, {"city": dim}, {"city": F.col("city")}, False, most), "id") == [(i,) for i in sorted(range(90), key=str)]


def test_merge_is_by_position_and_removes_all_copies(spark):
    nan = float("nan")
    a = spark.createDataFrame([(1, nan), (1, nan), (2, 1.0)], "a int, b double")
    b = spark.createDataFrame([(2, 1.0), (3, None), (3, None)], "other int, names double")
    got = merge_distinct(a, b)
    for most in (0, 3, 100):
        clustered = merge_clustered(a, b, a.columns[0], most, task_rows=2)
        assert str(rows(clustered)) == str(rows(got)) and clustered.columns == got.columns  # NaN
    assert got.columns == ["a", "b"] and got.count() == 3
    with pytest.raises(ValueError):
        merge_distinct(a, b.select("other"))


# --- consolidation


def test_consolidation_by_name_with_missing_columns(spark):
    a = spark.createDataFrame([("a", RUN), ("old", "2019-01-01")], "name string, data_date string")
    b = spark.createDataFrame([(RUN, "b", 0.5)], "data_date string, name string, prc double")
    got = consolidate([a, b, a], "2020-01-01", RUN)
    assert got.columns == ["name", "data_date", "prc"]
    assert rows(got) == [("a", RUN, None), ("a", RUN, None), ("b", RUN, 0.5)]


# --- windows and checks


def test_window_bounds_and_lag():
    assert windows.window_bounds(RUN, 30) == ("2020-01-02", RUN)
    assert windows.window_bounds(RUN, 30, inclusive_start=True) == ("2020-01-01", RUN)
    assert windows.run_date_of("2020-01-02", 2) == "2019-12-31"


def test_date_chunks_cover_the_window_once(spark):
    got = rows(windows.date_chunks(spark, RUN, 30, 3, 2), "task", "chunk", "start", "end")
    assert got[0] == (0, 0, dt.date(2020, 1, 27), dt.date(2020, 1, 31))
    assert got[-1] == (2, 1, dt.date(2020, 1, 2), dt.date(2020, 1, 6))
    days = [s + dt.timedelta(i) for _, _, s, e in got for i in range((e - s).days + 1)]
    assert sorted(days) == [dt.date(2020, 1, 2) + dt.timedelta(i) for i in range(30)]
    with pytest.raises(ValueError):
        windows.date_chunks(spark, RUN, 30, 4, 1)


def test_assigned_chunks_agree_with_the_ranges(spark):
    days = spark.range(34).select(F.date_sub(F.lit("2020-02-02").cast("date"), F.col("id").cast("int")).alias("d"))
    placed = windows.assign_chunks(days, "d", RUN, 30, 3, 2)
    ranges = windows.date_chunks(spark, RUN, 30, 3, 2)
    joined = days.join(ranges, F.col("d").between(F.col("start"), F.col("end")), "left")
    assert rows(placed, "d", "task", "chunk") == rows(joined, "d", "task", "chunk")


def test_missing_dates(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-01-03",), ("bad",), (None,)], "d string")
    assert rows(quality.missing_dates(df, "d", "2020-01-01", "2020-01-04")) == [
        (dt.date(2020, 1, 2),),
        (dt.date(2020, 1, 4),),
    ]
    chunks = windows.date_chunks(spark, "2020-01-04", 4, 2, 1)
    by_chunk = quality.missing_dates(df, "d", "2020-01-01", "2020-01-04", by_chunk=chunks)
    assert rows(by_chunk) == [(0, 0, dt.date(2020, 1, 4)), (1, 0, dt.date(2020, 1, 2))]
    assert rows(quality.count_dates(df, "d", "2020-01-01", "2020-01-04")) == [(2, 4)]


def test_input_readiness(spark):
    a, b = mart(spark, (1, RUN)), mart(spark, (1, "2020-01-30"))
    assert rows(quality.input_readiness({"a": a, "b": b}, RUN)) == [("a", True), ("b", False)]


def test_cast_losses_count_only_real_text(spark):
    spec = REPORTS["age"]
    raw = raw_rows(
        spark,
        spec,
        {"metrics_clicks": "many", "metrics_impressions": "3"},
        {"metrics_clicks": "None", "metrics_impressions": ""},
        {f: f for f in spec.raw_fields},
    )
    lost = dict(rows(quality.cast_loss_counts(raw, spec)))
    assert lost["clicks"] == 1 and lost["impressions"] == 1
    assert sum(lost.values()) == 2


# --- accounts


def test_accounts(spark):
    df = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", None)], "account_id string, status string")
    assert rows(accounts.account_status(df), "account_id", "state") == [
        ("1", "active"), ("2", "deactivated"), ("3", "deactivated")
    ]
    assert rows(accounts.active_accounts(df), "account_id") == [("1",)]
    assert rows(accounts.deactivated_accounts(df, ["age", "geo"])) == [
        ("age", "2"), ("age", "3"), ("geo", "2"), ("geo", "3")
    ]
    assert accounts.deactivated_accounts(df.where("status = '2'"), ["age"]).count() == 0


def test_backfill_keeps_copies(spark):
    spec = BACKFILLS["ad_conv"]
    raw = raw_rows(spark, spec, {"segments_device": "MOBILE"}, {"segments_device": "MOBILE"})
    assert project(raw, spec, RUN).count() == 2


def test_distinct_by_telling_columns(spark):
    # Alike in the telling column: equal rows, rows that differ elsewhere, and NULLs.
    a = spark.createDataFrame([(1, "x", 0.5), (1, "x", 0.5), (1, "y", 0.5), (2, "x", -0.0), (None, "x", None)], "k long, s string, d double")
    b = spark.createDataFrame([(2, "x", 0.0), (3, "x", -0.0), (None, "x", None), (4, None, float("nan")), (4, None, float("nan"))], a.schema)
    want = sorted(map(str, merge_distinct(a, b).collect()))
    for most in (0, 1, 100):
        got = merge_distinct_by(a, b, ["k"], most)
        assert sorted(map(str, got.collect())) == want and got.columns == a.columns and got.schema["d"].dataType == a.schema["d"].dataType
    alone = spark.range(8).selectExpr("id as k", "'x' as s", "-0.0D * (id + 1) as d")
    got = merge_distinct_by(alone, alone.where("k < 0"), ["k"])
    assert sorted(map(str, got.collect())) == sorted(map(str, alone.distinct().collect()))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # no whole row is shuffled


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_that_are_not_carried_are_not_typed(spark):
    # The test of the accounts lies below the projection that makes them numbers.
    ids = [-40000, -1, 0, 1, 7, 8, 32767, 32768, 32769, 65536, 70000]
    text = spark.createDataFrame([(str(i), "2020-01-15") for i in ids], "account string, data_date string")
    mart = text.repartition(2).selectExpr("try_cast(account as bigint) as id", "concat('x', account) as name", "data_date")
    fresh = spark.createDataFrame([(i,) for i in ids[::2]], "id long")
    profile = profile_keys(fresh, "id", store=True)
    got = carry_forward(fresh, mart, "id", "2020-01-01", RUN, profile, below=True)
    assert rows(got, "id") == rows(spark.createDataFrame([(i,) for i in ids[1::2]], "id long"))
    text = plan_of(got)
    assert text.index("concat(x") < text.index("scalar-subquery") and "scalar-subquery" in text.split("Repartition")[1]


def test_only_rows_alike_are_typed_twice(spark):
    text = spark.createDataFrame([(str(i % 8), str(i)) for i in range(12)], "k string, v string").repartition(2)
    typed = text.selectExpr("try_cast(k as bigint) as k", "concat('x', v) as v", "0.0 as zero")
    empty = typed.where("k < 0")
    got = merge_distinct_by(typed.union(typed.where("k = 5")), empty, ["k"])
    assert rows(got) == rows(typed.distinct()) and got.count() == 12
    assert "LeftSemi" not in plan_of(got)
