import pytest
from pyspark.sql import functions as F

from conftest import rows
from perfmart.operators import quality
from perfmart.operators.records import (
    decode_enums,
    decode_enums_by_table,
    flatten_records,
    float_text,
    raw_name,
    source_filter,
    stringify,
)
from perfmart.plans.reports import REPORTS
from perfmart.sources.raw import read_records

SCHEMA = (
    "campaign struct<id: bigint, status: int>, "
    "ad_group_criterion struct<age_range: struct<type: int>, final_urls: array<string>>, "
    "segments struct<date: string>"
)


def test_flatten_reads_json_records(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text(
        '{"campaign": {"id": 7, "status": 2}, "ad_group_criterion": {"age_range": {"type": 3}, '
        '"final_urls": ["a", "b"]}, "segments": {"date": "2020-01-01"}}\n{"campaign": {"id": 8}}\n'
    )
    flat = flatten_records(read_records(spark, SCHEMA, str(path)))
    assert flat.columns == [
        "campaign_id", "campaign_status", "ad_group_criterion_age_range_type_",
        "ad_group_criterion_final_urls", "segments_date",
    ]
    assert rows(stringify(flat)) == [
        ("7", "2", "3", '["a","b"]', "2020-01-01"), ("8", "None", "None", "None", "None")
    ]
    assert flatten_records(read_records(spark, SCHEMA, str(path)), ["campaign.id"]).columns == ["campaign_id"]
    assert raw_name("ad_group_criterion.type") == "ad_group_criterion_type_"


@pytest.mark.parametrize("limits", [{}, {"max_codes": 0}, {"max_codes": 0, "max_rows": 0}])
def test_decode_by_map_and_by_table(spark, limits):
    df = spark.createDataFrame([(1, 2), (2, 9), (3, None)], "campaign_id int, campaign_status int")
    fields = {"campaign_status": "Status", "not_there": "Status"}
    by_map = decode_enums(df, {"Status": {2: "ENABLED", 3: "PAUSED"}}, fields)
    dim = spark.createDataFrame([("Status", 2, "ENABLED"), ("Other", 9, "x")], "enum string, code int, name string")
    by_table = decode_enums_by_table(df, dim, fields, **limits)
    assert rows(by_map) == rows(by_table) == [(1, "ENABLED"), (2, None), (3, None)]
    name = lambda d: decode_enums(d, {"Status": {2: "ENABLED", 3: "PAUSED"}}, fields)
    assert rows(quality.decode_loss_counts(df, name, ["campaign_status"])) == [("campaign_status", 1)]


def test_codes_that_are_no_numbers_lose_their_name_only(spark):
    df = spark.createDataFrame([("2",), ("two",), (None,)], "campaign_status string")
    fields = {"campaign_status": "Status"}
    dim = spark.createDataFrame([("Status", "2", "ENABLED"), ("Status", "x", "y")], "enum string, code string, name string")
    want = [("ENABLED",), (None,), (None,)]
    assert rows(decode_enums(df, {"Status": {2: "ENABLED"}}, fields)) == want
    assert rows(decode_enums_by_table(df, dim, fields)) == want
    name = lambda d: decode_enums(d, {"Status": {2: "ENABLED"}}, fields)
    assert rows(quality.decode_loss_counts(df, name, ["campaign_status"])) == [("campaign_status", 1)]


def test_float_text_is_that_of_the_extract(spark):
    numbers = [0.0, -0.0, 1.0, 0.1, -2.5, 1e7, 12345678.9, 1e15, 1e16, 1.5e-5, 0.0001, 0.00012345678901234567,
               123456789012345.6, 2.5e20, 1e-300, 5e300, 100.0, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(x,) for x in numbers], "x double").coalesce(1)
    assert [r[0] for r in df.select(float_text(F.col("x"))).collect()] == [str(x) for x in numbers]


def test_stringify_missing_and_boolean(spark):
    df = spark.createDataFrame([(True, None, 1), (None, 2.0, None)], "a boolean, b double, c int")
    assert rows(stringify(df)) == [("None", "2.0", "None"), ("True", "None", "1")]


def test_source_filter(spark):
    spec = REPORTS["campaign"]
    df = spark.createDataFrame(
        [("ENABLED", "2020-01-31"), ("UNKNOWN", "2020-01-31"), (None, "2020-01-31"), ("PAUSED", "2020-01-01"),
         ("REMOVED", "2020-01-02")],
        "campaign_status string, segments_date string",
    )
    assert rows(source_filter(df, spec, "2020-01-31", 30)) == [
        ("ENABLED", "2020-01-31"), ("REMOVED", "2020-01-02")
    ]


def test_all_fields_are_decoded_without_a_join(spark):
    fields = {f"f{i}": f"Enum{i % 28}" for i in range(32)}
    df = spark.createDataFrame([tuple(range(32)), tuple(None for _ in range(32))], ", ".join(f"f{i} int" for i in range(32)))
    dim = spark.createDataFrame([(f"Enum{e}", c, f"{e}:{c}") for e in range(28) for c in range(40)] + [("Enum0", 0, "0:z")], "enum string, code int, name string")
    got = decode_enums_by_table(df, dim, fields)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text.split("Subquery")[0] and text.count("Join") == 0
    assert rows(got) == rows(decode_enums_by_table(df, dim, fields, max_codes=0))
    first = got.where("f1 IS NOT NULL").first()
    assert [first[f] for f in fields] == [f"{i % 28}:{i}" for i in range(32)]
    assert decode_enums_by_table(df, dim, {"x": "Enum0"}) is df
