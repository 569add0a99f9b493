"""The raw extracts that the queries derive from the test tables."""

import pytest

from checks import views
from checks.queries import QUERIES
from checks.views import extract, raw_expressions
from conftest import rows
from perfmart.plans.reports import BACKFILLS
from test_plans import plan

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_lines(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").limit(50)
    odd = [
        "cast(null as double) as l_quantity", "-0.0D as l_quantity", "2.5D as l_quantity",
        "cast(null as int) as l_linenumber", "7 as l_linenumber",
    ]
    for text in odd:
        name = text.rsplit(" ", 1)[1]
        changed = lines.limit(3).selectExpr(*[text if c == name else c for c in lines.columns])
        lines = lines.union(changed)
    return lines.localCheckpoint()


@pytest.mark.parametrize("most", [20_000, 0])
@pytest.mark.parametrize("name", ["ads", "campaign", "ad_conv"])
def test_shared_texts_are_those_that_each_line_would_make(odd_lines, monkeypatch, name, most):
    monkeypatch.setattr(views, "_MAX_PAIRS", most)
    spec = BACKFILLS[name]
    found = extract(odd_lines.repartition(3), odd_lines, spec)
    plain = odd_lines.selectExpr(*raw_expressions(spec))
    assert found.schema.names == plain.schema.names
    assert rows(found) == rows(plain)


@pytest.mark.parametrize("name", ["backfill_ads", "backfill_ads_ad_hoc", "backfill_campaign"])
def test_lines_look_up_the_texts_they_share(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CASE WHEN (l_linenumber" not in text
    assert text.count("BroadcastHashJoin [coalesce(l_linenumber") == 1


def test_lines_that_are_read_in_many_tasks_are_not_dealt(spark, tmp_path):
    spark.range(5000).selectExpr("id as l_orderkey", "id % 7 as l_linenumber").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    t = views.Tables(spark, str(tmp_path))
    assert "Exchange" in plan(views.lines_as_read(t))
    sizes = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in sizes}
    try:
        for name, size in sizes.items():
            spark.conf.set(name, size)
        read = views.lines_as_read(t)
        assert "Exchange" not in plan(read) and rows(read) == rows(views.lines(t))
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)
