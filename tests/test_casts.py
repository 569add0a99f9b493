import datetime as dt
import decimal
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perfmart.functions import casts

PROBES = [
    "12", "12.7", " 7 ", "-5", "+5", "-12.9", "None", "", "nan", "1.0E7", ".5", "-.5", ".", "-",
    "+", "5.", "1.2.3", "12a", "a12", "1 2", "9223372036854775807", "9223372036854775808",
    "-9223372036854775808", "-9223372036854775809", "2147483647", "2147483648", "\t8\n", "12. ",
    "12.7 ", "ABOVE_AVERAGE", "--", "12.x", "0x10", "1e3", "1_000", "007", "9223372036854775808.5",
]


def _both(spark, texts, ours, type_name):
    """Our cast, and the cast of a session without ANSI mode."""
    df = spark.createDataFrame([(t,) for t in texts], "x string").coalesce(1)
    mine = [r[0] for r in df.select(ours(F.col("x"))).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = [r[0] for r in df.select(F.col("x").cast(type_name)).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    return mine, plain


@pytest.mark.parametrize(
    "ours, type_name", [(casts.legacy_long, "bigint"), (casts.legacy_int, "int")]
)
def test_integral_casts_equal_the_non_ansi_cast(spark, ours, type_name):
    mine, plain = _both(spark, PROBES, ours, type_name)
    assert dict(zip(PROBES, mine)) == dict(zip(PROBES, plain))


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.text(alphabet="0123456789.+- eEN\t", max_size=12)
        | st.decimals(allow_nan=False, allow_infinity=False, places=2).map(str),
        min_size=40,
        max_size=60,
    )
)
def test_integral_casts_equal_the_non_ansi_cast_on_any_number_like_text(spark, texts):
    mine, plain = _both(spark, texts, casts.legacy_long, "bigint")
    assert mine == plain


def test_double(spark):
    texts = ["1.0E7", "None", "", "0.1", " 2 ", "inf", None]
    mine, plain = _both(spark, texts, casts.to_double, "double")
    assert mine == plain
    [(nan,)] = spark.createDataFrame([("nan",)], "x string").select(casts.to_double(F.col("x"))).collect()
    assert math.isnan(nan)


def test_decimal_date_and_currency(spark):
    df = spark.createDataFrame(
        [("1234567.12345678", "2020-1-2", "1500000"), ("None", "1/2/2020", "None")],
        "d string, t string, m string",
    )
    got = df.select(
        casts.to_decimal(F.col("d")), casts.to_date(F.col("t")), casts.micros_to_currency(F.col("m"))
    ).collect()
    assert tuple(got[0]) == (decimal.Decimal("1234567.123457"), dt.date(2020, 1, 2), 1.5)
    assert tuple(got[1]) == (None, None, None)
