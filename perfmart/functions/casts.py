"""Casts from report text to typed columns.

Raw report columns are all text, with ``'None'`` for a missing value.  The
published tables were defined by Spark's non-ANSI casts, so these helpers give
those results whatever ``spark.sql.ansi.enabled`` says, without touching it.

A failed ``try_cast`` from text raises and catches a Java exception for every
single cell.  On columns with many ``'None'`` cells that costs far more than the
scan itself, so text that cannot be a number is turned to NULL by a plain string
comparison before the cast sees it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "None"

# Whole text is an integer part, a point and only digits after it.
_DECIMAL_TEXT = r"^(?<sign>[ \p{Cntrl}]*[+-]?)(?<whole>[0-9]*)[.][0-9]*[ \p{Cntrl}]*$"


def _integral(x: Column, type_name: str) -> Column:
    # Digits, signs, the point and blanks all sort below ':'; letters above it.
    maybe_number = (x < ":") & (x != "")
    # The zero keeps '.5' (integer part empty) a number: 0, as the cast has it.
    truncated = F.regexp_replace(x, _DECIMAL_TEXT, "${sign}0${whole}")
    text = F.when(maybe_number, F.when(F.contains(x, F.lit(".")), truncated).otherwise(x))
    return text.try_cast(type_name)


def legacy_long(x: Column) -> Column:
    """Text to bigint: ``'12.7'`` is 12; ``'None'``, ``''``, ``'1.0E7'`` are NULL."""
    return _integral(x, "bigint")


def legacy_int(x: Column) -> Column:
    """Text to int, with the same rules as :func:`legacy_long`."""
    return _integral(x, "int")


def to_double(x: Column) -> Column:
    """Text to double; ``'nan'`` is NaN."""
    number = F.when(x != MISSING, x).try_cast("double")
    return F.when(x == "nan", F.lit(float("nan"))).otherwise(number)


def to_decimal(x: Column) -> Column:
    """Text to decimal(30,6), rounding half up at the sixth place."""
    return F.when(x != MISSING, x).try_cast("decimal(30,6)")


def to_date(x: Column) -> Column:
    """ISO-like text to date; other patterns such as ``'1/2/2020'`` are NULL."""
    return x.try_cast("date")


def micros_to_currency(x: Column) -> Column:
    """Micro-unit text to currency units."""
    return to_double(x) / F.lit(1000000.0)


CASTS = {
    "string": lambda x: x,
    "bigint": legacy_long,
    "int": legacy_int,
    "double": to_double,
    "decimal": to_decimal,
    "date": to_date,
    "currency": micros_to_currency,
}

# Column types of the published tables.
SPARK_TYPES = {
    "string": "string",
    "criteria": "string",
    "lookup": "string",
    "bigint": "bigint",
    "int": "int",
    "double": "double",
    "decimal": "decimal(30,6)",
    "date": "date",
    "currency": "double",
}
