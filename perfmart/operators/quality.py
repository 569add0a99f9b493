"""Completeness, readiness and cast-loss checks.  All return small DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.functions.casts import CASTS
from perfmart.operators.project import UNCAST, drop_header_rows, is_lost
from perfmart.plans.reports import ReportSpec


def distinct_dates(df: DataFrame, date_col: str) -> DataFrame:
    """Dates that have data; text that is no date is left out."""
    day = F.col(date_col).try_cast("date")
    return df.select(day.alias("date")).where(F.col("date").isNotNull()).distinct()


def _calendar(ranges: DataFrame) -> DataFrame:
    days = F.explode(F.sequence("start", "end")).alias("date")
    return ranges.select(*[c for c in ranges.columns if c not in ("start", "end")], days)


def missing_dates(
    df: DataFrame,
    date_col: str,
    start: str,
    end: str,
    by_chunk: DataFrame | None = None,
) -> DataFrame:
    """Dates of the window without any row: ``(date)``, or ``(task, chunk, date)``.

    With ``by_chunk`` (from ``date_chunks``) every chunk is checked against its
    own dates.  Both sides hold one row per date of the window.
    """
    if by_chunk is None:
        ranges = df.sparkSession.range(1).select(
            F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
        )
    else:
        ranges = by_chunk
    present = distinct_dates(df, date_col).where(F.col("date").between(start, end))
    return _calendar(ranges).join(present, "date", "left_anti").select(
        *[c for c in ranges.columns if c not in ("start", "end")], "date"
    )


def rows_by_date(df: DataFrame, date_col: str, start: str, end: str) -> dict[str | None, int]:
    """Rows of each date of the window, and under ``None`` of all others: a row a date reaches the driver."""
    day = F.col(date_col).try_cast("date")
    counted = df.groupBy(F.when(day.between(start, end), day.cast("string")).alias("date")).agg(F.count(F.lit(1)).alias("rows"))
    return {r["date"]: r["rows"] for r in counted.collect()}


def count_dates(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """``(found, expected)``: distinct dates of the window against its length."""
    present = distinct_dates(df, date_col).where(F.col("date").between(start, end))
    expected = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    return present.agg(F.count("date").alias("found")).withColumn("expected", expected)


def input_readiness(tables: dict[str, DataFrame], run_date: str) -> DataFrame:
    """``(table, ready)``: which inputs have a row in the run date's partition.

    For tables that the writers of this library made that is the same as having the
    partition: they never leave an empty one.
    """
    checks = [
        df.where(F.col("data_date") == run_date)
        .select(F.lit(1))
        .limit(1)
        .agg((F.count(F.lit(1)) > 0).alias("ready"))
        .select(F.lit(name).alias("table"), "ready")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, checks)


def partition_readiness(
    spark: SparkSession, paths: Mapping[str, str], run_date: str, empty_is_ready: bool = False
) -> DataFrame:
    """``(table, ready)``: which stored tables have the run date's partition.

    Only the folder is listed: no file is opened.  ``empty_is_ready`` takes a partition
    without a file, as a load of no rows by other tools leaves it, for a ready one.
    """

    def ready(path: str) -> bool:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
        try:
            files = listed.load(f"{path.rstrip('/')}/data_date={run_date}").select("path")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return empty_is_ready or not files.isEmpty()

    return spark.createDataFrame([(name, ready(path)) for name, path in paths.items()], "table string, ready boolean")


def record_counts(records: DataFrame, bad: str, part: str) -> DataFrame:
    """``(records, bad, without)``: all records, those that could not be parsed, and the others that lack ``part``."""
    broken = F.col(bad).isNotNull()
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(broken).alias("bad"),
        F.count_if(~broken & F.col(part).isNull()).alias("without"),
    )


def cast_loss_counts(raw: DataFrame, spec: ReportSpec) -> DataFrame:
    """``(column, lost)``: text other than ``'None'`` that a cast turned to NULL.

    One pass over the data: a sum per cast column, then one row turned into many.
    """
    rows = drop_header_rows(raw, spec.sentinel)
    cast = [c for c in spec.columns if c.kind not in UNCAST]
    sums = rows.agg(*[F.count_if(is_lost(F.col(c.raw), CASTS[c.kind](F.col(c.raw)))).alias(c.name) for c in cast])
    return sums.unpivot([], [c.name for c in cast], "column", "lost")


def decode_loss_counts(
    df: DataFrame, decode: Callable[[DataFrame], DataFrame], fields: list[str]
) -> DataFrame:
    """``(column, lost)``: enum codes that no name was found for.

    ``decode`` names the codes of ``fields`` and keeps all other columns.  The codes
    ride along, so one pass sees each code beside its name.
    """
    coded = decode(df.withColumns({f"_code_{f}": F.col(f) for f in fields}))
    lost = [F.count_if(F.col(f"_code_{f}").isNotNull() & F.col(f).isNull()).alias(f) for f in fields]
    return coded.agg(*lost).unpivot([], fields, "column", "lost")
