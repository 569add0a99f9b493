"""Split of a lookback window into equal date ranges, counted back from the run date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.plans.reports import Window


def window_bounds(run_date: str, lookback: int, inclusive_start: bool = False) -> tuple[str, str]:
    """First and last date of a window of ``lookback`` days ending on the run date.

    ``inclusive_start`` adds the day before.  The original load used that longer
    window for carrying rows while fetching only the shorter one, and so lost the
    fresh accounts' rows of that day whenever it carried any other.
    """
    day = dt.date.fromisoformat(run_date)
    back = lookback if inclusive_start else lookback - 1
    return (day - dt.timedelta(days=back)).isoformat(), run_date


def run_date_of(schedule_date: str, lag_days: int) -> str:
    """Run date of a report that is fetched some days late."""
    return (dt.date.fromisoformat(schedule_date) - dt.timedelta(days=lag_days)).isoformat()


def chunk_days(lookback: int, tasks: int, chunks: int) -> int:
    """Days per chunk; the window must divide evenly, or dates would be split."""
    if lookback <= 0 or tasks <= 0 or chunks <= 0 or lookback % (tasks * chunks):
        raise ValueError(f"{lookback} days do not divide into {tasks} x {chunks} ranges")
    return lookback // (tasks * chunks)


def lookback_of(window: Window) -> int:
    """Days covered by a report's fetch window."""
    return window.tasks * window.days


def date_chunks(
    spark: SparkSession, run_date: str, lookback: int, tasks: int, chunks: int
) -> DataFrame:
    """``(task, chunk, start, end)``: the date range that each chunk covers."""
    days = chunk_days(lookback, tasks, chunks)
    run = F.lit(run_date).cast("date")
    back = (F.col("id") * days).cast("int")
    return spark.range(tasks * chunks).select(
        F.floor(F.col("id") / chunks).cast("int").alias("task"),
        F.pmod("id", F.lit(chunks)).cast("int").alias("chunk"),
        F.date_sub(run, back + F.lit(days - 1)).alias("start"),
        F.date_sub(run, back).alias("end"),
    )


def assign_chunks(
    df: DataFrame, date_col: str, run_date: str, lookback: int, tasks: int, chunks: int
) -> DataFrame:
    """Add ``task`` and ``chunk`` to every row dated inside the window, NULL outside.

    The ranges are equal and adjoining, so the position follows from the distance
    to the run date; no range join is needed.
    """
    days = chunk_days(lookback, tasks, chunks)
    back = F.datediff(F.lit(run_date).cast("date"), F.col(date_col).try_cast("date"))
    place = F.when(back.between(0, lookback - 1), F.floor(back / days))
    return df.withColumns(
        {
            "task": F.floor(place / chunks).cast("int"),
            "chunk": F.pmod(place, F.lit(chunks)).cast("int"),
        }
    )
