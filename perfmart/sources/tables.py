"""Writers and table maintenance.

Path writes take the overwrite mode as a write option.  ``insertInto`` ignores
that option and would replace the whole table, so writes to catalog tables set
the session's mode around the call instead.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MODE = "spark.sql.sources.partitionOverwriteMode"

# Files that a write task holds open at once; a task with more partitions sorts the rest of its rows.
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_OPEN = 4

# About a third less on disk than the default, for paths that hold wide text.
_CODEC = "zstd"

#: Folders of a chunk among which its customers are dealt.  A rerun of some customers rewrites theirs alone.
CUSTOMER_BUCKETS = 64


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Dynamic partition overwrite for the session, restored afterwards."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


@contextmanager
def open_files(spark: SparkSession, files: int) -> Iterator[None]:
    """Let write tasks of at most so many partitions write them side by side; 0: none.

    A task otherwise sorts its rows by partition first, and wide rows spill when they are
    sorted.
    """
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, str(files))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


def cluster_for_write(df: DataFrame, *by: str) -> DataFrame:
    """Bring each partition's rows together so that it gets few, full files.

    The rebalance is adaptive: small dates are combined into one task, and a date
    that holds most of the rows is split over many.
    """
    return df.hint("rebalance", *(by or ("data_date",)))


def overwrite_partitions(
    df: DataFrame, path: str, by: str = "data_date", cluster: bool = True
) -> None:
    """Replace the partitions that ``df`` has rows for; leave the others alone.

    ``df`` may read from ``path``: the old files stay until the job commits.
    ``cluster=False`` saves the shuffle where every task holds plenty of rows of
    each partition anyway.
    """
    rows = cluster_for_write(df, by) if cluster else df
    with open_files(df.sparkSession, 0 if cluster else _OPEN):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", _CODEC)
            .partitionBy(by)
            .parquet(path)
        )


def overwrite_table(df: DataFrame, table: str, path: str, by: str = "data_date") -> None:
    """The same, as an external catalog table at ``path``; created on first use."""
    with dynamic_overwrite(df.sparkSession):
        (
            cluster_for_write(df, by)
            .write.mode("overwrite")
            .format("parquet")
            .partitionBy(by)
            .option("path", path)
            .saveAsTable(table)
        )


def insert_partitions(df: DataFrame, table: str, by: str = "data_date") -> None:
    """Insert by position into an existing table, replacing the partitions present."""
    spark = df.sparkSession
    expected = spark.table(table).columns
    if df.columns != expected or expected[-1] != by:
        raise ValueError(f"{table} takes {expected} in this order, {by} last")
    with dynamic_overwrite(spark):
        cluster_for_write(df, by).write.mode("overwrite").insertInto(table)


def publish_window(df: DataFrame, view: str, root: str, by: str = "data_date") -> None:
    """Replace the partitions that ``df`` has rows for, all at once for the readers of a view.

    The rows go to a folder of their own under ``root``.  Then one statement defines the
    catalog view anew: for each date, the load that holds it.  Whatever ends the job before
    that leaves every reader with the whole old window, and never with some dates of either.
    Conditions on the date prune folders as in a table.  Folders that no date names any
    more may be deleted once no reader is left on them.
    """
    spark, root, load = df.sparkSession, root.rstrip("/"), f"r{uuid.uuid4().hex}"
    cluster_for_write(df, by).write.partitionBy(by).parquet(f"{root}/load={load}")
    stored = spark.read.schema(f"`{by}` string").parquet(f"{root}/load={load}")
    dates = [r[by] for r in stored.distinct().collect()]
    if dates:
        _switch(spark, view, root, df.columns, by, published_loads(spark, view) | dict.fromkeys(dates, load))


def published_loads(spark: SparkSession, view: str) -> dict[str, str]:
    """Which load holds each date of a view made by :func:`publish_window`."""
    if not spark.catalog.tableExists(view):
        return {}
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:view)", args={"view": view})
    text = described.where("col_name = 'View Text'").first()["data_type"]
    return dict(re.findall(r"'([^']*)', '(r[0-9a-f]{32})'", text))


def _switch(spark: SparkSession, view: str, root: str, columns: list[str], by: str, loads: Mapping[str, str]) -> None:
    if any("'" in date for date in loads) or "`" in root:
        raise ValueError("dates and paths must not hold quotes")
    shown = ", ".join(f"CAST(`{c}` AS STRING) AS `{c}`" if c == by else f"`{c}`" for c in columns)
    held = ", ".join(f"'{date}', '{load}'" for date, load in sorted(loads.items()))
    name = ".".join(f"`{part}`" for part in view.split("."))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM parquet.`{root}` WHERE load = map({held})[CAST(`{by}` AS STRING)]")


def add_partition(spark: SparkSession, table: str, value: str, by: str = "data_date") -> None:
    """Register a partition of a catalog table unless it is there."""
    spark.sql(
        "ALTER TABLE IDENTIFIER(:table) ADD IF NOT EXISTS PARTITION "
        f"(`{by.replace('`', '``')}` = :value)",
        args={"table": table, "value": value},
    )


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register the partitions found under a catalog table's path."""
    spark.catalog.recoverPartitions(table)


def customer_bucket(customer: Column, buckets: int = CUSTOMER_BUCKETS) -> Column:
    """Bucket of a customer, given as text."""
    return F.pmod(F.xxhash64(customer), F.lit(buckets)).cast("int")


def _bucket(customer: str | None, buckets: int) -> Column:
    return F.lit(0) if customer is None else customer_bucket(F.col(customer), buckets)


def write_run(
    df: DataFrame,
    path: str,
    run_date: str,
    customer: str | None = None,
    buckets: int = CUSTOMER_BUCKETS,
    cluster: bool = True,
) -> None:
    """Replace one run of a raw extract, each chunk in few, full files.

    ``df`` has a ``chunk`` column, the part of the run that fetched the row.  With the
    column ``customer`` a chunk's customers are dealt into buckets, so that some of them
    can be replaced later.  The run's folder is overwritten as a whole, so a rerun never
    leaves old rows, even where it fetches nothing.  ``cluster=False`` is for rows that were
    dealt by chunk and :func:`customer_bucket` while they were narrow: the text rows of a report are
    several times as wide as what they are made of, and are then not shuffled.
    """
    rows = df.drop("data_date").withColumn("bucket", _bucket(customer, buckets))
    if cluster:
        rows = cluster_for_write(rows, "chunk", "bucket")
    with open_files(df.sparkSession, 0 if cluster else _OPEN):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", _CODEC)
            .partitionBy("chunk", "bucket")
            .parquet(_run_path(path, run_date))
        )


def write_chunk(
    df: DataFrame, path: str, run_date: str, chunk: str, customer: str | None = None, buckets: int = CUSTOMER_BUCKETS
) -> None:
    """Replace what one chunk fetched in a run, and nothing else of the run."""
    (
        df.drop("data_date", "chunk")
        .withColumn("bucket", _bucket(customer, buckets))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("bucket")
        .parquet(_chunk_path(path, run_date, chunk))
    )


def replace_customers(
    df: DataFrame, path: str, run_date: str, chunk: str, customer: str, buckets: int = CUSTOMER_BUCKETS
) -> None:
    """Replace what one chunk fetched for the customers that ``df`` has rows of.

    All other customers keep their rows, and those of other buckets their files.  A
    customer whose fetch came back empty has no row in ``df`` and keeps what it had.
    Only the buckets in question are read, at most ``buckets`` numbers reach the driver,
    and their old files stay until the new ones are committed.  ``buckets`` must be that
    of the run.
    """
    where = _chunk_path(path, run_date, chunk)
    fresh = df.drop("data_date", "chunk").withColumn("bucket", _bucket(customer, buckets))
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
    if not touched:
        return
    again = fresh.select(F.col(customer).alias("_customer")).distinct()
    try:
        stored = df.sparkSession.read.schema(fresh.schema).parquet(where).where(F.col("bucket").isin(touched))
        kept = stored.join(again, stored[customer].eqNullSafe(again["_customer"]), "left_anti")
        rows = kept.select(*fresh.columns).union(fresh)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = fresh
    overwrite_partitions(rows, where, "bucket")


def clear_run(spark: SparkSession, schema: T.StructType, path: str, run_date: str) -> None:
    """Remove all rows of one run of a raw extract."""
    empty = spark.createDataFrame([], schema).withColumn("chunk", F.lit(""))
    write_run(empty, path, run_date)


def _run_path(path: str, run_date: str) -> str:
    return f"{path.rstrip('/')}/data_date={run_date}"


def _chunk_path(path: str, run_date: str, chunk: str) -> str:
    return f"{_run_path(path, run_date)}/chunk={chunk}"
