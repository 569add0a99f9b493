"""Readers.  Every reader declares its schema: nothing is inferred from the files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.plans.reports import ReportSpec


def _read(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Parquet at ``path``, or no rows where nothing has been written yet.

    Without a schema Spark would read the partition column as a date.
    """
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, spec: ReportSpec, path: str, run_date: str) -> DataFrame:
    """One run of a raw extract; a run without a partition has no rows."""
    return _read(spark, spec.raw_schema, path).where(F.col("data_date") == run_date)


def read_mart(spark: SparkSession, spec: ReportSpec, path: str) -> DataFrame:
    """A published table; callers restrict ``data_date`` to prune its partitions."""
    return _read(spark, spec.schema, path)


def read_location_dims(
    spark: SparkSession, paths: dict[str, str], id_type: str = "bigint"
) -> dict[str, DataFrame]:
    """The location dimensions ``(id, cannonicalname)`` by level."""
    schema = f"id {id_type}, cannonicalname string"
    return {level: spark.read.schema(schema).parquet(path) for level, path in paths.items()}


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """The account list ``(account_id, status)``."""
    return spark.read.schema("account_id string, status string").parquet(path)


#: The text of a record that could not be parsed; NULL in all others.
BAD_RECORD = "_bad_record"


def read_records(
    spark: SparkSession, schema: T.StructType | str, path: str, source: str = "json", keep_bad: bool = False
) -> DataFrame:
    """Nested report records: JSON objects, one per line, or files of another source.

    From Parquet only the nested fields in use are read, and conditions on them reach the scan.
    With ``keep_bad`` the text of a broken JSON line is kept in ``BAD_RECORD``, so that it
    can be counted and left out; else such a line is a record without values.
    """
    reader = spark.read.format(source)
    if keep_bad:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.schema(schema).load(path)
