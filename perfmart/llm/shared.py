"""What the operators share: words, local names in expressions, and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that part words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[ \t-\r]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words(text: Column) -> Column:
    """The maximal runs of other characters than BLANKS; an empty array for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, also where `body` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="perfmart-")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    It cuts the lineage and keeps what several readers need; a lost executor costs only
    its running tasks.  The shuffle files of the write go when it is done, since nothing
    reads them again.  The folder belongs to the run, and whoever owns the shared folder
    clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def plain_names(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with every column but those of `used` renamed, and what gives a result of it the old columns back.

    Whatever an operator adds on the way, it meets no name of the table's own.
    """
    names = [c if c in used else f"column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda out: out.select(*names).toDF(*docs.columns)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
