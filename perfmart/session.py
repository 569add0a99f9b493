"""What jobs need of the session: settings for wide projections, and small results kept for later steps.

They change speed only, never results.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from perfmart.plans.reports import ReportSpec

_HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
_JIT_LIMIT = "8000"
_SPARK_DEFAULT = "65535"


def tune(spark: SparkSession, spec: ReportSpec) -> None:
    """Choose how a report's projection is compiled, for the rest of the session.

    A report turns dozens of text columns into typed ones in a single projection.
    Whole-stage codegen puts them into one Java method, and HotSpot never compiles
    methods above 8000 bytes of bytecode.  With that limit Spark falls back to its
    split projections, which do get compiled.  Where the projection sits on top of
    a chain of joins the fused method is still the faster one, because it does not
    copy the wide rows at every join.
    """
    spark.conf.set(_HUGE_METHOD, _SPARK_DEFAULT if spec.lookups else _JIT_LIMIT)


@contextmanager
def tuned(spark: SparkSession, spec: ReportSpec) -> Iterator[None]:
    """:func:`tune` for the length of a job."""
    with compiled(spark):
        tune(spark, spec)
        yield


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Split projections that HotSpot compiles, for jobs whose rows are narrow wherever they are joined."""
    before = spark.conf.get(_HUGE_METHOD)
    spark.conf.set(_HUGE_METHOD, _JIT_LIMIT)
    try:
        yield
    finally:
        spark.conf.set(_HUGE_METHOD, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, worked out once and kept in the checkpoint folder, which all executors share.

    That is the folder of ``spark.checkpoint.dir``.  Without it a local session takes a
    temporary one, and any other works ``df`` out anew each time.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master != "local" and not context.master.startswith("local["):
            return df
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="perfmart-"))
    return df.checkpoint()
