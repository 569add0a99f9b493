"""A folder for the tables that write queries make."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="perfmart-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may lack the setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
