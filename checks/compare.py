"""Run catalogue queries on Spark and on DuckDB and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.queries import ORACLE, QUERIES


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("perfmart")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        # Values as Python prints them; a missing value of any kind is 'NULL'.
        values = out[c].astype(object)
        values = values.where(values.notna(), None)
        if pd.api.types.is_datetime64_any_dtype(out[c]):
            values = out[c].dt.strftime("%Y-%m-%d").where(out[c].notna(), None)
        elif pd.api.types.is_integer_dtype(out[c]):
            values = out[c].astype("Int64").astype(object)
        out[c] = [
            "NULL" if v is None or v is pd.NaT or v is pd.NA or v != v else repr(float(v)) if isinstance(v, float) else str(v)
            for v in values
        ]
    return out.sort_values(list(out.columns), ignore_index=True)


def _integral_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("long", "integer")]


def differences(spark: SparkSession, con, folder: str, name: str) -> str | None:
    """What differs between both engines, or None."""
    result = QUERIES[name](spark, folder)
    ours = result.toPandas()
    theirs = con.execute(ORACLE[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for c in _integral_columns(result):
        # A NULL makes pandas hold integers as floats.
        ours[c], theirs[c] = ours[c].astype("Int64"), theirs[c].astype("Int64")
    a, b = _normal(ours), _normal(theirs)
    for c in a.columns:
        wrong = a[c] != b[c]
        if wrong.any():
            i = wrong.idxmax()
            return f"{wrong.sum()} values of {c}, first {a[c][i]!r} and {b[c][i]!r}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark, con = local_session(), oracle_connection(folder)
    failed = 0
    for name in names or list(QUERIES):
        began = time.monotonic()
        try:
            if name in ORACLE:
                problem = differences(spark, con, folder, name)
            else:
                problem = None
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{time.monotonic() - began:6.1f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
