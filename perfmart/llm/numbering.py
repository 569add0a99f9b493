"""Numbers for rows without a task that sees them all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.llm.shared import staged

PLACE = [T.StructField("_part", T.IntegerType()), T.StructField("_nth", T.LongType())]


def places(first: int, rows: int) -> list[pa.Array]:
    """The columns `_part` and `_nth`: the running task, and `rows` numbers from `first` on."""
    return [pa.array(np.full(rows, TaskContext.get().partitionId(), np.int32)), pa.array(np.arange(first, first + rows))]


def numbered(rows: DataFrame, order: list, name: str, number: str) -> DataFrame:
    """`rows` (read more than once, so best staged) with `number`: 1, 2, 3, ... by `order`.

    Rows are dealt by ranges of `order`, numbered in their task as they come, and offset by
    the sizes of the tasks before.  Where `order` tells all rows apart, no value of it can
    make a task larger than others; the only thing gathered is a count for each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 1
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *places(first, batch.num_rows)], [*names, "_in", "_at"])
            first += batch.num_rows

    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("_in", T.IntegerType()), T.StructField("_at", T.LongType())])
    dealt = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(count, schema), name)
    before = Window.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_in").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_in", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return dealt.join(F.broadcast(offsets), "_in").withColumn(number, F.col("_before") + F.col("_at")).select(*names, number)
