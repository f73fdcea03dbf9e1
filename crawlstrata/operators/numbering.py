"""Running totals over a global order, without putting the data in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlstrata.session import stage


def running_totals(rows: DataFrame, key: str, weight: str) -> DataFrame:
    """Adds `before` (weight of all smaller keys) and `total` to rows with distinct keys.

    The rows are range-partitioned, added up as each range streams by in order, and written once. A second pass
    adds up one number per range; only those numbers, as many as there are ranges, go through a single-task
    window and back to the tasks.
    """
    ranged = rows.withColumn(weight, F.col(weight).cast("long")).repartitionByRange(key).sortWithinPartitions(key)
    at = ranged.columns.index(weight)
    schema = ranged.withColumns({"_range": F.lit(0), "_inside": F.lit(0).cast("long")}).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), 0
        for batch in batches:
            weights = batch.column(at).to_numpy(zero_copy_only=False)
            sums = held + np.cumsum(weights)
            held = int(sums[-1]) if len(sums) else held
            added = [pa.array(np.full(len(sums), part, np.int32)), pa.array(sums - weights)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    numbered = stage(ranged.mapInArrow(add, schema))
    sums = numbered.groupBy("_range").agg(F.sum(weight).alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_range",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    # One row per range: never more than there are shuffle partitions.
    return numbered.join(F.broadcast(offsets), "_range").select(
        *rows.columns, (F.col("_offset") + F.col("_inside")).alias("before"), "total"
    )
