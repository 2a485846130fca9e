"""Running totals over a whole table in a given order, without a single-task sort.

The rows are range-partitioned by the order and sorted inside each partition;
a task adds up its own rows in passing, and one offset per partition (a table as
long as the number of partitions) is added afterwards. The ranges are drawn
from a sample, so the placed rows are written before anything reads them twice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from trip_star.llm.common import materialise, partitions

_PART, _VALUE = "__running_part", "__running_value"


def _add_up(batches):
    total = 0
    for batch in batches:
        value = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        upto = np.cumsum(value, dtype=np.int64)
        before = pa.array(total + upto - value, pa.int64())
        total += int(upto[-1]) if len(upto) else 0
        yield pa.RecordBatch.from_arrays([*batch.columns, before], names=[*batch.schema.names, "__before"])


def running_total(df: DataFrame, order: Sequence[Column], value: Column, out_col: str) -> DataFrame:
    """``df`` plus ``out_col``: the sum of ``value`` (longs, none null) over all rows
    that come earlier in ``order``, which must tell the rows apart to be
    repeatable. With ``value`` 1 it is a dense 0-based number."""
    spark = df.sparkSession
    spread = (
        df.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumns({_PART: F.spark_partition_id(), _VALUE: value.cast("long")})
    )
    schema = StructType([*spread.schema.fields, StructField("__before", LongType())])
    placed = materialise(spread.mapInArrow(_add_up, schema), f"running-{out_col}")
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(_PART).agg(F.sum(_VALUE).alias("__sum"))
    offsets = sums.select(F.col(_PART).alias("__of"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    joined = placed.join(F.broadcast(offsets), F.col(_PART) == F.col("__of"))  # one row per partition
    return joined.withColumn(out_col, F.col("__offset") + F.col("__before")).drop(_PART, _VALUE, "__of", "__offset", "__before")
