"""Exact positions in an order, for groups of any size.

Rows are range partitioned and sorted by (group, order), counted inside each partition, and the counts
of the partitions before are added.  A group that holds a third of all rows is spread over many
partitions like any other rows; no window or task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kpiforge.llm.text import store


def _count_up(column: int):
    """Rows sorted by the column: append each row's place among the partition's rows of its value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            value = batch.column(column)
            change = np.r_[True, pc.not_equal(value.slice(1), value.slice(0, n - 1)).to_numpy(zero_copy_only=False)]
            starts = np.flatnonzero(change)
            place = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
            if value[0].as_py() == last:
                place[:starts[1] if len(starts) > 1 else n] += seen
            last, seen = value[n - 1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "__place"])
    return run


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``__pos`` (from 0 in its group, by ``order``) and ``__rows`` (the group's rows).

    ``group`` has no nulls; rows that are equal in ``order`` get their positions in any order, so
    ``order`` ends with what tells the rows apart.
    """
    spread = (df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
              .withColumn("__part", F.spark_partition_id()))
    counted = store(spread.mapInArrow(_count_up(spread.columns.index(group)), StructType(
        [*spread.schema.fields, StructField("__place", LongType())])), "places")
    # one row per group and partition
    counts = counted.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__count"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "__part", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"),
                           F.sum("__count").over(whole).alias("__rows"))
    return counted.join(counts, [group, "__part"]).select(
        *df.columns, (F.col("__before") + F.col("__place")).alias("__pos"), "__rows")
