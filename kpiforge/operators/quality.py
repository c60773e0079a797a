"""Data-quality checks.

``dq_checks`` computes the six counts of the warehouse's validation step with
one aggregate pass per table (counts and ``count_if`` side by side) and turns
the single wide row into (check_name, value) rows with ``unpivot``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- FIXED VALUES: data-quality check names, in the order they are reported ---
DQ_CHECKS = [
    "bronze_rows",
    "silver_rows",
    "fact_sales_rows",
    "null_order_id_in_silver",
    "invalid_quantity_in_silver",
    "negative_revenue_in_silver",
]


def dq_checks(bronze: DataFrame, silver: DataFrame, fact: DataFrame) -> DataFrame:
    """(check_name, value) rows: one aggregate pass per table, unpivoted, unioned."""
    def checks(df: DataFrame, cols: list[F.Column]) -> DataFrame:
        one = df.agg(*cols)
        return one.select(*[F.col(c).cast("bigint") for c in one.columns]) \
            .unpivot([], one.columns, "check_name", "value")

    parts = [
        checks(bronze, [F.count(F.lit(1)).alias("bronze_rows")]),
        checks(silver, [
            F.count(F.lit(1)).alias("silver_rows"),
            F.count_if(F.col("order_id").isNull() | (F.col("order_id") == "")).alias("null_order_id_in_silver"),
            F.count_if(F.col("quantity") <= 0).alias("invalid_quantity_in_silver"),
            F.count_if(F.col("revenue") < 0).alias("negative_revenue_in_silver"),
        ]),
        checks(fact, [F.count(F.lit(1)).alias("fact_sales_rows")]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _runs(keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (file, at, key columns) -> a row per run of rows that follow each other in one file."""
    def greater(a: list[pa.Array], b: list[pa.Array]) -> pa.Array:
        """Row by row: a > b, column after column, null the least (as Spark compares structs)."""
        more = pc.or_(pc.and_(pc.is_valid(a[0]), pc.is_null(b[0])), pc.fill_null(pc.greater(a[0], b[0]), False))
        if len(a) == 1:
            return more
        same = pc.or_(pc.and_(pc.is_null(a[0]), pc.is_null(b[0])), pc.fill_null(pc.equal(a[0], b[0]), False))
        return pc.or_(more, pc.and_(same, greater(a[1:], b[1:])))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            file, at, *key = batch.columns
            places = at.to_numpy(zero_copy_only=False)
            other = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            breaks = other | (places[1:] != places[:-1] + 1)
            below = greater([k[:-1] for k in key], [k[1:] for k in key]).to_numpy(zero_copy_only=False) & ~breaks
            starts = np.concatenate(([0], np.flatnonzero(breaks) + 1))
            ends = np.concatenate((starts[1:] - 1, [batch.num_rows - 1]))
            yield pa.RecordBatch.from_arrays(
                [file.take(pa.array(starts)), pa.array(places[starts]), pa.array(places[ends] + 1), pa.array(ends + 1 - starts),
                 pa.array(np.add.reduceat(np.concatenate(([0], below.astype(np.int64))), starts)),
                 *(k.take(pa.array(i)) for i in (starts, ends) for k in key)],
                ["file", "at", "next", "rows", "out_of_order", *(f"{end}{i}" for end in ("first", "last") for i in range(keys))])
    return runs


def rows_out_of_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: the rows of a scan, and how many of them come before the row above them in their file, by ``keys``.

    A task compares the rows that it reads next to each other; between tasks only the first and last row of each run
    of rows are compared, so no row is shuffled."""
    typed = rows.select(*keys).schema
    ends = ", ".join(f"{end}{i} {typed[k].dataType.simpleString()}" for end in ("first", "last") for i, k in enumerate(keys))
    placed = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), *keys)
    runs = placed.mapInArrow(_runs(len(keys)), f"file string, at long, next long, rows long, out_of_order long, {ends}")
    ends_of = lambda end: F.struct(*(F.col(f"{end}{i}").alias(f"k{i}") for i in range(len(keys))))
    # each run, and under the place after it its last row
    places = runs.select(F.explode(F.array(
        F.struct("file", "at", "rows", "out_of_order", ends_of("first").alias("first"), F.lit(None).cast(_ends_type(typed, keys)).alias("last")),
        F.struct("file", F.col("next").alias("at"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("out_of_order"),
                 F.lit(None).cast(_ends_type(typed, keys)).alias("first"), ends_of("last").alias("last")))).alias("p")).select("p.*")
    met = places.groupBy("file", "at").agg(F.sum("rows").alias("rows"), F.sum("out_of_order").alias("out_of_order"),
                                           F.max("first").alias("first"), F.max("last").alias("last"))
    return met.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                   (F.coalesce(F.sum("out_of_order"), F.lit(0)) + F.count_if(F.col("last") > F.col("first"))).alias("out_of_order"))


def _ends_type(typed, keys: list[str]) -> str:
    return f"struct<{', '.join(f'k{i}: {typed[k].dataType.simpleString()}' for i, k in enumerate(keys))}>"


def dq_forecast_rows(forecast: DataFrame) -> DataFrame:
    """Rows per metric, and how many of them carry a forecast value."""
    return forecast.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("forecast_value").isNotNull()).alias("forecast_rows"))


def dq_state_count(geo_daily: DataFrame) -> DataFrame:
    return geo_daily.agg(F.count_distinct("state").alias("total_states"))
