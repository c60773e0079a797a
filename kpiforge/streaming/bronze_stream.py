"""Landing folder of raw order CSV files -> bronze table, incrementally."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kpiforge.sources.csv_ingest import normalize_columns, to_bronze


def raw_header_schema(spark: SparkSession, landing_dir: str, pattern: str = "*.csv") -> T.StructType:
    """All-string schema of the raw header (read from the files present now).

    A streaming file source needs its schema up front; the raw header is the
    contract of the feed, so it is taken from the first files once."""
    header = (spark.read.option("header", True).option("inferSchema", False)
              .option("pathGlobFilter", pattern).csv(landing_dir))
    return T.StructType([T.StructField(c, T.StringType(), True) for c in header.columns])


def bronze_stream(spark: SparkSession, landing_dir: str, schema: T.StructType | None = None,
                  pattern: str = "*.csv", max_files_per_trigger: int | None = None,
                  mode: str = "row") -> DataFrame:
    """Streaming bronze rows of the CSV files arriving in ``landing_dir``."""
    schema = schema or raw_header_schema(spark, landing_dir, pattern)
    reader = (spark.readStream.schema(schema).option("header", True)
              # a file whose header differs from the feed's stops the load instead of shifting its columns
              .option("enforceSchema", False)
              .option("multiLine", True).option("escape", '"')
              .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return to_bronze(normalize_columns(reader.csv(landing_dir)), mode=mode)


def start_bronze_ingest(spark: SparkSession, landing_dir: str, bronze_path: str,
                        checkpoint: str, available_now: bool = True, **kw) -> StreamingQuery:
    """Append new landing files to the bronze Parquet table.

    ``checkpoint`` must be in shared storage; with ``available_now`` the query
    processes everything that has arrived and stops (a scheduled load)."""
    writer = (bronze_stream(spark, landing_dir, **kw).writeStream
              .format("parquet").option("path", bronze_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
