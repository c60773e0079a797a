"""Append-once loads of raw order files into bronze.

A load is a folder ``loads/<name>`` with the bronze rows it adds (``rows``), the ledger of its files (``files``:
path, length, modificationTime) and, last, an empty marker.  A load counts once its marker is there, so one
that fails leaves nothing behind that a reader sees, and can be repeated.  A file that a finished load has, with the
same size and time, is not loaded again.  One loader runs at a time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from kpiforge.session import child_names, drop_path, path_exists, touch
from kpiforge.schemas import BRONZE
from kpiforge.sources.csv_ingest import source_files, stage_orders_csv, to_bronze
from kpiforge.sources.tables import STORED

LOADS, READY = "loads", "READY"
_FILES = "path string, length long, modificationTime timestamp"


def finished_loads(spark: SparkSession, root: str) -> list[str]:
    """Folders of the finished loads, oldest first."""
    folder = f"{root.rstrip('/')}/{LOADS}"
    return [f"{folder}/{n}" for n in child_names(spark, folder) if path_exists(spark, f"{folder}/{n}/{READY}")]


def _stored(spark: SparkSession, root: str, part: str, schema) -> DataFrame:
    loads = finished_loads(spark, root)
    if not loads:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{load}/{part}" for load in loads))


def loaded_files(spark: SparkSession, root: str) -> DataFrame:
    """The ledger: every file of a finished load."""
    return _stored(spark, root, "files", _FILES)


def loaded_bronze(spark: SparkSession, root: str) -> DataFrame:
    """The bronze rows of all finished loads."""
    return _stored(spark, root, "rows", BRONZE)


def new_files(spark: SparkSession, path: str | list[str], root: str) -> DataFrame:
    """Files of ``path`` that no finished load has."""
    return source_files(spark, path).join(loaded_files(spark, root), ["path", "length", "modificationTime"], "left_anti")


def load_new_files(spark: SparkSession, path: str | list[str], root: str, multiline: bool = True, mode: str = "row") -> str | None:
    """Append the rows of the files that are new; the load's folder, or None where there are none."""
    load = f"{root.rstrip('/')}/{LOADS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        new_files(spark, path, root).write.parquet(f"{load}/files")
        files = spark.read.schema(_FILES).parquet(f"{load}/files")
        if files.isEmpty():
            drop_path(spark, load)
            return None
        rows = stage_orders_csv(spark, files, f"{load}/staged", multiline)
        to_bronze(rows, mode=mode).write.options(**STORED).parquet(f"{load}/rows")
        drop_path(spark, f"{load}/staged")
    except BaseException:
        drop_path(spark, load)
        raise
    touch(spark, f"{load}/{READY}")
    return load
