"""Spark session defaults and shared scratch space.

The engine never writes to a machine-local temporary folder: intermediate
files go under the shared folder the cluster names in ``spark.checkpoint.dir``,
or, where that is unset and Spark runs in one process, inside the session's warehouse directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators are designed around (AQE re-plans joins from runtime
# sizes, splits skewed partitions and coalesces small ones).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# defaults for sessions this package creates itself (not forced on a caller's)
SESSION_DEFAULTS = {"spark.sql.session.timeZone": "UTC"}


def get_spark(master: str | None = None, app: str = "kpiforge", shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the engine's defaults; whatever is not passed is left to the submit settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_DEFAULTS, **ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def conf_bytes(spark: SparkSession, key: str) -> int:
    """A size among the session's settings, in bytes; below 0 where it is switched off."""
    text = spark.conf.get(key).strip()
    return -1 if text.startswith("-") else spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


@contextmanager
def scan_splits(spark: SparkSession, most: int) -> Iterator[None]:
    """Scans that run inside give a task at most so many bytes of files (fewer where the session says so)."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(conf_bytes(spark, key), most)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` names it.  Where that is unset and the master is local, a folder inside the session's
    warehouse directory is used.  On a cluster that directory may be the driver's own, so the setting is needed there."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/kpiforge_scratch"
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote, wherever it is stored."""
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what lies in a folder (none where it does not exist)."""
    fs, target = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file: one atomic step in every store."""
    fs, target = _hadoop(spark, path)
    fs.create(target, True).close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/kpiforge-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["get_spark", "apply_engine_conf", "child_names", "conf_bytes", "drop_path", "ensure_checkpoint_dir", "local_path", "path_exists",
           "scan_splits", "scratch_path", "touch"]
