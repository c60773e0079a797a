"""Table sinks and scans (Parquet).

* ``write_table``: full refresh (``overwrite``), create-if-absent (``ignore``)
  or ``append``; rows sorted inside each file on the table's sort key so the
  Parquet row-group min/max statistics give data skipping on that key.
* ``write_by_month``: a dated table partitioned by month (``order_month`` =
  ``yyyyMM`` as int) so a date-range read only lists the matching folders: the fact and silver.
* statistics beside a table: values that ``write_table`` observes while it writes (``table_stats`` reads
  them), so that a later query need not scan the table for its last date.
* ``load`` / ``load_fact``: scans; ``load_fact(start, end)`` derives the month
  range from the dates so partition pruning happens (Spark cannot infer
  ``order_month`` from a predicate on ``order_date``); ``load_latest_month``
  prunes to the newest month with a run-time scalar subquery.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kpiforge.session import scan_splits

FACT_PARTITION = "order_month"
STATS = "table_stats"
LEAST_ROWS_PER_FILE, MOST_ROWS_PER_FILE = 50_000, 4_000_000
# zstd takes 0.7 of snappy's bytes; a row group is the least that a task can read, so a file is as many tasks' work
STORED = {"compression": "zstd", "parquet.block.size": str(16 << 20)}
# bytes of files that a task sorts without a shuffle: about a million rows, whose sort fits a task's memory
BRONZE_SPLIT, FACT_SPLIT = 16 << 20, 32 << 20


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_table(df: DataFrame, root: str, name: str, sort: list[str] | None = None,
                mode: str = "overwrite", partition_by: list[str] | None = None, rows_per_file: int | None = None,
                stats: dict[str, Column] | None = None) -> str:
    """Write ``df`` as table ``name`` under ``root``; returns its path.

    With ``partition_by`` the partition columns lead the in-file sort: that is
    the order the partitioned writer needs, so it adds no sort of its own.
    ``rows_per_file`` bounds the files, so that a table from few tasks is read by many, without a shuffle.
    ``stats``: least or greatest values to keep beside the table; they are observed while it is written (and stay
    right where a task runs twice, as counts or sums would not)."""
    keys = [*(partition_by or []), *(sort or [])]
    seen = Observation() if stats else None
    if stats:
        df = df.observe(seen, *(c.alias(k) for k, c in stats.items()))
    out = df.sortWithinPartitions(*keys) if keys else df
    w = out.write.mode(mode).options(**STORED)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    path = table_path(root, name)
    w.parquet(path)
    if stats:
        one = df.sparkSession.range(1).select(*(F.lit(seen.get[k]).cast(df.select(c.alias(k)).schema[k].dataType).alias(k)
                                                for k, c in stats.items()))
        one.coalesce(1).write.mode("overwrite").parquet(table_path(f"{root.rstrip('/')}/{STATS}", name))
    return path


def table_stats(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The one row of values that ``write_table`` observed of a table."""
    return spark.read.parquet(table_path(f"{root.rstrip('/')}/{STATS}", name))


def file_rows(spark: SparkSession, rows: int) -> int:
    """Rows per file of a table of so many rows: a file per core, but neither tiny nor huge ones."""
    wanted = -(-rows // spark.sparkContext.defaultParallelism)
    return min(max(wanted, LEAST_ROWS_PER_FILE), MOST_ROWS_PER_FILE)


def with_order_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(FACT_PARTITION, month_number(F.col("order_date")))


def write_bronze(df: DataFrame, root: str, name: str, sort: list[str], mode: str = "overwrite", stored: bool = False) -> str:
    """All columns of all raw rows, its files sorted by ``sort``.

    Rows of a ``stored`` table are sorted as they are read, in splits of bounded size, without a shuffle.  For others
    ``rebalance`` on the sort key makes tasks of advisory size, so that each sorts in memory whatever a scan's split
    holds (128 MB of Parquet are 4 million rows and 2 GB of them in a sort); rows of an order travel together, as they
    compress."""
    if stored:
        with scan_splits(df.sparkSession, BRONZE_SPLIT):
            return write_table(df, root, name, sort=sort, mode=mode)
    return write_table(df.hint("rebalance", *sort), root, name, sort=sort, mode=mode)


def write_by_month(df: DataFrame, root: str, name: str, sort: list[str], mode: str = "overwrite") -> str:
    """A table with ``order_date`` in month folders, its files sorted by ``sort`` (which starts with the date).

    ``rebalance`` on the month groups rows by month folder (few files per
    folder instead of every task writing into every month), and AQE splits a
    large month into advisory-sized tasks instead of sending a whole month --
    1/80 of the table -- to one writer.
    """
    return write_table(with_order_month(df).hint("rebalance", FACT_PARTITION), root, name, sort=sort,
                       mode=mode, partition_by=[FACT_PARTITION])


def write_fact(fact: DataFrame, root: str, name: str = "fact_sales", mode: str = "overwrite", by_month: bool = False) -> str:
    """Month-partitioned fact; files sorted by (order_date, order_id, customer_id, product_id).

    ``by_month``: the rows are read from files of one month each (stored silver).  A task then has few months and
    writes them as it reads them, without a shuffle."""
    sort = ["order_date", "order_id", "customer_id", "product_id"]
    if by_month:
        with scan_splits(fact.sparkSession, FACT_SPLIT):
            return write_table(with_order_month(fact), root, name, sort=sort, mode=mode, partition_by=[FACT_PARTITION])
    return write_by_month(fact, root, name, sort, mode)


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, name))


def month_number(d: Column) -> Column:
    """``yyyyMM`` of a date, as the fact's partition column has it."""
    return F.date_format(d, "yyyyMM").cast("int")


def _yyyymm(d: dt.date | str) -> int:
    d = dt.date.fromisoformat(d) if isinstance(d, str) else d
    return d.year * 100 + d.month


def load_fact(spark: SparkSession, root: str, start: dt.date | str | None = None,
              end: dt.date | str | None = None, name: str = "fact_sales") -> DataFrame:
    """Fact rows with ``start <= order_date <= end``; prunes month folders."""
    df = load(spark, root, name)
    if start is not None:
        df = df.where((F.col(FACT_PARTITION) >= _yyyymm(start)) & (F.col("order_date") >= F.lit(start).cast("date")))
    if end is not None:
        df = df.where((F.col(FACT_PARTITION) <= _yyyymm(end)) & (F.col("order_date") <= F.lit(end).cast("date")))
    return df


def load_latest_month(spark: SparkSession, root: str, name: str = "fact_sales") -> DataFrame:
    """Fact rows of the latest month (the dashboard's default month).

    The month is a scalar subquery over the partition column, placed in the
    scan's partition filter: Spark evaluates it at run time and lists only
    that month's folder -- pruning without a driver round trip."""
    fact = load(spark, root, name)
    latest = fact.agg(F.max(FACT_PARTITION)).scalar()
    return fact.where(F.col(FACT_PARTITION) == latest)
