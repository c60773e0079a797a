"""Full warehouse refresh: bronze -> silver -> star schema -> marts -> forecast.

``refresh_warehouse`` builds every table in a version folder of its own and makes that version current in one step,
with an empty marker file: a refresh that fails at any stage leaves the tables of the version before.

Each table is written once (static overwrite: a rerun replaces, never
appends) and the next stage reads the Parquet just written, so every stage
starts from a short lineage in shared storage: a lost executor only re-runs
tasks of the current stage, never the whole chain.
"""

from __future__ import annotations

import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from kpiforge.operators.quality import dq_checks
from kpiforge.plans.warehouse import READY, VERSIONS, Warehouse, ready_versions
from kpiforge.session import child_names, drop_path, touch
from kpiforge.sources.tables import write_bronze, write_by_month, write_fact, write_table

SORT_KEYS = {
    "bronze_orders_raw": ["order_id"],
    "silver_orders_clean": ["order_date", "order_id"],
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "dim_channel": ["channel_id"],
    "dim_time": ["date"],
    "customer_rfm": ["pseudo_customer_id"],
    "channel_performance_summary": ["channel_id"],
    "product_profitability_summary": ["product_id"],
    "sales_forecast_ready": ["sales_date"],
    "kpi_daily_snapshot": ["snapshot_date"],
    "geographic_daily_summary": ["order_date", "state"],
    "channel_monthly_summary": ["snapshot_month", "channel_name"],
    "geographic_performance_summary": ["state"],
    "sales_forecast_result": ["metric_name", "sales_date"],
}

# (stage, tables written in it); each stage reads all earlier stages back
STAGES = [
    ["silver_orders_clean"],
    ["dim_customer", "dim_product", "dim_channel", "dim_time", "fact_sales"],
    ["customer_rfm", "channel_performance_summary", "product_profitability_summary",
     "sales_forecast_ready", "kpi_daily_snapshot", "geographic_daily_summary",
     "channel_monthly_summary", "geographic_performance_summary"],
    ["sales_forecast_result"],
]


LINES_PER_TASK = 500_000


def lines_by_order(fact: DataFrame) -> DataFrame:
    """The fact's lines as the marts read them, dealt by order once and held on disk while the marts are made.

    Each mart counts the orders of its groups, which needs the lines of an order in one place: dealt by order alone,
    they are in place for every grouping.  The number of parts goes by the rows, not by the session's."""
    parts = max(fact.sparkSession.sparkContext.defaultParallelism, -(-fact.count() // LINES_PER_TASK))
    return fact.drop("cost", "discount").repartition(parts, "order_id").persist(StorageLevel.DISK_ONLY)


def run_pipeline(spark: SparkSession, bronze: DataFrame, out_root: str, stored: bool = False) -> DataFrame:
    """Build all 16 tables under ``out_root``; returns the data-quality checks.

    ``bronze`` is a bronze-shaped frame (e.g. ``to_bronze(read_orders_csv(...))``), ``stored`` where it is the scan of
    a stored table.
    """
    write_bronze(bronze, out_root, "bronze_orders_raw", SORT_KEYS["bronze_orders_raw"], stored=stored)
    done = ["bronze_orders_raw"]
    for stage in STAGES:
        wh = Warehouse.from_tables(spark, out_root, stored=done)
        held = None
        if "fact_sales" in done and "customer_rfm" in stage:
            held = lines_by_order(wh.fact)
            wh = Warehouse.from_tables(spark, out_root, stored=done, fact=held)
        try:
            for name in stage:
                if name == "fact_sales":
                    write_fact(wh.fact, out_root, by_month=True)
                elif name == "silver_orders_clean":
                    write_by_month(wh.silver, out_root, name, SORT_KEYS[name])
                else:
                    write_table(wh.table(name), out_root, name, SORT_KEYS[name])
        finally:
            if held is not None:
                held.unpersist()
        done += stage
    built = Warehouse.from_tables(spark, out_root)
    return dq_checks(built.bronze, built.silver, built.fact)


def refresh_warehouse(spark: SparkSession, bronze: DataFrame, root: str, keep: int = 2, stored: bool = False) -> Warehouse:
    """Build a new version of all 16 tables under ``root``, make it the current one, and return it.

    Readers that hold the version before can go on: the last ``keep`` finished versions stay, what is older goes."""
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    version = f"{root.rstrip('/')}/{VERSIONS}/{name}"
    try:
        run_pipeline(spark, bronze, version, stored)
    except BaseException:
        drop_path(spark, version)
        raise
    touch(spark, f"{version}/{READY}")
    kept = ready_versions(spark, root)[-keep:]
    for old in child_names(spark, f"{root.rstrip('/')}/{VERSIONS}"):
        if old < kept[0]:
            drop_path(spark, f"{root.rstrip('/')}/{VERSIONS}/{old}")
    return Warehouse.current(spark, root)
