"""The warehouse as a graph of lazy DataFrames.

``Warehouse`` names every table of the bronze -> silver -> gold chain.  Each
table is either *stored* (a Parquet scan of a folder written by
``run_pipeline``) or *derived* (a lazy plan over the tables it depends on,
which Catalyst prunes per query).  ``from_testdata`` / ``from_csv`` derive
everything from a bronze frame; ``from_tables`` reads everything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.operators import forecast as fc
from kpiforge.operators import marts as M
from kpiforge.operators import star as S
from kpiforge.operators.semantic import DATASET_DATES, Period, during, latest_month
from kpiforge.operators.silver import silver_orders
from kpiforge.plans import views as V
from kpiforge.sources.csv_ingest import read_orders_csv, to_bronze
from kpiforge.session import child_names, path_exists
from kpiforge.sources.tables import FACT_PARTITION, load, table_stats
from kpiforge.sources.testdata import BRONZE_TABLE, land_bronze

TABLES = [
    "bronze_orders_raw", "silver_orders_clean", "dim_customer", "dim_product", "dim_channel",
    "dim_time", "fact_sales", "customer_rfm", "channel_performance_summary",
    "product_profitability_summary", "sales_forecast_ready", "kpi_daily_snapshot",
    "geographic_daily_summary", "channel_monthly_summary", "geographic_performance_summary",
    "sales_forecast_result",
]

VIEWS = [
    "vw_revenue_by_category", "vw_revenue_by_sub_category", "vw_top_products_by_revenue",
    "vw_channel_performance", "vw_customer_segment_distribution", "vw_geographic_performance",
    "vw_kpi_monthly_status", "vw_kpi_daily_comparison", "vw_monthly_channel_revenue",
    "vw_top_states_revenue",
]

# what each view is made from
VIEW_DEPS = {
    "vw_revenue_by_category": ("fact", "dim_product"),
    "vw_revenue_by_sub_category": ("fact", "dim_product"),
    "vw_top_products_by_revenue": ("fact", "dim_product"),
    "vw_channel_performance": ("fact", "dim_channel"),
    "vw_customer_segment_distribution": ("customer_rfm",),
    "vw_geographic_performance": ("silver",),
    "vw_kpi_monthly_status": ("fact",),
    "vw_kpi_daily_comparison": ("fact",),
    "vw_monthly_channel_revenue": ("fact", "dim_channel"),
    "vw_top_states_revenue": ("silver",),
}


# versions of a stored warehouse: root/versions/<name>/<table>; a version counts once its marker is there
VERSIONS, READY = "versions", "READY"


def ready_versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the finished versions, oldest first."""
    folder = f"{root.rstrip('/')}/{VERSIONS}"
    return [v for v in child_names(spark, folder) if path_exists(spark, f"{folder}/{v}/{READY}")]


def _no_bronze() -> DataFrame:
    raise ValueError("warehouse has no bronze source")


class Warehouse:
    def __init__(self, spark: SparkSession, bronze: DataFrame | None = None,
                 root: str | None = None, stored: Iterable[str] = (), last_date: DataFrame | None = None):
        self.spark = spark
        self._last_date = last_date  # one row: the last order date, where statistics have it
        self.root = root
        self._stored = set(stored)
        self._cache: dict[str, DataFrame] = {}
        if bronze is not None:
            self._cache["bronze_orders_raw"] = bronze

    # ----------------------------------------------------------- builders
    @classmethod
    def from_bronze(cls, spark: SparkSession, bronze: DataFrame) -> "Warehouse":
        return cls(spark, bronze=bronze)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str):
        root = land_bronze(spark, sf_dir)
        return cls(spark, bronze=load(spark, root, BRONZE_TABLE), last_date=table_stats(spark, root, BRONZE_TABLE).select("last_date"))

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str | list[str], encoding: str | None = None,
                 multiline: bool = True):
        return cls(spark, bronze=to_bronze(read_orders_csv(spark, path, encoding, multiline)))

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, stored: Iterable[str] = TABLES, fact: DataFrame | None = None):
        """``fact``: the stored fact's rows, held in another way."""
        wh = cls(spark, root=root, stored=stored)
        if fact is not None:
            wh._cache["fact_sales"] = fact
        return wh

    @classmethod
    def current(cls, spark: SparkSession, root: str) -> "Warehouse":
        """The tables of the newest finished version that ``refresh_warehouse`` wrote."""
        found = ready_versions(spark, root)
        if not found:
            raise ValueError(f"no finished version under {root}")
        return cls.from_tables(spark, f"{root.rstrip('/')}/{VERSIONS}/{found[-1]}")

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._cache:
            if name in self._stored:
                self._cache[name] = load(self.spark, self.root, name)
            else:
                self._cache[name] = build()
        return self._cache[name]

    # -------------------------------------------------------------- tables
    @property
    def bronze(self) -> DataFrame:
        return self._get("bronze_orders_raw", _no_bronze)

    @property
    def silver(self) -> DataFrame:
        return self._silver_scan.drop(FACT_PARTITION)

    @property
    def _silver_scan(self) -> DataFrame:
        """Silver with its month column where it is stored."""
        return self._get("silver_orders_clean", lambda: silver_orders(self.bronze))

    @property
    def fact(self) -> DataFrame:
        return self._fact_scan.drop(FACT_PARTITION)

    @property
    def _fact_scan(self) -> DataFrame:
        """The fact with its month column where it is stored, so that a period prunes folders."""
        return self._get("fact_sales", lambda: S.fact_sales(self.silver))

    @property
    def dim_customer(self) -> DataFrame:
        return self._get("dim_customer", lambda: S.dim_customer(self.silver))

    @property
    def dim_product(self) -> DataFrame:
        return self._get("dim_product", lambda: S.dim_product(self.silver))

    @property
    def dim_channel(self) -> DataFrame:
        return self._get("dim_channel", lambda: S.dim_channel(self.silver))

    @property
    def dim_time(self) -> DataFrame:
        return self._get("dim_time", lambda: S.dim_time(self.silver))

    @property
    def customer_rfm(self) -> DataFrame:
        def latest() -> Column | None:
            if "dim_time" in self._stored:
                return self.dim_time.agg(F.max("date")).scalar()
            return self._last_date.scalar() if self._last_date is not None else None
        return self._get("customer_rfm", lambda: M.customer_rfm(self.fact, latest=latest()))

    @property
    def channel_performance_summary(self) -> DataFrame:
        return self._get("channel_performance_summary",
                         lambda: M.channel_performance_summary(self.fact))

    @property
    def product_profitability_summary(self) -> DataFrame:
        return self._get("product_profitability_summary",
                         lambda: M.product_profitability_summary(self.fact))

    @property
    def sales_forecast_ready(self) -> DataFrame:
        return self._get("sales_forecast_ready", lambda: M.sales_forecast_ready(self.fact))

    @property
    def kpi_daily_snapshot(self) -> DataFrame:
        return self._get("kpi_daily_snapshot", lambda: M.kpi_daily_snapshot(self.fact))

    @property
    def geographic_daily_summary(self) -> DataFrame:
        return self._get("geographic_daily_summary",
                         lambda: M.geographic_daily_summary(self.silver))

    @property
    def channel_monthly_summary(self) -> DataFrame:
        return self._get("channel_monthly_summary",
                         lambda: M.channel_monthly_summary(self.fact, self.dim_channel))

    @property
    def geographic_performance_summary(self) -> DataFrame:
        return self._get("geographic_performance_summary",
                         lambda: M.geographic_performance_summary(self.fact, self.dim_customer))

    @property
    def sales_forecast_result(self) -> DataFrame:
        return self._get("sales_forecast_result",
                         lambda: fc.baseline_forecast(self.sales_forecast_ready))

    def table(self, name: str) -> DataFrame:
        attr = {"bronze_orders_raw": "bronze", "silver_orders_clean": "silver",
                "fact_sales": "fact"}.get(name, name)
        return getattr(self, attr)

    # ------------------------------------------------ virtual (not stored)
    def view(self, name: str, ordered: bool = False) -> DataFrame:
        """A dashboard dataset; ``ordered`` applies its presentation order."""
        df = getattr(V, name)(*[getattr(self, d) for d in VIEW_DEPS[name]])
        return V.order_view(name, df) if ordered else df

    def latest_month(self) -> Period:
        """The last month with an order: the dashboard's default period."""
        return latest_month(self.dim_time)

    def dataset(self, name: str, when: Period | None = None) -> DataFrame:
        """A table or view, in a period of its main date column (if it has one).

        Views over the fact or silver rows read only the period's rows; comparisons with the previous
        period read that one as well."""
        if when is None or name not in DATASET_DATES:
            return self.view(name) if name in VIEW_DEPS else self.table(name)
        col = DATASET_DATES[name]
        if name not in VIEW_DEPS:
            scans = {"fact_sales": lambda: self._fact_scan, "silver_orders_clean": lambda: self._silver_scan}
            df = scans[name]() if name in scans else self.table(name)
            return during(df, col, when).drop(FACT_PARTITION)
        start, end = when
        back = {"vw_kpi_monthly_status": F.add_months(start, -1), "vw_kpi_daily_comparison": F.date_sub(start, 1)}
        # monthly results are dated by the first of their month
        if name in ("vw_kpi_monthly_status", "vw_monthly_channel_revenue"):
            end = F.last_day(F.date_sub(end, 1)) + F.expr("INTERVAL '1' DAY")
        rows = (back.get(name, F.trunc(start, "month") if col == "snapshot_month" else start), end)
        source = {"fact": lambda: during(self._fact_scan, "order_date", rows).drop(FACT_PARTITION),
                  "silver": lambda: during(self._silver_scan, "order_date", rows).drop(FACT_PARTITION)}
        deps = [source[d]() if d in source else getattr(self, d) for d in VIEW_DEPS[name]]
        return during(getattr(V, name)(*deps), col, when)
