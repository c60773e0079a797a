"""The dashboard's chart queries (grouped queries over the datasets).

Rendering is not built; each function returns all rows a chart would draw, in its order.  ``when`` is
the dashboard's period filter: any date range, or ``wh.latest_month()``.  A caller that draws only some
rows puts ``limit`` on the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.constants import KPI_NAMES
from kpiforge.operators.semantic import Period, chart_query
from kpiforge.plans.warehouse import Warehouse

# --- FIXED VALUES: KPI card metrics ---
KPI_METRICS = ["total_revenue", "total_orders", "total_quantity_sold", "average_order_value"]


def _desc_then(metric: str, *dims: str) -> list[F.Column]:
    return [F.col(metric).desc()] + [F.col(d).asc() for d in dims]


def chart_kpi_totals(wh: Warehouse, when: Period | None = None) -> DataFrame:
    """The four big-number cards: totals over the whole daily snapshot."""
    return chart_query(wh.dataset("kpi_daily_snapshot", when), "kpi_daily_snapshot", metrics=KPI_METRICS)


def chart_mini_trends(wh: Warehouse, when: Period | None = None) -> DataFrame:
    """The four mini trend lines: one point per day per KPI."""
    return chart_query(wh.dataset("kpi_daily_snapshot", when), "kpi_daily_snapshot", metrics=KPI_METRICS,
                       time_col="snapshot_date", grain="P1D",
                       order_by=[F.col("snapshot_date").asc()])


def _kpi_order() -> F.Column:
    return F.array_position(F.array(*[F.lit(k) for k in KPI_NAMES]), F.col("kpi_name"))


def chart_kpi_status(wh: Warehouse, when: Period | None = None) -> DataFrame:
    """Raw table of the KPI status view, newest month first."""
    cols = ["kpi_name", "current_value", "previous_value", "delta_value", "delta_pct",
            "trend_direction", "minimum_status"]
    status = wh.dataset("vw_kpi_monthly_status", when)
    return status.orderBy(F.col("snapshot_month").desc(), _kpi_order()).select(*cols)


def chart_forecast_ready(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("sales_forecast_ready", when), "sales_forecast_ready",
                       metrics=["total_revenue", "total_orders"], time_col="sales_date",
                       grain="P1M", order_by=[F.col("sales_date").asc()])


def chart_revenue_forecast(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("sales_forecast_result", when), "sales_forecast_result",
                       metrics=["actual_value", "forecast_value"], time_col="sales_date",
                       grain="P1D", filters=[F.col("metric_name") == "Revenue"], order_by=[F.col("sales_date").asc()])


def chart_daily_trends(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("sales_forecast_ready", when), "sales_forecast_ready",
                       metrics=["total_revenue", "total_orders", "total_quantity"],
                       time_col="sales_date", grain="P1D",
                       order_by=[F.col("sales_date").asc()])


def chart_category(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("vw_revenue_by_category", when), "vw_revenue_by_category",
                       dims=["category"], metrics=["total_revenue"],
                       order_by=_desc_then("total_revenue", "category"))


def chart_sub_category(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("vw_revenue_by_sub_category", when), "vw_revenue_by_sub_category",
                       dims=["sub_category"], metrics=["total_revenue"],
                       order_by=_desc_then("total_revenue", "sub_category"))


def chart_monthly_channel(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("channel_monthly_summary", when), "channel_monthly_summary",
                       dims=["channel_name"], metrics=["total_revenue"],
                       time_col="snapshot_month", grain="P1M",
                       order_by=_desc_then("total_revenue", "snapshot_month", "channel_name"))


def chart_top_products(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("vw_top_products_by_revenue", when), "vw_top_products_by_revenue",
                       dims=["product_name", "category"],
                       metrics=["total_revenue", "total_quantity", "total_orders"],
                       order_by=_desc_then("total_revenue", "product_name", "category"))


def chart_channels(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("vw_channel_performance", when), "vw_channel_performance",
                       dims=["channel_name", "channel_type"],
                       metrics=["total_revenue", "total_orders"],
                       order_by=_desc_then("total_revenue", "channel_name", "channel_type"))


def chart_top_states(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("vw_top_states_revenue", when), "vw_top_states_revenue",
                       dims=["state"], metrics=["total_revenue", "total_orders"], order_by=_desc_then("total_revenue", "state"))


def chart_segments(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("vw_customer_segment_distribution", when),
                       "vw_customer_segment_distribution", dims=["segment_name"],
                       metrics=["customers"],
                       order_by=_desc_then("customers", "segment_name"))


def chart_geo_map(wh: Warehouse, when: Period | None = None) -> DataFrame:
    return chart_query(wh.dataset("geographic_daily_summary", when), "geographic_daily_summary",
                       dims=["iso_code"], metrics=["total_revenue"])


CHARTS = {
    "chart_kpi_totals": chart_kpi_totals,
    "chart_mini_trends": chart_mini_trends,
    "chart_kpi_status": chart_kpi_status,
    "chart_forecast_ready": chart_forecast_ready,
    "chart_revenue_forecast": chart_revenue_forecast,
    "chart_daily_trends": chart_daily_trends,
    "chart_category": chart_category,
    "chart_sub_category": chart_sub_category,
    "chart_monthly_channel": chart_monthly_channel,
    "chart_top_products": chart_top_products,
    "chart_channels": chart_channels,
    "chart_top_states": chart_top_states,
    "chart_segments": chart_segments,
    "chart_geo_map": chart_geo_map,
}
