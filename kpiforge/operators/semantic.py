"""Semantic layer: named metrics per dataset and grouped chart queries.

A dashboard query is ``SELECT dims, metrics FROM dataset WHERE filters
GROUP BY dims ORDER BY ... LIMIT n``; here it is ``chart_query`` returning a
lazy DataFrame (partial aggregation map-side, one shuffle on the dims).

Metrics of a dataset (``dataset_metrics``):
* auto: ``count`` = COUNT(*); every integral / floating column -> SUM(col);
  ``total_orders`` = COUNT(DISTINCT order_id) when the dataset has order_id;
* custom metrics override auto ones of the same name.

Integral SUMs of the auto rule are exact ``decimal(38,0)`` so id-like 64-bit
columns never overflow; floating SUMs are ``money_sum``: amounts, ratios and any other number alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.functions.expr import SUM_SCALE, fixed_round, money_sum, month_start, safe_ratio
from kpiforge.sources.tables import FACT_PARTITION, month_number

MetricFn = Callable[[], Column]


def _sum(c: str, scale: int | None = SUM_SCALE) -> MetricFn:
    return lambda: money_sum(c, scale)


# --- FIXED VALUES: custom metrics per dataset (names and definitions) ---
CUSTOM_METRICS: dict[str, dict[str, MetricFn]] = {
    "fact_sales": {
        "total_revenue": _sum("revenue"),
        "total_profit": _sum("profit"),
        "total_quantity_sold": lambda: F.sum("quantity"),
        "total_orders": lambda: F.count_distinct("order_id"),
        "average_order_value": lambda: safe_ratio(money_sum("revenue"),
                                                  F.count_distinct("order_id")),
    },
    "kpi_daily_snapshot": {
        "total_revenue": _sum("revenue"),
        "total_orders": lambda: F.sum("orders"),
        "total_quantity_sold": lambda: F.sum("quantity"),
        "average_order_value": lambda: fixed_round(F.avg("aov"), 4),
    },
    "sales_forecast_result": {
        "actual_value": _sum("actual_value"),
        "forecast_value": _sum("forecast_value"),
        "lower_bound": _sum("lower_bound"),
        "upper_bound": _sum("upper_bound"),
    },
}


# --- FIXED VALUES: columns declared nullable per dataset (no auto SUM metric) ---
NULLABLE_COLUMNS: dict[str, set[str]] = {
    "sales_forecast_result": {"actual_value", "forecast_value", "lower_bound", "upper_bound"},
    "vw_kpi_monthly_status": {"previous_value", "delta_pct"},
    "vw_kpi_daily_comparison": {"previous_value", "delta_pct"},
}


def auto_metrics(df: DataFrame, scale: int | None = SUM_SCALE, dataset: str | None = None) -> dict[str, MetricFn]:
    """COUNT(*), SUM of every numeric column not declared nullable, and
    COUNT(DISTINCT order_id) when the dataset has an order id."""
    out: dict[str, MetricFn] = {"count": lambda: F.count(F.lit(1))}
    skip = NULLABLE_COLUMNS.get(dataset or "", set())
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.IntegralType):
            out[f.name] = (lambda n: lambda: F.sum(F.col(n).cast("decimal(38,0)")))(f.name)
        elif isinstance(f.dataType, (T.FractionalType,)):
            out[f.name] = (lambda n: lambda: money_sum(n, scale))(f.name)
    if "order_id" in df.columns:
        out["total_orders"] = lambda: F.count_distinct("order_id")
    return out


def dataset_metrics(name: str, df: DataFrame) -> dict[str, MetricFn]:
    return {**auto_metrics(df, dataset=name), **CUSTOM_METRICS.get(name, {})}


def metric_columns(name: str, df: DataFrame, metrics: list[str] | None = None) -> list[Column]:
    registry = dataset_metrics(name, df)
    names = metrics if metrics is not None else list(registry)
    return [registry[m]().alias(m) for m in names]


def apply_grain(col: str, grain: str | None) -> Column:
    if grain in (None, "P1D"):
        return F.col(col)
    if grain == "P1M":
        return month_start(col)
    raise ValueError(f"unsupported time grain {grain!r}")


def chart_query(df: DataFrame, dataset: str, dims: list[str] | None = None,
                metrics: list[str] | None = None, time_col: str | None = None,
                grain: str | None = None, filters: list[Column] | None = None,
                order_by: list[Column] | None = None, limit: int | None = None,
                extra_metrics: dict[str, Column] | None = None) -> DataFrame:
    """Grouped dashboard query over ``df``; ``time_col`` is bucketed by ``grain``."""
    for f in filters or []:
        df = df.where(f)
    keys: list[Column] = []
    if time_col is not None:
        keys.append(apply_grain(time_col, grain).alias(time_col))
    keys += [F.col(d) for d in dims or []]
    aggs = metric_columns(dataset, df, metrics or [])
    aggs += [c.alias(n) for n, c in (extra_metrics or {}).items()]
    out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    return out


def top_n(df: DataFrame, by: list[Column], n: int) -> DataFrame:
    """First ``n`` rows under a total order (``by`` must end in unique tie-breakers).

    Planned as TakeOrderedAndProject: each task keeps its own top ``n``, only
    those reach the final merge."""
    return df.orderBy(*by).limit(n)


# --- FIXED VALUES: main date column of every dataset that has one ---
DATASET_DATES: dict[str, str] = {
    "fact_sales": "order_date",
    "silver_orders_clean": "order_date",
    "sales_forecast_ready": "sales_date",
    "sales_forecast_result": "sales_date",
    "kpi_daily_snapshot": "snapshot_date",
    "geographic_daily_summary": "order_date",
    "channel_monthly_summary": "snapshot_month",
    "vw_revenue_by_category": "order_date",
    "vw_revenue_by_sub_category": "order_date",
    "vw_top_products_by_revenue": "order_date",
    "vw_channel_performance": "order_date",
    "vw_geographic_performance": "order_date",
    "vw_kpi_monthly_status": "snapshot_month",
    "vw_kpi_daily_comparison": "snapshot_date",
    "vw_monthly_channel_revenue": "snapshot_month",
    "vw_top_states_revenue": "order_date",
}

Period = tuple[Column, Column]


def period(start: dt.date | str, end: dt.date | str) -> Period:
    """The half-open date range ``[start, end)``."""
    return F.lit(start).cast("date"), F.lit(end).cast("date")


def latest_month(dates: DataFrame, date_col: str = "date") -> Period:
    """The calendar month of the last date of a table with dates (such as ``dim_time``): scalar
    subqueries, no driver collect and no join."""
    first = dates.agg(month_start(F.max(date_col))).scalar()
    return first, F.add_months(first, 1)


def during(df: DataFrame, date_col: str, when: Period) -> DataFrame:
    """Rows of ``df`` in the period; the stored fact's month folders are pruned as well."""
    start, end = when
    if FACT_PARTITION in df.columns:
        month = F.col(FACT_PARTITION)
        df = df.where((month >= month_number(start)) & (month <= month_number(F.date_sub(end, 1))))
    return df.where((F.col(date_col) >= start) & (F.col(date_col) < end))
