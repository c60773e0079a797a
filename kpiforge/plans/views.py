"""Dashboard datasets (the BI layer's virtual views) as DataFrame functions.

The functions return the rows unordered.  The views' ``ORDER BY`` is
presentation only, and is applied just where a view is the final result
(``ordered``): under a chart's aggregate a sort would not be removed by the
optimizer (floating-point sums are order-sensitive) and would cost a
range-partitioning shuffle and a global sort of the whole view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions import constants as K
from kpiforge.functions.expr import SUM_SCALE, money_merge, money_parts, money_sum
from kpiforge.operators.compare import kpi_daily_comparison, kpi_monthly_status
from kpiforge.operators.joins import LABEL_SALTS, group_by_labels, join_dim
from kpiforge.operators.marts import (
    channel_monthly_summary,
    geographic_daily_summary,
    state_daily,
)


def _unknown(c: str) -> F.Column:
    return F.coalesce(F.col(c), F.lit(K.UNKNOWN)).alias(c)


def revenue_by_product_attribute(fact: DataFrame, dim_product: DataFrame, attr: str,
                                 scale: int | None = SUM_SCALE) -> DataFrame:
    """Revenue and quantity per (order date, product attribute).

    Sums are pre-aggregated per (order date, product) before the join, so the
    shuffle feeding a sort-merge join carries one row per product-day instead
    of one per order line."""
    per_product_day = fact.groupBy("order_date", "product_id").agg(
        *money_parts("revenue", scale), F.sum("quantity").alias("quantity"))
    j = join_dim(per_product_day, dim_product.select("product_id", attr), "product_id")
    return (j.withColumn(attr, _unknown(attr)).groupBy("order_date", attr)
            .agg(money_merge("revenue", scale).alias("total_revenue"),
                 F.sum("quantity").alias("total_quantity")))


def vw_revenue_by_category(fact, dim_product, scale=SUM_SCALE):
    return revenue_by_product_attribute(fact, dim_product, "category", scale)


def vw_revenue_by_sub_category(fact, dim_product, scale=SUM_SCALE):
    return revenue_by_product_attribute(fact, dim_product, "sub_category", scale)


def vw_top_products_by_revenue(fact: DataFrame, dim_product: DataFrame,
                               scale: int | None = SUM_SCALE) -> DataFrame:
    rows = fact.select("order_date", "product_id", "order_id", "revenue", "quantity")
    return group_by_labels(rows, dim_product, "product_id", ["order_date"], ["product_name", "category"],
                           [*money_parts("revenue", scale), F.sum("quantity").alias("quantity")],
                           {"total_revenue": money_merge("revenue", scale), "total_quantity": F.sum("quantity")})


def vw_channel_performance(fact: DataFrame, dim_channel: DataFrame,
                           scale: int | None = SUM_SCALE) -> DataFrame:
    rows = fact.select("order_date", "channel_id", "order_id", "revenue")
    return group_by_labels(rows, dim_channel, "channel_id", ["order_date"], ["channel_name", "channel_type"],
                           money_parts("revenue", scale), {"total_revenue": money_merge("revenue", scale)}, salts=LABEL_SALTS)


def vw_customer_segment_distribution(rfm: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return (rfm.groupBy("segment_name")
            .agg(F.count(F.lit(1)).alias("customers"),
                 money_sum("monetary", scale).alias("total_monetary")))


def vw_geographic_performance(silver: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return geographic_daily_summary(silver, scale)


def vw_kpi_monthly_status(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return kpi_monthly_status(fact, scale)


def vw_kpi_daily_comparison(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return kpi_daily_comparison(fact, scale)


def vw_monthly_channel_revenue(fact: DataFrame, dim_channel: DataFrame,
                               scale: int | None = SUM_SCALE) -> DataFrame:
    return channel_monthly_summary(fact, dim_channel, scale)


def vw_top_states_revenue(silver: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return state_daily(silver, scale)


# --- FIXED VALUES: presentation order of each view (its ORDER BY) ---
VIEW_ORDER: dict[str, list[tuple[str, bool]]] = {
    "vw_revenue_by_category": [("total_revenue", False)],
    "vw_revenue_by_sub_category": [("total_revenue", False)],
    "vw_top_products_by_revenue": [("total_revenue", False)],
    "vw_channel_performance": [("total_revenue", False)],
    "vw_customer_segment_distribution": [("customers", False)],
    "vw_geographic_performance": [("total_revenue", False)],
    "vw_monthly_channel_revenue": [("snapshot_month", True), ("total_revenue", False)],
    "vw_top_states_revenue": [("total_revenue", False)],
}


def order_view(name: str, df: DataFrame) -> DataFrame:
    keys = VIEW_ORDER.get(name)
    if not keys:
        return df
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in keys])
