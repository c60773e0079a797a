"""Summary marts over the fact table / silver rows.

Sums of amounts are exact (``money_sum``: no row is rounded, the sum becomes a double once at the end; pass
``None`` for the raw double sum), and every ratio is derived from them, so results do not depend on the order
in which partial sums were combined.

Distinct order counts use ``count_distinct`` (exact).  With a single distinct
column Spark plans it as two aggregations: the first shuffles on
(group key, order_id), so a group holding a third of all rows is still spread
over all reducers; the second only sees one row per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions import constants as K
from kpiforge.functions.expr import SUM_SCALE, iso_state_code, money_merge, money_parts, money_sum, month_start, safe_ratio
from kpiforge.operators.joins import LABEL_SALTS, group_by_labels, join_dim

def _orders() -> F.Column:
    return F.count_distinct("order_id")


# --------------------------------------------------------------------- daily
def daily_totals(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    """One row per order date: revenue, profit, distinct orders, quantity."""
    return fact.groupBy("order_date").agg(
        money_sum("revenue", scale).alias("total_revenue"),
        money_sum("profit", scale).alias("total_profit"),
        _orders().alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
    )


def sales_forecast_ready(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return daily_totals(fact, scale).select(
        F.col("order_date").alias("sales_date"), "total_revenue", "total_profit",
        "total_orders", "total_quantity")


def kpi_daily_snapshot(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    d = fact.groupBy("order_date").agg(
        money_sum("revenue", scale).alias("revenue"),
        _orders().alias("orders"),
        F.sum("quantity").alias("quantity"),
    )
    return d.select(F.col("order_date").alias("snapshot_date"), "revenue", "orders", "quantity",
                    safe_ratio(F.col("revenue"), F.col("orders")).alias("aov"))


# ------------------------------------------------------------ by dimension
def channel_performance_summary(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    g = fact.groupBy("channel_id").agg(
        money_sum("revenue", scale).alias("total_revenue"),
        money_sum("profit", scale).alias("total_profit"),
        _orders().alias("total_orders"),
    )
    return g.withColumn("profit_margin", safe_ratio(F.col("total_profit"), F.col("total_revenue")))


def product_profitability_summary(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    g = fact.groupBy("product_id").agg(
        money_sum("revenue", scale).alias("total_revenue"),
        money_sum("profit", scale).alias("total_profit"),
        F.sum("quantity").alias("total_quantity"),
        _orders().alias("total_orders"),
    )
    return g.withColumn("profit_margin", safe_ratio(F.col("total_profit"), F.col("total_revenue")))


def _known_state(silver: DataFrame) -> DataFrame:
    return silver.where((F.col("state") != K.UNKNOWN) & (F.col("state") != ""))


def state_daily(silver: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    """Revenue and distinct orders per (order date, raw state), known states only."""
    return _known_state(silver).groupBy("order_date", "state").agg(
        money_sum("revenue", scale).alias("total_revenue"),
        _orders().alias("total_orders"),
    )


def geographic_daily_summary(silver: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    # the ISO lookup runs after the aggregate: once per (day, state), not per row
    return state_daily(silver, scale).select(
        "order_date", iso_state_code("state").alias("iso_code"), "state",
        "total_revenue", "total_orders")


def channel_monthly_summary(fact: DataFrame, dim_channel: DataFrame,
                            scale: int | None = SUM_SCALE) -> DataFrame:
    """Month x channel name.  A fact row whose channel id has no dim row is named 'Unknown', and
    shares a group with a real 'Unknown' channel (see ``group_by_labels``)."""
    dated = fact.select(month_start("order_date").alias("snapshot_month"), "channel_id", "order_id", "revenue")
    return group_by_labels(dated, dim_channel, "channel_id", ["snapshot_month"], ["channel_name"],
                           money_parts("revenue", scale), {"total_revenue": money_merge("revenue", scale)}, salts=LABEL_SALTS)


def geographic_performance_summary(fact: DataFrame, dim_customer: DataFrame,
                                   scale: int | None = SUM_SCALE) -> DataFrame:
    """State x city of the customer dimension; rows whose customer has state
    'Unknown' (or no dim row) are left out.

    The fact side is pre-aggregated per (customer, order) before it is
    shuffled for the join (order lines of one order are adjacent in the files,
    so the partial aggregate collapses them map-side), and the 'Unknown'
    customer -- the designed hot key -- is salted over the shuffle partitions
    by order id (see ``joins.join_dim``).
    """
    per_order = fact.groupBy("customer_id", "order_id").agg(
        *money_parts("revenue", scale), *money_parts("profit", scale))
    dims = dim_customer.select("customer_id", "state", "city").where(F.col("state") != K.UNKNOWN)
    j = join_dim(per_order, dims, "customer_id", how="inner", hot_keys=[K.UNKNOWN],
                 salt_col="order_id")
    return j.groupBy("state", "city").agg(
        money_merge("revenue", scale).alias("total_revenue"),
        money_merge("profit", scale).alias("total_profit"),
        _orders().alias("total_orders"),
    )


# ---------------------------------------------------------------------- RFM
def rfm_key(pseudo: bool = True) -> F.Column:
    """Customer key of the RFM mart.  With ``pseudo`` the 'Unknown' customer is
    split into buckets by the last four characters of the order id."""
    if not pseudo:
        return F.col("customer_id")
    return F.when(F.col("customer_id") == K.UNKNOWN, F.right(F.col("order_id"), F.lit(4))) \
        .otherwise(F.col("customer_id"))


def customer_rfm(fact: DataFrame, scale: int | None = SUM_SCALE, pseudo: bool = True,
                 champions=(K.RFM_CHAMPIONS_MAX_RECENCY, K.RFM_CHAMPIONS_MIN_FREQUENCY,
                            K.RFM_CHAMPIONS_MIN_MONETARY),
                 loyal=(K.RFM_LOYAL_MAX_RECENCY, K.RFM_LOYAL_MIN_FREQUENCY),
                 at_risk=(K.RFM_AT_RISK_MIN_RECENCY, K.RFM_AT_RISK_MIN_MONETARY),
                 hibernating=K.RFM_HIBERNATING_MIN_RECENCY,
                 latest: F.Column | None = None) -> DataFrame:
    """``latest``: the last order date, where the table's statistics have it; else it is taken from the
    per-customer result, which scans the fact a second time."""
    per_key = fact.groupBy(rfm_key(pseudo).alias("pseudo_customer_id")).agg(
        F.max("order_date").alias("last_order"),
        _orders().alias("frequency"),
        money_sum("revenue", scale).alias("monetary"),
    )
    # a scalar subquery, planned once and inlined as a value -- no join
    max_date = latest if latest is not None else per_key.agg(F.max("last_order")).scalar()
    r, f, m = F.col("recency"), F.col("frequency"), F.col("monetary")
    segment = (
        F.when((r <= champions[0]) & (f >= champions[1]) & (m >= champions[2]), "Champions")
        .when((r <= loyal[0]) & (f >= loyal[1]), "Loyal")
        .when((r > at_risk[0]) & (m >= at_risk[1]), "At Risk")
        .when(r > hibernating, "Hibernating")
        .otherwise("Regular")
    )
    return (
        per_key.select("pseudo_customer_id",
                       F.datediff(max_date, F.col("last_order")).cast("bigint").alias("recency"),
                       "frequency", "monetary")
        .withColumn("segment_name", segment)
    )
