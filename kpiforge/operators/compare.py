"""Period-over-period KPI comparison (monthly status / daily comparison).

The previous period is the *calendar* previous one (month - 1, day - 1),
found by an equi-join of the per-period aggregate with itself shifted by one
period -- not ``lag``, which would silently compare against an older period
when one is missing.  The aggregate has one row per period (bounded by the
calendar span, not by data volume), so AQE turns the self-join into a
broadcast.  The four KPI branches are produced by one ``unpivot`` of the
aggregate instead of four scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions import constants as K
from kpiforge.functions.expr import SUM_SCALE, money_sum, month_start, safe_ratio


def period_totals(fact: DataFrame, grain: str = "month", scale: int | None = SUM_SCALE) -> DataFrame:
    period = month_start("order_date") if grain == "month" else F.col("order_date")
    g = fact.groupBy(period.alias("period")).agg(
        money_sum("revenue", scale).alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("quantity").alias("quantity"),
    )
    return g.withColumn("aov", safe_ratio(F.col("revenue"), F.col("orders")))


def _shift(period: F.Column, grain: str) -> F.Column:
    return F.add_months(period, 1) if grain == "month" else F.date_add(period, 1)


def period_compare(fact: DataFrame, grain: str = "month", status: bool = True,
                   scale: int | None = SUM_SCALE) -> DataFrame:
    totals = period_totals(fact, grain, scale)
    long = totals.select(
        "period",
        F.col("revenue").cast("double").alias(K.KPI_NAMES[0]),
        F.col("orders").cast("double").alias(K.KPI_NAMES[1]),
        F.col("quantity").cast("double").alias(K.KPI_NAMES[2]),
        F.col("aov").cast("double").alias(K.KPI_NAMES[3]),
    ).unpivot(["period"], K.KPI_NAMES, "kpi_name", "current_value")
    previous = long.select(_shift(F.col("period"), grain).alias("period"), "kpi_name",
                           F.col("current_value").alias("previous_value"))
    j = long.join(previous, ["period", "kpi_name"], "left")
    cur, prev = F.col("current_value"), F.col("previous_value")
    date_col = "snapshot_month" if grain == "month" else "snapshot_date"
    cols = [
        F.col("period").alias(date_col), "kpi_name", "current_value", "previous_value",
        (cur - F.coalesce(prev, F.lit(0.0))).alias("delta_value"),
        F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double"))
        .otherwise((cur - prev) / prev).alias("delta_pct"),
    ]
    if status:
        cols += [
            F.when(prev.isNull(), K.TREND_NO_BASELINE).when(cur >= prev, K.TREND_UP)
            .otherwise(K.TREND_DOWN).alias("trend_direction"),
            F.when(prev.isNull(), K.TREND_NO_BASELINE).when(cur >= prev, K.STATUS_MEETS)
            .otherwise(K.STATUS_BELOW).alias("minimum_status"),
        ]
    return j.select(*cols)


def kpi_monthly_status(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return period_compare(fact, "month", True, scale)


def kpi_daily_comparison(fact: DataFrame, scale: int | None = SUM_SCALE) -> DataFrame:
    return period_compare(fact, "day", False, scale)
