"""Baseline sales forecast: history plus a flat moving-average horizon.

Per metric (``Revenue`` = daily revenue, ``Orders`` = daily distinct orders):

* history rows: every day with sales, ``actual_value`` set, model
  ``actual_history``;
* level = mean of the last ``window`` rows by date (days with sales, not
  calendar days), sigma = population stddev over the whole history (0 if
  undefined);
* horizon rows h = 1..``horizon``: date = last day + h, forecast = level,
  bounds = level -/+ sigma (lower clipped at 0), model ``moving_average_7d``.

All metrics come from one unpivot of the daily table; sigma and the last
date are ordinary partial aggregates per metric, the level a per-metric
top-k of the newest rows (the reference's ORDER BY ... DESC LIMIT 7), and
the horizon rows are generated from the stats rows.  Empty history gives no
forecast rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions import constants as K
from kpiforge.functions.expr import fixed_round

STAT_SCALE = 4
DEFAULT_METRICS = {"Revenue": "total_revenue", "Orders": "total_orders"}


def forecast_history(daily: DataFrame, metrics: dict[str, str] | None = None) -> DataFrame:
    metrics = metrics or DEFAULT_METRICS
    wide = daily.select(F.col("sales_date"),
                        *[F.col(src).cast("double").alias(name) for name, src in metrics.items()])
    return wide.unpivot(["sales_date"], list(metrics), "metric_name", "actual_value")


def forecast_stats(history: DataFrame, window: int = K.FORECAST_WINDOW,
                   scale: int | None = STAT_SCALE, metrics: list[str] | None = None) -> DataFrame:
    """One row per metric: level (mean of the last ``window`` rows by date),
    sigma (population stddev of all rows, 0 if undefined) and the last date.

    The last rows are a per-metric top-k (``ORDER BY sales_date DESC LIMIT k``,
    planned as TakeOrderedAndProject: every task keeps its own k newest rows),
    so no task ever holds a metric's whole history."""
    names = metrics or list(DEFAULT_METRICS)
    spread = history.groupBy("metric_name").agg(
        F.coalesce(F.stddev_pop("actual_value"), F.lit(0.0)).alias("sigma"),
        F.max("sales_date").alias("max_date"))
    newest = [history.where(F.col("metric_name") == m).orderBy(F.col("sales_date").desc()).limit(window)
              for m in names]
    last = reduce(DataFrame.unionByName, newest)
    level = last.groupBy("metric_name").agg(F.avg("actual_value").alias("level"))
    stats = spread.join(level, "metric_name")
    if scale is not None:
        stats = stats.select("metric_name", fixed_round(F.col("level"), scale).alias("level"),
                             fixed_round(F.col("sigma"), scale).alias("sigma"), "max_date")
    return stats.select("metric_name", "level", "sigma", "max_date")


def baseline_forecast(daily: DataFrame, metrics: dict[str, str] | None = None,
                      horizon: int = K.FORECAST_HORIZON, window: int = K.FORECAST_WINDOW,
                      scale: int | None = STAT_SCALE, with_created_at: bool = True) -> DataFrame:
    """``daily`` has ``sales_date`` plus the metric source columns."""
    history = forecast_history(daily, metrics)
    stats = forecast_stats(history, window, scale, list(metrics or DEFAULT_METRICS))
    null = F.lit(None).cast("double")
    hist_rows = history.select(
        "sales_date", "metric_name", "actual_value", null.alias("forecast_value"),
        null.alias("lower_bound"), null.alias("upper_bound"),
        F.lit(K.FORECAST_MODEL_HISTORY).alias("model_name"))
    # horizon steps generated per stats row (one row per metric): no join
    steps = stats.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    lv, sg = F.col("level"), F.col("sigma")
    fc_rows = steps.select(
        F.date_add("max_date", F.col("h")).alias("sales_date"), "metric_name",
        null.alias("actual_value"), lv.alias("forecast_value"),
        F.greatest(lv - sg, F.lit(0.0)).alias("lower_bound"), (lv + sg).alias("upper_bound"),
        F.lit(K.FORECAST_MODEL_BASELINE).alias("model_name"))
    out = hist_rows.unionByName(fc_rows)
    if with_created_at:
        out = out.withColumn("created_at", F.current_timestamp())
    return out
