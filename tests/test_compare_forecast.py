"""Period comparison (calendar previous period) and the baseline forecast."""

from __future__ import annotations

import datetime as dt
import statistics

from pyspark.sql import functions as F

from kpiforge.operators.compare import period_compare
from kpiforge.operators.forecast import baseline_forecast
from kpiforge.operators.marts import sales_forecast_ready
from helpers import fact_rows

D = dt.date


def test_month_gap_has_no_baseline(spark):
    fact = fact_rows(spark, [("A", D(2022, 1, 5), 1, 100.0), ("B", D(2022, 3, 9), 2, 50.0)])
    rows = {(r.snapshot_month, r.kpi_name): r for r in period_compare(fact, "month").collect()}
    march = rows[(D(2022, 3, 1), "Revenue")]
    assert march.previous_value is None  # February is missing: not compared to January
    assert march.trend_direction == "No Baseline" and march.minimum_status == "No Baseline"
    assert march.delta_value == 50.0 and march.delta_pct is None


def test_day_over_day(spark):
    fact = fact_rows(spark, [("A", D(2022, 1, 1), 1, 100.0), ("B", D(2022, 1, 2), 3, 80.0),
                             ("C", D(2022, 1, 2), 1, 40.0), ("D", D(2022, 1, 4), 1, 10.0)])
    rows = {(r.snapshot_date, r.kpi_name): r for r in period_compare(fact, "day", status=False).collect()}
    assert rows[(D(2022, 1, 2), "Revenue")].previous_value == 100.0
    assert rows[(D(2022, 1, 2), "Revenue")].delta_pct == 0.2
    assert rows[(D(2022, 1, 2), "Orders")].current_value == 2.0
    assert rows[(D(2022, 1, 2), "AOV")].current_value == 60.0
    assert rows[(D(2022, 1, 4), "Revenue")].previous_value is None
    assert "trend_direction" not in period_compare(fact, "day", status=False).columns


def test_zero_previous(spark):
    fact = fact_rows(spark, [("A", D(2022, 1, 1), 1, 0.0), ("B", D(2022, 2, 1), 1, 5.0)])
    r = {(x.snapshot_month, x.kpi_name): x for x in period_compare(fact, "month").collect()}
    feb = r[(D(2022, 2, 1), "Revenue")]
    assert feb.previous_value == 0.0 and feb.delta_pct is None
    assert feb.trend_direction == "Up" and feb.minimum_status == "Meets Minimum"
    down = r[(D(2022, 2, 1), "Orders")]
    assert down.trend_direction == "Up"  # 1 >= 1


def test_short_history_forecast(spark):
    fact = fact_rows(spark, [("A", D(2022, 1, 1), 1, 10.0), ("B", D(2022, 1, 2), 1, 20.0),
                             ("C", D(2022, 1, 5), 1, 60.0)])
    out = baseline_forecast(sales_forecast_ready(fact)).drop("created_at")
    rows = out.collect()
    rev_fc = [r for r in rows if r.metric_name == "Revenue" and r.model_name == "moving_average_7d"]
    assert len(rev_fc) == 30
    assert {r.forecast_value for r in rev_fc} == {30.0}  # mean of the 3 days with sales
    sigma = round(statistics.pstdev([10.0, 20.0, 60.0]), 4)
    assert all(abs(r.upper_bound - (30.0 + sigma)) < 1e-9 for r in rev_fc)
    assert all(abs(r.lower_bound - (30.0 - sigma)) < 1e-9 for r in rev_fc)  # flat bounds
    # recent level far below sigma: the lower bound is clipped at 0
    spiky = fact_rows(spark, [(f"A{i}", D(2022, 1, 1) + dt.timedelta(days=i), 1, 1.0) for i in range(7)] +
                      [(f"B{i}", D(2021, 1, 1) + dt.timedelta(days=i), 1, 1000.0) for i in range(14)])
    lows = {r.lower_bound for r in baseline_forecast(sales_forecast_ready(spiky)).collect()
            if r.metric_name == "Revenue" and r.model_name == "moving_average_7d"}
    assert lows == {0.0}
    assert min(r.sales_date for r in rev_fc) == D(2022, 1, 6)
    assert max(r.sales_date for r in rev_fc) == D(2022, 2, 4)
    hist = [r for r in rows if r.model_name == "actual_history"]
    assert len(hist) == 6 and all(r.forecast_value is None for r in hist)


def test_last_seven_rows_not_days(spark):
    days = [D(2022, 1, 1) + dt.timedelta(days=2 * i) for i in range(10)]  # gaps between days
    fact = fact_rows(spark, [(f"O{i}", d, 1, float(i + 1)) for i, d in enumerate(days)])
    fc = (baseline_forecast(sales_forecast_ready(fact))
          .where((F.col("metric_name") == "Revenue") & F.col("forecast_value").isNotNull())
          .select("forecast_value").distinct().collect())
    assert [r.forecast_value for r in fc] == [round(sum(range(4, 11)) / 7, 4)]


def test_empty_history_gives_no_forecast(spark):
    fact = fact_rows(spark, []).limit(0)
    assert baseline_forecast(sales_forecast_ready(fact)).count() == 0
