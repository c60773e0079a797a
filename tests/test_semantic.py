"""Metric registry: auto metrics from the schema, custom metrics on top."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

from kpiforge.functions.expr import money_sum
from kpiforge.operators.marts import channel_monthly_summary
from kpiforge.operators.semantic import (
    DATASET_DATES, auto_metrics, chart_query, dataset_metrics, period, top_n,
)
from kpiforge.plans.charts import CHARTS
from kpiforge.plans.oracle import oracle_sql
from kpiforge.plans.warehouse import Warehouse
from pyspark.sql import functions as F


def test_auto_metric_rule(spark, sf_small):
    wh = Warehouse.from_testdata(spark, sf_small)
    assert set(auto_metrics(wh.fact)) == {"count", "channel_id", "quantity", "revenue", "cost",
                                          "profit", "discount", "total_orders"}
    status = wh.view("vw_kpi_monthly_status")
    assert set(dataset_metrics("vw_kpi_monthly_status", status)) == {"count", "current_value",
                                                                     "delta_value"}
    fc = wh.sales_forecast_result
    assert set(dataset_metrics("sales_forecast_result", fc)) == {
        "count", "actual_value", "forecast_value", "lower_bound", "upper_bound"}
    kpi = dataset_metrics("kpi_daily_snapshot", wh.kpi_daily_snapshot)
    assert {"total_revenue", "total_orders", "total_quantity_sold", "average_order_value"} <= set(kpi)


def test_chart_query_grain_filter_order_limit(spark):
    df = spark.createDataFrame(
        [(dt.date(2022, 1, 3), "a", 1.0), (dt.date(2022, 1, 20), "a", 2.0),
         (dt.date(2022, 2, 1), "b", 4.0), (dt.date(2022, 2, 2), "c", 8.0)],
        "d date, k string, total_revenue double")
    out = chart_query(df, "any", dims=["k"], metrics=["total_revenue"], time_col="d", grain="P1M",
                      filters=[F.col("k") != "c"], order_by=[F.col("total_revenue").desc()], limit=1)
    assert [tuple(r) for r in out.collect()] == [(dt.date(2022, 2, 1), "b", 4.0)]


def test_top_n_total_order(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(10)], "v int, id int")
    got = [r.id for r in top_n(df, [F.col("v").desc(), F.col("id").asc()], 3).collect()]
    assert got == [2, 5, 8]


def test_charts_have_no_row_limit(spark, sf_small):
    for name, fn in CHARTS.items():
        wh = Warehouse.from_testdata(spark, sf_small)
        plan = fn(wh)._jdf.queryExecution().analyzed().toString()
        # the forecast's seven-day window is the only limit
        assert "GlobalLimit" not in plan.replace("GlobalLimit 7", ""), name


def test_top_products_keep_every_group():
    con = duckdb.connect()
    for t in ("lineitem", "part", "orders", "customer", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.1/{t}.parquet'")
    rows = con.sql(f"SELECT count(*) FROM ({oracle_sql()['chart_top_products']})").fetchall()[0][0]
    assert rows == 10_345


def test_period_filter_of_every_dataset(spark, sf_small):
    wh = Warehouse.from_testdata(spark, sf_small)
    first, last = wh.dim_time.agg(F.min("date"), F.max("date")).first()
    month = last.replace(day=1)
    for name, col in DATASET_DATES.items():
        whole = [r for r in wh.dataset(name).select(col).collect()]
        want = sum(month <= r[0] <= last.replace(day=28) + dt.timedelta(days=10) and (r[0].year, r[0].month) == (month.year, month.month)
                   for r in whole)
        assert wh.dataset(name, wh.latest_month()).count() == want, name
    start, end = dt.date(first.year + 1, 3, 1), dt.date(first.year + 1, 4, 1)
    got = wh.dataset("vw_kpi_monthly_status", period(start, end)).collect()
    want = [r for r in wh.view("vw_kpi_monthly_status").collect() if start <= r.snapshot_month < end]
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_money_sums_are_exact(spark):
    """Beyond 2**53 cents a double loses cents; the decimal sum does not, however rows are split."""
    rows = [(90_071_992_547_409.93,)] * 400 + [(0.01,)] * 1000
    a = spark.createDataFrame(rows, "v double").repartition(3).agg(money_sum("v")).first()[0]
    b = spark.createDataFrame(rows[::-1], "v double").repartition(7).agg(money_sum("v")).first()[0]
    want = float(400 * Decimal("90071992547409.93") + 10)
    assert a == b == want
    odd = spark.createDataFrame([(1.5,), (float("inf"),)], "v double").agg(money_sum("v")).first()[0]
    assert odd == float("inf")
    assert math.isnan(spark.createDataFrame([(1.5,), (float("nan"),)], "v double").agg(money_sum("v")).first()[0])


def test_orders_count_once_where_ids_share_a_label(spark):
    """An id without a dim row is 'Unknown' like a real 'Unknown' channel; they share orders."""
    day = dt.date(2022, 1, 1)
    fact = spark.createDataFrame(
        [(day, 1, "o1", 1.0), (day, 1, "o1", 2.0), (day, 2, "o1", 4.0), (day, 9, "o1", 8.0), (day, 9, "o2", 16.0)],
        "order_date date, channel_id long, order_id string, revenue double")
    dim = spark.createDataFrame([(1, "Web", "E"), (2, "Unknown", "E")],
                                "channel_id long, channel_name string, channel_type string")
    got = {r.channel_name: (r.total_revenue, r.total_orders) for r in channel_monthly_summary(fact, dim).collect()}
    assert got == {"Web": (3.0, 1), "Unknown": (28.0, 2)}


def test_sums_do_not_round_rows(spark):
    """Thousands of small amounts, ratios, and any order of addition."""
    from kpiforge.operators.marts import daily_totals

    fact = spark.range(1000).selectExpr("date'2024-01-01' AS order_date", "cast(id AS string) AS order_id", "0.004D AS revenue",
                                        "0.1249D AS profit", "1 AS quantity")
    day = daily_totals(fact).first()
    assert (day.total_revenue, day.total_profit, day.total_orders) == (4.0, 124.9, 1000)
    ratios = spark.range(1000).selectExpr("0.1249D AS profit_margin", "1e-9D AS tiny", "1/3D AS third", "1e18D AS huge")
    found = ratios.agg(*(m().alias(n) for n, m in auto_metrics(ratios).items())).first()
    assert found.profit_margin == 124.9 and found["count"] == 1000
    assert abs(found.tiny - 1e-6) < 1e-18 and abs(found.third - 1000 / 3) < 1e-10 and found.huge == 1e21
    values = [(0.1 * i * (-1) ** i + i / 7,) for i in range(2000)]
    sums = {spark.createDataFrame(v, "v double").repartition(n).agg(money_sum("v")).first()[0]
            for v, n in ((values, 3), (values[::-1], 7), (sorted(values), 1))}
    assert len(sums) == 1 and abs(sums.pop() - math.fsum(v for v, in values)) < 1e-9
