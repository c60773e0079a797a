"""Plan assertions: the physical plans stay JVM-side and scale-safe."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from kpiforge.plans.catalog import QUERIES

KEYS = sorted(QUERIES)  # the warehouse's own queries


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {k: plan_of(E.queries()[k](spark, sf_small)) for k in KEYS}


@pytest.mark.parametrize("key", KEYS)
def test_no_python_udf(plans, key):
    p = plans[key]
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_product(plans, key):
    p = plans[key]
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p, key


@pytest.mark.parametrize("key", KEYS)
def test_no_window_operator(plans, key):
    # top-k and equi-joins instead of windows: no task holds a whole group
    assert not re.search(r"\bWindow \[", plans[key])


def test_column_pruning_reaches_scan(spark, sf_small):
    df = E.queries()["kpi_daily_snapshot"](spark, sf_small)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", df._jdf.queryExecution().executedPlan().toString()) \
        or re.findall(r"ReadSchema: (struct<[^\n]*)", _formatted(df))
    assert schemas
    for s in schemas:
        assert "customer_name" not in s and "city" not in s and "cost" not in s


def test_hot_key_is_salted(spark, sf_small):
    p = _formatted(E.queries()["geographic_performance_summary"](spark, sf_small))
    assert "xxhash64" in p  # the 'Unknown' customer is spread over buckets


def test_month_scan_prunes_partitions(spark, sf_small):
    df = E.queries()["fact_partition_scan"](spark, sf_small)
    p = _formatted(df)
    assert re.search(r"PartitionFilters: \[[^\n]*order_month[^\n]*Subquery", p)


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", ["month_filter_fact", "month_filter_kpi_status", "month_filter_channel_view"])
def test_period_prunes_stored_fact(spark, sf_small, key):
    p = _formatted(E.queries()[key](spark, sf_small))
    assert re.search(r"PartitionFilters: \[[^\n]*order_month[^\n]*Subquery", p), key


@pytest.mark.parametrize("key", ["vw_channel_performance", "channel_monthly_summary", "vw_top_products_by_revenue",
                                 "chart_channels", "chart_top_products", "vw_monthly_channel_revenue"])
def test_labels_take_one_pass_over_the_fact(spark, sf_small, key):
    """Without broadcasts: a scan of the fact and one of the dimension, few exchanges, and channels joined on a salt."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    df = QUERIES[key](spark, sf_small)
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        p = plan_of(df.select("*"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert p.count("FileScan parquet") <= 2
    exchanges = re.findall(r"Exchange (?:hash|range)partitioning\(([^)]*)\)", p)
    assert len(exchanges) <= 6, exchanges
    if "product" not in key:
        assert not [e for e in exchanges if "channel_id" in e and "_salt" not in e], exchanges
    assert any("order_id" in e for e in exchanges)


def test_scan_counts(spark, sf_small):
    """One scan of the facts per query; comparisons and the forecast do not scan again for their parts."""
    for key, most in (("chart_kpi_totals", 1), ("chart_revenue_forecast", 1), ("dq_forecast_rows", 1),
                      ("chart_segments", 1), ("chart_mini_trends", 1)):
        assert plan_of(QUERIES[key](spark, sf_small)).count("FileScan parquet") <= most, key


def test_rfm_scans_the_orders_once(spark, sf_small):
    """The last order date comes from the landed table's statistics."""
    p = plan_of(QUERIES["customer_rfm"](spark, sf_small))
    scans = re.findall(r"FileScan parquet [^\n]*", p)
    assert len([s for s in scans if "table_stats" not in s and "order_id" in s]) == 1, scans


def test_plans_do_not_show_earlier_runs(spark, sf_small):
    """A query that has run before has the plan that it had at first."""
    first = plan_of(QUERIES["customer_rfm"](spark, sf_small)).count("FileScan parquet")
    QUERIES["customer_rfm"](spark, sf_small).collect()
    assert plan_of(QUERIES["customer_rfm"](spark, sf_small)).count("FileScan parquet") == first
    test_rfm_scans_the_orders_once(spark, sf_small)
