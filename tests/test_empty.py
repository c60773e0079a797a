"""Empty input: every table, view and chart runs and yields no data rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kpiforge import schemas as S
from kpiforge.operators.quality import dq_checks
from kpiforge.plans.charts import CHARTS
from kpiforge.plans.warehouse import TABLES, VIEWS, Warehouse
from kpiforge.session import scratch_path
from kpiforge.sources.tables import load, write_table

# global aggregates return one row (of NULLs / zeros) even without input
ONE_ROW = {"chart_kpi_totals"}


@pytest.fixture(scope="module")
def empty_wh(spark):
    return Warehouse.from_bronze(spark, spark.createDataFrame([], S.BRONZE))


@pytest.mark.parametrize("name", TABLES + VIEWS)
def test_tables_and_views_empty(empty_wh, name):
    df = empty_wh.view(name) if name in VIEWS else empty_wh.table(name)
    assert df.count() == 0


@pytest.mark.parametrize("name", sorted(CHARTS))
def test_charts_empty(empty_wh, name):
    rows = CHARTS[name](empty_wh).collect()
    assert len(rows) == (1 if name in ONE_ROW else 0)


def test_dq_checks_empty(empty_wh):
    rows = {r.check_name: r.value for r in dq_checks(empty_wh.bronze, empty_wh.silver, empty_wh.fact).collect()}
    assert set(rows.values()) == {0} and len(rows) == 6


def test_create_if_absent_and_append(spark):
    root = scratch_path(spark, "modes")
    a = spark.range(3).withColumn("v", F.lit("a"))
    b = spark.range(5).withColumn("v", F.lit("b"))
    write_table(a, root, "t", sort=["id"])
    write_table(b, root, "t", sort=["id"], mode="ignore")  # CREATE ... IF NOT EXISTS
    assert load(spark, root, "t").count() == 3
    write_table(b, root, "t", sort=["id"], mode="append")  # INSERT ... SELECT
    assert load(spark, root, "t").count() == 8
    write_table(b, root, "t", sort=["id"])  # full refresh
    assert {r.v for r in load(spark, root, "t").collect()} == {"b"}
