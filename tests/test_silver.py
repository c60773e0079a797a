"""Parse-or-zero, date rules and the silver filter."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from kpiforge.functions.expr import double_or_zero, int_or_zero, iso_state_code, mmddyy_date, mmddyy_valid
from kpiforge.operators.silver import silver_orders, silver_rejects
from helpers import bronze

NUMBERS = ["2", "2.0", " 3 ", "", "abc", "+4", "99999999999", "1d", "nan", "1e3", "-5"]
AS_INT = [2, 0, 0, 0, 0, 4, 0, 0, 0, 0, -5]
AS_DOUBLE = [2.0, 2.0, 0.0, 0.0, 0.0, 4.0, 99999999999.0, 0.0, float("nan"), 1000.0, -5.0]


def test_int_or_zero(spark):
    df = spark.createDataFrame([(s,) for s in NUMBERS], "s string")
    got = [r.v for r in df.select(int_or_zero("s").alias("v")).collect()]
    assert got == AS_INT


def test_double_or_zero(spark):
    df = spark.createDataFrame([(s,) for s in NUMBERS], "s string")
    got = [r.v for r in df.select(double_or_zero("s").alias("v")).collect()]
    for g, e in zip(got, AS_DOUBLE):
        assert (math.isnan(g) and math.isnan(e)) or g == e


@pytest.mark.parametrize("text,expected", [
    ("06-07-22", dt.date(2022, 6, 7)),
    ("13-01-22", None),
    ("02-30-22", None),
    ("02-29-24", dt.date(2024, 2, 29)),
    ("2022-06-07", None),
    ("06-07-22\n", None),
    ("6-7-22", None),
    ("00-07-22", None),
])
def test_mmddyy(spark, text, expected):
    r = spark.createDataFrame([(text,)], "s string").select(
        F.when(mmddyy_valid("s"), mmddyy_date("s")).alias("d")).collect()[0]
    assert r.d == expected


def test_silver_rules(spark):
    b = bronze(spark, [
        {"order_id": "ok"},
        {"order_id": ""},
        {"order_id": "no-product", "product_id": ""},
        {"order_id": "bad-shape", "order_date": "2022-06-07"},
        {"order_id": "feb30", "order_date": "02-30-22"},
        {"order_id": "q0", "quantity": "0"},
        {"order_id": "q2.0", "quantity": "2.0"},
        {"order_id": "neg", "revenue": "-5.00"},
        {"order_id": "nan", "revenue": "nan"},
        {"order_id": "abc", "revenue": "abc"},
        {"order_id": "1d", "revenue": "1d"},
        {"order_id": "unknowns", "customer_id": "", "customer_name": "", "category": "",
         "channel_name": "", "state": "", "product_name": ""},
    ])
    s = {r.order_id: r for r in silver_orders(b).collect()}
    assert set(s) == {"ok", "abc", "1d", "unknowns"}
    assert s["abc"].revenue == 0.0 and s["1d"].revenue == 0.0
    u = s["unknowns"]
    assert (u.customer_id, u.customer_name, u.category, u.channel_name, u.state) == ("Unknown",) * 5
    assert u.product_name == "P1"  # falls back to the product id
    assert s["ok"].order_date == dt.date(2022, 6, 7) and s["ok"].quantity == 2
    rejects = {r.reason: r.rows for r in silver_rejects(b).collect()}
    assert rejects == {"empty_order_id": 1, "empty_product_id": 1, "bad_date_format": 1,
                       "invalid_date": 1, "bad_quantity": 2, "bad_revenue": 2}


def test_reject_counts_add_up(spark, sf_small):
    from kpiforge.plans.warehouse import Warehouse
    wh = Warehouse.from_testdata(spark, sf_small)
    total = wh.bronze.count()
    kept = wh.silver.count()
    rejected = sum(r.rows for r in silver_rejects(wh.bronze).collect())
    assert total == kept + rejected
    assert (total, kept) == (6000, 4788)


def test_iso_state_code(spark):
    df = spark.createDataFrame([("Maharashtra",), ("rj",), ("Punjab/Mohali/Zirakpur",),
                                ("Atlantis",), (None,)], "s string")
    got = [r.c for r in df.select(iso_state_code("s").alias("c")).collect()]
    assert got == ["IN-MH", "IN-RJ", "IN-PB", "UNKNOWN", "UNKNOWN"]


def test_empty_input(spark):
    b = bronze(spark, []).limit(0)
    assert silver_orders(b).count() == 0
    assert silver_rejects(b).count() == 0
