"""Small helpers to build bronze-shaped frames for unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kpiforge.functions.constants import BRONZE_COLUMNS

BRONZE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), False) for c in BRONZE_COLUMNS])

DEFAULT_ROW = {
    "order_id": "ORD-1", "order_date": "06-07-22", "customer_id": "C1", "customer_name": "Ann",
    "product_id": "P1", "product_name": "Widget", "category": "Tools", "sub_category": "Small",
    "channel_name": "Web", "quantity": "2", "revenue": "10.00", "cost": "4.00", "profit": "6.00",
    "discount": "0.00", "country": "India", "state": "Goa", "city": "Panaji",
}


def bronze(spark: SparkSession, rows: list[dict]) -> DataFrame:
    data = [tuple({**DEFAULT_ROW, **r}[c] for c in BRONZE_COLUMNS) for r in rows]
    return spark.createDataFrame(data, BRONZE_SCHEMA)


def fact_rows(spark: SparkSession, rows: list[tuple[str, dt.date, int, float]]) -> DataFrame:
    """(order_id, order_date, quantity, revenue) -> fact-shaped frame."""
    schema = T.StructType([
        T.StructField("order_id", T.StringType()), T.StructField("order_date", T.DateType()),
        T.StructField("customer_id", T.StringType()), T.StructField("product_id", T.StringType()),
        T.StructField("channel_id", T.LongType()), T.StructField("quantity", T.IntegerType()),
        T.StructField("revenue", T.DoubleType()), T.StructField("cost", T.DoubleType()),
        T.StructField("profit", T.DoubleType()), T.StructField("discount", T.DoubleType()),
    ])
    data = [(o, d, "C1", "P1", 1, q, r, 0.0, r, 0.0) for o, d, q, r in rows]
    return spark.createDataFrame(data, schema)
