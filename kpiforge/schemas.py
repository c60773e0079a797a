"""Output contracts of the warehouse tables (Spark types)."""

from __future__ import annotations

from pyspark.sql import types as T

from kpiforge.functions.constants import BRONZE_COLUMNS

S, D, I, L, DB, TS = (T.StringType(), T.DateType(), T.IntegerType(), T.LongType(),
                      T.DoubleType(), T.TimestampType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BRONZE = _struct(*[(c, S) for c in BRONZE_COLUMNS], ("ingestion_time", TS))

SILVER = _struct(
    ("order_id", S), ("order_date", D), ("customer_id", S), ("customer_name", S),
    ("product_id", S), ("product_name", S), ("category", S), ("sub_category", S),
    ("channel_name", S), ("quantity", I), ("revenue", DB), ("cost", DB), ("profit", DB),
    ("discount", DB), ("country", S), ("state", S), ("city", S), ("ingestion_time", TS),
)

FACT_SALES = _struct(
    ("order_id", S), ("order_date", D), ("customer_id", S), ("product_id", S),
    ("channel_id", L), ("quantity", I), ("revenue", DB), ("cost", DB), ("profit", DB),
    ("discount", DB),
)

SALES_FORECAST_RESULT = _struct(
    ("sales_date", D), ("metric_name", S), ("actual_value", DB), ("forecast_value", DB),
    ("lower_bound", DB), ("upper_bound", DB), ("model_name", S), ("created_at", TS),
)

DQ_RESULT = _struct(("check_name", S), ("value", L))
