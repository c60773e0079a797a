"""Bronze (all strings) -> silver (typed, cleaned rows).

One narrow ``select`` + ``where``: no shuffle, no dedup (the warehouse keeps
every valid source row).  A row survives when all rules hold:

1. order id not empty
2. product id not empty
3. date text has the ``MM-DD-YY`` shape
4. month in 1..12, day in 1..31 and the date exists (Feb 30 is rejected)
5. quantity parses to an int > 0 (``'2.0'`` parses to 0)
6. revenue parses to a double >= 0 and is not NaN
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.expr import (
    double_or_zero,
    int_or_zero,
    mmddyy_date,
    mmddyy_range_ok,
    mmddyy_shape_ok,
    unknown_if_empty,
)

# (reason, predicate that holds for a valid row), in the order rows are attributed
def validity_rules() -> list[tuple[str, Column]]:
    revenue = double_or_zero("revenue")
    return [
        ("empty_order_id", F.col("order_id") != ""),
        ("empty_product_id", F.col("product_id") != ""),
        ("bad_date_format", mmddyy_shape_ok("order_date")),
        ("invalid_date", mmddyy_range_ok("order_date") & mmddyy_date("order_date").isNotNull()),
        ("bad_quantity", int_or_zero("quantity") > 0),
        ("bad_revenue", (revenue >= 0) & ~F.isnan(revenue)),
    ]


def is_valid() -> Column:
    """All rules, as plain conjuncts: in a WHERE a NULL (a NULL cell, which
    bronze never has) drops the row like false, and the simple conjuncts
    (non-empty ids) stay visible to Parquet filter pushdown."""
    rules = [p for _, p in validity_rules()]
    out = rules[0]
    for p in rules[1:]:
        out = out & p
    return out


def silver_orders(bronze: DataFrame) -> DataFrame:
    has_ingestion = "ingestion_time" in bronze.columns
    cols = [
        F.col("order_id"),
        mmddyy_date("order_date").alias("order_date"),
        unknown_if_empty("customer_id").alias("customer_id"),
        unknown_if_empty("customer_name").alias("customer_name"),
        unknown_if_empty("product_id").alias("product_id"),
        F.when(F.col("product_name") == "", F.col("product_id")).otherwise(F.col("product_name"))
        .alias("product_name"),
        unknown_if_empty("category").alias("category"),
        unknown_if_empty("sub_category").alias("sub_category"),
        unknown_if_empty("channel_name").alias("channel_name"),
        int_or_zero("quantity").alias("quantity"),
        double_or_zero("revenue").alias("revenue"),
        double_or_zero("cost").alias("cost"),
        double_or_zero("profit").alias("profit"),
        double_or_zero("discount").alias("discount"),
        unknown_if_empty("country").alias("country"),
        unknown_if_empty("state").alias("state"),
        unknown_if_empty("city").alias("city"),
    ]
    if has_ingestion:
        cols.append(F.col("ingestion_time"))
    return bronze.where(is_valid()).select(*cols)


def reject_reason() -> Column:
    """The first failed rule of a bronze row, NULL when the row is valid."""
    expr = None
    for reason, ok in validity_rules():
        failed = ~F.coalesce(ok, F.lit(False))
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    return expr


def silver_rejects(bronze: DataFrame) -> DataFrame:
    """Rejected bronze rows per first failed rule: (reason, rows)."""
    return (bronze.select(reject_reason().alias("reason"))
            .where(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))
