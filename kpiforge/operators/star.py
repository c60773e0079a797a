"""Silver -> star schema: four dimensions and the sales fact.

Dimension attributes that the warehouse takes as "any value" per key are
made deterministic and row-consistent with ``min(struct(...))``: one source
row supplies all attributes, and the same input always gives the same dim.
``min`` is an ordinary partial aggregate, so a hot key (the 'Unknown'
customer can hold a third of the rows) collapses map-side to one row per task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.constants import CHANNEL_TYPE, CUSTOMER_SEGMENT
from kpiforge.functions.expr import channel_id, fixed_round

UNIT_PRICE_SCALE = 4


def fact_sales(silver: DataFrame) -> DataFrame:
    return silver.select(
        "order_id", "order_date", "customer_id", "product_id",
        channel_id("channel_name").alias("channel_id"),
        "quantity", "revenue", "cost", "profit", "discount",
    )


def _keep_rows(per_key: DataFrame) -> DataFrame:
    """Keep keys with at least one source row (all of them).

    The predicate is what keeps the hash pre-aggregation in the plan: without
    a duplicate-sensitive aggregate above it, the optimizer would fold the
    per-(key, attributes) step into the sort-based struct ``min`` and sort the
    full input instead of the deduplicated combinations."""
    return per_key.where(F.col("rows") > 0)


def dim_customer(silver: DataFrame) -> DataFrame:
    attrs = ["customer_name", "country", "state", "city"]
    # hash aggregate per (key, attributes) first: map-side with fixed-width
    # buffers; the struct ``min`` (a sort-based aggregate) then only sees one
    # row per distinct attribute combination
    combos = (silver.where(F.col("customer_id").isNotNull())
              .groupBy("customer_id", *attrs).agg(F.count(F.lit(1)).alias("n")))
    return (
        _keep_rows(combos.groupBy("customer_id")
                   .agg(F.min(F.struct(*attrs)).alias("a"), F.sum("n").alias("rows")))
        .select("customer_id", "a.customer_name", F.lit(CUSTOMER_SEGMENT).alias("customer_segment"),
                "a.country", "a.state", "a.city")
    )


def dim_product(silver: DataFrame, price_scale: int | None = UNIT_PRICE_SCALE) -> DataFrame:
    attrs = ["product_name", "category", "sub_category"]
    price = F.when(F.col("quantity") > 0, F.col("revenue") / F.col("quantity"))
    # partial sums per (product, attributes) with hash aggregation, then one
    # row per product: avg = sum of prices / number of priced rows
    combos = (silver.where(F.col("product_id").isNotNull())
              .groupBy("product_id", *attrs)
              .agg(F.sum(price).alias("s"), F.count(price).alias("n"),
                   F.count(F.lit(1)).alias("rows")))
    unit = F.when(F.sum("n") > 0, F.sum("s") / F.sum("n"))  # avg of no rows is NULL
    if price_scale is not None:
        unit = fixed_round(unit, price_scale)
    return (
        _keep_rows(combos.groupBy("product_id")
                   .agg(F.min(F.struct(*attrs)).alias("a"), unit.alias("unit_price"),
                        F.sum("rows").alias("rows")))
        .select("product_id", "a.product_name", "a.category", "a.sub_category", "unit_price")
    )


def dim_channel(silver: DataFrame) -> DataFrame:
    return (
        silver.select("channel_name").distinct()
        .select(channel_id("channel_name").alias("channel_id"), "channel_name",
                F.lit(CHANNEL_TYPE).alias("channel_type"))
    )


def dim_time(silver: DataFrame) -> DataFrame:
    d = F.col("date")
    return (
        silver.select(F.col("order_date").alias("date")).distinct()
        .select(
            d,
            F.dayofmonth(d).alias("day"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
            F.year(d).alias("year"),
        )
    )
