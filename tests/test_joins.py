"""Salted fact-to-dimension join equals the plain join, hot key or not."""

from __future__ import annotations

import pytest

from kpiforge.operators.joins import join_dim


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    # 'Unknown' holds 90 % of the fact rows; 'ghost' has no dimension row; one NULL key
    fact = spark.createDataFrame(
        [("Unknown" if i % 10 else f"C{i % 7}", f"O{i}", float(i)) for i in range(2000)]
        + [("ghost", "G1", 1.0), (None, "N1", 2.0)],
        "customer_id string, order_id string, revenue double")
    dim = spark.createDataFrame(
        [("Unknown", "Goa"), ("C0", "Kerala"), ("C3", "Assam")], "customer_id string, state string")
    plain = sorted((tuple(r) for r in fact.join(dim, "customer_id", how).collect()), key=repr)
    salted = join_dim(fact, dim, "customer_id", how=how, hot_keys=["Unknown"],
                      salt_col="order_id", buckets=16)
    got = salted.select(*fact.join(dim, "customer_id", how).columns).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain


def test_salt_spreads_the_hot_key(spark):
    """With a sort-merge join (no broadcast), the hot key's rows reach many reducers."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = spark.createDataFrame([("Unknown", f"O{i}") for i in range(4000)],
                                     "customer_id string, order_id string")
        dim = spark.createDataFrame([("Unknown", "Goa")], "customer_id string, state string")
        j = join_dim(fact, dim, "customer_id", how="inner", hot_keys=["Unknown"],
                     salt_col="order_id")
        assert "SortMergeJoin" in j._jdf.queryExecution().executedPlan().toString()
        per_reducer = j.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(per_reducer) >= 6  # unsalted, all 4000 rows would share one reducer
        assert sum(r["count"] for r in per_reducer) == 4000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salt_requires_a_salt_column(spark):
    fact = spark.createDataFrame([("a",)], "customer_id string")
    with pytest.raises(ValueError):
        join_dim(fact, fact, "customer_id", hot_keys=["a"])
