"""Fact-to-dimension joins that stay balanced when one key is hot.

Dimension tables here are unique on their key (they are ``groupBy(key)``
outputs).  A fact key such as ``'Unknown'`` can carry a third of all fact
rows; in a plain sort-merge join all of them would land in one reducer.

``join_dim(..., hot_keys=[...], salt_col=...)`` salts the known hot keys:
fact rows of a hot key get a deterministic salt in ``[0, buckets)`` from a
hash of ``salt_col`` (so a retried task sees the same salt), and only the
dimension rows of the hot keys are replicated once per bucket -- at most
``len(hot_keys) * buckets`` extra rows, a bound that does not grow with the
data.  Every other key keeps salt 0.  The join then runs on (key, salt):
one scan of each side, one shuffle, and the hot key spread over ``buckets``
reducers.  Spark still picks broadcast (AQE, measured sizes) when the
dimension is small, and AQE's skew-join splitting covers hot keys that were
not known in advance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.constants import UNKNOWN

SALT = "_salt"
LABEL_SALTS = 16  # copies of each row of a dimension of few rows, such as channels


def default_buckets(df: DataFrame) -> int:
    """Salt values per hot key: 4x the shuffle partitions, so that after hash
    partitioning of (key, salt) nearly every reducer gets an even share (with
    one salt per partition, hash collisions leave many reducers empty)."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def join_dim(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
             hot_keys: list[str] | None = None, salt_col: str | None = None,
             buckets: int | None = None) -> DataFrame:
    """``fact`` JOIN ``dim`` USING ``key`` (dim unique on key); hot keys salted."""
    if not hot_keys:
        return fact.join(dim, key, how)
    if salt_col is None:
        raise ValueError("salting a hot key needs a salt column of the fact side")
    n = buckets or default_buckets(fact)
    hot = F.coalesce(F.col(key).isin(hot_keys), F.lit(False))
    salted = fact.withColumn(
        SALT, F.when(hot, F.pmod(F.xxhash64(F.col(salt_col)), F.lit(n)).cast("int")).otherwise(F.lit(0)))
    spread = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0))))
    dim_salted = dim.withColumn(SALT, spread)
    return salted.join(dim_salted, [key, SALT], how).drop(SALT)


def group_by_labels(fact: DataFrame, dim: DataFrame, key: str, period: list[str], labels: list[str],
                    parts: list[Column], sums: dict[str, Column], orders: str = "total_orders",
                    salts: int | None = None) -> DataFrame:
    """Totals per (period, labels of the dimension), with exact distinct orders, in one pass over the fact.

    Labels are joined to the fact's rows (broadcast where the dimension's size is under the threshold; else on (key, salt)
    where ``salts`` replicates a dimension of few rows, so that a channel with a third of the rows is spread; AQE
    splits what is skewed beyond that).  Then rows become one per (period, labels, order) with the partial sums
    ``parts``, spread by order whatever share of the rows a label has; and last, one per (period, labels), where
    an order counts once also if its lines have several keys of one label.  Ids without a dim row are 'Unknown'.
    """
    known = dim.select(key, *labels)
    if salts:
        fact = fact.withColumn(SALT, F.pmod(F.xxhash64("order_id"), F.lit(salts)).cast("int"))
        known = known.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    named = fact.join(known, [key, SALT] if salts else key, "left")
    named = named.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in labels})
    per_order = named.groupBy(*period, *labels, "order_id").agg(*parts)
    return per_order.groupBy(*period, *labels).agg(
        *(total.alias(name) for name, total in sums.items()), F.count("order_id").alias(orders))
