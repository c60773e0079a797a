"""Sharding by proportional stratified interleaving.

Rows of every source are put in a seeded order; the row of rank r among the n of its source gets
the fraction (r + 1/2) / n.  Sorting all rows by that fraction interleaves the sources in
proportion, so any contiguous cut has the mixture of the whole.  The sorted rows are cut into
``shards`` runs whose lengths differ by at most one.

Both orders are uniform by construction (a hash, a fraction), so each is cut into equal buckets:
ranks are bucket offsets plus ``row_number`` inside one bucket.  A hot source is many buckets, equal rows
are numbered before they are hashed, and no window holds more than about ``MOST_ROWS`` rows.  Only DataFrame functions are used.

Defined cases: a null source is a stratum of its own; a null text has size 1 and checksum 0; a null
id is ordered first; repeated rows are rows like any other (their order among themselves does not
change the result); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.text import store

MOST_ROWS = 50_000
COPIES = 100  # equal rows (id, source, size, checksum) from which they are numbered


def _ranked(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], rank: str,
            size: str | None = None) -> DataFrame:
    """Add 0-based ``rank`` within ``group`` in the order (bucket, order), and the group's ``size``."""
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    if size:
        counts = counts.withColumn(size, F.sum("__rows").over(whole))
    keys = [*group, bucket]
    counts = counts.drop("__rows").withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    here = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__here", F.row_number().over(here))
            .join(counts, same)
            .withColumn(rank, F.col("__before") + F.col("__here") - 1)
            .drop("__here", "__before", *(f"__k{i}" for i in range(len(keys)))))


def _bucket(hashed: Column, buckets: int) -> Column:
    """Bucket of a non-negative 63-bit hash; the buckets keep the order of the hash."""
    return F.floor(F.shiftrightunsigned(hashed, 32) * F.lit(buckets) / F.lit(1 << 31)).cast("int")


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__copy``: 0, but a number of its own for each of more than ``COPIES`` equal rows.

    Hashes then spread them like different rows, and the set of their hashes does not depend on their order."""
    same = ["__id", "__source", "__size", "__crc"]
    many = store(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > COPIES).drop("__n"), "equal-rows")
    if many.isEmpty():
        return rows.withColumn("__copy", F.lit(0).cast("long")).drop("__part")
    many = many.withColumnsRenamed({c: f"__m{c}" for c in same})
    on = [F.col(c).eqNullSafe(F.col(f"__m{c}")) for c in same]
    few = rows.join(many, on, "left_anti").withColumn("__copy", F.lit(0).cast("long"))
    # a window holds the equal rows of one task that read the table
    copies = _ranked(rows.join(many, on, "left_semi"), same, "__part", ["__size"], "__copy").withColumn("__copy", F.col("__copy").cast("long"))
    return few.unionByName(copies).drop("__part")


def interleave(df: DataFrame, shards: int = 16, seed: int = 17, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source", carry: Sequence[str] = (),
               rows_per_bucket: int | None = None) -> DataFrame:
    """Assign every row a shard and a gapless slot in it.

    Returns id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard and the columns
    named in ``carry`` (such as the text, when the shards are to be written).  By default a bucket
    has about 10 sqrt(n) rows, so neither the buckets nor the rows in one are many.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"),
        (F.octet_length(text) + 1).cast("long").alias("__size"),
        F.crc32(text.cast("binary")).alias("__crc"),
        *(F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)),
    ).withColumn("__part", F.spark_partition_id())
    parts = [F.lit(seed), "__id", "__size", "__crc"]
    rows = store(_numbered_copies(store(rows, "shard-rows")), "shard-copies").withColumn("__hash", F.shiftrightunsigned(
        F.when(F.col("__copy") == 0, F.xxhash64(*parts)).otherwise(F.xxhash64(*parts, "__copy")), 1))
    n = rows.count()
    buckets = max(1, -(-n // (rows_per_bucket or max(1, min(MOST_ROWS, 10 * isqrt(n))))))
    order = ["__hash", "__id", "__size", "__crc", "__copy"]
    rows = rows.withColumn("__bucket", _bucket(F.col("__hash"), buckets))
    rows = _ranked(rows, ["__source"], "__bucket", order, "__rank", "__of")
    rows = rows.withColumn("__at", (2 * F.col("__rank") + 1) / (2 * F.col("__of")))
    rows = rows.withColumn("__bucket", F.floor(F.col("__at") * buckets).cast("int"))
    # one group of all rows: the running total is over the buckets, not over the rows
    rows = _ranked(rows.withColumn("__all", F.lit(0)), ["__all"], "__bucket",
                   ["__at", "__source", "__rank"], "__pos")
    shard = F.floor(F.col("__pos") * shards / F.lit(max(n, 1)))
    # first position of a shard: the smallest p with floor(p * shards / n) = shard
    rows = rows.withColumn("__shard", shard)
    first = F.ceil(F.col("__shard") * F.lit(n) / F.lit(shards))
    return rows.select(
        F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("__shard").cast("int").alias("shard"),
        (F.col("__pos") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *(F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)))


def write_shards(df: DataFrame, path: str, shards: int = 16, seed: int = 17, **names: str) -> None:
    """Write the rows as one folder per shard; files of a shard hold slot ranges in slot order."""
    placed = interleave(df, shards, seed, carry=[c for c in df.columns if c not in _DIGEST],
                        **names)
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


_DIGEST = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
