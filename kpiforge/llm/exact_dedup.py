"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of ``block_bytes`` bytes.  Distinct blocks are sorted by hash into
integer names: equal names mean equal bytes.  Then adjacent names are paired and the distinct pairs
named in the same way, level by level, until each text has one name.  A text leaves at the level
where it is one name, so a short text takes no part in the levels of a longer one.  Its identity is
that level with its name: two texts have the same one exactly when they are equal, as every name
stands for contents that were grouped and sorted, so a hash collision cannot merge two of them.

Blocks cross the network once, where distinct contents are grouped.  References to a block carry
only its 64-bit hash; the name is looked up by hash, and where several contents share one hash (a
collision) by the content itself.  Distinct contents are aggregated before the shuffle, and
the look-ups are plain joins, which Spark splits where a block or text is in a third of all rows.

Defined cases: a null text counts as empty; the empty text is one empty block; rows that repeat an
id are rows of their own (each is counted in the group); a null id is smaller than any other; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.text import store, store_result

BLOCK_BYTES = 4096
_BLOCKS = ("__row long, __id long, __sha string, __count int, __pos int, __block binary")


def _cut(block_bytes: int, with_rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.ascii_lower(batch.column(2).fill_null(""))
            rows, ids, shas, counts, positions, blocks = [], [], [], [], [], []
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                data = text.as_buffer().to_pybytes() if text.as_buffer() is not None else b""
                count = max(1, -(-len(data) // block_bytes))
                sha = hashlib.sha256(data).hexdigest()
                for pos in range(count):
                    rows.append(row)
                    ids.append(doc)
                    shas.append(sha if pos == 0 else None)
                    counts.append(count)
                    positions.append(pos)
                    blocks.append(data[pos * block_bytes:(pos + 1) * block_bytes])
                if len(blocks) >= 2048:
                    yield with_rows(rows, ids, shas, counts, positions, blocks)
                    rows, ids, shas, counts, positions, blocks = [], [], [], [], [], []
            yield with_rows(rows, ids, shas, counts, positions, blocks)
    return run


def _batch(rows, ids, shas, counts, positions, blocks) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(shas, pa.string()),
         pa.array(counts, pa.int32()), pa.array(positions, pa.int32()), pa.array(blocks, pa.binary())],
        ["__row", "__id", "__sha", "__count", "__pos", "__block"])


def name_contents(refs: DataFrame, contents: list[str], hashed: Column, buckets: int) -> DataFrame:
    """``refs`` with ``__name``: the integer name of its ``contents``, equal exactly for equal contents.

    Names are dense inside each hash bucket: bucket * 2**40 + the rank of the content in it.
    """
    refs = refs.withColumn("__hash", hashed)
    bucket = F.pmod("__hash", F.lit(buckets))
    # contents cross the network here, once; beyond, a hash stands for its only content
    kinds = store(refs.select("__hash", *contents).distinct().groupBy("__hash")
                  .agg(F.count(F.lit(1)).alias("__kinds")), "kinds").withColumn("__bucket", bucket)
    place = Window.partitionBy("__bucket").orderBy("__hash")
    single = kinds.filter("__kinds = 1").select("__hash", (F.col("__bucket") * F.lit(1 << 40)
                                                           + F.row_number().over(place)).alias("__name"))
    named = refs.drop(*contents).join(single, "__hash")
    shared = kinds.filter("__kinds > 1").select("__hash", "__bucket")
    if not shared.isEmpty():
        # several contents of one hash: their names are negative, by the contents themselves
        place = Window.partitionBy("__bucket").orderBy("__hash", *contents)
        contested = refs.join(shared, "__hash").select("__hash", "__bucket", *contents).distinct().select(
            "__hash", *contents, (-F.col("__bucket") * F.lit(1 << 40) - F.row_number().over(place)).alias("__name"))
        named = named.unionByName(refs.join(contested, ["__hash", *contents]).drop(*contents))
    return named.drop("__hash")


def identities(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row per row of ``df``: __id, __sha (SHA-256 of the normalised text), __level and __name (its identity).

    ``hash_bits`` below 64 makes collisions common; the result is the same (for tests).
    """
    def hashed(*cols: str) -> Column:
        h = F.xxhash64(*cols)
        return h if hash_bits == 64 else F.pmod(h, F.lit(1 << hash_bits))

    docs = df.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).cast("long").alias("__id"),
                     F.col(text_col).alias("__t"))
    blocks = store(docs.mapInArrow(_cut(block_bytes, _batch), _BLOCKS), "blocks")
    longest = blocks.agg(F.max("__count"), F.count(F.lit(1))).first()
    buckets = max(1, (longest[1] or 0) // 20_000 + 1)
    refs = blocks.select("__row", "__count", "__pos", "__block")
    names = store(name_contents(refs, ["__block"], hashed("__block"), buckets), "level")

    def finished(level: int) -> DataFrame:
        return names.filter(F.col("__count") <= 1 << level).select("__row", F.lit(level).alias("__level"), "__name")

    level, done = 0, finished(0)
    while (longest[0] or 1) > 1 << level:
        # the others are paired; one without a right neighbour has 0 there, as names start at 1 or are below 0
        half = F.expr("__pos div 2").cast("int").alias("__half")
        paired = names.filter(F.col("__count") > 1 << level).groupBy("__row", "__count", half).agg(
            F.max(F.when(F.col("__pos") % 2 == 0, F.col("__name"))).alias("__left"),
            F.coalesce(F.max(F.when(F.col("__pos") % 2 == 1, F.col("__name"))), F.lit(0).cast("long")).alias("__right"))
        paired = paired.withColumnRenamed("__half", "__pos")
        # names of one level are only compared with others of that level
        names = store(name_contents(paired, ["__left", "__right"], hashed("__left", "__right"), buckets), "level")
        level += 1
        done = done.unionByName(finished(level))
    heads = blocks.filter("__pos = 0").select("__row", "__id", "__sha")
    return heads.join(done, "__row").drop("__row")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """Group of every row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; with that id repeated, all its rows have kept.
    """
    # the blocks and levels are not needed once every row has its identity
    named = store_result(df.sparkSession, lambda: identities(df, id_col, text_col, block_bytes, hash_bits), "identities")
    groups = named.groupBy("__level", "__name").agg(F.max("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["__level", "__name"]).select(
        F.col("__id").alias("doc_id"), "keep_id", "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("__sha").alias("text_sha256"))
