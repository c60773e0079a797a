"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has a bit set where more than half of the text's shingle hashes have it.  Distinct
fingerprints emit every variant within half the radius: themselves and, for a radius of 2, their 64
neighbours at one bit.  Two fingerprints within the radius have a variant in the middle in
common; they are shuffled on variants, meet there, and their distinct pairs are verified by the
count of differing bits.

A variant's ball holds at most 65 distinct fingerprints, so no group is large, whatever copies the texts have:
rows of one fingerprint are one node before anything is emitted.  All members of a ball are within the
radius of each other, so a chain through the ball links the same components as all its pairs.

Defined cases: a null text counts as empty; texts without words have fingerprint 0, which links like any
other; a text of fewer than ``SHINGLE`` words is one shingle; a null id links but names no component
(null where a component has no other ids); rows that repeat an id are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.ngram_join import components
from kpiforge.llm.text import store

SHINGLE = 3
SEED = 42
RADIUS = 2
_CHUNK = 1 << 14


def fingerprint(text: bytes, words: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the XXH64 of all word shingles, A-Z lower-cased, words apart by one space."""
    found = text.lower().split()  # of bytes: ASCII letters, and white space \x20 \x09-\x0D
    if not found:
        return 0
    spaced = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(spaced, seed)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    total = len(found) - words + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _CHUNK):
        stop = min(at + _CHUNK, total)
        spans = zip(starts[at:stop].tolist(), ends[at + words - 1:stop + words - 1].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(spaced[a:b], seed) for a, b in spans), "<u8", stop - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > total).tolist()))


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["id", "print"])
    return run


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """(id, print): the fingerprint of every row, as a signed long."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints(words, seed), "id long, print long")


def ball(value: Column, reach: int) -> Column:
    """All variants of a fingerprint within ``reach`` bits, each with the bits changed: array of (variant, changed)."""
    masks = [0]
    for _ in range(reach):
        masks = sorted({m ^ (1 << k) for m in masks for k in range(64)} | set(masks))
    changed = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks))
    return F.transform(changed, lambda m: F.struct(value.bitwiseXOR(m).alias("variant"), m.alias("changed")))


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints of ``prints`` (print) within ``radius`` bits, a < b: enough of them to connect all.

    With an odd radius, one side of a pair reaches one bit further than the other; both emit the wider ball.
    """
    variants = (prints.select(F.explode(ball(F.col("print"), -(-radius // 2))).alias("v"))
                .select("v.variant", "v.changed"))
    met = variants.select("variant", F.col("variant").bitwiseXOR(F.col("changed")).alias("print"))
    if radius % 2:  # members of a ball may be radius + 1 apart: each with every other of the ball, bounded by its size
        met = met.withColumn("all", F.collect_list("print").over(Window.partitionBy("variant")))
        met = met.select("print", F.explode("all").alias("other"))
    else:
        met = met.withColumn("other", F.lag("print").over(Window.partitionBy("variant").orderBy("print")))
    pairs = met.filter("other < print").select(F.col("other").alias("a"), F.col("print").alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                    radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    prints = store(fingerprints(df, id_col, text_col, words, seed), "fingerprints")
    kinds = store(prints.groupBy("print").agg(F.min("id").alias("first")), "kinds")
    links = store(near_pairs(kinds.select("print"), radius), "pairs")
    named = kinds.select("print", F.col("print").alias("root"), "first")
    if not links.isEmpty():
        roots = components(links).withColumnRenamed("id", "print")
        named = kinds.join(roots, "print", "left").select("print", F.coalesce("root", "print").alias("root"), "first")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store(named.join(smallest, "root").select("print", "component_id"), "components")
    return prints.join(named, "print").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
