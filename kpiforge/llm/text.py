"""Vectorised text helpers shared by the operators of this subpackage.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; in UTF-8 those bytes
never occur inside a longer character, so all work happens on the raw bytes of an Arrow column.
A null text counts as empty.  Arrays are cut into slices of about ``SLICE_BYTES``, so memory does
not grow with the batch; one very long text is one slice of its own.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import kpiforge
from kpiforge.session import drop_path, scratch_path

SLICE_BYTES = 1 << 18
# any odd multiplier: powers of it are invertible modulo 2**64
_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_SHIPPED: dict[str, str] = {}
# tables written since the innermost open ``store_result`` began
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
               "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = _LOWER.astype(np.uint64) + np.uint64(1)
# letters, digits and all bytes of longer characters make words; other ASCII stands between them
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage: a lost executor costs the tasks that are running, not the whole history.
    """
    path = scratch_path(df.sparkSession, name)
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_result(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``store`` what ``make`` returns and delete the tables that were stored on the way there, also if it fails.

    Only the returned table may be read afterwards.  Calls may be nested."""
    mine: list[str] = []
    token = _WRITTEN.set(mine)
    try:
        try:
            made = make()
        finally:
            _WRITTEN.reset(token)
        return store(made, name)
    finally:
        for path in mine:
            drop_path(spark, path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def row_key(id_col: Column, text_col: Column) -> Column:
    """64-bit hash of a row's id and text: rows that share a null id or repeat one are told apart by their texts."""
    return F.xxhash64(F.lit(59), id_col.isNull(), id_col, text_col)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application (as ``--py-files`` would).

    Texts are large rows: batches for Python are kept small, so that neither side buffers many."""
    sc = spark.sparkContext
    for key, value in ARROW_BATCH.items():
        spark.conf.set(key, value)
    if _SHIPPED.get("app") == sc.applicationId:
        return
    root = Path(kpiforge.__file__).parent
    # the file stays: Spark's driver hands it to executors for as long as the application runs
    archive = Path(tempfile.mkdtemp(prefix="kpiforge-package-"), "kpiforge-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SHIPPED["app"] = sc.applicationId


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array as one uint8 vector, and the offset of each row (nulls: empty)."""
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[
        texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive row ranges of about ``limit`` bytes: (first row, end row, bytes, offsets)."""
    data, offsets = raw(texts)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        stop = min(stop, len(texts))
        yield start, stop, data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; those of a slice are kept, those of a longer text are not."""
    name = str(base)
    p = _POWERS.get(name)
    if p is None or len(p) < n:
        p = np.full(max(n, SLICE_BYTES + 2), base, np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        if len(p) == SLICE_BYTES + 2:
            _POWERS[name] = p
    return p[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray,
               between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each row's word count; ``between`` marks other bytes."""
    word = ~between[data]
    if not word.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    edge = word.copy()
    edge[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    edge[first] = word[first]  # a row starts a new word even without white space before it
    starts = np.flatnonzero(edge)
    last = word.copy()
    last[:-1] &= ~word[1:]
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    last[ends_at] = word[ends_at]
    ends = np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(bounds)


def word_hashes(data: np.ndarray, offsets: np.ndarray,
                between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every lower-cased word, and each row's word count."""
    starts, ends, counts = word_spans(data, offsets, between)
    return span_hashes(data, starts, ends), counts


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every lower-cased byte span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.take(_CODES, data, out=total[1:], mode="clip")  # the default mode copies; bytes are never beyond
    total[1:] *= _powers(_MULT, len(data))
    np.cumsum(total[1:], out=total[1:])
    # the sum over the word, brought back to position 0
    return mix((total[ends] - total[starts]) * _powers(_INVERSE, len(data) + 1)[starts])


def hash_of(word: str) -> int:
    """The hash ``word_hashes`` gives one word."""
    raw_word = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(raw_word, np.array([0, len(raw_word)]))[0][0])


def last_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every word's last four bytes, lower-cased (shorter words: their bytes)."""
    code = np.zeros(len(ends), np.uint64)
    for back in range(1, 5):
        at = ends - back
        byte = np.where(at >= starts, _LOWER[data[np.maximum(at, 0)]], 0)
        code = code * np.uint64(257) + byte.astype(np.uint64)
    return (mix(code) % np.uint64(buckets)).astype(np.int64)


class HashIndex:
    """Position of 64-bit hashes in a fixed array of distinct keys (-1: not there), by open addressing."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys.astype(np.uint64)
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.mask = np.uint64(size - 1)
        self.slots = np.full(size, -1, np.int32)
        waiting, step = np.arange(len(keys)), 0
        while len(waiting):
            at = ((self.keys[waiting] + np.uint64(step)) & self.mask).astype(np.int64)
            _, first = np.unique(at, return_index=True)
            first = first[self.slots[at[first]] < 0]
            self.slots[at[first]] = waiting[first]
            waiting = np.delete(waiting, first)
            step += 1
        self.steps = step

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.keys):
            return out
        open_ = np.arange(len(hashes))
        for step in range(self.steps):
            slot = self.slots[((hashes[open_] + np.uint64(step)) & self.mask).astype(np.int64)]
            there = slot >= 0
            hit = there & (self.keys[np.maximum(slot, 0)] == hashes[open_])
            out[open_[hit]] = slot[hit]
            open_ = open_[there & ~hit]
            if not len(open_):
                break
        return out


CHUNKS = 64
FAN = 64
PARTS = "part int, chunk int, counts binary"


def chunks(part: int, total: np.ndarray) -> pa.RecordBatch:
    """A task's vector of sums as ``CHUNKS`` rows for ``vector_sum``."""
    split = np.array_split(total, CHUNKS)
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * CHUNKS, pa.int32()), pa.array(range(CHUNKS), pa.int32()),
         pa.array([c.tobytes() for c in split], pa.binary())], ["part", "chunk", "counts"])


def _adder(dtype: str):
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), dtype) for c in table.column("counts").combine_chunks())
        return pa.table({"part": table.column("part")[:1].cast(pa.int32()),
                         "chunk": table.column("chunk")[:1].cast(pa.int32()),
                         "counts": pa.array([total.tobytes()], pa.binary())})
    return add


def vector_sum(parts: DataFrame, size: int, dtype: str = "int64") -> np.ndarray:
    """Sum of the tasks' vectors of a fixed size, added in a tree: at most ``FAN`` in one place."""
    level = parts
    while True:
        level = store(level.withColumn("part", F.expr(f"part div {FAN}").cast("int"))
                      .groupBy("part", "chunk").applyInArrow(_adder(dtype), PARTS), "sums")
        if not level.agg(F.max("part")).first()[0]:
            break
    rows = sorted((r.chunk, bytes(r.counts)) for r in level.collect())
    return np.frombuffer(b"".join(c for _, c in rows), dtype).copy() if rows else np.zeros(size, dtype)
