"""Hard-negative mining over an STR-packed R-tree.

Vectors are sort-tile-recursive packed: ranked along the coordinate of most variance and cut into slabs,
ranked along the next inside each slab and cut into tiles of ``TILE`` rows (both by exact positions, so
equal vectors are spread over tiles like any others).  A tile is one row of the stored tree: inside it, the rows
of a label are packed in the same way into leaves of ``LEAF`` rows.  A box's smallest and largest coordinates
bound the inner product with an anchor coordinate by coordinate.

A search takes a block of anchors and a lane of ``LANE`` tiles from a queue, best bound first: tiles
open into leaves, leaves into rows.  A box is skipped for an anchor when it lies outside the anchor's
score windows, when it holds only labels the anchor does not look for, or when its bound is strictly below the k-th score
found; equal scores are never skipped, as a smaller id may win.  First the positives of every anchor
are searched, then the negatives in the windows that the positives' scores give.

Anchors against all rows are blocks against lanes, joined on (block, lane); every anchor meets every lane's
boxes once, and its best rows of each lane are merged.  No group is larger than ``ANCHORS`` anchors and
``LANE * TILE`` rows.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; vectors
of different lengths compare as if padded with zeros; a null id comes after all others in a tie and is no anchor;
rows that repeat an id are rows of their own, and each of them is an anchor where its id is one; scores beyond 64 bits are
cut to the largest (smallest) long; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.ranks import positions
from kpiforge.llm.text import PARTS, chunks, store, vector_sum

TILE = 1024
LEAF = 32
LANE = 4
ANCHORS = 1024
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # per cent of the positive's score
_NO_ID = np.iinfo(np.int64).max  # stands for a null id; larger than any other
_EXACT = 2.0 ** 53


def prepared(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(row, id, label, q): the rows that take part, with components floor(scale * x)."""
    x = F.col(vector_col)
    # NaN is above infinity in Spark's order
    usable = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    return (df.withColumn("__label", label)
            .filter(F.col("__label").isNotNull() & x.isNotNull() & usable)
            .select(F.monotonically_increasing_id().alias("row"),
                    F.coalesce(F.col(id_col).cast("long"), F.lit(int(_NO_ID))).alias("id"), F.col("__label").cast("long").alias("label"),
                    F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long")).alias("q")))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` int64 numbers, shorter lists padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _moments(width: int):
    def run(batches):
        from pyspark import TaskContext

        total = np.zeros((2, width))
        for batch in batches:
            q = _matrix(batch.column(0), width).astype(float)
            total += [q.sum(0), (q * q).sum(0)]
        yield chunks(TaskContext.get().partitionId(), total.ravel())
    return run


def _str_order(q: np.ndarray, rows: np.ndarray, axes: list[int], leaf: int) -> list[np.ndarray]:
    """Leaves of about ``leaf`` rows: slabs along the first axis, each cut along the next."""
    if len(rows) <= leaf:
        return [rows]
    leaves = -(-len(rows) // leaf)
    slabs = leaves if len(axes) == 1 else int(np.ceil(leaves ** (1 / len(axes))))
    size = -(-leaves // slabs) * leaf
    rows = rows[np.argsort(q[rows, axes[0]], kind="stable")]
    return [part for at in range(0, len(rows), size) for part in _str_order(q, rows[at:at + size], axes[1:] or axes, leaf)]


def _pack(width: int, leaf: int):
    def run(tile: pa.Table) -> pa.Table:
        tile = tile.sort_by("row")
        q = _matrix(tile.column("q"), width)
        label = tile.column("label").to_numpy()
        axes = np.argsort(-q.astype(float).var(axis=0), kind="stable")[:3].tolist() or [0]
        # a leaf holds one label
        leaves = [part for one in np.unique(label)
                  for part in (_str_order(q, np.flatnonzero(label == one), axes, leaf) if width else [np.flatnonzero(label == one)])]
        order = np.concatenate(leaves)
        small = np.int32 if not q.size or np.abs(q).max() < 2 ** 31 and q.min() > -2 ** 31 else np.int64
        ids = lambda c: tile.column(c).to_numpy()[order].astype(np.int64).tobytes()
        return pa.table({
            "tile": tile.column("tile")[:1], "rows": pa.array([ids("row")], pa.binary()), "ids": pa.array([ids("id")], pa.binary()),
            "labels": pa.array([ids("label")], pa.binary()), "q": pa.array([q[order].astype(small).tobytes()], pa.binary()),
            "leaves": pa.array([np.cumsum([0, *map(len, leaves)]).astype(np.int32).tobytes()], pa.binary())})
    return run


_TILE = "tile long, rows binary, ids binary, labels binary, q binary, leaves binary"


def packed(rows: DataFrame, width: int, tile: int, leaf: int) -> tuple[DataFrame, DataFrame, int]:
    """The rows with their tile, the stored tiles, and how many there are."""
    if rows.isEmpty():
        axes = [0, 0]
    else:
        sums = vector_sum(rows.select("q").mapInArrow(_moments(width), PARTS), 2 * width, "float64").reshape(2, -1)
        n = rows.count()
        axes = np.argsort(sums[0] ** 2 / n - sums[1], kind="stable")[:2].tolist() or [0]
        axes = [*axes, *axes][:2]
    total = rows.count()
    slab = tile * max(1, int(np.ceil(np.sqrt(-(-total // tile)))))
    at = lambda axis: F.coalesce(F.get("q", F.lit(axis)), F.lit(0))
    keyed = rows.withColumns({"__all": F.lit(0), "x": at(axes[0]), "y": at(axes[1])})
    slabs = positions(keyed, "__all", ["x", "row"]).select(
        "row", "id", "label", "q", "x", "y", F.expr(f"__pos div {slab}").alias("slab"))
    tiled = positions(slabs, "slab", ["y", "row"]).withColumn(
        "tile", F.col("slab") * (slab // tile) + F.expr(f"__pos div {tile}")).select("row", "id", "label", "q", "tile")
    tiled = store(tiled, "tiled")
    tiles = store(tiled.groupBy("tile").applyInArrow(_pack(width, leaf), _TILE), "tiles")
    return tiled, tiles, max(1, -(-total // slab) * (slab // tile))


class _Tile:
    """A stored tile, with the boxes of its leaves."""

    def __init__(self, width: int, rows: bytes, ids: bytes, labels: bytes, q: bytes, leaves: bytes) -> None:
        self.rows, self.ids, labels = (np.frombuffer(b, np.int64) for b in (rows, ids, labels))
        self.starts = np.frombuffer(leaves, np.int32)
        kind = np.int32 if len(q) == 4 * width * len(self.rows) else np.int64
        self.q = np.frombuffer(q, kind).reshape(-1, width).astype(np.int64)
        self.labels = labels[self.starts[:-1]]
        self.low = np.minimum.reduceat(self.q, self.starts[:-1], axis=0) if width else self.q[:len(self.labels)]
        self.high = np.maximum.reduceat(self.q, self.starts[:-1], axis=0) if width else self.q[:len(self.labels)]


def _bounds(plus: np.ndarray, minus: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest inner product of each anchor with a point of each box, coordinate by coordinate."""
    low, high = low.astype(float).T, high.astype(float).T
    return plus @ high + minus @ low, plus @ low + minus @ high


def _inner(anchors: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products, anchors by rows; beyond 64 bits the outermost long."""
    most = (np.abs(anchors.astype(float)).max(initial=0) * np.abs(q.astype(float)).max(initial=0)) * max(1, q.shape[1])
    if most < _EXACT:
        return (anchors.astype(float) @ q.astype(float).T).astype(np.int64)
    exact = anchors.astype(object) @ q.astype(object).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


class _Search:
    """Best rows of a block of anchors, for every score window of each; one best-first queue over the boxes of a lane."""

    def __init__(self, rows, labels, q: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, best: int) -> None:
        self.rows, self.labels, self.q, self.same = rows, labels, q, same
        self.low, self.high = low, high  # anchors x windows
        self.plus, self.minus = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
        shape = (*low.shape, best)
        self.size = np.abs(q.astype(float))
        self.found = np.zeros(shape, bool)
        self.scores = np.full(shape, np.iinfo(np.int64).min)
        self.ids = np.full(shape, _NO_ID)
        self.hits = np.full(shape, -1)

    def open(self, most: np.ndarray, least: np.ndarray, slack: np.ndarray) -> np.ndarray:
        """Anchors that may find something in a box with these bounds (anchors x 1)."""
        full = self.found[:, :, -1]
        floor = np.where(full, np.maximum(self.low, self.scores[:, :, -1]), self.low)  # a tie with the last one is still open
        return ((most + slack >= floor) & (least - slack <= self.high)).any(axis=1)

    def run(self, tiles: list[_Tile]) -> None:
        queue, boxes = [], []
        for k, tile in enumerate(tiles):
            most, least = _bounds(self.plus, self.minus, tile.low, tile.high)
            # bounds are exact while every sum is below 2**53; beyond, what floating point may be off by
            largest = self.size @ np.maximum(np.abs(tile.low.astype(float)), np.abs(tile.high.astype(float))).T
            slack = np.where(largest < _EXACT, 0.0, 1e-9 * largest)
            boxes.append((most, least, slack))
            heapq.heappush(queue, (-float((most + slack).max()), k, -1))
        while queue:
            _, k, leaf = heapq.heappop(queue)
            most, least, slack = boxes[k]
            if leaf < 0:  # a tile opens into its leaves
                if self.open(most.max(1, keepdims=True), least.min(1, keepdims=True), slack.max(1, keepdims=True)).any():
                    for n in range(most.shape[1]):
                        heapq.heappush(queue, (-float((most[:, n] + slack[:, n]).max()), k, n))
                continue
            tile = tiles[k]
            wanted = (self.labels == tile.labels[leaf]) == self.same
            if wanted.any():
                wanted &= self.open(*(b[:, leaf:leaf + 1] for b in (most, least, slack)))
            at = np.flatnonzero(wanted)
            if len(at):
                self.take(at, tile, slice(tile.starts[leaf], tile.starts[leaf + 1]))

    def take(self, at: np.ndarray, tile: _Tile, part: slice) -> None:
        scores = _inner(self.q[at], tile.q[part])[:, None, :]
        fits = ((scores >= self.low[at][:, :, None]) & (scores <= self.high[at][:, :, None])
                & (tile.rows[part] != self.rows[at][:, None])[:, None, :])
        last = np.where(self.found[at, :, -1], self.scores[at, :, -1], np.iinfo(np.int64).min)
        fits &= scores >= last[:, :, None]
        some = np.argwhere(fits.any(axis=2))
        if not len(some):
            return
        a, w = at[some[:, 0]], some[:, 1]
        fits = fits[some[:, 0], some[:, 1]]
        wide = lambda x: np.broadcast_to(x, fits.shape)
        found = np.concatenate([self.found[a, w], fits], axis=1)
        every = np.concatenate([self.scores[a, w], scores[some[:, 0], 0]], axis=1)
        ids = np.concatenate([self.ids[a, w], wide(tile.ids[part])], axis=1)
        hits = np.concatenate([self.hits[a, w], wide(tile.rows[part])], axis=1)
        # ~score falls as the score rises, also for the smallest long
        order = np.lexsort((hits, ids, ~every, ~found), axis=1)[:, :self.found.shape[2]]
        pick = lambda x: np.take_along_axis(x, order, axis=1)
        self.found[a, w], self.scores[a, w], self.ids[a, w], self.hits[a, w] = pick(found), pick(every), pick(ids), pick(hits)


_FOUND = "anchor long, window int, hit long, hit_id long, score long"


def _lane(width: int, same: bool, best: int):
    def run(anchors: pa.Table, tiles: pa.Table) -> pa.Table:
        out = {"anchor": [], "window": [], "hit": [], "hit_id": [], "score": []}
        if len(anchors) and len(tiles):
            anchors, tiles = anchors.sort_by("row"), tiles.sort_by("tile")
            rows, labels = (anchors.column(c).to_numpy() for c in ("row", "label"))
            windows = max(1, max(len(x) for x in anchors.column("low").to_pylist()))
            low = np.full((len(rows), windows), np.iinfo(np.int64).max)  # nothing fits a window that is not there
            high = np.full((len(rows), windows), np.iinfo(np.int64).min)
            for side, name in ((low, "low"), (high, "high")):
                for i, values in enumerate(anchors.column(name).to_pylist()):
                    side[i, :len(values)] = values
            search = _Search(rows, labels, _matrix(anchors.column("q"), width), low, high, same, best)
            search.run([_Tile(width, *(tiles.column(c)[i].as_py() for c in ("rows", "ids", "labels", "q", "leaves")))
                        for i in range(len(tiles))])
            a, w, k = np.nonzero(search.found)
            out = {"anchor": rows[a], "window": w, "hit": search.hits[a, w, k], "hit_id": search.ids[a, w, k],
                   "score": search.scores[a, w, k]}
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})
    return run


def search(anchors: DataFrame, tiles: DataFrame, blocks: int, lanes: int, width: int, same: bool, best: int) -> DataFrame:
    """The ``best`` rows of every anchor and window: anchor, window, hit, hit_id, score, rank (from 1).

    ``anchors``: block, row, label, q, low and high (arrays: one window per place); ``tiles``: the stored tiles with lane.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).cast("long")
    left = anchors.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    right = tiles.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = (left.groupBy("block", "lane").cogroup(right.groupBy("block", "lane"))
             .applyInArrow(_lane(width, same, best), _FOUND))
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "hit_id", "hit")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, scale: int = 256, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, tile: int = TILE, leaf: int = LEAF, lane: int = LANE,
                   block: int = ANCHORS) -> DataFrame:
    """Hard negatives of the rows for which ``is_anchor`` (over the column ``id``) holds.

    For each anchor and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of another
    label with ``low * positive_score <= 100 * score <= high * positive_score``: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    rows = store(prepared(df, id_col, vector_col, F.col("label") if label is None else label, scale), "vectors")
    width = rows.agg(F.max(F.size("q"))).first()[0] or 0
    tiled, tiles, count = packed(rows, width, tile, leaf)
    lanes = -(-count // lane)
    tiles = tiles.withColumn("lane", F.expr(f"tile div {lane}"))
    # anchors of neighbouring tiles share a block
    anchors = positions(tiled.filter((F.col("id") != int(_NO_ID)) & is_anchor).withColumn("__all", F.lit(0)), "__all", ["tile", "row"])
    anchors = store(anchors.select(F.expr(f"__pos div {block}").alias("block"), "row", "id", "label", "q", "__rows"), "anchors")
    blocks = -(-(anchors.agg(F.max("__rows")).first()[0] or 1) // block)
    anchors = anchors.drop("__rows")
    longest = np.iinfo(np.int64)
    free = anchors.withColumns({"low": F.array(F.lit(int(longest.min)).cast("long")), "high": F.array(F.lit(int(longest.max)).cast("long"))})
    good = store(search(free, tiles, blocks, lanes, width, True, positives), "positives")
    # one window per positive; 80 s <= 100 t <= 100 s in whole numbers
    score = F.col("score").cast("decimal(38,0)")
    lowest = F.ceil(score * low / 100).cast("long")
    highest = F.floor(score * high / 100).cast("long")
    windows = good.select("anchor", "rank", lowest.alias("l"), highest.alias("h"))
    windows = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "l", "h"))).alias("w")).select(
        F.col("anchor").alias("row"), F.col("w.l").alias("low"), F.col("w.h").alias("high"))
    bad = search(anchors.drop("id").join(windows, "row"), tiles, blocks, lanes, width, False, negatives)
    name = lambda c: F.when(F.col(c) != int(_NO_ID), F.col(c))
    pairs = good.select("anchor", (F.col("rank") - 1).alias("window"), F.col("hit_id").alias("p"), F.col("score").alias("positive_score"))
    out = bad.join(pairs, ["anchor", "window"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("a")), "anchor")
    return out.select(F.col("a").alias("anchor_id"), name("p").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      name("hit_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
