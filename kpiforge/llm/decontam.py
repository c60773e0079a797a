"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages of ``PASSAGE`` words.  A randomised SVD of the TF-IDF matrix of all
passages and benchmark items, over the items' words, gives a latent space: one pass multiplies
the matrix and its transpose with a start block drawn from the items, and the orthonormal basis of the
result is turned by the eigenvectors of the passages' covariance in it, which the same products give.  Passages are searched in that
space: the items whose cosine is at least ``COSINE`` are candidates; an item of more than ``PIECE`` words
is searched as a whole and in overlapping pieces.  Where the space and the words' weights cannot promise
that cosine to a verbatim copy among rare words (``Items.unsure``), every passage with enough of the
item's words is a candidate too.  A candidate is kept if the longest
common subsequence of the item and the text around the passage has ``SHARE`` of the item's words, and
that of the item's end (its answer) ``ANSWER`` of the answer's; ``WHOLE`` of the item is enough alone.

Document frequencies are counted over all documents in a fixed number of hash cells, so a shared
cell can only raise a cosine.  Items are taken in blocks of ``BLOCK_ITEMS``, halved while they have
more than ``VOCABULARY`` words or ``BLOCK_ROWS`` pieces (one item is never cut); each block has a space of
its own; ``BLOCKS_A_PASS`` blocks together are broadcast against all documents.  Nothing is shuffled but the
sums of fixed size and the matches.

Defined cases: null or empty texts and items without a word match nothing; a null item id is an id;
rows that repeat a document id match row by row, and a pair is returned once with its best values; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.text import (
    PARTS, PUNCTUATION, HashIndex, chunks, free_names, raw, row_key, slices, span_hashes, store, vector_sum, word_spans,
)

PASSAGE = 32
STRIDE = 16
CELLS = 1 << 18
RANK = 256
VOCABULARY = 8_192
BLOCK_ITEMS = 256
BLOCK_ROWS = 1_024
BLOCKS_A_PASS = 4  # blocks that share a pass over the corpus
SEGMENTS = 32  # sums of a passage or word that are made at a time
PIECE = 2 * PASSAGE  # a passage inside a copy of an item is inside one of its pieces
OWN = 0.5  # share of a piece's weight that its words in the space have at least
COSINE = 0.18
SHARE = 0.6
ANSWER = 0.34
WHOLE = 0.85
COMMON = 0.05  # words in more documents than this share are left out of the space, but for OWN


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, counts = word_spans(data, offsets, PUNCTUATION)
    return span_hashes(data, starts, ends), counts


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a word of each cell; the last place counts the documents."""
    from pyspark import TaskContext

    total = np.zeros(CELLS + 1, np.int64)
    for batch in batches:
        for _, _, data, offsets in slices(pc.utf8_lower(batch.column(0).fill_null(""))):
            hashes, counts = _words(data, offsets)
            row = np.repeat(np.arange(len(counts)), counts)
            total[:CELLS] += np.bincount(np.unique(row * CELLS + _cell(hashes)) % CELLS, minlength=CELLS)
            total[CELLS] += len(counts)
    yield chunks(TaskContext.get().partitionId(), total)


class Items:
    """A block of benchmark items: their words, the space's vocabulary and TF-IDF rows."""

    def __init__(self, ids: list, texts: list[str], idf: np.ndarray, common: float) -> None:
        data, offsets = raw(pc.utf8_lower(pa.array(texts, pa.large_string()).fill_null("")))
        hashes, counts = _words(data, offsets)
        bounds = np.r_[0, np.cumsum(counts)]
        own = [i for i in range(len(ids)) if counts[i]]
        self.ids = [ids[i] for i in own]
        self.words = [hashes[bounds[i]:bounds[i + 1]] for i in own]
        # the whole item, and pieces of a long one: (item, first word, end)
        self.spans = []
        for i, words in enumerate(self.words):
            self.spans.append((i, 0, len(words)))
            if len(words) > PIECE:
                self.spans += [(i, at, min(at + PIECE, len(words))) for at in range(0, len(words) - PASSAGE, PASSAGE)]
        self.owner = np.array([i for i, _, _ in self.spans], np.int64)
        kept = [hashes[idf[_cell(hashes)] > common]]
        for i, low, high in self.spans:
            words = self.words[i][low:high]
            weight = idf[_cell(words)]
            by = np.argsort(-weight, kind="stable")
            energy = np.cumsum(weight[by] ** 2)
            kept.append(words[by[:1 + int(np.searchsorted(energy, OWN * energy[-1]))]])
        self.index = HashIndex(np.unique(np.concatenate(kept)))
        self.rows = np.zeros((len(self.spans), len(self.index.keys)), np.float32)
        full = np.zeros(len(self.spans))
        for n, (i, low, high) in enumerate(self.spans):
            words = self.words[i][low:high]
            at = self.index.find(words)
            np.add.at(self.rows[n], at[at >= 0], idf[_cell(words[at >= 0])])
            full[n] = (idf[_cell(words)] ** 2).sum()
        self.rows /= np.maximum(np.sqrt(full), 1e-9)[:, None]
        # cosine of a passage that holds a share of the piece's words, all others being of the largest weight
        size = np.array([high - low for _, low, high in self.spans])
        part = np.array([_overlap(n) for n in size])
        copied = full * part / np.maximum(size, 1)
        self.least = copied / np.sqrt(np.maximum((copied + (PASSAGE - part) * idf.max() ** 2) * full, 1e-18))

    def unsure(self, latent: np.ndarray, cosine: float) -> list[int]:
        """Items without a piece whose verbatim copy is sure to reach ``cosine`` in the space."""
        sure = self.owner[self.least * (latent.astype(float) ** 2).sum(1) >= cosine]
        return sorted(set(range(len(self.ids))) - set(sure.tolist()))


def _overlap(words: int) -> int:
    """Words of a run of this length that one passage has at least."""
    return min(words, (min(words, 2 * PASSAGE - STRIDE) + STRIDE) // 2)


def _blocks(ids: list, texts: list[str], idf: np.ndarray, common: float) -> Iterator[Items]:
    items = Items(ids, texts, idf, common) if ids else None
    if items is None or not items.ids:
        return
    if len(ids) > 1 and (len(items.index.keys) > VOCABULARY or len(items.spans) > BLOCK_ROWS):
        half = len(ids) // 2
        yield from _blocks(ids[:half], texts[:half], idf, common)
        yield from _blocks(ids[half:], texts[half:], idf, common)
    else:
        yield items


def _summed(weight: np.ndarray, rows: np.ndarray, at: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of ``weight * rows[at]`` over the segments that start at ``begins``, as many at a time as stay in the cache."""
    out = np.empty((len(begins), rows.shape[1]), rows.dtype)
    bounds = np.r_[begins, len(at)]
    for i in range(0, len(begins), SEGMENTS):
        part = bounds[i:i + SEGMENTS + 1]
        some = slice(part[0], part[-1])
        out[i:i + SEGMENTS] = np.add.reduceat(weight[some, None] * rows[at[some]], part[:-1] - part[0], axis=0)
    return out


def _products(state):
    """Sums over all passages of x (x' start), for every block of items: the passages' covariance times its start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        idf, blocks = state.value
        held = [(HashIndex(keys), start, np.zeros(start.shape)) for keys, start in blocks]
        for batch in batches:
            for _, _, data, offsets in slices(pc.utf8_lower(batch.column(0).fill_null(""))):
                hashes, counts = _words(data, offsets)
                if not len(hashes):
                    continue
                # passages do not cross rows
                base = np.cumsum(counts) - counts
                per_row = -(-counts // PASSAGE)
                first = np.cumsum(per_row) - per_row
                inside = np.arange(len(hashes)) - np.repeat(base, counts)
                passage = np.repeat(first, counts) + inside // PASSAGE
                weight = idf[_cell(hashes)]
                norm = np.sqrt(np.bincount(passage, weight * weight, int(per_row.sum())))
                for index, start, total in held:
                    at = index.find(hashes)
                    known = np.flatnonzero(at >= 0)
                    if not len(known):
                        continue
                    value = (weight[known] / np.maximum(norm[passage[known]], 1e-9)).astype(np.float32)
                    begins = np.flatnonzero(np.r_[True, np.diff(passage[known]) > 0])
                    seen = _summed(value, start, at[known], begins)
                    order = np.argsort(at[known], kind="stable")
                    cols = at[known][order]
                    starts = np.flatnonzero(np.r_[True, np.diff(cols) > 0])
                    segment = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(known)]))
                    total[cols[starts]] += _summed(value[order], seen, segment[order], starts)
        yield chunks(TaskContext.get().partitionId(), np.concatenate([t.astype(np.float32).ravel() for _, _, t in held]))
    return run


def latent_spaces(texts: DataFrame, blocks: list[Items], idf: np.ndarray, rank: int = RANK, seed: int = 7) -> list[np.ndarray]:
    """Orthonormal basis (vocabulary x rank) of the randomised SVD for every block, by falling singular value.

    One pass over the corpus multiplies the covariance C of the passages with each block's start S.  The range of
    C S gives the basis; C itself is known in it from the same products, as C S (S' C S)^-1 S' C (Nystroem)."""
    rng = np.random.default_rng(seed)
    starts = []
    for items in blocks:
        words = items.rows.shape[1]
        size = min(rank, words)
        start = items.rows.T @ rng.standard_normal((len(items.rows), size)) + 1e-3 * rng.standard_normal((words, size))
        starts.append((start / np.linalg.norm(start, axis=0)).astype(np.float32))
    held = texts.sparkSession.sparkContext.broadcast((idf, [(b.index.keys, s) for b, s in zip(blocks, starts)]))
    sizes = [s.size for s in starts]
    sums = vector_sum(texts.mapInArrow(_products(held), PARTS), sum(sizes), "float32").astype(float)
    out = []
    for items, start, flat in zip(blocks, starts, np.split(sums, np.cumsum(sizes)[:-1])):
        from_docs, from_items = flat.reshape(start.shape), items.rows.T @ (items.rows @ start)
        # items and passages count the same in the space
        basis = np.linalg.qr(sum(m / max(np.linalg.norm(m), 1e-9) for m in (from_docs, from_items)))[0]
        core = start.T.astype(float) @ from_docs
        in_docs = basis.T @ from_docs
        in_docs = in_docs @ np.linalg.pinv((core + core.T) / 2, rcond=1e-6, hermitian=True) @ in_docs.T
        seen = items.rows @ basis
        inner = sum(m / max(np.trace(m), 1e-9) for m in (in_docs, seen.T @ seen))
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        keep = np.argsort(-values)
        keep = keep[values[keep] > 1e-9 * max(values.max(), 1e-30)]
        out.append((basis @ vectors[:, keep]).astype(np.float32))
    return out


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one machine word per row of the table."""
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if w in places:
            match = row & places[w]
            row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def _cosine(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """TF-IDF cosine of two word lists, with the norms the space uses."""
    keys, at = np.unique(np.r_[a, b], return_inverse=True)
    tf = [np.bincount(x, minlength=len(keys)) for x in (at[:len(a)], at[len(a):])]
    weight = idf[_cell(keys)] ** 2
    return float((tf[0] * tf[1] * weight).sum() / np.sqrt(max((tf[0] * weight).sum() * (tf[1] * weight).sum(), 1e-18)))


_FOUND = "doc_id long, item_id long, cosine double, share double, at int"


class _Seeker:
    """A block of items as a task searches for it."""

    def __init__(self, ids, words, keys, basis, latent, owner, unsure) -> None:
        self.ids, self.words, self.basis, self.latent, self.owner, self.unsure = ids, words, basis, latent, owner, unsure
        self.index = HashIndex(keys)
        self.firsts = np.flatnonzero(np.r_[True, np.diff(owner) > 0])
        self.counted = HashIndex(np.unique(np.concatenate([words[i] for i in unsure]))) if unsure else None
        # the last row is for other words
        self.member = np.zeros((len(self.counted.keys) + 1 if unsure else 0, len(unsure)), np.int32)
        for n, i in enumerate(unsure):
            self.member[self.counted.find(words[i]), n] = 1
        self.sizes = np.array([len(w) for w in words])
        self.lists = [w.tolist() for w in words]


def _search(state, cosine: float, share: float, answer: float, whole: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, blocks = state.value
        seekers = [_Seeker(*b) for b in blocks]
        for batch in batches:
            docs = batch.column(0).to_pylist()
            out: dict[tuple, tuple] = {}
            for top, _, data, offsets in slices(pc.utf8_lower(batch.column(1).fill_null(""))):
                hashes, counts = _words(data, offsets)
                weight = idf[_cell(hashes)]
                energy = np.r_[0, np.cumsum(weight * weight)]
                number = np.where(counts > 0, np.maximum(-(-(counts - PASSAGE) // STRIDE), 0) + 1, 0)
                row = np.repeat(np.arange(len(counts)), number)
                turn = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
                base = np.cumsum(counts) - counts
                low = base[row] + turn * STRIDE
                high = np.minimum(low + PASSAGE, base[row] + counts[row])
                norm = np.sqrt(np.maximum(energy[high] - energy[low], 1e-9))
                for seeker in seekers:
                    at = seeker.index.find(hashes)
                    known = np.flatnonzero(at >= 0)
                    inner = np.r_[0, np.cumsum(np.where(at >= 0, weight * weight, 0))]
                    # a cosine is at most the share of the passage's weight on the space's words; repeated words add up
                    most = np.maximum(inner[high] - inner[low], 0) / norm ** 2
                    some = np.flatnonzero((most >= cosine ** 2 / 2) & (inner[high] > inner[low]))
                    hits: dict[tuple[int, int], float] = {}
                    if len(some):
                        where = np.searchsorted(known, np.c_[low[some], high[some]])
                        some, where = some[where[:, 1] > where[:, 0]], where[where[:, 1] > where[:, 0]]
                    if len(some):
                        held = where[:, 1] - where[:, 0]
                        begins = np.r_[0, np.cumsum(held)[:-1]]
                        token = known[np.repeat(where[:, 0] - begins, held) + np.arange(int(held.sum()))]
                        seen = _summed(weight[token].astype(np.float32), seeker.basis, at[token], begins)
                        close = (seen / norm[some, None].astype(np.float32)) @ seeker.latent.T
                        if len(seeker.firsts) < len(seeker.owner):
                            close = np.maximum.reduceat(close, seeker.firsts, axis=1)
                        for p, i in np.argwhere(close >= cosine).tolist():
                            hits[int(some[p]), i] = float(close[p, i])
                    for n in range(0, len(seeker.unsure), 8):
                        there = seeker.member[seeker.counted.find(hashes), n:n + 8]
                        there = np.r_[np.zeros((1, there.shape[1]), np.int64), np.cumsum(there, axis=0)]
                        least = np.array([max(1, int(share * _overlap(int(seeker.sizes[i])))) for i in seeker.unsure[n:n + 8]])
                        for p, k in np.argwhere(there[high] - there[low] >= least).tolist():
                            if (p, seeker.unsure[n + k]) not in hits:
                                hits[p, seeker.unsure[n + k]] = float("nan")
                    for (p, i), near_by in sorted(hits.items()):
                        key = (docs[top + int(row[p])], seeker.ids[i])
                        old = out.get(key)
                        if old and old[1] >= 1:
                            continue
                        a = max(int(base[row[p]]), int(low[p] - seeker.sizes[i]))
                        b = min(int(base[row[p]] + counts[row[p]]), int(high[p] + seeker.sizes[i]))
                        near = hashes[a:b].tolist()
                        part = common_subsequence(seeker.lists[i], near) / seeker.sizes[i]
                        if part < share:
                            continue
                        end = seeker.lists[i][-max(1, int(seeker.sizes[i]) // 5):]
                        if part >= whole or common_subsequence(end, near) >= answer * len(end):
                            if not old or part > old[1]:
                                if near_by != near_by:
                                    near_by = _cosine(hashes[low[p]:high[p]], seeker.words[i], idf)
                                out[key] = (near_by, part, int(low[p] - base[row[p]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in out], pa.int64()), pa.array([i for _, i in out], pa.int64()),
                 *(pa.array([v[k] for v in out.values()], t) for k, t in enumerate((pa.float64(), pa.float64(), pa.int32())))],
                ["doc_id", "item_id", "cosine", "share", "at"])
    return run


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", rank: int = RANK, cosine: float = COSINE, share: float = SHARE) -> DataFrame:
    """One row per (document, item) that match: doc_id, item_id, cosine, share (of the item's words), at (word)."""
    spark = df.sparkSession
    texts = df.select(F.col(text_col).alias("t"))
    counts = vector_sum(texts.mapInArrow(_frequencies, PARTS), CELLS + 1)
    idf = np.log((counts[CELLS] + 1) / (counts[:CELLS] + 1)) + 1e-3
    common = np.log(1 / COMMON)
    parts = max(1, -(-benchmark.count() // BLOCK_ITEMS))
    kept = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).alias("t")).distinct()

    def blocks() -> Iterator[Items]:
        for part in range(parts):
            rows = sorted(((r.i, r.t) for r in kept.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).collect()),
                          key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
            yield from _blocks([r[0] for r in rows], [r[1] for r in rows], idf, common)

    found = None
    every = blocks()
    while some := list(islice(every, BLOCKS_A_PASS)):
        spaces = latent_spaces(texts, some, idf, rank)
        latent = [(items.rows @ basis).astype(np.float32) for items, basis in zip(some, spaces)]
        held = spark.sparkContext.broadcast((idf, [
            (b.ids, b.words, b.index.keys, basis, near, b.owner, b.unsure(near, cosine)) for b, basis, near in zip(some, spaces, latent)]))
        pairs = df.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")).mapInArrow(
            _search(held, cosine, share, ANSWER, WHOLE), _FOUND)
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        return spark.createDataFrame([], _FOUND)
    best = F.max(F.struct("share", "cosine", (-F.col("at")).alias("at")))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", F.col("b.cosine").alias("cosine"), F.col("b.share").alias("share"),
                    (-F.col("b.at")).cast("int").alias("at")))


def clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without a leak: every row by its own text, also where ids are null or repeated."""
    leak, = free_names(df, "__leak")
    key = row_key(F.col(id_col), F.col(text_col))
    rows = df.select(key.alias("key"), F.col(text_col).alias("t"))
    marked = store(leaks(rows, benchmark, "key", "t").select(F.col("doc_id").alias(leak)).distinct(), "leaks")
    return df.withColumn(leak, key).join(marked, leak, "left_anti").drop(leak)
