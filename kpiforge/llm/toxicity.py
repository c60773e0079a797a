"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is its own embedding plus the mean embedding of its character 4-grams (with marks at
both ends), both hashed to fixed tables.  Two gated recurrent networks read a window of ``WINDOW``
words from either end; attention pools their states; a logistic unit scores the window.  Windows
start every ``STRIDE`` words, so all overlapping windows of the whole text are scored, and a text's
score is that of its worst window.

The network is trained here, in numpy, on a bounded sample of labelled texts (``TRAIN_TEXTS`` toxic
and ``CLEAN_TEXTS`` clean ones, drawn by a hash of the id).  Texts of the sample are whole, with all their windows; the sample's
size is bounded by ``TEXT_WINDOWS`` windows (of ``WINDOW_BYTES`` bytes) a text on average, and a text that is too long for
what is left of it is passed over for the next in order.  A label
holds for a text, not for each of its windows: training starts with the windows of toxic texts that
have the words and 4-grams most typical of toxic texts, then takes those that the network itself scores
highest, and for clean texts the highest as well as others.

Scoring projects each distinct word of a slice once and runs all its windows side by side.

Defined cases: a null text, or one without a word, has score 0; a null id is held out; ids that are
labelled more than once are toxic if any label says so; rows that repeat an id are scored one by one;
without both labels to learn from every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.text import PUNCTUATION, mix, slices, span_hashes, store, word_spans

WINDOW = 32
STRIDE = 16
HIDDEN = 8
WIDTH = 12
ATTEND = 8
WORD_CELLS = 1 << 17
DECAY = 0.05
BLANK = 0.2  # share of words that training leaves out
GRAM_CELLS = 1 << 17
TRAIN_TEXTS = 700
CLEAN_TEXTS = 2_400
TEXT_WINDOWS = 24
WINDOW_BYTES = 512
LEAST_TEXTS = 5  # training texts that have a word or 4-gram with an embedding of its own
SPARE = 2  # times the sample that is drawn, as labels may be of texts that are not there
THRESHOLD = 0.3
EPOCHS = (4, 3, 3, 2)
RARER = 12  # times that a marking word or 4-gram is rarer in clean texts
BATCH_WINDOWS = 4_000  # windows of either label in one epoch, at most
SIGNS = 3.0  # standard errors from which a word or 4-gram marks a window
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                  hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word cell of every word, its 4-grams' cells in one line, and where each word's begin."""
    sizes = ends - starts
    # the words one after another, each between two marks
    wide = sizes + 2
    at = np.cumsum(wide) - wide
    line = np.ones(int(wide.sum()), np.uint64)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    line[np.repeat(at + 1, sizes) + inside] = _LOWER[data[np.repeat(starts, sizes) + inside]]
    grams = np.maximum(wide - 3, 1)
    first = np.cumsum(grams) - grams
    start = np.repeat(at, grams) + np.arange(int(grams.sum())) - np.repeat(first, grams)
    line = np.r_[line, np.zeros(4, np.uint64)]
    code = np.zeros(len(start), np.uint64)
    for k in range(4):
        code = code * np.uint64(257) + line[start + k]
    return ((hashes % np.uint64(WORD_CELLS)).astype(np.int64),
            (mix(code) % np.uint64(GRAM_CELLS)).astype(np.int64), first)


def text_words(data: np.ndarray, offsets: np.ndarray):
    """Each row's word count, each word's place among the distinct ones, and these words' features."""
    starts, ends, counts = word_spans(data, offsets, PUNCTUATION)
    hashes = span_hashes(data, starts, ends)
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    return counts, place, word_features(data, starts[first], ends[first], hashes[first])


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and row of every window."""
    number = np.where(counts > 0, np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + 1, 0)
    row = np.repeat(np.arange(len(counts)), number)
    turn = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    base = np.cumsum(counts) - counts
    return base[row] + turn * STRIDE, np.minimum(counts[row] - turn * STRIDE, WINDOW), row


def initial(words: np.ndarray, grams: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Random weights, with embeddings for these cells; row 0, all zeros, is for every other cell."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    out = {}
    for name, some, cells in (("word", words, WORD_CELLS), ("gram", grams, GRAM_CELLS)):
        out[f"{name}_row"] = np.zeros(cells, np.int32)
        out[f"{name}_row"][some] = np.arange(1, len(some) + 1)
        out[name] = normal(len(some) + 1, WIDTH, by=0.3)
        out[name][0] = 0
    for side in "fb":
        out |= {f"x{side}": normal(WIDTH, 3 * HIDDEN, by=0.4), f"h{side}": normal(HIDDEN, 3 * HIDDEN, by=0.3),
                f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
    out |= {"att": normal(2 * HIDDEN, ATTEND, by=0.4), "v": normal(ATTEND, by=0.5),
            "out": normal(2 * HIDDEN, by=0.5), "bias": np.full(1, -1.0, np.float32)}
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def embed(p: dict[str, np.ndarray], features) -> np.ndarray:
    word, grams, first = features
    if not len(word):
        return np.zeros((0, WIDTH), np.float32)
    sizes = np.diff(np.r_[first, len(grams)])
    mean = np.add.reduceat(p["gram"][p["gram_row"][grams]], first, axis=0) / sizes[:, None].astype(np.float32)
    return p["word"][p["word_row"][word]] + mean


def forward(p: dict[str, np.ndarray], vectors: np.ndarray, at: np.ndarray, there: np.ndarray, keep: bool = False):
    """Window scores (logits); ``at`` [window, step] picks word vectors, ``there`` marks real words."""
    n, steps = at.shape
    hidden = np.zeros((steps, n, 2 * HIDDEN), np.float32)
    saved = {}
    for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        inputs = vectors @ p[f"x{side}"] + p[f"c{side}"]
        h = np.zeros((n, HIDDEN), np.float32)
        half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
        for t in order:
            gx, gh = inputs[at[:, t]], h @ p[f"h{side}"]
            zr = _sigmoid(gx[:, :2 * HIDDEN] + gh[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(gx[:, 2 * HIDDEN:] + r * gh[:, 2 * HIDDEN:])
            m = there[:, t, None]
            new = h + m * ((1 - z) * (c - h))
            if keep:
                saved[side, t] = (h, z, r, c, gh[:, 2 * HIDDEN:])
            h = new
            hidden[t, :, half] = h
    u = np.tanh(hidden @ p["att"])
    e = u @ p["v"] + np.where(there.T > 0, 0, -1e9).astype(np.float32)
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    pooled = np.einsum("tn,tnh->nh", a, hidden)
    logit = pooled @ p["out"] + p["bias"][0]
    return (logit, (hidden, u, a, pooled, saved)) if keep else logit


def gradients(p, features, at, there, labels, weights):
    """Loss gradients of one batch of windows; ``at`` indexes the words of ``features``."""
    vectors = embed(p, features)
    logit, (hidden, u, a, pooled, saved) = forward(p, vectors, at, there, keep=True)
    n, steps = at.shape
    g = {k: np.zeros_like(v) for k, v in p.items() if not k.startswith(("word", "gram"))}
    dl = (weights * (_sigmoid(logit) - labels)).astype(np.float32) / n
    g["out"], g["bias"][0] = pooled.T @ dl, dl.sum()
    dpool = dl[:, None] * p["out"]
    dhid = a[:, :, None] * dpool[None]
    da = np.einsum("nh,tnh->tn", dpool, hidden)
    de = a * (da - (a * da).sum(0))
    g["v"] = np.einsum("tn,tnk->k", de, u)
    du = de[:, :, None] * p["v"] * (1 - u * u)
    g["att"] = np.einsum("tnh,tnk->hk", hidden, du)
    dhid += du @ p["att"].T
    dvec = np.zeros_like(vectors)
    for side, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
        half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
        dh = np.zeros((n, HIDDEN), np.float32)
        dinputs = np.zeros((len(vectors), 3 * HIDDEN), np.float32)
        for t in order:
            h, z, r, c, gc = saved[side, t]
            dh = dh + dhid[t][:, half]
            m = there[:, t, None]
            dm = dh * m
            dc = dm * (1 - z) * (1 - c * c)
            dz = -dm * (c - h) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            dg = np.hstack([dz, dr, dc])
            dgh = np.hstack([dz, dr, dc * r])
            g[f"h{side}"] += h.T @ dgh
            dh = dh - dm * (1 - z) + dgh @ p[f"h{side}"].T
            np.add.at(dinputs, at[:, t], dg)
        g[f"c{side}"] = dinputs.sum(0)
        g[f"x{side}"] = vectors.T @ dinputs
        dvec += dinputs @ p[f"x{side}"].T
    word, grams, first = features
    sizes = np.diff(np.r_[first, len(grams)])
    g["word"] = np.zeros_like(p["word"])
    np.add.at(g["word"], p["word_row"][word], dvec)
    g["gram"] = np.zeros_like(p["gram"])
    np.add.at(g["gram"], p["gram_row"][grams], np.repeat(dvec / sizes[:, None], sizes, axis=0).astype(np.float32))
    g["word"][0] = g["gram"][0] = 0
    return g


class Trainer:
    """Adam over batches of windows."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p, self.step = p, 0
        self.mean = {k: np.zeros_like(v) for k, v in p.items() if not k.endswith("_row")}
        self.square = {k: np.zeros_like(v) for k, v in p.items() if not k.endswith("_row")}

    def update(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.step += 1
        for k, d in g.items():
            self.mean[k] += 0.1 * (d - self.mean[k])
            self.square[k] += 0.01 * (d * d - self.square[k])
            m, s = self.mean[k] / (1 - 0.9 ** self.step), self.square[k] / (1 - 0.99 ** self.step)
            self.p[k] -= (rate * (m / (np.sqrt(s) + 1e-6) + DECAY * self.p[k])).astype(np.float32)


def _pick(features, words: np.ndarray):
    """The features of some of the words, and those words' numbers among them."""
    word, grams, first = features
    sizes = np.diff(np.r_[first, len(grams)])
    some, place = np.unique(words, return_inverse=True)
    own = sizes[some]
    start = np.cumsum(own) - own
    return (word[some], grams[np.repeat(first[some] - start, own) + np.arange(int(own.sum()))], start), place


def fit(texts: pa.ChunkedArray, text_of: np.ndarray, toxic: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Train on windows: their texts, the document each is from, and the documents' labels."""
    rng = np.random.default_rng(seed)
    (_, _, data, offsets), = slices(texts.cast(pa.large_string()).combine_chunks(), 1 << 40)
    counts, place, features = text_words(data, offsets)
    base = np.cumsum(counts) - counts
    size = np.minimum(counts, WINDOW)
    there = (np.arange(WINDOW)[None] < size[:, None]).astype(np.float32)
    at = np.where(there > 0, place.astype(np.int32)[np.minimum(base[:, None] + np.arange(WINDOW)[None], max(len(place) - 1, 0))], 0)
    label = toxic[text_of]
    # how much more often toxic documents have a word or 4-gram than clean ones, in standard errors
    word, grams, first = features
    owner = np.repeat(np.arange(len(word)), np.diff(np.r_[first, len(grams)]))
    docs = np.repeat(text_of, counts)
    typical = np.zeros(len(word))
    pairs = np.unique(docs * len(word) + place)
    learned = {}
    for name, cell, of, cells in (("word", word, np.arange(len(word)), WORD_CELLS), ("gram", grams, owner, GRAM_CELLS)):
        # distinct (document, cell) pairs, a share of the documents at a time
        sizes = np.bincount(of, minlength=len(word))
        starts = np.cumsum(sizes) - sizes
        parts = []
        for some in np.array_split(np.arange(len(pairs)), 1 + len(pairs) // 200_000):
            d, w = pairs[some] // len(word), pairs[some] % len(word)
            n = sizes[w]
            spread = np.repeat(starts[w] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            parts.append(np.unique((np.repeat(d, n) * cells + cell[spread]).astype(np.int32)))
        seen = np.unique(np.concatenate(parts))
        hot = toxic[seen // cells] > 0
        # what few texts have can only be learned by heart: it stays without an embedding
        usual = np.bincount(seen % cells, minlength=cells) >= LEAST_TEXTS
        learned[name] = np.flatnonzero(usual)
        one = np.bincount(seen[hot] % cells, minlength=cells) / max(toxic.sum(), 1)
        two = np.bincount(seen[~hot] % cells, minlength=cells) / max((1 - toxic).sum(), 1)
        both = (one + two) / 2 + 1e-4
        z = (one - two) / np.sqrt(both * (1 - np.minimum(both, 0.999)) * (1 / max(toxic.sum(), 1) + 1 / max((1 - toxic).sum(), 1)))
        # common ones also differ where the labels' texts are of other languages or lengths
        z[(one < RARER * two) | ~usual] = 0
        np.maximum.at(typical, of, z[cell])
    rank = (typical[at] * there).max(1)
    p = initial(learned["word"], learned["gram"], seed)
    trainer = Trainer(p)
    marked = rank >= SIGNS
    for turn, epochs in enumerate(EPOCHS):
        bound = SIGNS if turn == 0 else 0.5
        best = np.full(len(toxic), -np.inf)
        np.maximum.at(best, text_of, rank)
        top = rank >= best[text_of] - 1e-9
        hits = np.flatnonzero((label > 0) & (size > 0) & (marked | (top & (rank > bound))))
        if not len(hits):
            hits = np.flatnonzero((label > 0) & (size > 0) & top)
        clean = np.flatnonzero((label == 0) & (size > 0))
        hard = clean[np.argsort(-rank[clean], kind="stable")[:BATCH_WINDOWS // 2]]
        for _ in range(epochs):
            some = [rng.choice(x, min(len(x), BATCH_WINDOWS), replace=False) for x in (hits, clean)]
            batch = np.unique(np.r_[some[0][:BATCH_WINDOWS // 2], hard, some[1]])
            rng.shuffle(batch)
            for some in np.array_split(batch, max(1, len(batch) // 192)):
                longest = max(int(size[some].max()), 1)
                used, index = _pick(features, at[some][:, :longest].ravel())
                trainer.update(gradients(p, used, index.reshape(len(some), longest), there[some][:, :longest] * (rng.random((len(some), longest)) >= BLANK * (label[some, None] == 0)),
                                         label[some].astype(np.float32),
                                         np.where(label[some] > 0, 1.5, 1.0).astype(np.float32)),
                               0.01 if turn < 2 else 0.004)
        vectors = embed(p, features)
        rank = np.concatenate([_sigmoid(forward(p, vectors, at[i:i + 4096], there[i:i + 4096]))
                               for i in range(0, len(at), 4096)])
    return p


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        orders, labels, costs, texts = [], [], [], []
        toxic, order = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for first, _, data, offsets in slices(pc.utf8_lower(batch.column(2).fill_null(""))):
            starts, ends, counts = word_spans(data, offsets, PUNCTUATION)
            begin, size, row = windows(counts)
            for r in range(len(counts)):
                for w in np.flatnonzero(row == r):
                    a, b = starts[begin[w]], ends[begin[w] + size[w] - 1]
                    orders.append(order[first + r])
                    labels.append(toxic[first + r])
                    costs.append(max(1, -(-int(b - a) // WINDOW_BYTES)))
                    texts.append(bytes(data[a:b]).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(orders, pa.int64()), pa.array(labels, pa.int32()), pa.array(costs, pa.int64()), pa.array(texts, pa.string())],
            ["order", "toxic", "cost", "text"])


def choose(costs: list[tuple[int, int]], texts: int) -> list[int]:
    """The first ``texts`` texts by order, of (order, cost), that fit the sample's size one after another."""
    left, chosen = texts * TEXT_WINDOWS, []
    for order, cost in sorted(costs):
        if len(chosen) < texts and cost <= left:
            chosen.append(order)
            left -= cost
    return chosen


def train(texts: DataFrame, labels: DataFrame, train_texts: int = TRAIN_TEXTS,
          clean_texts: int = CLEAN_TEXTS) -> dict[str, np.ndarray] | None:
    """Fit on texts (__id, text) with labels (__id, toxic 0 or 1).

    The sample is drawn from the labels, lowest hash first, so it is bounded before the texts are read:
    they are picked by a broadcast of ``SPARE`` times the sample's ids, and no text is shuffled."""
    order = F.shiftrightunsigned(F.xxhash64(F.lit(43), "__id"), 1).alias("order")
    drawn = [labels.filter(F.col("toxic") == label).select("__id", "toxic", order).orderBy("order", "__id").limit(SPARE * n)
             for label, n in ((1, train_texts), (0, clean_texts))]
    rows = texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), "__id")
    sample = store(rows.select("order", "toxic", "text")
                   .mapInArrow(_training_windows, "order long, toxic int, cost long, text string"), "toxicity-sample")
    # one row for each drawn text
    costs = sample.groupBy("toxic", "order").agg(F.sum("cost").alias("cost")).collect()
    chosen = [order for label, n in ((1, train_texts), (0, clean_texts))
              for order in choose([(r.order, r.cost) for r in costs if r.toxic == label], n)]
    picked = sample.join(F.broadcast(sample.sparkSession.createDataFrame([(o,) for o in chosen], "order long")), "order")
    # one task learns from the bounded sample, so that the driver only holds the weights
    learned = picked.select("order", "toxic", "text").coalesce(1).mapInArrow(_learn, "weights binary").collect()
    return dict(np.load(io.BytesIO(bytes(learned[0].weights)))) if learned else None


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    order, label = table.column("order").to_numpy(), table.column("toxic").to_numpy()
    # in the texts' order; windows of one text are in one batch, in theirs
    keep = np.argsort(order, kind="stable")
    ids, text_of = np.unique(order[keep], return_inverse=True)
    toxic = np.zeros(len(ids))
    np.maximum.at(toxic, text_of, label[keep].astype(float))
    if not 0 < toxic.sum() < len(toxic):
        return
    weights = io.BytesIO()
    np.savez(weights, **fit(table.column("text").take(pa.array(keep)), text_of, toxic))
    yield pa.RecordBatch.from_arrays([pa.array([weights.getvalue()], pa.binary())], ["weights"])


def text_scores(p: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of every row: its worst window's."""
    counts, place, features = text_words(data, offsets)
    out = np.zeros(len(counts))
    begin, size, row = windows(counts)
    if not len(begin):
        return out
    vectors = embed(p, features)
    for i in range(0, len(begin), 4096):
        steps = np.arange(WINDOW)[None]
        there = steps < size[i:i + 4096, None]
        at = np.where(there, place[np.minimum(begin[i:i + 4096, None] + steps, len(place) - 1)], 0)
        scores = _sigmoid(forward(p, vectors, at, there.astype(np.float32)))
        np.maximum.at(out, row[i:i + 4096], scores)
    return out


def _score(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        for batch in batches:
            if p is None:
                scores = np.zeros(batch.num_rows)
            else:
                scores = np.concatenate([np.zeros(0)] + [text_scores(p, data, offsets)
                                                         for _, _, data, offsets in slices(pc.utf8_lower(batch.column(2).fill_null("")))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])
    return run


def held_out(id_col: Column) -> Column:
    """Whether crc32(id as text) mod 4 is 2; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_texts: int = TRAIN_TEXTS, clean_texts: int = CLEAN_TEXTS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    apart = held_out(F.col(id_col))
    marked = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("toxic"))
              .filter(F.col("__id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("__id")))
              .groupBy("__id").agg(F.max("toxic").alias("toxic")))
    texts = df.filter(~apart).select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text"))
    held = df.sparkSession.sparkContext.broadcast(train(texts, marked, train_texts, clean_texts))
    scored = (df.select(F.col(id_col).cast("long").alias("doc_id"), apart.alias("held_out"), F.col(text_col).alias("t"))
              .mapInArrow(_score(held), "doc_id long, held_out boolean, score double"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
