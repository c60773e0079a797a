"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams (1 to 3 bytes of the lower-cased text, hashed
to ``CELLS`` cells) that both contain, divided by the root of the product of their own counts: a
blended spectrum of presence bits over the whole text.  A fixed set of landmark texts gives the
Nyström features ``k(x, Z) K(Z, Z)^(-1/2)``; kernel ridge regression, one language against the rest,
is solved on them.  Scoring is one matrix product of a batch's presence bits with the landmarks and
one with the regression's weights.

The classifier is fitted on a bounded sample of labelled rows, ``TRAIN_ROWS`` in all, spread evenly
over the languages (the ``TRAIN_ROWS`` most frequent ones, equal counts by name) and drawn by a hash of the id; executors turn them into presence bits, so the
driver never holds a text.  Every row is scored.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a null language is not
learned; a null id is not learned from; without rows to learn from everything is ``und``; repeated
rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.text import mix, row_key, slices

CELLS = 1 << 14
GRAM = 3
LANDMARKS = 64
TRAIN_ROWS = 4_000
RIDGE = 1e-2
ROWS = 128  # rows of one matrix product
UNKNOWN = "und"

# everything in ASCII that is no letter counts as a space
_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def presence(texts: pa.Array) -> Iterator[np.ndarray]:
    """Presence bits of the texts' n-grams, as matrices of at most ``ROWS`` rows."""
    lowered = pc.utf8_lower(texts.fill_null(""))
    for first, stop, data, offsets in slices(lowered):
        folded = _FOLD[data].astype(np.uint64)
        for top in range(0, stop - first, ROWS):
            bounds = offsets[top:min(top + ROWS, stop - first) + 1]
            part = folded[bounds[0]:bounds[-1]]
            sizes = np.diff(bounds)
            row = np.repeat(np.arange(len(sizes)), sizes)
            left = np.repeat(bounds[1:] - bounds[0], sizes) - np.arange(len(part))  # bytes to the row's end
            bits = np.zeros((len(sizes), CELLS), np.uint8)
            code = np.zeros(len(part), np.uint64)
            for n in range(1, GRAM + 1):
                at = np.flatnonzero(left >= n)
                code = code[:len(at)] if n == 1 else code
                grown = np.zeros(len(part), np.uint64)
                grown[at] = (code[at] if n > 1 else 0) * np.uint64(256) + part[at + n - 1]
                code = grown
                cell = mix(code[at] * np.uint64(4) + np.uint64(n)) & np.uint64(CELLS - 1)
                bits[row[at], cell.astype(np.int64)] = 1
            yield bits


def kernel(bits: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of every row with every landmark."""
    own = np.sqrt(np.maximum(bits.sum(1, dtype=np.float32), 1))
    theirs = np.sqrt(np.maximum(landmarks.sum(1, dtype=np.float32), 1))
    return (bits.astype(np.float32) @ landmarks.T.astype(np.float32)) / own[:, None] / theirs[None]


def _sample_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [np.packbits(b).tobytes() for bits in presence(batch.column(2)) for b in bits]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["order", "lang", "bits"])


class Model:
    def __init__(self, langs: list[str], landmarks: np.ndarray, weights: np.ndarray) -> None:
        self.langs, self.landmarks, self.weights = langs, landmarks, weights


def fit(langs: list[str], packed: np.ndarray, lang: np.ndarray, landmarks: int = LANDMARKS) -> Model:
    """Landmarks spread over the languages, Nyström features, ridge regression one against the rest."""
    landmarks = max(landmarks, len(langs))  # each language has one
    chosen: list[int] = []
    turn = 0
    by = [np.flatnonzero(lang == i).tolist() for i in range(len(langs))]
    while len(chosen) < min(landmarks, len(lang)):
        for rows in by:
            if turn < len(rows) and len(chosen) < landmarks:
                chosen.append(rows[turn])
        turn += 1
    z = np.unpackbits(packed[chosen], axis=1)
    values, vectors = np.linalg.eigh(kernel(z, z).astype(float))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    # the sample's bits stay packed but for one product at a time
    seen = [kernel(np.unpackbits(packed[i:i + ROWS], axis=1), z) for i in range(0, len(packed), ROWS)]
    phi = np.hstack([np.concatenate(seen) @ root, np.ones((len(packed), 1))])
    aims = (lang[:, None] == np.arange(len(langs))[None]).astype(float)
    # every language counts the same
    weight = (1 / np.maximum(aims.sum(0), 1))[lang][:, None]
    solved = np.linalg.solve(phi.T @ (weight * phi) + RIDGE * np.eye(phi.shape[1]) / len(phi), phi.T @ (weight * aims))
    return Model(langs, z, np.vstack([root @ solved[:-1], solved[-1:]]).astype(np.float32))


def train(rows: DataFrame, train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> Model | None:
    """Fit on rows (order: a 63-bit hash, lang, text); languages and a bounded sample are read here."""
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(train_rows).collect()}
    if not counts:
        return None
    langs = sorted(counts)
    each = max(2, train_rows // len(langs))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, 1.3 * each / counts[k])))])
    some = rows.filter(F.col("order") < F.get(F.array(share), F.lit(0))[F.col("lang")] * float(1 << 63))
    found = some.select("order", "lang", "text").mapInArrow(_sample_bits, "order long, lang string, bits binary")
    table = found.toPandas().sort_values(["order", "bits"], kind="stable")
    table = table.groupby("lang", sort=False).head(each)
    if not len(table):
        return None
    packed = np.frombuffer(b"".join(map(bytes, table["bits"])), np.uint8).reshape(len(table), CELLS // 8)
    langs = sorted(set(table["lang"]))
    return fit(langs, packed, np.array([langs.index(x) for x in table["lang"]]), landmarks)


def _predict(held, columns: list[str]):
    """Columns of the batch but the last two (text, has a letter), then lang_pred and score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            width = batch.num_columns
            names, scores = [], []
            letters = batch.column(width - 1).fill_null(False).to_pylist()
            if model is None:
                names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            else:
                for bits in presence(batch.column(width - 2)):
                    out = kernel(bits, model.landmarks) @ model.weights[:-1] + model.weights[-1]
                    best = out.argmax(1)
                    names += [model.langs[i] for i in best]
                    scores += np.clip(out[np.arange(len(best)), best], 0, 1).tolist()
                names = [n if ok else UNKNOWN for n, ok in zip(names, letters)]
                scores = [s if ok else 0.0 for s, ok in zip(scores, letters)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width - 2], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "score"])
    return run


def held_out(id_col: Column) -> Column:
    """Whether crc32(id as text) mod 3 is 1; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, keyed: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; with ``keyed``, its ``row_key`` stands for doc_id."""
    apart = held_out(F.col(id_col))
    rows = df.filter(~apart & F.col(lang_col).isNotNull()).select(
        F.shiftrightunsigned(F.xxhash64(F.lit(41), F.col(id_col)), 1).alias("order"),
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    model = train(rows.filter(F.col("text").rlike(r"\p{L}")), train_rows, landmarks)
    held = df.sparkSession.sparkContext.broadcast(model)
    own = row_key(F.col(id_col), F.col(text_col)) if keyed else F.col(id_col).cast("long")
    return (df.select(own.alias("doc_id"), apart.alias("held_out"), F.col(text_col).alias("t"),
                      F.col(text_col).rlike(r"\p{L}").alias("letters"))
            .mapInArrow(_predict(held, ["doc_id", "held_out"]),
                        "doc_id long, held_out boolean, lang_pred string, score double"))
