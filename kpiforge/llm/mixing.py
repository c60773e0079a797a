"""Mixing sources to target weights by cube-method balanced sampling.

Each source has a target number of words; target / size is the expected number of times each of
its documents is taken.  The whole part is taken outright.  The fractional part is an inclusion
probability, decided by the cube method: the vector of probabilities moves through the null space of
the constraints (documents taken and words taken stay as expected) until one of them is 0 or 1, and
so on, until only as many undecided documents remain as there are constraints.

Spark runs the flight in blocks of a source of about ``block_rows`` documents; each leaves at most
two undecided, which meet in the next level's blocks, until a source is one block.  There the
landing drops the document constraint, then the last document is drawn by its probability.  A hot
source is many blocks.  Random numbers are hashes of (seed, document), so reruns agree.

Defined cases: a null text has 0 words; a null source is a source of its own, the last one; rows
that repeat (id, source, size) are one unit, taken as one with the sum of their words; a null id is
an id; a source without words has target 0 and its documents are not taken; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.ranks import positions
from kpiforge.llm.text import free_names, slices, store, word_spans

BLOCK_ROWS = 2048
MAX_REPEAT = 3
# fixed values: the weights that sources get in turn
WEIGHTS = (1, 2, 3)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes: list[int] = []
        for _, _, data, offsets in slices(batch.column(2)):
            sizes += word_spans(data, offsets)[2].tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], ["__id", "__source", "__size"])


def word_sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """(__id, __source, __size): the words of every row's text."""
    return (df.select(F.col(id_col).cast("long").alias("__id"), F.col(source_col).cast("string").alias("__source"),
                      F.col(text_col).alias("__t"))
            .mapInArrow(_sizes, "__id long, __source string, __size long"))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_REPEAT) -> DataFrame:
    """Sources (__source, source_size, ...) with ``target``, their share of all words by weight.

    No target is above ``most`` times its source's size; the excess goes to the others.  Sources get the
    weights in turn, in their order by code point, null last.  The list stays a table however long it
    is: each round is one sum over it, and a round that caps no more sources is the last.
    """
    # null sorts after every text; a group of its own name for all, as positions are in groups
    ordered = positions(sources.withColumn("__all", F.lit(0)).withColumn("__none", F.col("__source").isNull().cast("int")),
                        "__all", ["__none", "__source"])
    by_turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                           (F.col("__pos") % len(weights) + 1).cast("int"))
    rows = store(ordered.select(*sources.columns, by_turn.alias("__weight")), "sources")
    takes = (F.col("source_size") > 0) & (F.col("__weight") > 0)
    most_words = F.col("source_size") * F.lit(float(most))
    total, by = rows.agg(F.sum("source_size"), F.sum(F.when(takes, F.col("__weight")))).first()
    left, capped = float(total or 0), 0
    share = F.lit(left) * F.col("__weight") / F.lit(by or 1.0)
    while by:
        # the level only rises, so a source above its bound stays there
        above = share > most_words
        n, words, by = rows.filter(takes).agg(
            F.count_if(above), F.sum(F.when(above, most_words)), F.sum(F.when(~above, F.col("__weight")))).first()
        if n <= capped:
            break
        capped, left = n, float(total) - words
        # with every source at its bound nothing is left to share, and all stay there
        share = F.lit(left) * F.col("__weight") / F.lit(by) if by else most_words
    return rows.withColumn("target", F.when(takes, F.least(share, most_words)).otherwise(0.0)).drop("__weight")


def flight(prob: np.ndarray, size: np.ndarray, draw: np.ndarray, last: bool) -> np.ndarray:
    """Move the probabilities through the null space of (1, size) until at most two are undecided.

    The units come in the order of their size, largest first.  Each step takes the first undecided
    unit and moves it to 0 or 1 as far as the others, which give way together, allow; so large
    documents are settled against many small ones, and what stays undecided is small.  A unit that
    the constraints hold fast is moved along the words alone.  With ``last``, the landing goes on
    without the document constraint, and the last unit is drawn.
    """
    low = 1e-9
    prob = prob.astype(float)
    # the units' own numbers seed the steps, so a rerun of the block takes the same ones
    rng = np.random.default_rng((draw * (1 << 32)).astype(np.uint64) if len(draw) else 0)
    units = np.flatnonzero((prob > low) & (prob < 1 - low))
    p, s = prob[units], size[units].astype(float)
    while len(units) > (1 if last else 2):
        centred = s - s.mean()
        spread = centred @ centred
        # the unit vector of the first unit, projected on the vectors with sum 0 and words 0
        along = -centred * (centred[0] / spread if spread else 0.0) - 1 / len(s)
        along[0] += 1
        if along[0] < 1e-6 or len(units) == 2:
            if not s.any():
                along = np.full(len(s), -1 / len(s))
            else:
                along = -s * (s[0] / (s @ s))
            along[0] += 1
        if along[0] < 1e-12:  # only this unit has words
            along = np.zeros(len(s))
            along[0] = 1.0
        move = np.abs(along) > 1e-15
        rises = along > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(move, np.where(rises, 1 - p, p) / np.abs(along), np.inf).min()
            down = np.where(move, np.where(rises, p, 1 - p) / np.abs(along), np.inf).min()
        # the mean of the two steps is no step at all
        p = p + along * (up if rng.random() * (up + down) < down else -down)
        done = (p <= low) | (p >= 1 - low)
        prob[units[done]] = np.round(p[done])
        units, p, s = units[~done], p[~done], s[~done]
    prob[units] = np.where(rng.random(len(units)) < p, 1.0, 0.0) if last else p
    return prob


def _fly(last: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # large documents are decided first, so what the landing has to settle is small
        block = block.sort_values(["__words", "__draw", "__id", "__size"], kind="stable",
                                  ascending=[False, True, True, True])
        block["__prob"] = flight(block["__prob"].to_numpy(), block["__words"].to_numpy(),
                                 block["__draw"].to_numpy(), last)
        return block
    return run


def copies(sizes: DataFrame, seed: int = 23, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_REPEAT,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """How often each unit is taken: __id, __source, __size, __rows, source_size, target, copies.

    Sources are a table like any other; Spark broadcasts it only where its size is below the threshold.
    """
    units = store(sizes.groupBy("__id", "__source", "__size").agg(F.count(F.lit(1)).alias("__rows")), "units")
    sources = store(units.groupBy("__source").agg(F.sum(F.expr("__size * __rows")).alias("source_size"),
                                                  F.count(F.lit(1)).alias("__n")), "source-sizes")
    times = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    whole = F.floor(times + 1e-9).cast("int")
    plan = store(targets(sources, weights, most).select(
        F.col("__source").alias("__of"), "source_size", "target", whole.alias("__whole"),
        F.greatest(times - whole, F.lit(0.0)).alias("__prob"),
        F.ceil(F.col("__n") / block_rows).cast("long").alias("__blocks")), "mix-plan")
    work = units.join(plan, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    work = (work.withColumn("__words", F.expr("__size * __rows"))
            .withColumn("__draw", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__id", "__size"), 11) / float(1 << 53))
            .withColumn("__sid", F.xxhash64("__source"))
            .withColumn("__block", F.pmod(F.xxhash64(F.lit(seed + 1), "__id", "__size"), F.col("__blocks"))))
    most_blocks = plan.agg(F.max("__blocks")).first()[0] or 1
    decided = None
    while True:
        last = most_blocks == 1
        # at the last level every source is one block, also those that were one block before
        flown = store(work.groupBy("__source", "__block").applyInPandas(_fly(last), work.schema), "flight")
        done = flown if last else flown.filter("__prob <= 1e-9 OR __prob >= 1 - 1e-9")
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        # each block leaves two at most, so the next level's blocks hold block_rows again
        fan = max(2, block_rows // 2)
        work = (flown.filter("__prob > 1e-9 AND __prob < 1 - 1e-9")
                .withColumn("__block", F.expr(f"__block div {fan}")))
        most_blocks = -(-most_blocks // fan)
    taken = F.when(F.col("__size") > 0, F.col("__whole") + F.round("__prob").cast("int")).otherwise(F.lit(0))
    return decided.select("__id", "__source", "__size", "__rows", "source_size", "target", taken.alias("copies"))


def mix(df: DataFrame, seed: int = 23, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mixture itself: rows of ``df``, each as often as it is taken, columns unchanged."""
    chosen = copies(word_sizes(df, id_col, text_col, source_col), seed).filter("copies > 0")
    size, copy, times = free_names(df, "__words", "__copy", "__times")
    chosen = chosen.select("__id", "__source", "__size", F.col("copies").alias(times))
    sized = df.withColumn(size, F.arrow_udf(word_count, "long")(F.col(text_col)))
    on = ((sized[id_col].cast("long").eqNullSafe(chosen["__id"])) & (sized[size] == chosen["__size"])
          & (sized[source_col].cast("string").eqNullSafe(chosen["__source"])))
    return (sized.join(chosen, on)
            .select(*(sized[c] for c in df.columns), F.explode(F.array_repeat(F.lit(0), chosen[times])).alias(copy))
            .select(*df.columns))


def word_count(texts: pa.Array) -> pa.Array:
    out: list[int] = []
    for _, _, data, offsets in slices(texts):
        out += word_spans(data, offsets)[2].tolist()
    return pa.array(out, pa.int64())
