"""Language-model scores from a Brown class bigram model.

Words belong to classes; p(w | v) = p(class w | class v) * p(w | class w).  The classes come from
exchange clustering: words move to the class that raises the likelihood of the class bigrams most.

Spark counts every training word (all of them, by 64-bit hash).  The ``VOCABULARY`` most frequent
words and the ``SUFFIXES`` buckets of all other words' last bytes are the units that exchange moves on
the driver.  Every round is one pass over all training texts, in which tasks count each unit's
neighbouring classes in vectors of a fixed size; the vectors are added in a tree, and the exchange
itself runs on these sums.  Then every other training word starts from its bucket's class and moves to
its own best class: its neighbours' classes come together by a shuffle, and the words move in parallel
against the class bigrams of the last round; if that lowers the likelihood, they stay.  Only words that no training text has keep their
bucket's class.  The class bigrams of the model are counted after all words have moved.

Counts and classes of the ``LOOKUP`` most frequent words (equal counts by hash) are a broadcast table of that fixed size; all
others are joined with the full table, alone and in pairs of neighbours, so any number of words is
learned and scored exactly.  No word beyond the table is frequent, so these joins have no hot key.

p(c | c') is smoothed towards p(c); p(w | c) adds 0.1 to each count, with one unknown word per
class.  A document starts and ends in a state of its own, so scores are comparable and sum to one.

Defined cases: a null text counts as empty (one end token); a null id is held out; rows that repeat
an id are scored and learned from row by row; without training rows every token is unknown; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.ranks import positions
from kpiforge.llm.text import (
    PARTS, HashIndex, chunks, last_bytes, slices, store, span_hashes, vector_sum, word_spans,
)

CLASSES = 32
VOCABULARY = 16_384
SUFFIXES = 4_096
LOOKUP = 1 << 18
COUNTED = 1 << 19  # words that a task holds to count them
MOVED = 1 << 13  # rows of words' neighbours that a task holds to move them
ROUNDS = 3
ADD = 0.1
BETA = 5.0
END = 0  # unit and class of the end of a document
END_LINE = np.array([END])


def held_out(id_col: Column, parts: int = 10, part: int = 0) -> Column:
    """Whether crc32(id as text) mod ``parts`` is ``part``; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(True))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, summed over about ``COUNTED`` words at a time."""
    def summed() -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"])

    held, size = [], 0
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            starts, ends, _ = word_spans(data, offsets)
            held.append(span_hashes(data, starts, ends))
            size += len(starts)
            if size >= COUNTED:
                yield summed()
                held, size = [], 0
    if size:
        yield summed()


class Units:
    """The units of a text: END, the vocabulary's words, and suffix buckets for all others."""

    def __init__(self, words: np.ndarray) -> None:
        self.index = HashIndex(words)
        self.size = 1 + len(words) + SUFFIXES

    def sequence(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units of all rows in a line, END after each row; the words' hashes; rows' word counts."""
        starts, ends, counts = word_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        units = self.index.find(hashes) + 1
        rare = np.flatnonzero(units == 0)
        units[rare] = 1 + len(self.index.keys) + last_bytes(data, starts[rare], ends[rare], SUFFIXES)
        return lined(units, counts), hashes, counts


def lined(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The words' values of all rows in a line, END after each row."""
    line = np.full(len(values) + len(counts), END, values.dtype)
    line[np.arange(len(values)) + np.repeat(np.arange(len(counts)), counts)] = values
    return line


def _equal(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of equal rows each, and how many rows equal it."""
    order = np.lexsort(columns)
    if not len(order):
        return order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in columns:
        new[1:] |= np.diff(c[order].astype(np.int64)) != 0
    first = np.flatnonzero(new)
    return order[first], np.diff(np.r_[first, len(order)])


def _neighbours(state, classes: int):
    """Counts of the class before and after every unit, over this task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, cls = state.value
        units = Units(words)
        total = np.zeros((2, units.size * classes), np.int64)
        held, size = [], 0

        def add() -> None:
            line = np.concatenate([END_LINE, *held])
            before, line = line[:-1], line[1:]
            total[0] += np.bincount(line * classes + cls[before], minlength=total.shape[1])
            total[1] += np.bincount(before * classes + cls[line], minlength=total.shape[1])

        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                held.append(units.sequence(data, offsets)[0])  # a line ends with END
                size += len(held[-1])
                if size >= COUNTED:
                    add()
                    held, size = [], 0
        if size:
            add()
        yield chunks(TaskContext.get().partitionId(), total.ravel())
    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(left: np.ndarray, right: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """One round: every unit but END moves to its best class, given its neighbours' classes.

    The units come by frequency, and the class bigram counts follow each move.
    """
    classes = left.shape[1]
    cls = cls.copy()
    left, right = left.astype(float), right.astype(float)
    pairs = np.zeros((classes, classes))  # [before, after]
    np.add.at(pairs.T, cls, left)
    count = right.sum(1)
    sums = np.bincount(cls, weights=count, minlength=classes)
    for w in np.argsort(-count, kind="stable"):
        if w == END or not count[w]:
            continue
        a, l, r = cls[w], np.flatnonzero(left[w]), np.flatnonzero(right[w])
        lw, rw = left[w, l], right[w, r]
        pairs[a, r] -= rw
        pairs[l, a] -= lw
        sums[a] -= count[w]
        after, before = np.maximum(pairs[:, r], 0), np.maximum(pairs[l].T, 0)
        gain = ((_f(after + rw) - _f(after)).sum(1) + (_f(before + lw) - _f(before)).sum(1)
                - 2 * (_f(sums + count[w]) - _f(np.maximum(sums, 0))))
        gain[END] = -np.inf
        b = int(np.argmax(gain))
        if gain[b] <= gain[a] + 1e-9:
            b = a
        cls[w] = b
        pairs[b, r] += rw
        pairs[l, b] += lw
        sums[b] += count[w]
    return cls


_AROUND = "word long, place int, n long"


def _tail_neighbours(state, classes: int):
    """Every word that is no unit between its neighbours, with counts; ``place`` holds its bucket and the class before and after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cls = state.value
        units = Units(words)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                line, hashes, counts = units.sequence(data, offsets)
                around = np.r_[END, cls[line], END]
                at = np.flatnonzero(line > len(words))
                word = lined(hashes, counts)[at]
                place = ((line[at] - 1 - len(words)) * classes + around[at]) * classes + around[at + 2]
                first, n = _equal(place, word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word[first].view(np.int64)), pa.array(place[first].astype(np.int32)), pa.array(n.astype(np.int64))],
                    ["word", "place", "n"])
    return run


def _whole_words(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of ``_AROUND`` sorted by word, about ``most`` at a time; the rows of a word stay together."""
    held, rows = [], 0
    for batch in batches:
        held.append([batch.column(c).to_numpy() for c in range(3)])
        rows += batch.num_rows
        if rows < most:
            continue
        word, place, n = (np.concatenate(c) for c in zip(*held))
        last = int(np.searchsorted(word, word[-1]))
        if last:
            yield word[:last], place[:last], n[:last]
        # of the last word, more rows may follow: its equal rows become one
        places, at = np.unique(place[last:], return_inverse=True)
        total = np.zeros(len(places), np.int64)
        np.add.at(total, at, n[last:])
        held, rows = [[np.full(len(places), word[-1]), places, total]], 0
    if held:
        word, place, n = (np.concatenate(c) for c in zip(*held))
        if len(word):
            yield word, place, n


def best_classes(left: np.ndarray, right: np.ndarray, own: np.ndarray, pairs: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The class each word moves to from its ``own``, given all others as they are: the rule of ``exchange``."""
    left, right = left.astype(float), right.astype(float)
    count = right.sum(1)
    every = np.arange(len(own))
    rest = np.repeat(sums[None].astype(float), len(own), axis=0)
    rest[every, own] -= count
    gain = -2 * (_f(rest + count[:, None]) - _f(np.maximum(rest, 0)))
    for mine, other, table in ((right, left, pairs.T), (left, right, pairs)):
        i, c = np.nonzero(mine)
        n = mine[i, c][:, None]
        held = table[c].astype(float)  # the class bigrams of every class with c, without the word's own
        held[np.arange(len(i)), own[i]] -= n[:, 0]
        same = np.flatnonzero(c == own[i])
        held[same] -= other[i[same]]
        held = np.maximum(held, 0)
        np.add.at(gain, i, _f(held + n) - _f(held))
    gain[:, END] = -np.inf
    best = gain.argmax(1)
    return np.where(gain[every, best] <= gain[every, own] + 1e-9, own, best)


def _move(state):
    """Rows of ``_AROUND`` sorted by word to words with their count and best class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, pairs, sums = state.value
        classes = len(sums)
        for word, place, n in _whole_words(batches, MOVED):
            first = np.flatnonzero(np.r_[True, np.diff(word) != 0])
            row = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(word)])) * classes
            left, right = (np.bincount(row + c, n, len(first) * classes).reshape(-1, classes).astype(np.int64)
                           for c in (place // classes % classes, place % classes))
            own = buckets[place[first] // classes ** 2]
            cls = best_classes(left, right, own, pairs, sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[first]), pa.array(right.sum(1)), pa.array(cls.astype(np.int32)), pa.array(own.astype(np.int32))],
                ["word", "n", "cls", "own"])
    return run


class Classes:
    """Classes of a text's words by the broadcast table; a word that is not there has its bucket's for now."""

    def __init__(self, words: np.ndarray, cls: np.ndarray, buckets: np.ndarray) -> None:
        self.index, self.cls, self.buckets = HashIndex(words), cls, buckets

    def sequence(self, data: np.ndarray, offsets: np.ndarray):
        """Classes of all rows in a line, END after each row; words' hashes, places in the table, rows' word counts."""
        starts, ends, counts = word_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        place = self.index.find(hashes)
        cls = np.r_[self.cls, END][place].astype(np.int64)
        rare = np.flatnonzero(place < 0)
        cls[rare] = self.buckets[last_bytes(data, starts[rare], ends[rare], SUFFIXES)]
        return lined(cls, counts), hashes, place, counts


def _open_pairs(line: np.ndarray, hashes: np.ndarray, place: np.ndarray, counts: np.ndarray):
    """Whether each step of the line has a word that is not in the table; row and columns of equal ones, with counts."""
    rare, word = lined((place < 0).astype(np.int64), counts) > 0, lined(hashes, counts)
    row = np.repeat(np.arange(len(counts)), counts + 1)
    at = np.flatnonzero(rare | np.r_[False, rare[:-1]])
    prev_rare, cur_rare = np.r_[False, rare[:-1]][at], rare[at]
    # a row's first step comes from the END before it, which is never rare
    prev = np.where(prev_rare, np.r_[np.uint64(0), word[:-1]][at], np.uint64(0))
    cur = np.where(cur_rare, word[at], np.uint64(0))
    a, b = np.r_[END, line[:-1]][at], line[at]
    first, n = _equal(a, b, prev, cur, prev_rare, cur_rare, row[at])
    columns = [pa.array(prev[first].view(np.int64), mask=~prev_rare[first]), pa.array(cur[first].view(np.int64), mask=~cur_rare[first]),
               pa.array(a[first].astype(np.int32)), pa.array(b[first].astype(np.int32)), pa.array(n.astype(np.int64))]
    return at, row[at][first], columns


_STEPS = "prev long, cur long, a int, b int, n long"


def _steps(held, classes: int):
    """Class bigrams: summed where the table has both words, else one row per pair with the words it has not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Classes(*held.value)
        names = [c.split()[0] for c in _STEPS.split(", ")]
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                line, hashes, place, counts = table.sequence(data, offsets)
                at, _, columns = _open_pairs(line, hashes, place, counts)
                code = np.delete(np.r_[END, line[:-1]] * classes + line, at)
                total += np.bincount(code, minlength=len(total))
                yield pa.RecordBatch.from_arrays(columns, names)
        some = np.flatnonzero(total)
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, pa.array((some // classes).astype(np.int32)), pa.array((some % classes).astype(np.int32)),
             pa.array(total[some])], names)
    return run


def _resolved(steps: DataFrame, tail: DataFrame) -> DataFrame:
    """``steps`` with the classes of its words; words that are not in ``tail`` keep their bucket's class."""
    for word, cls in (("prev", "a"), ("cur", "b")):
        found = (steps.filter(F.col(word).isNotNull())
                 .join(tail.select(F.col("word").alias(word), F.col("cls").alias("__cls")), word, "left")
                 .withColumn(cls, F.coalesce("__cls", cls)).drop("__cls"))
        steps = steps.filter(F.col(word).isNull()).unionByName(found)
    return steps


class ClassModel:
    """Words of the table with their counts and classes, buckets' classes, and log10 probabilities."""

    def __init__(self, words, counts, cls, buckets, trans, below, total, kinds) -> None:
        self.words, self.counts, self.cls = words, counts, cls  # the look-up table, by hash
        self.buckets = buckets                           # class of unseen words, by their last bytes
        self.trans, self.below = trans, below            # log10 p(c | c'), log10 of p(w | c)'s denominator
        self.total, self.kinds = total, kinds            # training tokens and distinct ones
        self.end_count = 0


COUNT_BINS = 1 << 16


def _most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The ``most`` most frequent words (word, n): exactly so many, equal counts by word.

    A histogram of the counts, of at most ``COUNT_BINS`` rows, leaves out what is certainly beyond; the rest is ranked."""
    least, held = 1, 0
    for r in (words.groupBy(F.least("n", F.lit(COUNT_BINS)).alias("n")).agg(F.count(F.lit(1)).alias("k"))
              .orderBy(F.desc("n")).collect()):
        least, held = r.n, held + r.k
        if held >= most:
            break
    some = words.filter(F.col("n") >= least).select("word", "n")
    if held <= most:
        return some
    ranked = positions(some.withColumns({"__all": F.lit(0), "__less": -F.col("n")}), "__all", ["__less", "word"])
    return ranked.filter(F.col("__pos") < most).select("word", "n")


def _likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of class bigrams, up to what does not depend on the classes."""
    return float(_f(pairs).sum() - _f(pairs.sum(0)).sum() - _f(pairs.sum(1)).sum())


def train(texts: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, vocabulary: int = VOCABULARY,
          lookup: int = LOOKUP) -> tuple[ClassModel, DataFrame]:
    """The model of a one-column table of texts, and count and class of every word that is no unit."""
    sc = texts.sparkSession.sparkContext
    words = store(texts.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    documents = texts.count()
    seen = words.agg(F.count(F.lit(1)).alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    listed = store(_most_frequent(words, lookup), "table")
    top = listed.toPandas()
    top = top.sort_values(["n", "word"], ascending=[False, True])
    table, counts = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    units = table[:vocabulary]
    size = 1 + len(units) + SUFFIXES
    # each of the most frequent words starts as a class; the others start together
    cls = np.full(size, classes - 1)
    cls[END] = END
    cls[1:min(classes - 1, 1 + len(units))] = np.arange(1, min(classes - 1, 1 + len(units)))
    cls[1 + len(units):] = 1 + np.arange(SUFFIXES) % (classes - 1)
    for i in range(rounds + 1):
        state = sc.broadcast((units, cls))
        sums = vector_sum(texts.mapInArrow(_neighbours(state, classes), PARTS), 2 * size * classes)
        left, right = sums.reshape(2, size, classes)
        if i < rounds:
            cls = exchange(left, right, cls)
    pairs = np.zeros((classes, classes))
    np.add.at(pairs.T, cls, left.astype(float))
    sums = np.bincount(cls, weights=right.sum(1), minlength=classes)
    buckets = cls[1 + len(units):]
    # all other words move from their bucket's class to their own best one, in parallel
    move = sc.broadcast((buckets, pairs, sums))
    around = (texts.mapInArrow(_tail_neighbours(state, classes), _AROUND)
              .repartition("word").sortWithinPartitions("word"))
    tail = store(around.mapInArrow(_move(move), "word long, n long, cls int, own int"), "tail")
    index = HashIndex(table)

    def bigrams(tail: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Classes of the table's words, and the class bigrams of all texts."""
        found = tail.join(listed, "word", "left_semi").select("word", "cls").toPandas()
        table_cls = np.full(len(table), END, np.int16)
        table_cls[:len(units)] = cls[1:1 + len(units)]
        table_cls[index.find(found["word"].to_numpy(np.int64).view(np.uint64))] = found["cls"].to_numpy(np.int16)
        held = sc.broadcast((table, table_cls, buckets))
        steps = store(texts.mapInArrow(_steps(held, classes), _STEPS), "steps")
        after = np.zeros((classes, classes))
        for r in _resolved(steps, tail).groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
            after[r.a, r.b] = r.n
        return table_cls, after

    moved = _likelihood(pairs)
    table_cls, pairs = bigrams(tail)
    if _likelihood(pairs) < moved:  # words that move at once can be in each other's way: then they stay
        tail = tail.withColumn("cls", F.col("own"))
        table_cls, pairs = bigrams(tail)
    into = pairs.sum(0)
    share = (into + ADD) / (into.sum() + ADD * classes)
    trans = np.log10((pairs + BETA * share) / (pairs.sum(1, keepdims=True) + BETA))
    kinds = np.bincount(cls[:1 + len(units)], minlength=classes).astype(float)
    for r in tail.groupBy("cls").agg(F.count(F.lit(1)).alias("k")).collect():
        kinds[r.cls] += r.k
    below = np.log10(into + ADD * (kinds + 1))
    total = int(seen.n) + documents
    model = ClassModel(table, counts, table_cls, buckets, trans, below, total, int(seen.kinds) + (1 if documents else 0))
    model.end_count = documents
    return model, tail


_ROWS = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, model double, word long, times long, prev long, cur long, a int, b int"


def _score(held):
    """One row per text with all but its rare words, and one row per rare word, and per pair with one, of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        table = Classes(m.words, m.cls, m.buckets)
        gain = np.log10(np.r_[m.counts, 0] + ADD)  # the last place is for words not in the table
        floor = np.log10(m.total + ADD * (m.kinds + 1))
        end_gain = np.log10(m.end_count + ADD)
        for batch in batches:
            for start, stop, data, offsets in slices(batch.column(3)):
                cls, hashes, place, counts = table.sequence(data, offsets)
                at, pair_row, pairs = _open_pairs(cls, hashes, place, counts)
                steps = m.trans[np.r_[END, cls[:-1]], cls] - m.below[cls]
                steps[at] = 0  # their classes come by a join
                row = np.repeat(np.arange(len(counts)), counts)
                rows = len(counts)
                found = np.bincount(row, np.where(place >= 0, gain[place], 0.0), rows) + end_gain
                model = np.add.reduceat(steps, np.r_[0, np.cumsum(counts + 1)[:-1]]) + found
                tokens = counts + 1
                known = np.bincount(row, place >= 0, rows).astype(np.int64) + (m.end_count > 0)
                part = batch.slice(start, stop - start)
                texts = {"row": part.column(0), "id": part.column(1), "held_out": part.column(2),
                         "n_tokens": pa.array(tokens.astype(np.int64)), "n_known": pa.array(known),
                         "base": pa.array(found - tokens * floor), "model": pa.array(model)}
                yield _padded(texts)
                rare = np.flatnonzero(place < 0)
                if len(rare):
                    # a text's equal rare words are one row
                    first, times = _equal(hashes[rare], row[rare])
                    yield _padded({"row": part.column(0).take(pa.array(row[rare][first])),
                                   "word": pa.array(hashes[rare][first].view(np.int64)), "times": pa.array(times.astype(np.int64))})
                    yield _padded({"row": part.column(0).take(pa.array(pair_row)),
                                   **dict(zip(("prev", "cur", "a", "b", "times"), pairs))})
    return run


def _padded(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch of ``_ROWS``, null in all other columns."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [c.split() for c in _ROWS.split(", ")]
    rows = len(columns["row"])
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(rows, kinds[t]) for c, t in fields],
                                      [c for c, _ in fields])


def class_scores(df: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, vocabulary: int = VOCABULARY,
                 lookup: int = LOOKUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row."""
    apart = held_out(F.col(id_col))
    model, tail = train(df.filter(~apart).select(F.col(text_col).alias("t")), classes, rounds, vocabulary, lookup)
    held = df.sparkSession.sparkContext.broadcast(model)
    parts = store(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                            apart.alias("held_out"), F.col(text_col).alias("t")).mapInArrow(_score(held), _ROWS), "scores")
    none = {"id": "long", "held_out": "boolean", "n_tokens": "long"}
    empty = [F.lit(None).cast(t).alias(c) for c, t in none.items()]
    rare = (parts.filter("word IS NOT NULL").select("row", "word", "times")
            .join(tail.select("word", "n"), "word", "left"))
    gain = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))
    rare = rare.select("row", *empty, F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("n_known"),
                       gain.alias("base"), gain.alias("model"))
    # from Arrow: a list of rows would start Python workers of its own on the executors, which stay
    before, after = (c.ravel().astype(np.int32) for c in np.indices((classes, classes)))
    steps = df.sparkSession.createDataFrame(pa.table({"a": before, "b": after, "step": (model.trans - model.below).ravel()}))
    pairs = _resolved(parts.filter("a IS NOT NULL").select("row", "prev", "cur", "a", "b", "times"), tail)
    pairs = pairs.join(F.broadcast(steps), ["a", "b"]).select(
        "row", *empty, F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"),
        (F.col("times") * F.col("step")).alias("model"))
    texts = parts.filter("n_tokens IS NOT NULL").drop("word", "times", "prev", "cur", "a", "b")
    both = texts.unionByName(rare).unionByName(pairs).groupBy("row").agg(
        F.max("id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("model").alias("score"))
    return both.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                       "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
