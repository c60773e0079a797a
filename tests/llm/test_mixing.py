from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiforge.llm.mixing import copies, flight, mix, targets, word_sizes


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_word_sizes(odd, docs):
    for df in (odd, docs):
        got = sorted(((r[0], r[1], r[2]) for r in word_sizes(df).collect()), key=repr)
        assert got == sorted(((r.doc_id, r.source, words(r.text)) for r in df.collect()), key=repr)


def brute_targets(sizes, weights, total, most=3):
    """Shares by weight; whichever is above its bound is set to it, one at a time, lowest bound a weight first."""
    out = [0.0] * len(sizes)
    left, open_ = total, [i for i in range(len(sizes)) if sizes[i] > 0]
    for i in sorted(open_, key=lambda i: sizes[i] / weights[i]):
        by = sum(weights[k] for k in open_)
        out[i] = min(left * weights[i] / by, most * sizes[i])
        left -= out[i]
        open_.remove(i)
    return out


@pytest.mark.parametrize("sizes, weights, want", [
    ([10, 10], (1, 3), [5, 15]),
    # the small source stops at three times its size; the others share what is left by weight
    ([1, 100, 99], (2, 1, 1), [3, 98.5, 98.5]),
    ([0, 10], (5, 1), [0, 10]),
    ([0, 0], (1, 2), [0, 0]),
    ([], (1,), [])])
def test_targets(spark, sizes, weights, want):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "__source string, source_size long")
    assert [r.target for r in targets(df, weights).orderBy("__source").collect()] == want
    assert want == pytest.approx(brute_targets(sizes, weights, sum(sizes)))


def test_targets_of_many_sources(spark):
    """Several rounds of caps, names beyond the first plane, null as the last source."""
    rng = np.random.default_rng(4)
    names = sorted({chr(int(c)) + str(i) for i, c in enumerate(rng.choice([65, 233, 0xFFFD, 0x1F600], 300))}) + [None]
    sizes = [int(n) for n in 10 ** rng.uniform(0, 6, len(names))]
    df = spark.createDataFrame(list(zip(names, sizes)), "__source string, source_size long").repartition(7)
    got = {r["__source"]: r.target for r in targets(df).collect()}
    want = brute_targets(sizes, [1 + i % 3 for i in range(len(names))], sum(sizes))
    assert [got[n] for n in names] == pytest.approx(want)
    assert sum(t == 3 * s for t, s in zip(want, sizes)) > 20


@pytest.mark.parametrize("n", [1, 2, 3, 40, 600])
def test_flight_keeps_both_totals(n):
    rng = np.random.default_rng(n)
    size = np.sort(rng.integers(1, 2000, n))[::-1]
    prob, draw = np.full(n, 0.37), rng.random(n)
    flown = flight(prob, size, draw, last=False)
    undecided = (flown > 0) & (flown < 1)
    assert undecided.sum() <= 2
    if n >= 40:
        assert abs(flown.sum() - prob.sum()) < 1 and abs(flown @ size - prob @ size) < size.max()
    done = flight(prob, size, draw, last=True)
    assert set(done) <= {0.0, 1.0}
    if n >= 40:
        assert abs(done @ size - prob @ size) <= 3 * np.sort(size)[:3].max() + 1


def test_inclusion_probability():
    """Every document, large or small, is taken as often as its probability says."""
    rng = np.random.default_rng(0)
    size = np.array([5000, 900, 300, 300, 120, 80, 50, 20, 10, 5])
    taken = np.mean([flight(np.full(10, 0.3), size, rng.random(10), True) for _ in range(3000)], axis=0)
    assert np.abs(taken - 0.3).max() < 0.05


@pytest.mark.parametrize("block_rows", [2048, 4])
def test_mixture_of_documents(docs, block_rows):
    sizes = word_sizes(docs)
    rows = copies(sizes, block_rows=block_rows).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        s = by.setdefault(r["__source"], [0, 0, r.target, r.source_size, 0])
        s[4] = max(s[4], r["__size"])
        s[0] += r["__size"]
        s[1] += r["__size"] * r.copies
        assert 0 <= r.copies <= 3
    assert abs(sum(s[2] for s in by.values()) - sum(s[0] for s in by.values())) < 1e-6
    for size, taken, target, told, largest in by.values():
        assert told == size and abs(taken - target) <= max(0.1 * target, largest)
    again = copies(sizes.repartition(5), block_rows=block_rows).collect()
    assert sorted((r["__id"], r.copies) for r in rows) == sorted((r["__id"], r.copies) for r in again)


def test_odd_rows(odd, nothing):
    rows = copies(word_sizes(odd)).collect()
    assert sum(r["__rows"] for r in rows) == odd.count()
    assert all(r.copies == 0 for r in rows if r["__size"] == 0)
    assert copies(word_sizes(nothing)).count() == 0
    mixed = mix(odd)
    assert mixed.columns == odd.columns and mix(nothing).count() == 0
    want = {}
    for r in rows:
        want[r["__id"], r["__source"], r["__size"]] = r["__rows"] * r.copies
    got = mixed.select("doc_id", "source", F.col("text")).collect()
    have = {}
    for r in got:
        k = (r.doc_id, r.source, words(r.text))
        have[k] = have.get(k, 0) + 1
    assert have == {k: n for k, n in want.items() if n}
