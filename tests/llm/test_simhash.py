from __future__ import annotations

import random
import re

import pytest
import xxhash
from corpus_brute import lower_ascii
from pyspark.sql import functions as F

from kpiforge.llm import simhash


def brute_print(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    grams = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=2):
    """prints: (id, fingerprint) of every row."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(prints):
        for j, (_, y) in enumerate(prints[:i]):
            if (x ^ y).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, (d, p) in enumerate(prints)), key=repr)


def test_documents(docs):
    want = brute_components([(r.doc_id, brute_print(r.text)) for r in docs.collect()])
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == want


def test_odd_rows(odd, nothing):
    want = brute_components([(r.doc_id, brute_print(r.text)) for r in odd.collect()])
    assert sorted(map(tuple, simhash.near_duplicates(odd).collect()), key=repr) == want
    assert simhash.near_duplicates(nothing).count() == 0


def test_long_text_and_chunks():
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdÄ") for _ in range(rng.randint(1, 7))) for _ in range(40_000))
    assert simhash.fingerprint(text.encode()) == brute_print(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_planted_fingerprints(spark, radius):
    rng = random.Random(radius)
    values = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(12):
        value = rng.getrandbits(64)
        values.add(value)
        for _ in range(12):  # a walk of a few bits each step, as signed numbers too
            for _ in range(rng.randint(1, 4)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "print long")
    pairs = {tuple(sorted(x % (1 << 64) for x in (r.a, r.b))) for r in simhash.near_pairs(df, radius).collect()}
    assert all((a ^ b).bit_count() <= radius for a, b in pairs)
    mine = {v: v for v in values}

    def find(v):
        while mine[v] != v:
            v = mine[v]
        return v

    for a, b in pairs:
        mine[find(a)] = find(b)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                assert find(a) == find(b)


def test_spark_hash_agrees(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("a b c", 42)
