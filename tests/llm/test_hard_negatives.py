from __future__ import annotations

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kpiforge.llm.hard_negatives import hard_negatives
from kpiforge.llm.queries import ORACLE_SQL, op12_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, row string, q int"


def brute(rows, low=80, high=100, positives=5, negatives=5):
    usable = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((vec_id, label, [math.floor(256 * x) for x in v]))
    out = []
    for i, (anchor, label, q) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        near = []
        for j, (other, its, p) in enumerate(usable):
            if j != i:
                near.append((-sum(a * b for a, b in zip(q, p)), other is None, other or 0, other, its == label))
        near.sort()
        for score, _, _, positive, _ in [x for x in near if x[4]][:positives]:
            fit = [x for x in near if not x[4] and -score * low <= -x[0] * 100 <= -score * high][:negatives]
            out += [(anchor, positive, rank, x[3], -score, -x[0]) for rank, x in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(df, **options):
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return sorted(map(tuple, hard_negatives(df, F.col("id") % 100 == 0, label=label, **options).collect()), key=repr)


def vectors(seed, count, width=6):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        v = [rng.gauss(0, 1) for _ in range(width)] if rng.random() < 0.7 else [float(rng.randint(0, 1)) for _ in range(width)]
        rows.append((i * 10, v, rng.randint(0, 3), 1, "r", 2))
    return rows


@pytest.mark.parametrize("options", [{}, {"tile": 16, "leaf": 4, "lane": 2, "block": 3}, {"tile": 1, "leaf": 1, "lane": 1, "block": 1}])
def test_ties_and_small_boxes_match_all_rows(spark, options):
    count = 300 if options.get("tile") != 1 else 40
    rows = vectors(1, count)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df, **options) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(2, 60) + [
        (700, None, 1, 1, "", 1), (800, [1.0, None], 1, 1, "", 1), (900, [float("nan")] * 6, 1, 1, "", 1),
        (1000, [float("inf")] * 6, 1, 1, "", 1), (1100, [1.0] * 6, None, 1, "", 1), (None, [1.0] * 6, 1, 1, "", 1), (None, [1.0] * 6, 1, 1, "", 1),
        (1200, [], 1, 1, "", 1), (1300, [1.0], 1, 1, "", 1), (-100, [2.0] * 6, 1, 1, "", 1),
        *[(100, [1.0] * 6, 1, 1, "", 1)] * 3, *[(2001, [0.9] * 6, 2, 1, "", 1)] * 40]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df, tile=8, leaf=4, block=2) == brute(rows)
    assert mined(spark.createDataFrame([], SCHEMA)) == []


def test_large_components(spark):
    rng = random.Random(3)
    rows = [(i * 50, [rng.uniform(-1, 1) * 2.0 ** rng.choice([0, 20, 22]) for _ in range(4)], i % 2, 1, "", 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    assert mined(df, tile=8, leaf=2) == brute(rows)


def test_query_matches_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_small}/embeddings.parquet'")
    want = con.execute(ORACLE_SQL["op12_hard_negatives"])
    names = [c[0] for c in want.description]
    got = op12_hard_negatives(spark, sf_small)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
