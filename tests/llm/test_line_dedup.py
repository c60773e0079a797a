from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from corpus_brute import lower_ascii
from pyspark.sql import functions as F

from kpiforge.llm.line_dedup import keep_bitmap, kept_text


def key(line):
    return lower_ascii(line.strip(" \t\n\x0b\x0c\r"))


def brute(rows):
    holders = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            if len(key(line)) >= 10 and r.doc_id is not None:
                holders[key(line)].add(r.doc_id)
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        kept = [x for x in lines if r.doc_id is None or len(key(x)) < 10 or min(holders[key(x)]) == r.doc_id]
        out.append((r.doc_id, len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df, **options):
    marked = keep_bitmap(df, **options)
    kept = kept_text(F.col("text"), F.col("keep_bitmap"))
    rows = marked.select("doc_id", "n_dropped", F.sha2(kept.cast("binary"), 256).alias("s")).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("runs", [1, 64])
def test_matches_brute_force(odd, docs, runs):
    assert run(odd, runs=runs) == brute(odd.collect())
    assert run(docs, runs=runs) == brute(docs.collect())


def test_many_lines_and_columns(spark):
    """Drops in several words of the bitmap, and the caller's columns unchanged."""
    first = "\n".join(f"a line with number {i}" for i in range(0, 400, 3))
    second = "\n".join(f"a line with number {i}" for i in range(400))
    df = spark.createDataFrame([(1, first, "x"), (2, second, "y")], "doc_id long, text string, __doc string")
    assert run(df) == brute(df.collect())
    marked = keep_bitmap(df)
    assert marked.columns == ["doc_id", "text", "__doc", "n_dropped", "keep_bitmap"]
    words = {r.doc_id: r.keep_bitmap for r in marked.collect()}
    assert words[1] is None and [w.word for w in words[2]] == list(range(7))


def test_empty_table(nothing):
    assert keep_bitmap(nothing).count() == 0
