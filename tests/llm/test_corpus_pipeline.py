"""The pipeline's stages against their operators' brute-force rules, each on its own input."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from test_ngram_join import brute as brute_groups
from test_sharding import brute as brute_shards

import __spark_entry__ as entry
from kpiforge.llm.queries import ORACLE_SQL, QUERIES
from kpiforge.llm.text import store
from kpiforge.session import child_names, ensure_checkpoint_dir


def test_registered():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(QUERIES)


def test_stages(spark, sf_small, docs):
    columns = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(store(stage(spark, kept[-1], sf_small), f"test-{name}"))
    assert all(df.columns == columns for df in kept[:-1])
    rows = [df.collect() for df in kept]
    ids = [Counter(r.doc_id for r in own) for own in rows]
    # language: every document with a letter and a language stays
    assert set(ids[0]) - set(ids[1]) <= {r.doc_id for r in rows[0] if not re.search(r"[^\W\d_]{3}", r.text or "")}
    # near duplicates: the smallest id of each component
    assert set(ids[2]) == {c for _, _, c in brute_groups([(r.doc_id, r.text) for r in rows[1]])}
    # benchmark: what goes holds an item
    words = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    items = [words(r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in rows[2] if any(i and i in words(r.text) for i in items)}
    assert leaky <= set(ids[2]) - set(ids[3]) and len(set(ids[2]) - set(ids[3])) <= len(leaky) + 2
    # mixture: whole documents, three times at most
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].values()) <= 3
    # shards: all that is left
    assert sorted(map(tuple, rows[5]), key=repr) == brute_shards(kept[4], 16, 17)


def test_rows_that_share_an_id_are_judged_one_by_one(spark, sf_small, docs):
    """Several rows with a null id, and several with one id: some leak, one has no letter, the others stay."""
    items = sorted((r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect() if r.text), key=len)
    clean = [f"{word} and a plain sentence about the weather of today" for word in ("first", "second", "third")]
    texts = [*clean, f"some words before {items[-1]} some words after", "12 34", None]
    new = [(i, t) for i in (None, 9_999_999) for t in texts]
    rows = spark.createDataFrame(new, "doc_id long, text string").repartition(2)
    both = docs.unionByName(rows, allowMissingColumns=True)
    mine = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect() if r.doc_id in (None, 9_999_999))
    known = store(corpus_pipeline.language(spark, both, sf_small), "test-known")
    want = sorted((i, t) for i in (0, 9_999_999) for t in texts[:4])
    assert mine(known) == want and known.columns == both.columns
    assert mine(corpus_pipeline.benchmark(spark, known, sf_small)) == [w for w in want if w[1] in clean]


def test_empty_documents(spark, sf_small, nothing):
    docs = nothing.drop("__id")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
        assert docs.count() == 0


def test_run_leaves_only_what_its_last_stage_reads(spark, sf_small):
    root = ensure_checkpoint_dir(spark)
    before = set(child_names(spark, root))
    rows = corpus_pipeline.run(spark, sf_small).collect()
    left = {n.removeprefix("kpiforge-").rsplit("-", 1)[0]: n for n in set(child_names(spark, root)) - before}
    # the mixture, and tables of the last stage, whose rows are read when the result is
    assert [n for n in left if n.startswith("stage-")] == ["stage-mixture"]
    assert set(left) - {"stage-mixture"} <= {"equal-rows", "shard-rows", "shard-copies"}
    mixed = spark.read.parquet(f"{root}/{left['stage-mixture']}")
    assert sorted(map(tuple, rows), key=repr) == brute_shards(mixed, 16, 17)
