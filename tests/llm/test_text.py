"""Stored tables: what a result was made from goes once it is stored."""

from __future__ import annotations

import pytest

from kpiforge.llm.exact_dedup import exact_groups
from kpiforge.llm.text import store, store_result
from kpiforge.session import child_names, ensure_checkpoint_dir


def tables(spark):
    return set(child_names(spark, ensure_checkpoint_dir(spark)))


def test_only_the_result_stays(spark, odd):
    before = tables(spark)
    kept = store_result(spark, lambda: store(store(odd, "first"), "second").filter("doc_id > 3"), "kept")
    new = tables(spark) - before
    assert len(new) == 1 and new.pop().startswith("kpiforge-kept-")
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(map(tuple, odd.filter("doc_id > 3").collect()), key=repr)


def test_nested_results_go_with_the_outer_one(spark, odd):
    before = tables(spark)
    inner = lambda: store_result(spark, lambda: store(odd, "first"), "inner")
    kept = store_result(spark, lambda: inner().unionByName(store(odd, "more")), "outer")
    assert [n.split("-")[1] for n in tables(spark) - before] == ["outer"] and kept.count() == 2 * odd.count()


def test_a_failure_leaves_nothing(spark, odd):
    def broken():
        store(odd, "first")
        raise ValueError("stop")
    before = tables(spark)
    with pytest.raises(ValueError):
        store_result(spark, broken, "kept")
    assert tables(spark) == before
    assert store(odd, "after").count() == odd.count() and len(tables(spark) - before) == 1


def test_exact_dedup_leaves_the_identities_only(spark, odd):
    before = tables(spark)
    exact_groups(odd, block_bytes=16).collect()
    assert [n.split("-")[1] for n in tables(spark) - before] == ["identities"]
