"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import sys
import os

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from kpiforge.plans.catalog import QUERIES  # noqa: E402
from compare import digest, duck  # noqa: E402

KEYS = sorted(QUERIES)  # the warehouse's own queries


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    df = E.queries()[key](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["snapshot_date", "revenue", "orders", "quantity", "aov"]
    assert df.count() > 0
