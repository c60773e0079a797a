"""The driver contract: lazy DataFrames, unique column names, stable schemas."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as E
from kpiforge.plans.catalog import QUERIES

KEYS = sorted(QUERIES)  # the warehouse's own queries


def test_entry_is_lazy_dataframe(spark):
    assert isinstance(E.entry(spark), DataFrame)


@pytest.mark.parametrize("key", KEYS)
def test_schema_unique_and_stable(spark, sf_small, key):
    a = E.queries()[key](spark, sf_small)
    b = E.queries()[key](spark, sf_small)
    assert len(set(a.columns)) == len(a.columns)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert not {"ingestion_time", "created_at"} & set(a.columns)  # no load timestamps in results
