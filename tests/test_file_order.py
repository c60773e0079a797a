"""Order of rows in stored files, checked without shuffling them."""

from __future__ import annotations

import os

import pytest


@pytest.mark.parametrize("keys", [["s", "d"], ["d"]])
def test_rows_out_of_order_across_splits_and_files(spark, tmp_path, keys):
    """As a join of each row with the one above it in its file: null keys, letters beyond ASCII, files of many splits."""
    from kpiforge.operators.quality import rows_out_of_order
    values = ["a", "é", None, "日本", "aa", "", "z"]
    rows = [(values[i * 5 % 7], None if i % 11 == 0 else i * 37 % 101) for i in range(4000)]
    df = spark.createDataFrame(rows, "s string, d int").repartition(2)
    df.write.option("parquet.block.size", 1000).parquet(f"{tmp_path}/t")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
                                          "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for k, v in zip(old, ("2000", "1", "97")):
            spark.conf.set(k, v)
        stored = spark.read.parquet(f"{tmp_path}/t")
        found = rows_out_of_order(stored, keys).first()
        plan = rows_out_of_order(stored, keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    least = lambda r: tuple((v is not None, v.encode() if isinstance(v, str) else v or 0) for v in r)
    want = 0
    for f in sorted(os.listdir(f"{tmp_path}/t")):
        if f.endswith(".parquet"):
            some = [least(tuple(r)) for r in spark.read.parquet(f"{tmp_path}/t/{f}").coalesce(1).select(*keys).toPandas().astype(object).where(lambda x: x.notna(), None).itertuples(index=False)]
            want += sum(a > b for a, b in zip(some, some[1:]))
    assert (found.rows, found.out_of_order) == (4000, want) and 0 < want < 4000
    assert "Join" not in plan
