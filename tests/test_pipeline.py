"""Full refresh pipeline, stored tables, invariants and data-quality checks."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from kpiforge.operators.quality import dq_checks
from kpiforge.plans.pipeline import run_pipeline
from kpiforge.plans.warehouse import TABLES, Warehouse
from kpiforge.session import local_path, scratch_path
from kpiforge.sources.tables import load_fact
from kpiforge.sources.testdata import bronze_from_testdata


@pytest.fixture(scope="module")
def built(spark, sf_small):
    out = scratch_path(spark, "pipeline-test")
    dq = {r.check_name: r.value for r in run_pipeline(spark, bronze_from_testdata(spark, sf_small), out).collect()}
    return out, dq


def _snapshot(spark, root):
    wh = Warehouse.from_tables(spark, root)
    snap = {}
    for t in TABLES:
        df = wh.table(t).drop("ingestion_time", "created_at")
        snap[t] = sorted(tuple(r) for r in df.collect())
    return snap


def test_all_tables_written(spark, built):
    out, _ = built
    for t in TABLES:
        assert os.path.isdir(local_path(f"{out}/{t}")), t


def test_dq_checks(built):
    _, dq = built
    assert dq == {"bronze_rows": 6000, "silver_rows": 4788, "fact_sales_rows": 4788,
                  "null_order_id_in_silver": 0, "invalid_quantity_in_silver": 0,
                  "negative_revenue_in_silver": 0}


def test_rerun_is_full_refresh(spark, sf_small, built):
    out, _ = built
    before = _snapshot(spark, out)
    run_pipeline(spark, bronze_from_testdata(spark, sf_small), out)
    assert _snapshot(spark, out) == before


def test_fact_is_month_partitioned(spark, built):
    out, _ = built
    months = [d for d in os.listdir(local_path(f"{out}/fact_sales")) if d.startswith("order_month=")]
    assert len(months) == 80
    one = load_fact(spark, out, "2024-06-01", "2024-06-30")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "order_month" in plan
    assert one.select(F.min("order_date"), F.max("order_date")).first()[0] >= __import__("datetime").date(2024, 6, 1)


def test_invariants(spark, built):
    out, _ = built
    wh = Warehouse.from_tables(spark, out)

    def total(df, c):
        return round(df.agg(F.sum(c)).first()[0], 2)

    fact_rev = total(wh.fact, "revenue")
    assert wh.fact.count() == wh.silver.count()
    for df, c in [(wh.channel_performance_summary, "total_revenue"),
                  (wh.product_profitability_summary, "total_revenue"),
                  (wh.sales_forecast_ready, "total_revenue"),
                  (wh.kpi_daily_snapshot, "revenue"),
                  (wh.channel_monthly_summary, "total_revenue"),
                  (wh.customer_rfm, "monetary")]:
        assert total(df, c) == fact_rev
    known = wh.silver.where((F.col("state") != "Unknown") & (F.col("state") != ""))
    assert total(wh.geographic_daily_summary, "total_revenue") == total(known, "revenue")
    bad_aov = wh.kpi_daily_snapshot.where(F.abs(F.col("aov") * F.col("orders") - F.col("revenue")) > 1e-6)
    assert bad_aov.count() == 0
    fc = wh.sales_forecast_result
    days = wh.sales_forecast_ready.count()
    per_metric = {r.metric_name: (r.n, r.f) for r in fc.groupBy("metric_name").agg(
        F.count("*").alias("n"), F.count("forecast_value").alias("f")).collect()}
    assert per_metric == {"Revenue": (days + 30, 30), "Orders": (days + 30, 30)}
    assert fc.where(F.col("lower_bound") < 0).count() == 0
    segs = {r.segment_name for r in wh.customer_rfm.select("segment_name").distinct().collect()}
    assert segs <= {"Champions", "Loyal", "At Risk", "Hibernating", "Regular"}


def test_from_csv_matches_bronze(spark, sf_small):
    """The bronze table exported as a raw CSV and ingested again is the same."""
    import __spark_entry__ as E
    a = sorted(tuple(r) for r in E.queries()["csv_scan"](spark, sf_small).collect())
    b = sorted(tuple(r) for r in E.queries()["bronze_orders"](spark, sf_small).collect())
    assert a == b


def test_stored_schemas_match_contracts(spark, built):
    from kpiforge import schemas as S
    out, _ = built
    wh = Warehouse.from_tables(spark, out)

    def shape(df):
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    assert shape(wh.bronze) == shape(spark.createDataFrame([], S.BRONZE))
    assert shape(wh.silver) == shape(spark.createDataFrame([], S.SILVER))
    assert shape(wh.fact) == shape(spark.createDataFrame([], S.FACT_SALES))
    assert shape(wh.sales_forecast_result) == shape(spark.createDataFrame([], S.SALES_FORECAST_RESULT))


def test_table_files_sorted_on_sort_key(built):
    """Each written file is sorted on the table's sort key (row-group min/max skipping)."""
    import glob

    import pyarrow.parquet as pq
    out, _ = built
    for table, key in [("dim_customer", "customer_id"), ("kpi_daily_snapshot", "snapshot_date"),
                       ("silver_orders_clean", "order_date")]:
        files = glob.glob(f"{local_path(out)}/{table}/**/*.parquet", recursive=True)
        assert files
        for f in files:
            values = pq.read_table(f, columns=[key]).column(key).to_pylist()
            assert values == sorted(values), (table, f)


def test_fact_files_sorted_within_month(built):
    import glob

    import pyarrow.parquet as pq
    out, _ = built
    files = glob.glob(f"{local_path(out)}/fact_sales/order_month=*/*.parquet")
    assert files
    for f in files:
        rows = pq.read_table(f, columns=["order_date", "order_id"]).to_pylist()
        keys = [(r["order_date"], r["order_id"]) for r in rows]
        assert keys == sorted(keys), f


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_invariants_every_scale(spark, sf_dir):
    """SURVEY §5.3 invariants on the lazy warehouse at each scale factor."""
    wh = Warehouse.from_testdata(spark, sf_dir)
    totals = wh.fact.agg(F.round(F.sum("revenue"), 2).alias("fact"), F.count("*").alias("n")).first()
    assert totals.n == wh.silver.count()
    for df, c in [(wh.channel_performance_summary, "total_revenue"),
                  (wh.product_profitability_summary, "total_revenue"),
                  (wh.sales_forecast_ready, "total_revenue"),
                  (wh.kpi_daily_snapshot, "revenue"),
                  (wh.channel_monthly_summary, "total_revenue"),
                  (wh.customer_rfm, "monetary")]:
        assert df.agg(F.round(F.sum(c), 2)).first()[0] == totals.fact
    dq = {r.check_name: r.value for r in dq_checks(wh.bronze, wh.silver, wh.fact).collect()}
    assert dq["null_order_id_in_silver"] == dq["invalid_quantity_in_silver"] == dq["negative_revenue_in_silver"] == 0
    seg = wh.view("vw_customer_segment_distribution").agg(F.sum("customers")).first()[0]
    assert seg == wh.customer_rfm.count()


def test_stored_tables_equal_lazy_plans(spark, sf_small, built):
    """run_pipeline's stored tables hold exactly what the lazy graph computes."""
    out, _ = built
    stored = Warehouse.from_tables(spark, out)
    lazy = Warehouse.from_testdata(spark, sf_small)
    for t in TABLES:
        a = stored.table(t).drop("ingestion_time", "created_at")
        b = lazy.table(t).drop("ingestion_time", "created_at").select(*a.columns)
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr), t


def test_failed_refresh_leaves_the_tables(spark, sf_small, monkeypatch):
    """Whatever stage fails, readers keep the 16 tables of the version before, and nothing of the new one stays."""
    from kpiforge.plans import pipeline as P
    root = scratch_path(spark, "versions-test")
    bronze = bronze_from_testdata(spark, sf_small)
    first = P.refresh_warehouse(spark, bronze, root)
    before = {t: first.table(t).count() for t in TABLES}
    write = P.write_table
    for broken in ("dim_time", "customer_rfm", "sales_forecast_result"):
        def failing(df, out, name, *args, **kw):
            if name == broken:
                raise OSError(f"lost store while writing {name}")
            return write(df, out, name, *args, **kw)
        monkeypatch.setattr(P, "write_table", failing)
        with pytest.raises(OSError):
            P.refresh_warehouse(spark, bronze.limit(10), root)
        monkeypatch.setattr(P, "write_table", write)
        now = Warehouse.current(spark, root)
        assert now.root == first.root and {t: now.table(t).count() for t in TABLES} == before
        assert len(os.listdir(local_path(f"{root}/versions"))) == 1
    second = P.refresh_warehouse(spark, bronze.limit(500), root)
    assert second.root != first.root and second.bronze.count() == 500
    assert first.fact.count() == before["fact_sales"]  # a reader of the version before goes on
    P.refresh_warehouse(spark, bronze.limit(20), root)
    assert len(os.listdir(local_path(f"{root}/versions"))) == 2


def test_no_version_is_an_error(spark):
    with pytest.raises(ValueError):
        Warehouse.current(spark, scratch_path(spark, "empty-root"))


def test_silver_period_reads_only_its_files(spark, built):
    out, _ = built
    wh = Warehouse.from_tables(spark, out)
    from kpiforge.operators.semantic import period
    files = lambda df: {r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()}
    every = files(wh._silver_scan)
    month = wh.dataset("silver_orders_clean", period("2024-03-01", "2024-04-01"))
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "order_month" not in month.columns
    month.collect()
    scanned = _files_read(month)
    assert len(every) >= 80 and scanned <= 2
    assert month.count() == wh.silver.where("order_date >= '2024-03-01' AND order_date < '2024-04-01'").count() > 0


def _files_read(df):
    """Files that the scans of an executed plan opened, by Spark's own count."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "ShuffleQueryStageExec":
            continue
        metric = leaf.metrics().get("numFiles")
        if metric.isDefined():
            total += metric.get().value()
    return total


def test_landed_bronze_can_be_read_by_many_tasks(spark):
    from kpiforge.sources.tables import file_rows
    bronze = bronze_from_testdata(spark, "/root/testdata/sf0.1")
    assert bronze.rdd.getNumPartitions() >= 8
    assert file_rows(spark, 10 ** 12) == 4_000_000 and file_rows(spark, 10) == 50_000
    plan = bronze._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_statistics_beside_a_table(spark, sf_small):
    from kpiforge.sources.tables import table_stats
    from kpiforge.sources.testdata import BRONZE_TABLE, land_bronze
    stats = table_stats(spark, land_bronze(spark, sf_small), BRONZE_TABLE).first()
    want = Warehouse.from_testdata(spark, sf_small).silver.agg(F.min("order_date"), F.max("order_date")).first()
    assert (stats.first_date, stats.last_date) == tuple(want)


def test_bronze_is_sorted_in_tasks_of_bounded_size(spark, sf_small, tmp_path):
    """Rows that one task reads are sorted by several; each file is in order and no row is lost."""
    from kpiforge.sources.tables import load, write_bronze
    from kpiforge.sources.testdata import bronze_from_testdata

    bronze = bronze_from_testdata(spark, sf_small).drop("ingestion_time")
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "64k")
        write_bronze(bronze.coalesce(1), str(tmp_path), "bronze_orders_raw", ["order_id"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    stored = load(spark, str(tmp_path), "bronze_orders_raw")
    rows = stored.select("order_id", "_metadata.file_path", "_metadata.row_index").toPandas()
    assert rows.file_path.nunique() > 1
    for _, some in rows.sort_values("row_index").groupby("file_path"):
        assert some.order_id.is_monotonic_increasing
    assert stored.exceptAll(bronze).isEmpty() and bronze.exceptAll(stored).isEmpty()


def _stages(spark, run):
    """Stages of the longest job that ``run`` starts: one where nothing is shuffled."""
    group = f"stages-{id(run)}"
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(group)]
    assert jobs
    return max(len(j.stageIds) for j in jobs)


def test_stored_bronze_and_fact_are_written_without_a_shuffle(spark, sf_small, built, tmp_path):
    """The refresh sorts stored bronze as it reads it, and takes the fact's months from silver's files."""
    import glob

    import pyarrow.parquet as pq

    from kpiforge.operators.star import fact_sales
    from kpiforge.sources.tables import load, write_bronze, write_fact
    out, _ = built
    bronze, silver = bronze_from_testdata(spark, sf_small), load(spark, out, "silver_orders_clean")
    root = str(tmp_path)
    assert _stages(spark, lambda: write_bronze(bronze, root, "b", ["order_id"], stored=True)) == 1
    assert _stages(spark, lambda: write_fact(fact_sales(silver), root, "f", by_month=True)) == 1
    for name, rows in (("b", bronze), ("f", fact_sales(silver))):
        stored = load(spark, root, name).select(*rows.columns)
        assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()
    assert len(glob.glob(f"{root}/f/order_month=*")) == 80
    for f in glob.glob(f"{root}/f/order_month=*/*.parquet") + glob.glob(f"{root}/b/*.parquet"):
        table = pq.ParquetFile(f).read(columns=["order_date", "order_id"] if "/f/" in f else ["order_id"])
        keys = [tuple(r.values()) for r in table.to_pylist()]
        assert keys == sorted(keys), f


def test_stored_tables_are_zstd(built):
    import glob

    import pyarrow.parquet as pq
    out, _ = built
    for table in ("bronze_orders_raw", "silver_orders_clean", "fact_sales", "customer_rfm"):
        for f in glob.glob(f"{local_path(out)}/{table}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(f).metadata
            assert {meta.row_group(g).column(0).compression for g in range(meta.num_row_groups)} <= {"ZSTD"}, f


def test_scan_splits_only_go_down(spark):
    from kpiforge.session import scan_splits
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        for before, inside in (("128MB", "1000"), ("500b", "500")):
            spark.conf.set(key, before)
            with pytest.raises(ZeroDivisionError), scan_splits(spark, 1000):
                assert spark.conf.get(key) == inside
                1 / 0
            assert spark.conf.get(key) == before
    finally:
        spark.conf.set(key, old)


def test_marts_count_orders_without_dealing_the_lines_again(spark, built):
    """Lines dealt by order once: no mart of the refresh shuffles them by its group and order again."""
    import re

    from kpiforge.operators import marts as M
    from kpiforge.plans.pipeline import lines_by_order
    out, _ = built
    stored = Warehouse.from_tables(spark, out)
    lines = lines_by_order(stored.fact)
    try:
        held = Warehouse.from_tables(spark, out, fact=lines)
        for make in (M.daily_totals, M.kpi_daily_snapshot, M.channel_performance_summary, M.product_profitability_summary, M.customer_rfm):
            df = make(held.fact)
            rows = sorted(map(tuple, df.collect()), key=repr)
            assert rows == sorted(map(tuple, make(stored.fact).collect()), key=repr)
            plan = df._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
            assert not [e for e in re.findall(r"hashpartitioning\(([^)]*)\)", plan) if "order_id" in e], plan
    finally:
        lines.unpersist()


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_lines_of_an_order_are_landed_together(spark, sf_small, threshold):
    """Orders are the last join by which lines move, whether parts can be broadcast or not; the rows are the same."""
    import re

    from kpiforge.sources.testdata import _joined, mapped_columns
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, threshold)
        j = _joined(spark, sf_small)
        plan = j._jdf.queryExecution().optimizedPlan().toString()
        joins = [c for c in re.findall(r"Join Inner, \(([^)]*)\)", plan) if "l_orderkey" in c or "l_partkey" in c]
        assert ("l_partkey" if threshold == "10MB" else "l_orderkey") in joins[0], plan
        got = sorted(map(tuple, j.select(*(c.alias(n) for n, c in mapped_columns(j).items())).collect()))
    finally:
        spark.conf.set(key, old)
    want = sorted(map(tuple, bronze_from_testdata(spark, sf_small).drop("ingestion_time").collect()))
    assert got == want
