"""Driver tables -> raw orders source (test-input definition).

The driver ships clean TPC-H-style tables.  This module turns them into what
the warehouse ingests: a loosely named, all-string orders feed with
deterministic dirt that exercises every cleaning rule (empty ids, bad dates,
impossible dates, '2.0' / 'nan' / '1d' numbers, unknown customers, states that
are misspelt or missing).  The values follow the shared mapping of FIXTURES.md
section 3 so the DuckDB oracle can rebuild the same bronze rows from SQL.

On top of that mapping the raw frame uses source-style headers (``Order ID``,
``SKU`` + ``ASIN`` with gaps, ``ship-state`` ...) and pads some cells with
tabs / no-break spaces, so header normalisation, per-row candidate fallback and
whitespace stripping are exercised by every query that starts from it.

Joins: orders are enriched with the customer first, then joined to line
items and parts, and nation / region last, so the line-item-sized data is shuffled
twice; strategies are left to Spark (sort-merge, or broadcast when AQE
measures a side under the threshold).

``land_bronze`` runs this once per application and stores the bronze table
under ``spark.checkpoint.dir``; every registered query starts from that
stored table, as the warehouse's own queries start from its loaded bronze.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.functions.expr import mmddyy_date
from kpiforge.operators.silver import is_valid
from kpiforge.session import conf_bytes, scratch_path
from kpiforge.sources.csv_ingest import normalize_columns, to_bronze
from kpiforge.sources.tables import file_rows, load, write_table

# Test-input constants of the shared mapping (FIXTURES.md section 3).
STATES = [
    "MAHARASHTRA", "Karnataka", "Tamil Nadu", "New Delhi", "RJ", "Rajshthan", "Orissa", "PB",
    "Punjab/Mohali/Zirakpur", "Pondicherry", "NL", "AR", "Jammu & Kashmir", "Goa", "LADAKH", "", "Atlantis",
    "Kerala", "Sikkim", "Delhi", "Gujarat", "Bihar", "Assam", "Mizoram", "Tripura",
]
NOT_SPECIFIED_PRIORITY = "4-NOT SPECIFIED"
SOURCE_TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    od = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_nationkey", "n_name", "n_regionkey")
    rg = read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name")
    pa = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_retailprice")
    # orders are enriched with the customer first (an orders-sized join), so the
    # lineitem-sized data is shuffled twice (part key, order key) instead of three
    # times.  Orders are joined last, so that the lines of an order come together and
    # compress, in what is stored and in later shuffles; what can be broadcast moves
    # no lines and is joined after them, so that its columns are not shuffled
    orders = od.join(cu, "o_custkey")
    if _fits_broadcast(spark, sf_dir, "part"):
        lines = li.join(orders, "l_orderkey").join(pa, "l_partkey")
    else:
        lines = li.join(pa, "l_partkey").join(orders, "l_orderkey")
    # a handful of rows by nature; by their keys, lines would go to a handful of tasks
    return lines.join(F.broadcast(na.join(rg, "n_regionkey")), "c_nationkey")


def _fits_broadcast(spark: SparkSession, sf_dir: str, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return size <= conf_bytes(spark, "spark.sql.autoBroadcastJoinThreshold")


def mapped_columns(j: DataFrame) -> dict[str, Column]:
    """The FIXTURES.md section 3 mapping, column by column (bronze names)."""
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    od = F.col("o_orderdate")
    unknown_customer = F.col("c_custkey") % 3 == 0
    price = _money(F.col("l_extendedprice"))
    regular_date = F.concat_ws(
        "-", F.lpad(_s(F.month(od)), 2, "0"), F.lpad(_s(F.dayofmonth(od)), 2, "0"),
        F.substring(_s(F.year(od) + 25), 3, 2))
    qk = (ok + ln)
    rk = (ok + pk) % 71
    return {
        "order_id": F.when(ok % 97 == 0, "").otherwise(F.concat(F.lit("ORD-"), F.lpad(_s(ok), 7, "0"))),
        "order_date": F.when(ok % 83 == 0, "13-45-22").when(ok % 89 == 0, "2022-06-07")
        .when(ok % 79 == 0, "02-30-22").otherwise(regular_date),
        "customer_id": F.when(unknown_customer, "").otherwise(_s(F.col("c_custkey"))),
        "customer_name": F.when(unknown_customer, "").otherwise(F.col("c_name")),
        "product_id": F.when(pk % 101 == 0, "").otherwise(F.concat(F.lit("SKU-"), _s(pk))),
        "product_name": F.when(pk % 2 == 0, "").otherwise(F.col("p_name")),
        "category": F.when(pk % 53 == 0, "").otherwise(F.col("p_type")),
        "sub_category": F.col("p_brand"),
        "channel_name": F.when(F.col("o_orderpriority") == NOT_SPECIFIED_PRIORITY, "")
        .otherwise(F.col("o_orderpriority")),
        "quantity": F.when(qk % 10 == 0, "0").when(qk % 37 == 0, "2.0")
        .otherwise(_s(F.col("l_quantity").cast("int"))),
        "revenue": F.when(rk == 0, "").when(rk == 1, "-5.00").when(rk == 2, "nan")
        .when(rk == 3, "abc").when(rk == 4, "1d").otherwise(_s(price)),
        "cost": _s(_money(F.col("p_retailprice"))),
        "profit": _s(price - _money(F.col("p_retailprice"))),
        "discount": _s(F.col("l_discount").cast("decimal(4,2)")),
        "country": F.col("r_name"),
        "state": F.get(F.array(*[F.lit(s) for s in STATES]), F.col("n_nationkey").cast("int")),
        "city": F.concat(F.col("n_name"), F.lit("-"), F.col("c_mktsegment")),
    }


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw orders feed with source-style headers (before normalisation)."""
    j = _joined(spark, sf_dir)
    m = mapped_columns(j)
    pk = F.col("l_partkey")
    padded = F.col("c_custkey") % 7 == 1
    # product id arrives split over SKU and ASIN; SKU is empty on some rows
    sku = F.when(pk % 7 == 3, "").otherwise(m["product_id"])
    asin = F.when((pk % 7 == 3) | (pk % 2 == 0), m["product_id"]).otherwise("")
    return j.select(
        m["order_id"].alias("Order ID"),
        m["order_date"].alias("Date"),
        m["customer_id"].alias("Buyer-ID"),
        F.when(padded, F.concat(F.lit("\t\u00a0"), m["customer_name"], F.lit(" "))).otherwise(
            m["customer_name"]).alias("Customer Name"),
        sku.alias("SKU"),
        m["product_name"].alias("Item Name"),
        m["category"].alias("Category"),
        m["sub_category"].alias("Sub-Category"),
        m["channel_name"].alias("Sales Channel "),
        m["quantity"].alias("Qty"),
        m["revenue"].alias("Amount"),
        m["cost"].alias("COGS"),
        m["profit"].alias("Gross Profit"),
        m["discount"].alias("Discount"),
        m["country"].alias("ship-country"),
        m["state"].alias("ship-state"),
        m["city"].alias("ship-city"),
        asin.alias("ASIN"),
    )


BRONZE_TABLE = "bronze_orders_raw"
# landing folders written in this application, keyed by source signature
_LANDED: dict[tuple, str] = {}


def source_signature(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the source files, as the store that holds them reports (any Hadoop path)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for name in SOURCE_TABLES:
        path = hadoop.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        path = fs.makeQualified(path)
        parts = sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
        files.append((str(path), tuple(parts)))
    return (spark.sparkContext.applicationId, tuple(files))


def land_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Load the raw feed into a bronze table once per application, in the
    shared checkpoint folder, and return its warehouse root.

    This is the warehouse's own first step (raw file -> stored bronze table);
    every query then starts from the stored bronze: short lineage that
    survives lost executors, and plans that start from plain columns instead
    of the whole source mapping inlined into every predicate.  Files are bounded by rows (the line items are
    counted from their footers), so few writers do not mean few readers; the first and last order date
    are kept beside the table."""
    key = source_signature(spark, sf_dir)
    root = _LANDED.get(key)
    if root is None:
        root = scratch_path(spark, "landing")
        bronze = to_bronze(normalize_columns(raw_orders(spark, sf_dir)), mode="row")
        date = F.when(is_valid(), mmddyy_date("order_date"))
        write_table(bronze, root, BRONZE_TABLE, rows_per_file=file_rows(spark, read_table(spark, sf_dir, "lineitem").count()),
                    stats={"first_date": F.min(date), "last_date": F.max(date)})
        _LANDED[key] = root
    return root


def bronze_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bronze table of the driver tables (see ``land_bronze``)."""
    return load(spark, land_bronze(spark, sf_dir), BRONZE_TABLE)
