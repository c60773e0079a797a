"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the DataFrame code: the same rules expressed in SQL
over the driver tables (views ``lineitem orders customer part nation region``).
The shared starting point is the test-input mapping of FIXTURES.md section 3
(``BRONZE_SQL``); everything after it is plain SQL with DuckDB functions
(``regexp_full_match``, ``TRY_CAST``, ``md5``, struct ``min``).

Amounts are added as DECIMAL(38,6), a scale of the oracle's own (the amounts of the test input have 2 or 4
places; the engine adds at 16), so no row is rounded and neither side depends on the order of addition.
Canonicalisation shared with the Spark side: forecast level / sigma and unit price rounded to 4
places, integral sums of the auto-metric rule as DECIMAL(38,0).
"""

from __future__ import annotations

import re

BRONZE_SQL = """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE concat('ORD-', lpad(CAST(l_orderkey AS STRING), 7, '0')) END AS order_id,
 CASE WHEN l_orderkey % 83 = 0 THEN '13-45-22' WHEN l_orderkey % 89 = 0 THEN '2022-06-07' WHEN l_orderkey % 79 = 0 THEN '02-30-22'
  ELSE concat(lpad(CAST(month(o_orderdate) AS STRING),2,'0'),'-',lpad(CAST(day(o_orderdate) AS STRING),2,'0'),'-',substr(CAST(year(o_orderdate + INTERVAL '25' YEAR) AS STRING),3,2)) END AS order_date,
 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey AS STRING) END AS customer_id,
 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS customer_name,
 CASE WHEN l_partkey % 101 = 0 THEN '' ELSE concat('SKU-', CAST(l_partkey AS STRING)) END AS product_id,
 CASE WHEN l_partkey % 2 = 0 THEN '' ELSE p_name END AS product_name,
 CASE WHEN l_partkey % 53 = 0 THEN '' ELSE p_type END AS category, p_brand AS sub_category,
 CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS channel_name,
 CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 THEN '0' WHEN (l_orderkey + l_linenumber) % 37 = 0 THEN '2.0' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
 CASE (l_orderkey + l_partkey) % 71 WHEN 0 THEN '' WHEN 1 THEN '-5.00' WHEN 2 THEN 'nan' WHEN 3 THEN 'abc' WHEN 4 THEN '1d' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS revenue,
 CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS cost,
 CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS profit,
 CAST(CAST(l_discount AS DECIMAL(4,2)) AS STRING) AS discount,
 r_name AS country,
 split_part('MAHARASHTRA|Karnataka|Tamil Nadu|New Delhi|RJ|Rajshthan|Orissa|PB|Punjab/Mohali/Zirakpur|Pondicherry|NL|AR|Jammu & Kashmir|Goa|LADAKH||Atlantis|Kerala|Sikkim|Delhi|Gujarat|Bihar|Assam|Mizoram|Tripura','|',n_nationkey+1) AS state,
 concat(n_name,'-',c_mktsegment) AS city
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey JOIN part ON l_partkey=p_partkey
"""


def _int(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN coalesce(TRY_CAST({x} AS INTEGER), 0) ELSE 0 END)"


def _dbl(x: str) -> str:
    pat = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:nan|inf|infinity)"
    return f"(CASE WHEN regexp_full_match({x}, '{pat}') THEN coalesce(TRY_CAST({x} AS DOUBLE), 0.0) ELSE 0.0 END)"


def _unk(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 'Unknown' ELSE {x} END AS {x}"


_DATE = "TRY_CAST('20' || substr(order_date, 7, 2) || '-' || substr(order_date, 1, 2) || '-' || substr(order_date, 4, 2) AS DATE)"
_SHAPE = "regexp_full_match(order_date, '[0-9]{2}-[0-9]{2}-[0-9]{2}')"
_RANGE = ("coalesce(TRY_CAST(substr(order_date, 1, 2) AS INTEGER), 0) BETWEEN 1 AND 12 AND "
          "coalesce(TRY_CAST(substr(order_date, 4, 2) AS INTEGER), 0) BETWEEN 1 AND 31")

SILVER_SQL = f"""
SELECT order_id, {_DATE} AS order_date,
  {_unk('customer_id')}, {_unk('customer_name')}, {_unk('product_id')},
  CASE WHEN product_name = '' THEN product_id ELSE product_name END AS product_name,
  {_unk('category')}, {_unk('sub_category')}, {_unk('channel_name')},
  {_int('quantity')} AS quantity, {_dbl('revenue')} AS revenue, {_dbl('cost')} AS cost,
  {_dbl('profit')} AS profit, {_dbl('discount')} AS discount,
  {_unk('country')}, {_unk('state')}, {_unk('city')}
FROM bronze
WHERE order_id <> '' AND product_id <> '' AND {_SHAPE} AND {_RANGE} AND {_DATE} IS NOT NULL
  AND {_int('quantity')} > 0 AND {_dbl('revenue')} >= 0 AND NOT isnan({_dbl('revenue')})
"""

_CH = "('0x' || substr(md5(channel_name), 1, 15))::BIGINT"

# --- FIXED VALUES: state spellings and their ISO 3166-2 codes (the oracle's own copy) ---
_ISO_VALUES = """
    ('MAHARASHTRA', 'IN-MH'), ('KARNATAKA', 'IN-KA'), ('TAMIL NADU', 'IN-TN'), ('TELANGANA', 'IN-TG'),
    ('UTTAR PRADESH', 'IN-UP'), ('DELHI', 'IN-DL'), ('NEW DELHI', 'IN-DL'), ('KERALA', 'IN-KL'),
    ('WEST BENGAL', 'IN-WB'), ('ANDHRA PRADESH', 'IN-AP'), ('GUJARAT', 'IN-GJ'), ('HARYANA', 'IN-HR'),
    ('RAJASTHAN', 'IN-RJ'), ('RJ', 'IN-RJ'), ('RAJSHTHAN', 'IN-RJ'), ('RAJSTHAN', 'IN-RJ'),
    ('MADHYA PRADESH', 'IN-MP'), ('ODISHA', 'IN-OR'), ('ORISSA', 'IN-OR'), ('BIHAR', 'IN-BR'), ('PUNJAB', 'IN-PB'),
    ('PB', 'IN-PB'), ('PUNJAB/MOHALI/ZIRAKPUR', 'IN-PB'), ('ASSAM', 'IN-AS'), ('UTTARAKHAND', 'IN-UT'),
    ('JHARKHAND', 'IN-JH'), ('GOA', 'IN-GA'), ('CHHATTISGARH', 'IN-CT'), ('HIMACHAL PRADESH', 'IN-HP'),
    ('JAMMU & KASHMIR', 'IN-JK'), ('PUDUCHERRY', 'IN-PY'), ('PONDICHERRY', 'IN-PY'), ('CHANDIGARH', 'IN-CH'),
    ('MANIPUR', 'IN-MN'), ('ANDAMAN & NICOBAR', 'IN-AN'), ('MEGHALAYA', 'IN-ML'), ('SIKKIM', 'IN-SK'),
    ('NAGALAND', 'IN-NL'), ('NL', 'IN-NL'), ('TRIPURA', 'IN-TR'), ('ARUNACHAL PRADESH', 'IN-AR'), ('AR', 'IN-AR'),
    ('MIZORAM', 'IN-MZ'), ('DADRA AND NAGAR', 'IN-DN'), ('LADAKH', 'IN-LA'), ('LAKSHADWEEP', 'IN-LD')
"""

_MEASURES = {
    "revenue": "@sum(revenue) AS total_revenue",
    "profit": "@sum(profit) AS total_profit",
    "quantity": "CAST(sum(quantity) AS BIGINT) AS total_quantity",
    "orders": "count(DISTINCT order_id) AS total_orders",
}
# totals per label: name, what a group is, measures, and which rows
_LABEL_TOTALS = [
    ("channel_monthly_summary", "order_month AS snapshot_month, channel_name", ("revenue", "orders"), ""),
    ("geographic_performance_summary", "state, city", ("revenue", "profit", "orders"), "WHERE state <> 'Unknown'"),
    ("vw_revenue_by_category", "order_date, category", ("revenue", "quantity"), ""),
    ("vw_revenue_by_sub_category", "order_date, sub_category", ("revenue", "quantity"), ""),
    ("vw_top_products_by_revenue", "order_date, product_name, category", ("revenue", "quantity", "orders"), ""),
    ("vw_channel_performance", "order_date, channel_name, channel_type", ("revenue", "orders"), ""),
]

CTES = {
    "bronze": BRONZE_SQL,
    "silver": SILVER_SQL,
    "fact": f"""SELECT order_id, order_date, customer_id, product_id, {_CH} AS channel_id,
        quantity, revenue, cost, profit, discount FROM silver""",
    "dim_customer": """SELECT customer_id, a['customer_name'] AS customer_name, 'Unknown' AS customer_segment,
        a['country'] AS country, a['state'] AS state, a['city'] AS city
      FROM (SELECT customer_id, min({'customer_name': customer_name, 'country': country, 'state': state, 'city': city}) AS a
            FROM silver WHERE customer_id IS NOT NULL GROUP BY customer_id)""",
    "dim_product": """SELECT product_id, a['product_name'] AS product_name, a['category'] AS category,
        a['sub_category'] AS sub_category, unit_price
      FROM (SELECT product_id, min({'product_name': product_name, 'category': category, 'sub_category': sub_category}) AS a,
                   floor(avg(CASE WHEN quantity > 0 THEN revenue / quantity END) * 10000.0 + 0.5) / 10000.0 AS unit_price
            FROM silver WHERE product_id IS NOT NULL GROUP BY product_id)""",
    "dim_channel": f"""SELECT {_CH} AS channel_id, channel_name, 'E-Commerce Channel' AS channel_type
      FROM (SELECT DISTINCT channel_name FROM silver)""",
    "dim_time": """SELECT date, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
        strftime(date, '%B') AS month_name, 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter,
        CAST(year(date) AS INTEGER) AS year
      FROM (SELECT DISTINCT order_date AS date FROM silver)""",
    "iso": f"SELECT * FROM (VALUES {_ISO_VALUES}) AS t(name, code)",
    "sales_forecast_ready": """SELECT order_date AS sales_date, @sum(revenue) AS total_revenue,
        @sum(profit) AS total_profit, count(DISTINCT order_id) AS total_orders,
        CAST(sum(quantity) AS BIGINT) AS total_quantity
      FROM fact GROUP BY order_date""",
    "kpi_daily_snapshot": """SELECT snapshot_date, revenue, orders, quantity,
        CASE WHEN orders = 0 THEN 0.0 ELSE revenue / orders END AS aov
      FROM (SELECT order_date AS snapshot_date, @sum(revenue) AS revenue,
                   count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity
            FROM fact GROUP BY order_date)""",
    "customer_rfm": """SELECT pseudo_customer_id, recency, frequency, monetary,
        CASE WHEN recency <= 30 AND frequency >= 3 AND monetary >= 500 THEN 'Champions'
             WHEN recency <= 60 AND frequency >= 2 THEN 'Loyal'
             WHEN recency > 90 AND monetary >= 200 THEN 'At Risk'
             WHEN recency > 120 THEN 'Hibernating'
             ELSE 'Regular' END AS segment_name
      FROM (SELECT CASE WHEN customer_id = 'Unknown' THEN right(order_id, 4) ELSE customer_id END AS pseudo_customer_id,
                   date_diff('day', max(order_date), (SELECT max(order_date) FROM fact)) AS recency,
                   count(DISTINCT order_id) AS frequency, @sum(revenue) AS monetary
            FROM fact GROUP BY 1)""",
    "channel_performance_summary": """SELECT channel_id, total_revenue, total_profit, total_orders,
        CASE WHEN total_revenue = 0 THEN 0.0 ELSE total_profit / total_revenue END AS profit_margin
      FROM (SELECT channel_id, @sum(revenue) AS total_revenue, @sum(profit) AS total_profit,
                   count(DISTINCT order_id) AS total_orders FROM fact GROUP BY channel_id)""",
    "product_profitability_summary": """SELECT product_id, total_revenue, total_profit, total_quantity, total_orders,
        CASE WHEN total_revenue = 0 THEN 0.0 ELSE total_profit / total_revenue END AS profit_margin
      FROM (SELECT product_id, @sum(revenue) AS total_revenue, @sum(profit) AS total_profit,
                   CAST(sum(quantity) AS BIGINT) AS total_quantity, count(DISTINCT order_id) AS total_orders
            FROM fact GROUP BY product_id)""",
    "geographic_daily_summary": """SELECT g.order_date, coalesce(iso.code, 'UNKNOWN') AS iso_code, g.state,
        g.total_revenue, g.total_orders
      FROM (SELECT order_date, state, @sum(revenue) AS total_revenue, count(DISTINCT order_id) AS total_orders
            FROM silver WHERE state <> 'Unknown' AND state <> '' GROUP BY order_date, state) g
      LEFT JOIN iso ON upper(g.state) = iso.name""",
    # sales lines with the labels of their product, channel and customer
    "labelled": """SELECT order_id, order_date, CAST(date_trunc('month', order_date) AS DATE) AS order_month, revenue, profit, quantity,
        ifnull(product_name, 'Unknown') AS product_name, ifnull(category, 'Unknown') AS category,
        ifnull(sub_category, 'Unknown') AS sub_category, ifnull(channel_name, 'Unknown') AS channel_name,
        ifnull(channel_type, 'Unknown') AS channel_type, state, city
      FROM fact LEFT JOIN dim_product USING (product_id) LEFT JOIN dim_channel USING (channel_id)
        LEFT JOIN dim_customer USING (customer_id)""",
    **{name: f"SELECT {keys}, {', '.join(_MEASURES[m] for m in measures)} FROM labelled {rows} GROUP BY ALL"
       for name, keys, measures, rows in _LABEL_TOTALS},
    "vw_customer_segment_distribution": """SELECT segment_name, count(*) AS customers,
        @sum(monetary) AS total_monetary FROM customer_rfm GROUP BY segment_name""",
    "vw_top_states_revenue": """SELECT order_date, state, @sum(revenue) AS total_revenue,
        count(DISTINCT order_id) AS total_orders
      FROM silver WHERE state <> 'Unknown' AND state <> '' GROUP BY order_date, state""",
    # every KPI of every period, by day and by month, in one long table
    "kpi_values": """SELECT grain, bucket, kpi, value FROM (
        SELECT grain, bucket, @sum(revenue) AS "Revenue",
               CAST(count(DISTINCT order_id) AS DOUBLE) AS "Orders", CAST(sum(quantity) AS DOUBLE) AS "Quantity",
               @sum(revenue) / count(DISTINCT order_id) AS "AOV"
        FROM (SELECT unnest(['day', 'month']) AS grain, unnest([order_date, CAST(date_trunc('month', order_date) AS DATE)]) AS bucket,
                     revenue, order_id, quantity FROM fact) GROUP BY grain, bucket)
      UNPIVOT (value FOR kpi IN ("Revenue", "Orders", "Quantity", "AOV"))""",
    # each value beside the one of the calendar period before
    "kpi_changes": """SELECT n.grain, n.bucket, n.kpi AS kpi_name, n.value AS current_value, b.value AS previous_value,
        n.value - ifnull(b.value, 0.0) AS delta_value,
        (n.value - b.value) / nullif(b.value, 0.0) AS delta_pct
      FROM kpi_values n LEFT JOIN kpi_values b
        ON b.grain = n.grain AND b.kpi = n.kpi
       AND n.bucket = CAST(CASE n.grain WHEN 'day' THEN b.bucket + INTERVAL 1 DAY ELSE b.bucket + INTERVAL 1 MONTH END AS DATE)""",
    "vw_kpi_monthly_status": """SELECT bucket AS snapshot_month, kpi_name, current_value, previous_value, delta_value, delta_pct,
        CASE WHEN previous_value IS NULL THEN 'No Baseline' WHEN current_value < previous_value THEN 'Down' ELSE 'Up' END AS trend_direction,
        CASE WHEN previous_value IS NULL THEN 'No Baseline' WHEN current_value < previous_value THEN 'Below Minimum'
             ELSE 'Meets Minimum' END AS minimum_status
      FROM kpi_changes WHERE grain = 'month'""",
    "vw_kpi_daily_comparison": """SELECT bucket AS snapshot_date, kpi_name, current_value, previous_value, delta_value, delta_pct
      FROM kpi_changes WHERE grain = 'day'""",
    # both metrics by day in one long table; newest = 1 for the latest day
    "daily_metric": """SELECT metric_name, sales_date, value, row_number() OVER (PARTITION BY metric_name ORDER BY sales_date DESC) AS newest
      FROM (SELECT sales_date, CAST(total_revenue AS DOUBLE) AS "Revenue", CAST(total_orders AS DOUBLE) AS "Orders" FROM sales_forecast_ready)
      UNPIVOT (value FOR metric_name IN ("Revenue", "Orders"))""",
    "metric_outlook": """SELECT metric_name, max(sales_date) AS last_day,
        floor(avg(value) FILTER (WHERE newest <= 7) * 10000.0 + 0.5) / 10000.0 AS mid,
        floor(coalesce(stddev_pop(value), 0) * 10000.0 + 0.5) / 10000.0 AS spread
      FROM daily_metric GROUP BY metric_name""",
    "sales_forecast_result": """SELECT sales_date, metric_name, value AS actual_value, NULL::DOUBLE AS forecast_value,
        NULL::DOUBLE AS lower_bound, NULL::DOUBLE AS upper_bound, 'actual_history' AS model_name FROM daily_metric
      UNION ALL
      SELECT CAST(last_day + CAST(ahead AS INTEGER) AS DATE), metric_name, NULL, mid,
             CASE WHEN mid > spread THEN mid - spread ELSE 0.0 END, mid + spread, 'moving_average_7d'
      FROM metric_outlook, (SELECT unnest(range(1, 31)) AS ahead)""",
    "latest_month": """SELECT CAST(date_trunc('month', max(order_date)) AS DATE) AS lo,
        CAST(date_trunc('month', max(order_date)) + INTERVAL 1 MONTH AS DATE) AS hi FROM fact""",
}

_REJECT = f"""CASE WHEN NOT (order_id <> '') THEN 'empty_order_id'
  WHEN NOT (product_id <> '') THEN 'empty_product_id'
  WHEN NOT {_SHAPE} THEN 'bad_date_format'
  WHEN NOT ({_RANGE} AND {_DATE} IS NOT NULL) THEN 'invalid_date'
  WHEN NOT ({_int('quantity')} > 0) THEN 'bad_quantity'
  WHEN NOT ({_dbl('revenue')} >= 0 AND NOT isnan({_dbl('revenue')})) THEN 'bad_revenue' END"""

_FACT_COLS = "order_id, order_date, customer_id, product_id, channel_id, quantity, revenue, cost, profit, discount"
_DEC = "DECIMAL(38,0)"

_BRONZE_COLS = ["order_id", "order_date", "customer_id", "customer_name", "product_id", "product_name", "category", "sub_category",
                "channel_name", "quantity", "revenue", "cost", "profit", "discount", "country", "state", "city"]
_STORED = {"bronze_orders_raw": "bronze", "silver_orders_clean": "silver", "fact_sales": "fact", **{t: t for t in (
    "dim_customer", "dim_product", "dim_channel", "dim_time", "customer_rfm", "channel_performance_summary",
    "product_profitability_summary", "sales_forecast_ready", "kpi_daily_snapshot", "geographic_daily_summary",
    "channel_monthly_summary", "geographic_performance_summary", "sales_forecast_result")}}


def _rows_of_tables(more: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{name}' AS table_name, count(*) AS "rows"{more} FROM {cte}""" for name, cte in _STORED.items())


FINAL = {
    "bronze_orders": "SELECT * FROM bronze",
    "bronze_table_mode": f"""SELECT {', '.join("CASE WHEN l_partkey % 7 = 3 THEN '' ELSE product_id END AS product_id" if c == "product_id"
        else c for c in _BRONZE_COLS)} FROM ({BRONZE_SQL.replace("SELECT CASE", "SELECT l_partkey, CASE", 1)})""",
    "csv_scan": "SELECT * FROM bronze",
    "csv_encodings": "SELECT * REPLACE (replace(city, 'E', '\u00c9') AS city) FROM bronze",
    "append_once": "SELECT * REPLACE (replace(city, 'E', '\u00c9') AS city) FROM bronze",
    "silver_orders": "SELECT * FROM silver",
    "silver_reject_reasons": f'SELECT reason, count(*) AS "rows" FROM (SELECT {_REJECT} AS reason FROM bronze) WHERE reason IS NOT NULL GROUP BY reason',
    "fact_sales": "SELECT * FROM fact",
    "fact_partition_scan": f"""SELECT {_FACT_COLS}, CAST(strftime(order_date, '%Y%m') AS INTEGER) AS order_month
        FROM fact, latest_month WHERE order_date >= lo AND order_date < hi""",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": "SELECT * FROM dim_product",
    "dim_channel": "SELECT * FROM dim_channel",
    "dim_time": "SELECT * FROM dim_time",
    "customer_rfm": "SELECT * FROM customer_rfm",
    "channel_performance_summary": "SELECT * FROM channel_performance_summary",
    "product_profitability_summary": "SELECT * FROM product_profitability_summary",
    "sales_forecast_ready": "SELECT * FROM sales_forecast_ready",
    "kpi_daily_snapshot": "SELECT * FROM kpi_daily_snapshot",
    "geographic_daily_summary": "SELECT * FROM geographic_daily_summary",
    "iso_state_code": """SELECT s.state, coalesce(iso.code, 'UNKNOWN') AS iso_code
        FROM (SELECT DISTINCT state FROM silver) s LEFT JOIN iso ON upper(s.state) = iso.name""",
    "channel_monthly_summary": "SELECT * FROM channel_monthly_summary",
    "geographic_performance_summary": "SELECT * FROM geographic_performance_summary",
    "sales_forecast_result": "SELECT * FROM sales_forecast_result",
    "data_quality_checks": """
        SELECT 'bronze_rows' AS check_name, count(*) AS value FROM bronze
        UNION ALL SELECT 'silver_rows', count(*) FROM silver
        UNION ALL SELECT 'fact_sales_rows', count(*) FROM fact
        UNION ALL SELECT 'null_order_id_in_silver', count(*) FROM silver WHERE order_id IS NULL OR order_id = ''
        UNION ALL SELECT 'invalid_quantity_in_silver', count(*) FROM silver WHERE quantity <= 0
        UNION ALL SELECT 'negative_revenue_in_silver', count(*) FROM silver WHERE revenue < 0""",
    "dq_forecast_rows": """SELECT metric_name, count(*) AS "rows", count(forecast_value) AS forecast_rows
        FROM sales_forecast_result GROUP BY metric_name""",
    "table_rows": _rows_of_tables(""),
    "file_order": _rows_of_tables(", CAST(0 AS BIGINT) AS out_of_order"),
    "metrics_products_auto": f"""SELECT count(*) AS count, @sum(total_revenue) AS total_revenue, @sum(total_profit) AS total_profit,
        CAST(sum(total_quantity) AS {_DEC}) AS total_quantity, CAST(sum(total_orders) AS {_DEC}) AS total_orders,
        floor(fsum(profit_margin) * 1000000.0 + 0.5) / 1000000.0 AS profit_margin FROM product_profitability_summary""",
    "dq_state_count": "SELECT count(DISTINCT state) AS total_states FROM geographic_daily_summary",
    "metrics_fact_sales_auto": f"""SELECT count(*) AS count, CAST(sum(channel_id) AS {_DEC}) AS channel_id,
        CAST(sum(quantity) AS {_DEC}) AS quantity, @sum(revenue) AS revenue, @sum(cost) AS cost,
        @sum(profit) AS profit, @sum(discount) AS discount,
        count(DISTINCT order_id) AS total_orders FROM fact""",
    "metrics_fact_sales": """SELECT @sum(revenue) AS total_revenue, @sum(profit) AS total_profit,
        CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, count(DISTINCT order_id) AS total_orders,
        CASE WHEN count(DISTINCT order_id) = 0 THEN 0.0 ELSE @sum(revenue) / count(DISTINCT order_id) END AS average_order_value
        FROM fact""",
    "metrics_kpi_daily": """SELECT @sum(revenue) AS total_revenue, CAST(sum(orders) AS BIGINT) AS total_orders,
        CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, floor(avg(aov) * 10000.0 + 0.5) / 10000.0 AS average_order_value
        FROM kpi_daily_snapshot""",
    "metrics_forecast": """SELECT @sum(actual_value) AS actual_value, @sum(forecast_value) AS forecast_value,
        @sum(lower_bound) AS lower_bound, @sum(upper_bound) AS upper_bound
        FROM sales_forecast_result""",
    "latest_month_filter": """SELECT k.* FROM kpi_daily_snapshot k, latest_month
        WHERE k.snapshot_date >= lo AND k.snapshot_date < hi""",
    "month_filter_fact": f"SELECT {_FACT_COLS} FROM fact, latest_month WHERE order_date >= lo AND order_date < hi",
    "month_filter_silver": "SELECT s.* FROM silver s, latest_month WHERE order_date >= lo AND order_date < hi",
    "month_filter_forecast": "SELECT r.* FROM sales_forecast_result r, latest_month WHERE sales_date >= lo AND sales_date < hi",
    "month_filter_channel_monthly": "SELECT c.* FROM channel_monthly_summary c, latest_month WHERE snapshot_month >= lo AND snapshot_month < hi",
    "month_filter_channel_view": "SELECT v.* FROM vw_channel_performance v, latest_month WHERE order_date >= lo AND order_date < hi",
    "month_filter_kpi_status": "SELECT v.* FROM vw_kpi_monthly_status v, latest_month WHERE snapshot_month >= lo AND snapshot_month < hi",
    "month_filter_kpi_daily": "SELECT v.* FROM vw_kpi_daily_comparison v, latest_month WHERE snapshot_date >= lo AND snapshot_date < hi",
    "kpi_latest_days": "SELECT * FROM kpi_daily_snapshot ORDER BY snapshot_date DESC LIMIT 10",
    "top_products_profitability": """SELECT * FROM product_profitability_summary
        ORDER BY total_revenue DESC, product_id LIMIT 10""",
    "vw_revenue_by_category": "SELECT * FROM vw_revenue_by_category ORDER BY total_revenue DESC",
    "vw_revenue_by_sub_category": "SELECT * FROM vw_revenue_by_sub_category ORDER BY total_revenue DESC",
    "vw_top_products_by_revenue": "SELECT * FROM vw_top_products_by_revenue ORDER BY total_revenue DESC",
    "vw_channel_performance": "SELECT * FROM vw_channel_performance ORDER BY total_revenue DESC",
    "vw_customer_segment_distribution": "SELECT * FROM vw_customer_segment_distribution ORDER BY customers DESC",
    "vw_geographic_performance": "SELECT * FROM geographic_daily_summary ORDER BY total_revenue DESC",
    "vw_kpi_monthly_status": "SELECT * FROM vw_kpi_monthly_status",
    "vw_kpi_daily_comparison": "SELECT * FROM vw_kpi_daily_comparison",
    "vw_monthly_channel_revenue": "SELECT * FROM channel_monthly_summary ORDER BY snapshot_month, total_revenue DESC",
    "vw_top_states_revenue": "SELECT * FROM vw_top_states_revenue ORDER BY total_revenue DESC",
    "chart_kpi_totals": """SELECT @sum(revenue) AS total_revenue, CAST(sum(orders) AS BIGINT) AS total_orders,
        CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, floor(avg(aov) * 10000.0 + 0.5) / 10000.0 AS average_order_value
        FROM kpi_daily_snapshot""",
    "chart_mini_trends": """SELECT snapshot_date, @sum(revenue) AS total_revenue, CAST(sum(orders) AS BIGINT) AS total_orders,
        CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, floor(avg(aov) * 10000.0 + 0.5) / 10000.0 AS average_order_value
        FROM kpi_daily_snapshot GROUP BY snapshot_date ORDER BY snapshot_date""",
    "chart_kpi_status": """SELECT kpi_name, current_value, previous_value, delta_value, delta_pct, trend_direction, minimum_status
        FROM vw_kpi_monthly_status""",
    "chart_forecast_ready": f"""SELECT CAST(date_trunc('month', sales_date) AS DATE) AS sales_date,
        @sum(total_revenue) AS total_revenue, CAST(sum(total_orders) AS {_DEC}) AS total_orders
        FROM sales_forecast_ready GROUP BY 1 ORDER BY 1""",
    "chart_revenue_forecast": """SELECT sales_date, @sum(actual_value) AS actual_value,
        @sum(forecast_value) AS forecast_value
        FROM sales_forecast_result WHERE metric_name = 'Revenue' GROUP BY sales_date ORDER BY sales_date""",
    "chart_daily_trends": f"""SELECT sales_date, @sum(total_revenue) AS total_revenue,
        CAST(sum(total_orders) AS {_DEC}) AS total_orders, CAST(sum(total_quantity) AS {_DEC}) AS total_quantity
        FROM sales_forecast_ready GROUP BY sales_date ORDER BY sales_date""",
    "chart_category": """SELECT category, @sum(total_revenue) AS total_revenue
        FROM vw_revenue_by_category GROUP BY category ORDER BY total_revenue DESC, category""",
    "chart_sub_category": """SELECT sub_category, @sum(total_revenue) AS total_revenue
        FROM vw_revenue_by_sub_category GROUP BY sub_category ORDER BY total_revenue DESC, sub_category""",
    "chart_monthly_channel": """SELECT CAST(date_trunc('month', snapshot_month) AS DATE) AS snapshot_month, channel_name,
        @sum(total_revenue) AS total_revenue FROM channel_monthly_summary GROUP BY 1, 2
        ORDER BY total_revenue DESC, snapshot_month, channel_name""",
    "chart_top_products": f"""SELECT product_name, category, @sum(total_revenue) AS total_revenue,
        CAST(sum(total_quantity) AS {_DEC}) AS total_quantity, CAST(sum(total_orders) AS {_DEC}) AS total_orders
        FROM vw_top_products_by_revenue GROUP BY product_name, category
        ORDER BY total_revenue DESC, product_name, category""",
    "chart_channels": f"""SELECT channel_name, channel_type, @sum(total_revenue) AS total_revenue,
        CAST(sum(total_orders) AS {_DEC}) AS total_orders FROM vw_channel_performance
        GROUP BY channel_name, channel_type ORDER BY total_revenue DESC, channel_name, channel_type""",
    "chart_top_states": f"""SELECT state, @sum(total_revenue) AS total_revenue,
        CAST(sum(total_orders) AS {_DEC}) AS total_orders FROM vw_top_states_revenue
        GROUP BY state ORDER BY total_revenue DESC, state""",
    "chart_segments": f"""SELECT segment_name, CAST(sum(customers) AS {_DEC}) AS customers
        FROM vw_customer_segment_distribution GROUP BY segment_name ORDER BY customers DESC, segment_name""",
    "chart_geo_map": """SELECT iso_code, @sum(total_revenue) AS total_revenue
        FROM geographic_daily_summary GROUP BY iso_code""",
}


def _amounts(sql: str) -> str:
    """``@sum(x)``: the sum of amounts, as a double."""
    return re.sub(r"@sum\(([^()]+)\)", r"CAST(sum(CAST(\1 AS DECIMAL(38,6))) AS DOUBLE)", sql)


def _with(final: str) -> str:
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())
    return _amounts(f"WITH {ctes}\n{final}")


def oracle_sql() -> dict[str, str]:
    return {k: _with(v) for k, v in FINAL.items()}
