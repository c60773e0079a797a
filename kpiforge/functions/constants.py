"""Fixed values that must equal the warehouse's published rules.

Everything in this module is data, not logic: header aliases of the raw
orders file, the state-name -> ISO 3166-2 code table, RFM thresholds and
the labels the marts emit.  They are kept together, in their natural order,
so a reader can check them against the specification in one place.
"""

from __future__ import annotations

# --- FIXED VALUES: bronze column -> raw header candidates (tried in order) ---
BRONZE_CANDIDATES: dict[str, list[str]] = {
    "order_id": ["order_id", "orderid", "amazon_order_id", "order"],
    "order_date": ["order_date", "date", "order_date_time", "ship_date"],
    "customer_id": ["customer_id", "buyer_id", "customer"],
    "customer_name": ["customer_name", "buyer_name", "name"],
    "product_id": ["product_id", "sku", "style", "asin"],
    "product_name": ["product_name", "item_name", "product"],
    "category": ["category", "product_category"],
    "sub_category": ["sub_category", "subcategory", "size"],
    "channel_name": ["channel", "sales_channel", "platform", "fulfilled_by"],
    "quantity": ["quantity", "qty"],
    "revenue": ["revenue", "sales", "amount", "total_amount"],
    "cost": ["cost", "cogs", "expense"],
    "profit": ["profit", "gross_profit"],
    "discount": ["discount", "discount_rate"],
    "country": ["country", "ship_country"],
    "state": ["state", "ship_state"],
    "city": ["city", "ship_city"],
}

BRONZE_COLUMNS: list[str] = list(BRONZE_CANDIDATES)

# --- FIXED VALUES: upper-cased state spelling -> ISO 3166-2 code; else UNKNOWN ---
STATE_ISO_CODES: dict[str, str] = {
    "MAHARASHTRA": "IN-MH",
    "KARNATAKA": "IN-KA",
    "TAMIL NADU": "IN-TN",
    "TELANGANA": "IN-TG",
    "UTTAR PRADESH": "IN-UP",
    "DELHI": "IN-DL",
    "NEW DELHI": "IN-DL",
    "KERALA": "IN-KL",
    "WEST BENGAL": "IN-WB",
    "ANDHRA PRADESH": "IN-AP",
    "GUJARAT": "IN-GJ",
    "HARYANA": "IN-HR",
    "RAJASTHAN": "IN-RJ",
    "RJ": "IN-RJ",
    "RAJSHTHAN": "IN-RJ",
    "RAJSTHAN": "IN-RJ",
    "MADHYA PRADESH": "IN-MP",
    "ODISHA": "IN-OR",
    "ORISSA": "IN-OR",
    "BIHAR": "IN-BR",
    "PUNJAB": "IN-PB",
    "PB": "IN-PB",
    "PUNJAB/MOHALI/ZIRAKPUR": "IN-PB",
    "ASSAM": "IN-AS",
    "UTTARAKHAND": "IN-UT",
    "JHARKHAND": "IN-JH",
    "GOA": "IN-GA",
    "CHHATTISGARH": "IN-CT",
    "HIMACHAL PRADESH": "IN-HP",
    "JAMMU & KASHMIR": "IN-JK",
    "PUDUCHERRY": "IN-PY",
    "PONDICHERRY": "IN-PY",
    "CHANDIGARH": "IN-CH",
    "MANIPUR": "IN-MN",
    "ANDAMAN & NICOBAR": "IN-AN",
    "MEGHALAYA": "IN-ML",
    "SIKKIM": "IN-SK",
    "NAGALAND": "IN-NL",
    "NL": "IN-NL",
    "TRIPURA": "IN-TR",
    "ARUNACHAL PRADESH": "IN-AR",
    "AR": "IN-AR",
    "MIZORAM": "IN-MZ",
    "DADRA AND NAGAR": "IN-DN",
    "LADAKH": "IN-LA",
    "LAKSHADWEEP": "IN-LD",
}
UNKNOWN_ISO = "UNKNOWN"

# --- FIXED VALUES: labels and constants of the star schema and marts ---
UNKNOWN = "Unknown"
CUSTOMER_SEGMENT = "Unknown"
CHANNEL_TYPE = "E-Commerce Channel"
CENTURY_PREFIX = "20"

# --- FIXED VALUES: RFM rule, evaluated top to bottom, first match wins ---
RFM_CHAMPIONS_MAX_RECENCY = 30
RFM_CHAMPIONS_MIN_FREQUENCY = 3
RFM_CHAMPIONS_MIN_MONETARY = 500.0
RFM_LOYAL_MAX_RECENCY = 60
RFM_LOYAL_MIN_FREQUENCY = 2
RFM_AT_RISK_MIN_RECENCY = 90  # strictly greater
RFM_AT_RISK_MIN_MONETARY = 200.0
RFM_HIBERNATING_MIN_RECENCY = 120  # strictly greater
RFM_SEGMENTS = ["Champions", "Loyal", "At Risk", "Hibernating", "Regular"]

# --- FIXED VALUES: baseline forecast ---
FORECAST_WINDOW = 7
FORECAST_HORIZON = 30
FORECAST_MODEL_HISTORY = "actual_history"
FORECAST_MODEL_BASELINE = "moving_average_7d"

# --- FIXED VALUES: KPI comparison labels ---
KPI_NAMES = ["Revenue", "Orders", "Quantity", "AOV"]
TREND_NO_BASELINE = "No Baseline"
TREND_UP = "Up"
TREND_DOWN = "Down"
STATUS_MEETS = "Meets Minimum"
STATUS_BELOW = "Below Minimum"
