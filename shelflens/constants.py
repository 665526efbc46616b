"""Fixed values that must equal the reference's for identical results.

Everything in this module is a constant of the business rules (flag glyphs,
note texts, thresholds, vendor column names, report column order).  The
logic that uses them lives in ``functions`` / ``operators`` / ``plans``.
"""

from __future__ import annotations

# --- fixed values: flag glyphs and note texts ------------------------------
FLAG_WARN = "⚠️"      # warning sign + variation selector-16
FLAG_OK = "✅"              # white heavy check mark
NOTE_STALE = "Reprice or remove"
NOTE_BAD_METADATA = "Fix metadata issues"
NOTE_GOOD = "Good seller"
UNKNOWN_TITLE = "Unknown Title"
UNKNOWN_TEXT = "UNKNOWN"

# --- fixed values: rule thresholds ------------------------------------------
SALES_WINDOWS_DAYS = (30, 90)
STALE_DAYS = 120                 # stale if last sale older than this
STALE_DAYS_NO_RECENT = 90        # ... or no 30-day sales and older than this
SHORT_TITLE_BAD = 5              # bad metadata if title shorter than this
SHORT_TITLE_SCORE = 10           # quality score penalty below this length
LOW_PRICE = 2.0
SCORE_PENALTY = 25
GOOD_SELLER_MAX_DAYS = 30
ANNUALISE_FACTOR = 4             # 90-day sales * 4 stands in for 12 months
ANNUAL_MIN_SALES = 3
HEURISTIC_MAJOR = 0.25
HEURISTIC_MINOR = 0.125
NEVER_SOLD_DAYS_FEATURE = 365    # clustering: days for a never-sold item

# --- fixed values: cluster description rule --------------------------------
CLUSTER_HIGH = "High Performers"
CLUSTER_STALE = "Stale Inventory"
CLUSTER_POOR = "Poor Metadata"
CLUSTER_AVERAGE = "Average Performers"
HIGH_MIN_SALES30 = 5
HIGH_MAX_DAYS = 30
STALE_MAX_SALES30 = 1
STALE_MIN_DAYS = 90
POOR_META_SHARE = 0.5

# --- fixed values: report layout --------------------------------------------
REPORT_COLUMNS = [
    "SKU", "Title", "ISBN", "Price", "Has_Image", "quantity",
    "Sales Last 30d", "Sales Last 90d", "Days Since Last Sale",
    "Is_Stale", "Bad_Metadata", "Metadata_Quality_Score", "Flag", "Notes",
    "Revenue Last 30d", "Revenue Last 90d",
]

# --- fixed values: daily sales-and-traffic report header (18 columns) -------
SALES_REPORT_COLUMNS = [
    "Date", "Ordered Product Sales", "Ordered Product Sales - B2B",
    "Units Ordered", "Units Ordered - B2B", "Total Order Items",
    "Total Order Items - B2B", "Average Sales per Order Item",
    "Average Sales per Order Item - B2B", "Average Units per Order Item",
    "Average Units per Order Item - B2B", "Average Selling Price",
    "Average Selling Price - B2B", "Sessions - Total", "Sessions - Total - B2B",
    "Order Item Session Percentage", "Order Item Session Percentage - B2B",
    "Average Offer Count",
]

# --- fixed values: vendor column names -> canonical names --------------------
# Loader map (listing reports).  Columns are copied, so when several vendor
# names land on one canonical name the last entry present in this order wins.
LOADER_COLUMN_MAP = [
    ("seller-sku", "SKU"),
    ("sku", "SKU"),
    ("asin1", "ASIN"),
    ("item-name", "Title"),
    ("item_name", "Title"),
    ("item-description", "Title"),
    ("product-name", "Title"),
    ("name", "Title"),
    ("title", "Title"),
    ("price", "Price"),
    ("price-amount", "Price"),
    ("quantity", "quantity"),
    ("quantity-available", "quantity"),
    ("condition", "Condition"),
    ("fulfillment-channel", "FulfillmentChannel"),
    ("open-date", "OpenDate"),
]
# Cleaner map (profiling/cleaning step): a rename.
CLEANER_COLUMN_MAP = [
    ("seller-sku", "SKU"),
    ("sku", "SKU"),
    ("asin1", "ASIN"),
    ("item-name", "Title"),
    ("item_name", "Title"),
    ("item-description", "Title"),
    ("product-name", "Title"),
    ("price", "Price"),
    ("price-amount", "Price"),
    ("quantity", "Quantity"),
    ("quantity-available", "Quantity"),
]
REQUIRED_LISTING_COLUMNS = ("SKU", "ASIN", "Price", "quantity")
TITLE_HINTS = ("name", "title", "description")
ISBN_CANDIDATES = ("isbn", "external_product_id", "product-id")
EXCEL_TEXT_COLUMNS = ("SKU", "sku", "seller-sku")
MONEY_NAME_HINTS = ("price", "sales", "revenue")
PERCENT_NAME_HINTS = ("rate", "percentage", "pct")
TIME_NAME_HINTS = ("date", "time", "period")

# --- fixed values: seller performance -------------------------------------
PERFORMANCE_METRICS = [
    "on_time_delivery_rate", "late_shipment_rate", "LateShipmentRate",
    "order_defect_rate", "OrderDefectRate", "defect_rate",
]
PERFORMANCE_TIME_COLUMNS = ["Date", "date", "period", "week", "month"]
GMT_FORMAT = "M/d/yy H:mm:ss 'GMT'"

# --- fixed values: clustering / numeric defaults ----------------------------
KMEANS_SEED = 42
KMEANS_MAX_ITER = 100
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 5
HISTOGRAM_BINS = 30

# fixed values: texts that count as missing in vendor files
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                  "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
