"""DuckDB SQL oracles, one per registered query.

These are *independent* formulations of the same semantics, written in
plain SQL over the driver's pre-registered tables.  The adapter rules mirror
``shelflens/sources/fixtures.py``.
"""

from __future__ import annotations

from datetime import timedelta

from shelflens import constants as K
from shelflens.sources.fixtures import AS_OF


def ts(value) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


AS_OF_SQL = ts(AS_OF)
LO30 = ts(AS_OF - timedelta(days=30))
LO90 = ts(AS_OF - timedelta(days=90))

INV = """inv AS (
  SELECT CASE WHEN p_partkey % 10 = 0 THEN 'N' ELSE 'P' END || CAST(p_partkey AS VARCHAR) AS SKU,
         CASE WHEN p_partkey % 11 = 0 THEN substr(p_name, 1, 3) ELSE p_name END AS Title,
         CASE WHEN p_partkey % 7 = 0 THEN NULL
              WHEN p_partkey % 13 = 0 THEN ''
              ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS ISBN,
         CAST(p_partkey % 20 AS DOUBLE) + 0.99 AS Price,
         p_size % 5 <> 0 AS Has_Image,
         CAST(p_size % 9 AS BIGINT) AS quantity
  FROM part)"""

SALES = """sales AS (
  SELECT 'P' || CAST(l_partkey AS VARCHAR) AS SKU, l_shipdate AS Date,
         l_quantity AS quantity, CAST(l_suppkey % 50 AS DOUBLE) + 0.49 AS Price
  FROM lineitem)"""

PER_SKU = f"""per_sku AS (
  SELECT SKU, max(Date) AS last_sale,
         sum(CASE WHEN Date >= {LO30} THEN quantity END) AS s30,
         sum(CASE WHEN Date >= {LO90} THEN quantity END) AS s90,
         sum(CASE WHEN Date >= {LO30} THEN CAST(Price AS DECIMAL(18,6)) * CAST(quantity AS DECIMAL(12,3)) END) AS r30,
         sum(CASE WHEN Date >= {LO90} THEN CAST(Price AS DECIMAL(18,6)) * CAST(quantity AS DECIMAL(12,3)) END) AS r90
  FROM sales WHERE SKU IS NOT NULL GROUP BY SKU)"""

ITEMS = f"""items AS (
  SELECT i.SKU, i.Title, i.ISBN, i.Price, i.Has_Image, i.quantity,
         CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(p.last_sale)) / 86400000000.0) AS BIGINT) AS days,
         coalesce(p.s30, 0.0) AS s30, coalesce(p.s90, 0.0) AS s90,
         coalesce(CAST(p.r30 AS DOUBLE), 0.0) AS r30, coalesce(CAST(p.r90 AS DOUBLE), 0.0) AS r90
  FROM inv i LEFT JOIN per_sku p ON i.SKU = p.SKU)"""

FLAGS = """flags AS (
  SELECT *,
         coalesce(days > 120, false) OR (coalesce(s30 = 0, false) AND coalesce(days > 90, false)) AS Is_Stale,
         coalesce(length(Title) < 5, false) OR ISBN IS NULL OR NOT coalesce(Has_Image, false)
           OR coalesce(Price < 2.0, false) AS Bad_Metadata,
         CAST(100 - CASE WHEN coalesce(length(Title) < 10, false) THEN 25 ELSE 0 END
                  - CASE WHEN ISBN IS NULL THEN 25 ELSE 0 END
                  - CASE WHEN NOT coalesce(Has_Image, false) THEN 25 ELSE 0 END
                  - CASE WHEN coalesce(Price < 2.0, false) THEN 25 ELSE 0 END AS INTEGER) AS Metadata_Quality_Score
  FROM items)"""

REPORT = """report AS (
  SELECT SKU, Title, ISBN, Price, Has_Image, quantity,
         s30 AS "Sales Last 30d", s90 AS "Sales Last 90d", days AS "Days Since Last Sale",
         Is_Stale, Bad_Metadata, Metadata_Quality_Score,
         CASE WHEN Is_Stale OR Bad_Metadata THEN '⚠️' ELSE '✅' END AS Flag,
         CASE WHEN NOT Is_Stale AND NOT Bad_Metadata THEN 'Good seller'
              ELSE CASE WHEN Is_Stale THEN 'Reprice or remove' ELSE '' END
                || CASE WHEN Bad_Metadata THEN 'Fix metadata issues' ELSE '' END END AS Notes,
         r30 AS "Revenue Last 30d", r90 AS "Revenue Last 90d"
  FROM flags)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_ctes(INV, SALES, PER_SKU, ITEMS, FLAGS, REPORT)


HEUR = """heur AS (
  SELECT *, least(greatest(1.0
      - CASE WHEN coalesce("Days Since Last Sale" > 120, false) THEN 0.25 ELSE 0 END
      - CASE WHEN coalesce("Sales Last 90d" * 4 < 3, false) THEN 0.25 ELSE 0 END
      - CASE WHEN coalesce(length(Title) < 5, false) THEN 0.125 ELSE 0 END
      - CASE WHEN ISBN IS NULL OR ISBN = '' THEN 0.125 ELSE 0 END
      - CASE WHEN NOT coalesce(Has_Image, false) THEN 0.125 ELSE 0 END
      - CASE WHEN coalesce(Price < 2.0, false) THEN 0.125 ELSE 0 END, 0.0), 1.0)::DOUBLE AS Heuristic_Score
  FROM report)"""

LAST = """last AS (SELECT SKU, max(Date) AS Last_Sale FROM sales WHERE SKU IS NOT NULL GROUP BY SKU)"""


def _r(select: str) -> str:
    return BASE + select


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_inventory_report"] = _r("SELECT * FROM report")
    # B
    q["q_normalize_quantity"] = with_ctes(SALES) + "SELECT SKU, Date, quantity FROM sales"
    q["q_report_projection"] = _r("""SELECT SKU, Title, ISBN, Price, Has_Image, quantity,
        "Sales Last 30d", "Sales Last 90d", "Days Since Last Sale", Is_Stale, Bad_Metadata,
        Metadata_Quality_Score, Flag, Notes FROM report""")
    # E
    q["q_join_recency"] = _r('SELECT SKU, "Days Since Last Sale" FROM report')
    q["q_join_sales_30d"] = _r('SELECT SKU, "Sales Last 30d" FROM report')
    q["q_join_sales_90d"] = _r('SELECT SKU, "Sales Last 90d" FROM report')
    q["q_join_revenue"] = _r('SELECT SKU, "Revenue Last 30d", "Revenue Last 90d" FROM report')
    # F
    q["q_last_sale"] = with_ctes(SALES, LAST) + "SELECT * FROM last"
    q["q_days_since_last_sale"] = with_ctes(SALES, LAST) + f"""SELECT SKU, Last_Sale,
        CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(Last_Sale)) / 86400000000.0) AS BIGINT) AS Days_Since_Last_Sale
        FROM last"""
    for d, lo in ((30, LO30), (90, LO90)):
        q[f"q_sales_last_{d}d"] = with_ctes(SALES) + f"""SELECT SKU, sum(quantity) AS Sales_Last_{d}d
            FROM sales WHERE Date >= {lo} AND SKU IS NOT NULL GROUP BY SKU"""
    q["q_revenue_windows"] = with_ctes(SALES) + f"""SELECT SKU,
        coalesce(CAST(sum(CASE WHEN Date >= {LO30} THEN CAST(Price AS DECIMAL(18,6)) * CAST(quantity AS DECIMAL(12,3)) END) AS DOUBLE), 0.0) AS Revenue_30d,
        coalesce(CAST(sum(CAST(Price AS DECIMAL(18,6)) * CAST(quantity AS DECIMAL(12,3))) AS DOUBLE), 0.0) AS Revenue_90d
        FROM sales WHERE Date >= {LO90} AND SKU IS NOT NULL GROUP BY SKU"""
    q["q_flag_counts"] = _r("""SELECT Flag,
        CASE WHEN Flag = '⚠️' THEN 'Needs Attention' ELSE 'Good Seller' END AS Label,
        count(*) AS items, sum(count(*)) OVER ()::BIGINT AS total_items,
        round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share
        FROM report GROUP BY Flag""")
    q["q_sales_distribution"] = _r('SELECT "Sales Last 30d", count(*) AS items FROM report GROUP BY 1')
    # G
    for col in ("Is_Stale", "Bad_Metadata", "Flag", "Notes", "Metadata_Quality_Score"):
        key = {"Is_Stale": "q_is_stale", "Bad_Metadata": "q_bad_metadata", "Flag": "q_flag",
               "Notes": "q_notes", "Metadata_Quality_Score": "q_metadata_quality_score"}[col]
        q[key] = _r(f"SELECT SKU, {col} FROM report")
    q["q_stale_items_strict"] = _r("""SELECT * FROM report WHERE coalesce("Days Since Last Sale" > 120, false)
        OR ("Sales Last 90d" = 0 AND coalesce(quantity > 0, false)) OR "Sales Last 90d" * 4 < 3""")
    q["q_bad_metadata_strict"] = _r("""SELECT * FROM report WHERE coalesce(length(Title) < 5, false)
        OR ISBN IS NULL OR ISBN = '' OR NOT coalesce(Has_Image, false) OR coalesce(Price < 2.0, false)""")
    q["q_good_sellers_strict"] = _r("""SELECT * FROM report WHERE "Sales Last 30d" > 0
        AND coalesce("Days Since Last Sale" <= 30, false) AND Title IS NOT NULL AND Title <> ''
        AND Title <> 'Unknown Title' AND coalesce(Has_Image, false) AND coalesce(quantity > 0, false)""")
    q["q_heuristic_score"] = BASE.rstrip() + ",\n" + HEUR + "\nSELECT SKU, Heuristic_Score FROM heur"
    # H
    q["q_report_stale"] = _r("SELECT * FROM report WHERE Is_Stale")
    q["q_report_bad_metadata"] = _r("SELECT * FROM report WHERE Bad_Metadata")
    q["q_report_good_sellers"] = _r("SELECT * FROM report WHERE NOT Is_Stale AND NOT Bad_Metadata")
    q["q_report_sales_velocity"] = _r("""SELECT SKU, Title, "Sales Last 30d", "Sales Last 90d",
        "Days Since Last Sale" FROM report ORDER BY "Sales Last 90d" DESC, SKU""")
    q["q_report_metadata_quality"] = _r("""SELECT SKU, Title, ISBN, Has_Image, Metadata_Quality_Score
        FROM report ORDER BY Metadata_Quality_Score DESC, SKU""")
    q["q_report_heuristic"] = BASE.rstrip() + ",\n" + HEUR + """
        SELECT SKU, Title, ISBN, Has_Image, Price, Heuristic_Score FROM heur ORDER BY Heuristic_Score DESC, SKU"""
    q["q_report_round_trip"] = _r('SELECT SKU, Title, "Days Since Last Sale", "Sales Last 90d", "Revenue Last 90d" FROM report')
    q["q_report_revenue"] = _r("""SELECT SKU, Title, "Revenue Last 30d", "Revenue Last 90d",
        "Sales Last 30d", "Sales Last 90d" FROM report ORDER BY "Revenue Last 90d" DESC, SKU""")
    q["q_stale_scatter"] = _r("""SELECT SKU, "Days Since Last Sale", "Sales Last 30d",
        CASE WHEN Flag = '⚠️' THEN 'Needs Attention' ELSE 'Good Seller' END AS Class FROM report""")
    q.update(oracle_sql_sources())
    q.update(oracle_sql_clustering())
    return q


# ---------------------------------------------------------------------------
# Vendor-text tables (mirror of the adapters in sources/fixtures.py)
# ---------------------------------------------------------------------------
def money_sql(x: str) -> str:
    return f"'$' || format('{{:,.2f}}', CAST({x} AS DOUBLE))"


DAILY_AGG = """daily_agg AS (
  SELECT CAST(l_shipdate AS DATE) AS d,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ops,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS ops_b2b,
         CAST(sum(l_quantity) AS BIGINT) AS units,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS units_b2b,
         count(*) AS items, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS items_b2b,
         count(CASE WHEN l_linenumber = 1 THEN 1 END) AS sessions
  FROM lineitem GROUP BY 1)"""

NULL_TEXT = "CAST(NULL AS VARCHAR)"
NULL_NUM = "CAST(NULL AS DOUBLE)"


def _daily_columns(typed: bool) -> str:
    """The 18 report columns; ``typed`` gives the cleaned (C8) rendering."""
    m = (lambda x: f"CAST({x} AS DOUBLE)") if typed else money_sql
    null_money = NULL_NUM if typed else NULL_TEXT
    date = "CAST(d AS TIMESTAMP)" if typed else "strftime(d, '%Y-%m-%d')"
    return f"""{date} AS "Date",
         {m('ops')} AS "Ordered Product Sales",
         {m('ops_b2b')} AS "Ordered Product Sales - B2B",
         CAST(units AS VARCHAR) AS "Units Ordered", CAST(units_b2b AS VARCHAR) AS "Units Ordered - B2B",
         CAST(items AS VARCHAR) AS "Total Order Items", CAST(items_b2b AS VARCHAR) AS "Total Order Items - B2B",
         {null_money} AS "Average Sales per Order Item", {null_money} AS "Average Sales per Order Item - B2B",
         {NULL_TEXT} AS "Average Units per Order Item", {NULL_TEXT} AS "Average Units per Order Item - B2B",
         {null_money} AS "Average Selling Price", {null_money} AS "Average Selling Price - B2B",
         CAST(sessions AS VARCHAR) AS "Sessions - Total", {NULL_TEXT} AS "Sessions - Total - B2B",
         CAST((items_b2b * 100) // items AS VARCHAR) || '%' AS "Order Item Session Percentage",
         {NULL_TEXT} AS "Order Item Session Percentage - B2B",
         '1' AS "Average Offer Count\""""


DAILY_TEXT = f"""daily_text AS (SELECT {_daily_columns(False)} FROM daily_agg)"""

VENDOR_LISTING = """vendor_listing AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS "seller-sku",
         'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS asin1,
         p_name AS "item-name",
         p_type || ' ' || p_name AS "product-name",
         CASE WHEN p_partkey % 9 = 0 THEN 'n/a' ELSE """ + money_sql("p_retailprice") + """ END AS price,
         CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 11 = 0 THEN '-1' ELSE CAST(p_size AS VARCHAR) END AS quantity,
         CASE WHEN p_size % 4 = 0 THEN 'True' WHEN p_size % 4 = 1 THEN 'false'
              WHEN p_size % 4 = 2 THEN 'yes' ELSE NULL END AS has_image,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS external_product_id,
         'X' || CAST(p_partkey AS VARCHAR) AS "product-id",
         p_partkey AS k, p_size AS s, p_retailprice, p_type, p_name
  FROM part)"""

VENDOR_PERF = """vendor_perf AS (
  SELECT event_id AS "event-id",
         strftime(ts, '%m/%d/%y %H:%M:%S') || ' GMT (PST)' AS "Date",
         '="U' || CAST(user_id AS VARCHAR) || '"' AS sku,
         event_type,
         CAST(value AS VARCHAR) || '%' AS late_shipment_rate,
         CAST(90 + event_id % 10 AS VARCHAR) || '.5%' AS on_time_delivery_rate,
         CASE WHEN event_id % 50 = 0 THEN 'n/a' ELSE '0.0' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') END AS order_defect_rate,
         value AS order_value,
         ts
  FROM events)"""

PERF_DAILY = """perf AS (
  SELECT CAST(ts AS DATE) AS Date,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS units_ordered,
         round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS order_defect_rate,
         round(avg(value), 6) AS mean_value
  FROM events GROUP BY 1)"""

SNAPSHOT = """snapshot AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS SKU,
         'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS ASIN,
         p_name AS Title,
         CASE WHEN p_size % 3 = 0 THEN 'Used' ELSE 'New' END AS Condition,
         p_retailprice AS Price, CAST(p_size AS BIGINT) AS Quantity
  FROM part)"""

CATALOG = """catalog AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS SKU,
         'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS ASIN,
         p_name AS Title, p_brand AS Author,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN ''
              ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS ISBN,
         p_size % 5 <> 0 AS Has_Image,
         strftime(DATE '1990-01-01' + CAST(p_partkey % 3650 AS INTEGER), '%Y-%m-%d') AS Publication_Date
  FROM part)"""

# (table, family, cte, sample key, [(column, spark type)])
SALES_TABLE_COLS = [(c, "string") for c in (
    "Date", "Ordered Product Sales", "Ordered Product Sales - B2B", "Units Ordered",
    "Units Ordered - B2B", "Total Order Items", "Total Order Items - B2B",
    "Average Sales per Order Item", "Average Sales per Order Item - B2B",
    "Average Units per Order Item", "Average Units per Order Item - B2B", "Average Selling Price",
    "Average Selling Price - B2B", "Sessions - Total", "Sessions - Total - B2B",
    "Order Item Session Percentage", "Order Item Session Percentage - B2B", "Average Offer Count")]
LISTING_TABLE_COLS = [(c, "string") for c in (
    "seller-sku", "asin1", "item-name", "product-name", "price", "quantity", "has_image",
    "external_product_id", "product-id")]
PERF_TABLE_COLS = [("event-id", "bigint"), ("Date", "string"), ("sku", "string"),
                   ("event_type", "string"), ("late_shipment_rate", "string"), ("on_time_delivery_rate", "string"),
                   ("order_defect_rate", "string"), ("order_value", "double")]
PROFILE_TABLES = [
    ("sales", "sales", "daily_text", "Date", SALES_TABLE_COLS),
    ("inventory", "inventory", "vendor_listing", "seller-sku", LISTING_TABLE_COLS),
    ("performance", "performance", "vendor_perf", "event-id", PERF_TABLE_COLS),
]
PROFILE_CTES = with_ctes(DAILY_AGG, DAILY_TEXT, VENDOR_LISTING, VENDOR_PERF)


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# fixed values: texts that count as missing
MISSING = ", ".join(_lit(t) for t in (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"))


def _present(col: str, typ: str) -> str:
    return f"(CASE WHEN {_q(col)} NOT IN ({MISSING}) THEN {_q(col)} END)" if typ == "string" else _q(col)


def _type_sql(col: str, typ: str) -> str:
    if typ != "string":
        return _lit(typ)
    c = _present(col, typ)
    return (f"CASE WHEN count(*) = 0 THEN 'string' "
            f"WHEN bool_and(coalesce(regexp_matches({c}, '^\\s*[+-]?\\d{{1,18}}\\s*$'), false)) THEN 'bigint' "
            f"WHEN coalesce(bool_and(regexp_matches({c}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')), true) THEN 'double' "
            f"ELSE 'string' END")


def _issue_sql(family: str, col: str, typ: str) -> list[tuple[str, str]]:
    c = _present(col, typ)
    low = col.lower()
    text = typ == "string"
    bad_date = f"bool_or({c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL)"
    out = []
    if family == "sales":
        if col == "Date" and text:
            out.append(("Date format inconsistencies detected", bad_date))
        if text and any(h in low for h in ("price", "sales", "revenue")):
            out.append((f"Currency formatting in column: {col}",
                         f"bool_or(coalesce(regexp_matches({c}, '[$,]'), false))"))
            out.append((f"Unparseable currency values in column: {col}",
                         f"bool_or({c} IS NOT NULL AND TRY_CAST(trim(regexp_replace({c}, '[$,\"]', '', 'g')) AS DOUBLE) IS NULL)"))
    elif family == "performance":
        if any(h in low for h in ("date", "time", "period")) and text:
            out.append((f"Date format inconsistencies in column: {col}", bad_date))
        if text and any(h in low for h in ("rate", "percentage", "pct")):
            out.append((f"Percentage formatting in column: {col}",
                         f"bool_or(coalesce(contains({c}, '%'), false))"))
    return out


def _profile_rows_sql() -> str:
    """One row per (table, column): ordinal, type, counts, issues text."""
    parts = []
    for table, family, cte, _, cols in PROFILE_TABLES:
        for i, (col, typ) in enumerate(cols):
            issues = _issue_sql(family, col, typ)
            if issues:
                pieces = ", ".join(f"CASE WHEN {expr} THEN {_lit(t)} END" for t, expr in issues)
                issue_expr = f"concat_ws('; ', {pieces})"
            else:
                issue_expr = "''"
            parts.append(
                f"SELECT {_lit(table)} AS \"table\", {i} AS ordinal, {_lit(col)} AS \"column\", "
                f"{_type_sql(col, typ)} AS data_type, count(*) AS row_count, "
                f"count(*) - count({_present(col, typ)}) AS missing_count, "
                f"CASE WHEN count(*) > 0 THEN round((count(*) - count({_present(col, typ)})) * 100.0 / count(*), 1) "
                f"ELSE 0.0 END::DOUBLE AS missing_pct, {issue_expr} AS issues FROM {cte}")
    return "\nUNION ALL\n".join(parts)


def _samples_sql() -> str:
    parts = []
    for table, _, cte, key, cols in PROFILE_TABLES:
        for i, (col, _typ) in enumerate(cols):
            val = f"coalesce(CAST({_q(col)} AS VARCHAR), 'None')"
            parts.append(
                f"SELECT {_lit(table)} AS \"table\", {i} AS ordinal, {_lit(col)} AS \"column\", "
                f"string_agg({val}, ' | ' ORDER BY {_q(key)}) AS samples "
                f"FROM (SELECT * FROM {cte} ORDER BY {_q(key)} NULLS FIRST LIMIT 5)")
    return "\nUNION ALL\n".join(parts)


# fixed values: the raw files of q_profile_files
PROFILE_FILES = {"sales": "SalesandTrafficByDate.csv", "inventory": "Inventory+Report+03-22-2025.txt",
                 "performance": "SellerPerformance.csv"}


def _file_samples_sql() -> str:
    """The first five rows of each file in the type that the profile found."""
    parts = []
    for table, _, cte, key, cols in PROFILE_TABLES:
        for i, (col, typ) in enumerate(cols):
            c = _present(col, typ)
            kind = f"(SELECT data_type FROM prof WHERE \"table\" = {_lit(table)} AND ordinal = {i})"
            val = (f"coalesce(CASE {kind} WHEN 'double' THEN CAST(TRY_CAST({c} AS DOUBLE) AS VARCHAR) "
                   f"WHEN 'bigint' THEN CAST(TRY_CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END, 'None')")
            parts.append(f"SELECT {_lit(table)} AS \"table\", {i} AS ordinal, string_agg({val}, ' | ' ORDER BY {_q(key)}) AS samples "
                         f"FROM (SELECT * FROM {cte} ORDER BY {_q(key)} NULLS FIRST LIMIT 5)")
    return "\nUNION ALL\n".join(parts)


def _describe_sql(source_cte: str, source: str, metrics: list[str], digits: int = 6) -> str:
    stats = []
    for i, m in enumerate(metrics):
        c = _q(m)
        stats.append(f"count({c})::DOUBLE AS count_{i}, avg({c}) AS mean_{i}, stddev_samp({c}) AS std_{i}, "
                     f"min({c})::DOUBLE AS min_{i}, quantile_cont({c}, 0.25) AS q25_{i}, "
                     f"quantile_cont({c}, 0.5) AS q50_{i}, quantile_cont({c}, 0.75) AS q75_{i}, "
                     f"max({c})::DOUBLE AS max_{i}")
    st = f"st AS (SELECT {', '.join(stats)} FROM {source})"
    rows = []
    for name, key in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                      ("25%", "q25"), ("50%", "q50"), ("75%", "q75"), ("max", "max")):
        vals = ", ".join(f"round({key}_{i}::DOUBLE, {digits}) AS {_q(m)}" for i, m in enumerate(metrics))
        rows.append(f"SELECT {_lit(name)} AS statistic, {vals} FROM st")
    return source_cte.rstrip() + ",\n" + st + "\n" + "\nUNION ALL\n".join(rows)


def oracle_sql_sources() -> dict[str, str]:
    q: dict[str, str] = {}
    # -- cleaning (C) -------------------------------------------------------
    q["q_clean_currency"] = "SELECT l_orderkey, l_linenumber, l_extendedprice AS Price, l_returnflag FROM lineitem"
    q["q_clean_quantity"] = """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber IN (1, 2) THEN 0.0 ELSE greatest(l_quantity, 0.0) END AS Quantity FROM lineitem"""
    q["q_fill_defaults"] = """SELECT
        coalesce(CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 'P' || CAST(p_partkey AS VARCHAR) END, 'UNKNOWN') AS SKU,
        coalesce(CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_name END, 'UNKNOWN') AS Title,
        coalesce(CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_retailprice END, 0.0) AS Price,
        coalesce(CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END, 0) AS Quantity FROM part"""
    q["q_parse_date"] = "SELECT l_orderkey, l_linenumber, l_shipdate AS Date FROM lineitem"
    q["q_parse_gmt_timestamp"] = "SELECT l_orderkey, l_linenumber, date_trunc('second', l_shipdate) AS Date FROM lineitem"
    q["q_unwrap_excel_text"] = "SELECT l_orderkey, l_linenumber, 'P' || CAST(l_partkey AS VARCHAR) AS SKU FROM lineitem"
    q["q_clean_percentage"] = """SELECT l_orderkey, l_linenumber,
        CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DOUBLE) / 100.0 AS discount_rate FROM lineitem"""
    q["q_clean_sales"] = with_ctes(DAILY_AGG) + f"SELECT {_daily_columns(True)} FROM daily_agg"
    q["q_clean_inventory"] = with_ctes(VENDOR_LISTING) + """SELECT has_image, external_product_id, "product-id",
        "seller-sku" AS SKU, asin1 AS ASIN, "product-name" AS Title,
        coalesce(CASE WHEN k % 9 = 0 THEN NULL ELSE p_retailprice END, 0.0) AS Price,
        coalesce(CASE WHEN s % 7 = 0 THEN NULL WHEN s % 11 = 0 THEN -1.0 ELSE CAST(s AS DOUBLE) END, 0.0) AS Quantity
        FROM vendor_listing"""
    cleaned = """SELECT "event-id", date_trunc('second', ts) AS "Date",
        'U' || substr(sku, 4, length(sku) - 4) AS sku, event_type,
        CAST(rtrim(late_shipment_rate, '%') AS DOUBLE) / 100.0 AS late_shipment_rate,
        CAST(rtrim(on_time_delivery_rate, '%') AS DOUBLE) / 100.0 AS on_time_delivery_rate,
        TRY_CAST(order_defect_rate AS DOUBLE) AS order_defect_rate, order_value
        FROM vendor_perf"""
    q["q_clean_performance"] = with_ctes(VENDOR_PERF) + cleaned
    q["q_clean_then_summarise"] = _describe_sql(with_ctes(VENDOR_PERF, f"cleaned AS ({cleaned})"), "cleaned",
                                                ["on_time_delivery_rate", "order_defect_rate", "late_shipment_rate"])
    q["q_title_length"] = with_ctes(INV) + "SELECT SKU, Title, CAST(length(Title) AS INTEGER) AS Title_Length FROM inv"
    # -- column resolution (B) ------------------------------------------------
    q["q_map_columns"] = with_ctes(VENDOR_LISTING) + """SELECT "seller-sku", asin1, "item-name", "product-name",
        price AS Price, quantity, has_image, external_product_id, "product-id",
        "seller-sku" AS SKU, asin1 AS ASIN, "product-name" AS Title FROM vendor_listing"""
    q["q_resolve_title"] = """SELECT 'P' || CAST(p_partkey AS VARCHAR) AS SKU,
        p_type || ' ' || p_name AS "product-description", p_type || ' ' || p_name AS Title FROM part"""
    q["q_ensure_columns"] = """SELECT 'P' || CAST(p_partkey AS VARCHAR) AS SKU,
        'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS ASIN, 0.0::DOUBLE AS Price, 0.0::DOUBLE AS quantity FROM part"""
    q["q_has_image"] = with_ctes(VENDOR_LISTING) + """SELECT "seller-sku",
        coalesce(CASE WHEN lower(has_image) IN ('true', 'yes') THEN true
                      WHEN lower(has_image) IN ('false', 'no') THEN false END, false) AS Has_Image
        FROM vendor_listing"""
    q["q_resolve_isbn"] = with_ctes(VENDOR_LISTING) + """SELECT "seller-sku", external_product_id, "product-id",
        external_product_id AS ISBN FROM vendor_listing"""
    q["q_daily_sales_projection"] = with_ctes(DAILY_AGG) + """SELECT CAST(d AS TIMESTAMP) AS Date,
        CAST(ops AS DOUBLE) AS OrderedProductSales, CAST(ops AS DOUBLE) AS Sales,
        CAST(units AS DOUBLE) AS quantity FROM daily_agg"""
    q["q_synthetic_sku"] = with_ctes(DAILY_AGG) + """SELECT CAST(d AS TIMESTAMP) AS Date,
        'SALE_' || strftime(d, '%Y%m%d') || '_' || CAST(row_number() OVER (ORDER BY units DESC, d) - 1 AS VARCHAR) AS SKU
        FROM daily_agg"""
    # -- sources (A) ------------------------------------------------------------
    q["q_read_sales_report"] = with_ctes(DAILY_AGG) + """SELECT CAST(d AS TIMESTAMP) AS Date,
        CAST(ops AS DOUBLE) AS OrderedProductSales, CAST(ops AS DOUBLE) AS Sales,
        CAST(units AS DOUBLE) AS quantity,
        'SALE_' || strftime(d, '%Y%m%d') || '_' || CAST(row_number() OVER (ORDER BY d) - 1 AS VARCHAR) AS SKU
        FROM daily_agg"""
    q["q_read_inventory_tsv"] = with_ctes(VENDOR_LISTING) + """SELECT "seller-sku" AS SKU, asin1 AS ASIN,
        "product-name" AS Title,
        coalesce(CASE WHEN k % 9 = 0 THEN NULL ELSE p_retailprice END, 0.0) AS Price,
        CASE WHEN s % 7 = 0 OR s % 11 = 0 THEN 0.0 ELSE CAST(s AS DOUBLE) END AS quantity,
        coalesce(CASE WHEN lower(has_image) IN ('true', 'yes') THEN true
                      WHEN lower(has_image) IN ('false', 'no') THEN false END, false) AS Has_Image,
        external_product_id AS ISBN FROM vendor_listing"""
    q["q_read_performance"] = with_ctes(PERF_DAILY) + """SELECT Date, CAST(units_ordered AS INTEGER) AS units_ordered,
        order_defect_rate, mean_value FROM perf"""
    q["q_ragged_csv"] = """SELECT CAST(l_orderkey AS VARCHAR) AS Column1,
        CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS Column2
        FROM lineitem WHERE l_linenumber <> 5 UNION ALL SELECT 'Column1', 'Column2'"""
    q["q_sales_history"] = with_ctes(SALES) + f"""SELECT * FROM sales
        WHERE Date BETWEEN {ts(AS_OF - timedelta(days=365))} AND {AS_OF_SQL}"""
    q["q_inventory_summary"] = with_ctes(SNAPSHOT) + "SELECT * FROM snapshot"
    q["q_catalog_lookup"] = with_ctes(CATALOG, SALES) + f"""SELECT * FROM catalog
        WHERE SKU IN (SELECT SKU FROM sales WHERE Date >= {LO30})"""
    q["q_enrich_catalog"] = with_ctes(SNAPSHOT, CATALOG) + """SELECT s.*, c.Author, c.ISBN, c.Has_Image,
        c.Publication_Date FROM snapshot s LEFT JOIN catalog c ON s.SKU = c.SKU"""
    # -- performance (J) and describe (F-A9) -------------------------------------
    q["q_select_metrics"] = with_ctes(PERF_DAILY) + "SELECT Date, order_defect_rate FROM perf"
    q["q_performance_trend"] = with_ctes(PERF_DAILY) + """SELECT CAST(Date AS TIMESTAMP) AS time,
        'order_defect_rate' AS metric, order_defect_rate AS value FROM perf"""
    q["q_performance_summary"] = _describe_sql(with_ctes(PERF_DAILY), "perf", ["order_defect_rate"])
    q["q_describe_metrics"] = _describe_sql(with_ctes(SALES), "sales", ["quantity", "Price"])
    # -- profiling (D) ---------------------------------------------------------------
    prof = PROFILE_CTES.rstrip() + ",\nprof AS (\n" + _profile_rows_sql() + ")\n"
    counts = []
    for table, _, cte, _, cols in PROFILE_TABLES:
        counts.append(f"SELECT {_lit(table)} AS \"table\", count(*) AS row_count, "
                      f"CASE WHEN count(*) > 0 THEN {len(cols)} ELSE 0 END AS column_count, "
                      f"CASE WHEN count(*) > 0 THEN '' ELSE 'Empty or invalid DataFrame' END AS issues FROM {cte}")
    q["q_profile_counts"] = PROFILE_CTES + "\nUNION ALL\n".join(counts)
    q["q_profile_missing"] = prof + 'SELECT "table", "column", missing_count, missing_pct FROM prof'
    q["q_profile_types"] = prof + 'SELECT "table", ordinal, "column", data_type, row_count FROM prof'
    q["q_profile_samples"] = PROFILE_CTES + _samples_sql()
    q["q_profile_issues"] = prof + """SELECT "table", "column", unnest(string_split(issues, '; ')) AS issue
        FROM prof WHERE issues <> ''"""
    names = " ".join(f"WHEN {_lit(t)} THEN {_lit(n)}" for t, n in PROFILE_FILES.items())
    q["q_profile_files"] = (prof.rstrip() + ",\nsamp AS (\n" + _file_samples_sql() + ")\n"
                            + f"""SELECT CASE p."table" {names} END AS "table", p.ordinal, p."column", p.data_type, p.row_count,
        p.missing_count, p.missing_pct, p.issues, s.samples FROM prof p
        LEFT JOIN samp s ON p."table" = s."table" AND p.ordinal = s.ordinal""")
    q["q_profile_report"] = (prof.rstrip() + ",\nsamp AS (\n" + _samples_sql() + ")\n"
                             + """SELECT p."table", p.ordinal, p."column", p.data_type, p.row_count, p.missing_count,
        p.missing_pct, p.issues, s.samples FROM prof p
        LEFT JOIN samp s ON p."table" = s."table" AND p.ordinal = s.ordinal""")
    return q


FEATURES_CTE = """feat AS (
  SELECT SKU, coalesce(Price, 0.0)::DOUBLE AS Price, s30::DOUBLE AS Sales_Last_30d, s90::DOUBLE AS Sales_Last_90d,
         coalesce(CAST(days AS DOUBLE), 365.0) AS Days_Since_Last_Sale,
         CAST(coalesce(Has_Image, false) AS DOUBLE) AS Has_Image,
         CAST(ISBN IS NOT NULL AS DOUBLE) AS Has_ISBN
  FROM items)"""
K_TOLERANCE = "1e-4"
FEATURE_NAMES = ["Price", "Sales_Last_30d", "Sales_Last_90d", "Days_Since_Last_Sale", "Has_Image", "Has_ISBN"]


def _z(col: str, source: str = "") -> str:
    """Population z-score; a constant column scores 0 (scale 1)."""
    c = _q(col)
    return (f"round(({c} - avg({c}) OVER ()) / CASE WHEN coalesce(stddev_pop({c}) OVER (), 0) > 0 "
            f"THEN stddev_pop({c}) OVER () ELSE 1 END, 6)")


PART_POINTS = """pts AS (
  SELECT p_partkey AS id,
         round((p - avg(p) OVER ()) / CASE WHEN stddev_pop(p) OVER () > 0 THEN stddev_pop(p) OVER () ELSE 1 END, 6) AS x,
         round((s - avg(s) OVER ()) / CASE WHEN stddev_pop(s) OVER () > 0 THEN stddev_pop(s) OVER () ELSE 1 END, 6) AS y
  FROM (SELECT p_partkey, CAST(p_retailprice AS DOUBLE) AS p, CAST(p_size AS DOUBLE) AS s FROM part))"""


def dbscan_sql(eps: float = 0.08, min_samples: int = 5) -> str:
    """Brute-force DBSCAN (all pairs + recursive closure): small fixtures only."""
    e2 = eps * eps
    return f"""WITH RECURSIVE {PART_POINTS},
pairs AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b
          ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {e2}),
core AS (SELECT a AS id FROM pairs GROUP BY a HAVING count(*) >= {min_samples}),
core_edges AS (SELECT a, b FROM pairs WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(src, dst) AS (SELECT a, b FROM core_edges
                    UNION SELECT r.src, e.b FROM reach r JOIN core_edges e ON r.dst = e.a),
comp AS (SELECT src AS id, min(dst) AS cluster FROM reach GROUP BY src),
border AS (SELECT p.a AS id, min(c.cluster) AS cluster FROM pairs p JOIN comp c ON p.b = c.id
           WHERE p.a NOT IN (SELECT id FROM core) GROUP BY p.a)
SELECT p.id AS p_partkey, CAST(coalesce(c.cluster, b.cluster, -1) AS BIGINT) AS cluster,
       p.id IN (SELECT id FROM core) AS is_core
FROM pts p LEFT JOIN comp c ON p.id = c.id LEFT JOIN border b ON p.id = b.id"""


def kmeans_ctes(k: int = 3) -> str:
    """K-means by recursion: fixed-point z-scores, the row nearest to the mean and the
    farthest ones as start, then Lloyd steps until the centres rest.  ``k`` is 3 by the
    file rule for every table of 30 parts or more."""
    names = [f"s{i}" for i in range(len(FEATURE_NAMES))]
    dist = lambda c: " + ".join(f"({n}::DOUBLE - {c}_{i}) * ({n}::DOUBLE - {c}_{i})" for i, n in enumerate(names))
    steps = ", ".join(f"""CAST(floor((({_q(c)} - avg({_q(c)}) OVER ()) / CASE WHEN coalesce(stddev_pop({_q(c)}) OVER (), 0) > 0
        THEN stddev_pop({_q(c)}) OVER () ELSE 1 END) * 1048576.0 + 0.5) AS BIGINT) AS {n}""" for c, n in zip(FEATURE_NAMES, names))
    as_centre = lambda j: ", ".join(f"{n}::DOUBLE AS c{j}_{i}" for i, n in enumerate(names))
    values = ", ".join(names)
    ctes = [f"st AS MATERIALIZED (SELECT *, {steps} FROM feat)",
            f"c0 AS (SELECT {as_centre(0)} FROM st ORDER BY {' + '.join(f'{n}::DOUBLE * {n}::DOUBLE' for n in names)}, {values} LIMIT 1)"]
    for j in range(1, k):
        near = [dist(f"c{i}") for i in range(j)]
        least = near[0] if j == 1 else f"least({', '.join(near)})"
        ctes.append(f"c{j} AS (SELECT {as_centre(j)} FROM st, {', '.join(f'c{i}' for i in range(j))} ORDER BY {least} DESC, {values} LIMIT 1)")
    flat = [f"c{j}_{i}" for j in range(k) for i in range(len(names))]
    label = f"{k - 1}"
    for j in range(k - 2, -1, -1):
        label = f"CASE WHEN {' AND '.join(f'd{j} <= d{m}' for m in range(j + 1, k))} THEN {j} ELSE {label} END"
    far = ", ".join(f"{dist(f'c{j}')} AS d{j}" for j in range(k))
    new = ", ".join(f"coalesce(CAST(sum(CASE WHEN lab = {j} THEN {n} END) AS DOUBLE) / count(CASE WHEN lab = {j} THEN 1 END), c{j}_{i}) AS n{j}_{i}"
                    for j in range(k) for i, n in enumerate(names))
    moved = " + ".join(f"(c{c[1:]} - n{c[1:]}) * (c{c[1:]} - n{c[1:]})" for c in flat)
    ctes.append(f"""km(it, moved, {', '.join(flat)}) AS (
  SELECT 0, CAST('infinity' AS DOUBLE), {', '.join(flat)} FROM {', '.join(f'c{j}' for j in range(k))}
  UNION ALL
  SELECT it + 1, ({moved}) / (1048576.0 * 1048576.0), {', '.join('n' + c[1:] for c in flat)} FROM (
    SELECT it, {', '.join(flat)}, {new} FROM (
      SELECT *, {label} AS lab FROM (SELECT st.*, km.*, {far} FROM km, st WHERE moved > {K_TOLERANCE} AND it < {K.KMEANS_MAX_ITER}))
    GROUP BY it, {', '.join(flat)}))""")
    ctes.append(f"""lab AS (SELECT *, {label} AS raw FROM (
  SELECT st.*, {far} FROM st, (SELECT * FROM km ORDER BY it DESC LIMIT 1) fin))""")
    ctes.append("""rk AS (SELECT raw, CAST(row_number() OVER (ORDER BY avg(Price), count(*)) - 1 AS INTEGER) AS Cluster FROM lab GROUP BY raw)""")
    ctes.append("given AS (SELECT lab.*, rk.Cluster FROM lab JOIN rk USING (raw))")
    return ",\n".join(ctes)


def _cluster_queries(base: str) -> dict[str, str]:
    """Statistics, descriptions and histogram of the labelled rows ``given``."""
    given = base + """,
stats AS (SELECT Cluster, avg(Price) AS p, avg(Sales_Last_30d) AS s30, avg(Days_Since_Last_Sale) AS d,
          avg(Has_Image) AS im, avg(Has_ISBN) AS isbn, count(SKU) AS items FROM given GROUP BY Cluster)
"""
    described = given.rstrip() + f""",
described AS (SELECT Cluster, CASE
        WHEN s30 > {K.HIGH_MIN_SALES30} AND d < {K.HIGH_MAX_DAYS} THEN '{K.CLUSTER_HIGH}'
        WHEN s30 < {K.STALE_MAX_SALES30} AND d > {K.STALE_MIN_DAYS} THEN '{K.CLUSTER_STALE}'
        WHEN im < {K.POOR_META_SHARE} OR isbn < {K.POOR_META_SHARE} THEN '{K.CLUSTER_POOR}'
        ELSE '{K.CLUSTER_AVERAGE}' END || ' (n=' || items || ')' AS Cluster_Description, items FROM stats)
"""
    return {"described": described,
            "stats": given + """SELECT Cluster, round(p, 6) AS mean_Price, round(s30, 6) AS mean_Sales_Last_30d,
        round(d, 6) AS mean_Days_Since_Last_Sale, round(im, 6) AS mean_Has_Image, round(isbn, 6) AS mean_Has_ISBN, items FROM stats""",
            "histogram": given.rstrip() + f""",
lim AS (SELECT Cluster, CASE WHEN min(Price) = max(Price) THEN min(Price) - 0.5 ELSE min(Price) END AS lo,
        CASE WHEN min(Price) = max(Price) THEN max(Price) + 0.5 ELSE max(Price) END AS hi FROM given GROUP BY Cluster),
binned AS (SELECT g.Cluster, CAST(least(floor((Price - lo) / ((hi - lo) / {K.HISTOGRAM_BINS})), {K.HISTOGRAM_BINS - 1}) AS INTEGER) AS bin
        FROM given g JOIN lim USING (Cluster))
SELECT l.Cluster, CAST(b.bin AS INTEGER) AS bin, lo + b.bin * (hi - lo) / {K.HISTOGRAM_BINS} AS bin_start,
       lo + (b.bin + 1) * (hi - lo) / {K.HISTOGRAM_BINS} AS bin_end,
       (SELECT count(*) FROM binned x WHERE x.Cluster = l.Cluster AND x.bin = b.bin) AS items
FROM lim l, (SELECT unnest(range({K.HISTOGRAM_BINS})) AS bin) b"""}


def pca_sql(k: int = 2, rounds: int = 18) -> str:
    """First components by power iteration on the covariance (squared ``rounds`` times,
    i.e. 2**rounds steps at once, as eigenvalues lie close), the found one taken out before
    the next; a component's largest loading is positive."""
    ctes = ["x AS MATERIALIZED (SELECT vec_id, label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)",
            "m AS (SELECT i, avg(v) AS mean FROM x GROUP BY i)",
            "c AS MATERIALIZED (SELECT vec_id, label, i, v - mean AS v FROM x JOIN m USING (i))",
            "g0 AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) / (SELECT count(*) - 1 FROM embeddings) AS s FROM c a JOIN c b USING (vec_id) GROUP BY a.i, b.i)"]
    for n in range(1, k + 1):
        g = f"g{n - 1}"
        ctes += [f"r{n} AS MATERIALIZED (SELECT i, list(s ORDER BY j) AS s FROM {g} GROUP BY i)",
                 f"mat{n} AS MATERIALIZED (SELECT list(s ORDER BY i) AS rows FROM r{n})",
                 f"""p{n}(t, rows) AS (SELECT 0, rows FROM mat{n}
  UNION ALL SELECT t + 1, list_transform(rows, lambda a: list_transform(rows, lambda b: list_inner_product(a, b) / size)) FROM (
    SELECT t, rows, list_sum(list_transform(rows, lambda a: list_inner_product(a, a))) AS size FROM p{n} WHERE t < {rounds}))""",
                 f"""w{n} AS MATERIALIZED (SELECT list_transform(rows, lambda a: list_inner_product(a, list_transform(range(len(rows)), lambda q: 1.0 + (q % 7) / 10.0)::DOUBLE[])) AS w
  FROM p{n} WHERE t = {rounds})""",
                 f"""u{n} AS MATERIALIZED (SELECT list_transform(w, lambda q: q / sqrt(list_inner_product(w, w))) AS v FROM w{n})""",
                 f"""e{n} AS MATERIALIZED (SELECT CASE WHEN list_max(v) >= -list_min(v) THEN v ELSE list_transform(v, lambda q: -q) END AS v FROM u{n})""",
                 f"l{n} AS MATERIALIZED (SELECT unnest(range(len(v))) AS i, unnest(v) AS w FROM e{n})",
                 f"""g{n} AS MATERIALIZED (SELECT g.i, g.j, g.s - (SELECT sum(a.w * h.s * b.w) FROM {g} h JOIN l{n} a ON h.i = a.i JOIN l{n} b ON h.j = b.i) * a.w * b.w AS s
  FROM {g} g JOIN l{n} a ON g.i = a.i JOIN l{n} b ON g.j = b.i)"""]
    joins = " ".join(f"JOIN l{n} USING (i)" for n in range(1, k + 1))
    picks = ", ".join(f"round(sum(v * l{n}.w), 4) + 0.0 AS pc{n}" for n in range(1, k + 1))
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"\nSELECT vec_id, label, {picks} FROM c {joins} GROUP BY vec_id, label"


def oracle_sql_clustering() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_ctes(INV, SALES, PER_SKU, ITEMS, FEATURES_CTE)
    q["q_cluster_features"] = base + "SELECT * FROM feat"
    q["q_standardize"] = base + "SELECT SKU, " + ", ".join(f"{_z(c)} AS {_q(c)}" for c in FEATURE_NAMES) + " FROM feat"
    q["q_dbscan"] = dbscan_sql()
    q["q_pca"] = pca_sql()
    given = _cluster_queries(base.rstrip() + """,
given AS (SELECT *, CAST(Sales_Last_90d > 0 AS INTEGER) + CAST(Price > 10 AS INTEGER) AS Cluster FROM feat)""")
    q["q_cluster_stats_given"] = given["stats"]
    q["q_describe_clusters_given"] = given["described"] + "SELECT Cluster, Cluster_Description FROM described"
    q["q_price_histogram_given"] = given["histogram"]
    labels = (BASE.rstrip() + ",\n" + FEATURES_CTE + ",\n" + kmeans_ctes()).replace("WITH ", "WITH RECURSIVE ", 1)
    fitted = _cluster_queries(labels)
    q["q_kmeans"] = labels + "\nSELECT SKU, Cluster FROM given"
    q["q_cluster_nunique"] = labels + """,
sizes AS (SELECT Cluster, count(*) AS items FROM given GROUP BY Cluster)
SELECT count(*) AS n_clusters, min(items) AS smallest, max(items) AS largest FROM sizes"""
    q["q_cluster_stats"] = fitted["stats"]
    q["q_describe_clusters"] = fitted["described"] + "SELECT * FROM described"
    q["q_price_histogram"] = fitted["histogram"]
    q["q_join_clusters"] = fitted["described"] + "SELECT r.*, g.Cluster, d.Cluster_Description FROM report r JOIN given g USING (SKU) JOIN described d USING (Cluster)"
    return q
