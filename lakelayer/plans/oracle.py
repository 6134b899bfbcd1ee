"""Independent SQL statements of every registered query (DuckDB dialect).

Each entry restates, in plain SQL over the driver's tables, what the Spark
query computes: the retail views of ``lakelayer.sources.driver`` as CTEs, the
quality rules as CASE expressions, dedupe as ROW_NUMBER, and so on. Money is
summed as DECIMAL(18,2) and cast to DOUBLE, exactly as the Spark side does,
so results agree bit for bit.
"""

from __future__ import annotations

# --- retail views over the driver tables ------------------------------------

RAW_TX = """raw_tx AS (
  SELECT 'TXN' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         o.o_orderdate AS transaction_ts,
         CASE WHEN l.l_partkey % 97 = 0 THEN NULL
              WHEN l.l_partkey % 101 = 0 THEN '  '
              ELSE 'S' || CAST(c.c_nationkey AS VARCHAR) END AS store_id,
         'P' || CAST(l.l_partkey AS VARCHAR) AS product_id,
         CASE WHEN (l.l_partkey + l.l_suppkey) % 89 = 0 THEN 'N/A'
              ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE WHEN l.l_partkey % 103 = 0 THEN ''
              ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
         o.o_orderpriority AS payment_type
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

NULL_COND = " OR ".join(
    f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''"
    for c in ("transaction_id", "transaction_ts", "store_id", "product_id", "quantity", "unit_price")
)
NUM_COND = " OR ".join(
    f"({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL)" for c in ("quantity", "unit_price")
)
RAW_COLS = "transaction_id, transaction_ts, store_id, product_id, quantity, unit_price, payment_type"

TAGGED = f"""tagged AS (
  SELECT {RAW_COLS},
         NULLIF(CONCAT_WS(',',
           CASE WHEN {NULL_COND} THEN 'null_required_field' END,
           CASE WHEN {NUM_COND} THEN 'non_numeric_value' END,
           CASE WHEN COUNT(*) OVER (PARTITION BY transaction_id) > 1 THEN 'duplicate_key' END
         ), '') AS _dq_failure_reason
  FROM raw_tx
)"""

# Silver transactions: clean rows, quantity -> int, unit_price -> double.
# Clean ids are unique (every repeated id was quarantined), so no dedupe step.
SILVER_TX = """silver_tx AS (
  SELECT transaction_id, transaction_ts, store_id, product_id,
         TRY_CAST(quantity AS INTEGER) AS quantity,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price, payment_type
  FROM tagged WHERE _dq_failure_reason IS NULL
)"""

FACT = """fact AS (
  SELECT transaction_id, transaction_ts, CAST(transaction_ts AS DATE) AS date_key, store_id, product_id,
         quantity, unit_price, ROUND(quantity * unit_price, 2) AS revenue, payment_type
  FROM silver_tx
)"""

PRODUCTS = """products AS (
  SELECT 'P' || CAST(p.p_partkey AS VARCHAR) AS product_id,
         p.p_name AS product_name,
         CASE WHEN p.p_partkey % 53 = 0 THEN NULL ELSE 'C-' || p.p_type END AS category_id,
         CASE WHEN s.first_suppkey IS NOT NULL THEN 'SUP' || CAST(s.first_suppkey AS VARCHAR) END AS supplier_id,
         p.p_retailprice AS unit_cost
  FROM part p
  LEFT JOIN (SELECT l_partkey, MIN(l_suppkey) AS first_suppkey FROM lineitem GROUP BY l_partkey) s
    ON p.p_partkey = s.l_partkey
)"""

CATEGORIES = """categories AS (
  SELECT 'C-' || p_type AS category_id, p_type AS category_name,
         'D' || CAST(length(p_type) % 3 AS VARCHAR) AS department_id
  FROM (SELECT DISTINCT p_type FROM part)
)"""

DEPARTMENTS = """departments AS (
  SELECT department_id, 'Department ' || department_id AS department_name
  FROM (SELECT DISTINCT 'D' || CAST(length(p_type) % 3 AS VARCHAR) AS department_id FROM part)
)"""

STORES = """stores AS (
  SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name,
         CASE WHEN n_nationkey % 12 = 11 THEN NULL ELSE 'R' || CAST(n_regionkey AS VARCHAR) END AS region_id
  FROM nation
)"""

REGIONS = """regions AS (
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS region_id, r_name AS region_name FROM region
)"""

SUPPLIERS = """suppliers AS (
  SELECT 'SUP' || CAST(s.s_suppkey AS VARCHAR) AS supplier_id, s.s_name AS supplier_name, n.n_name AS country
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

RAW_SHIP = """raw_ship AS (
  SELECT 'SH' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
         CAST(l_shipdate AS DATE) AS ship_date,
         'P' || CAST(l_partkey AS VARCHAR) AS product_id,
         'SUP' || CAST(l_suppkey AS VARCHAR) AS supplier_id,
         CAST(l_quantity AS INTEGER) AS quantity_received
  FROM lineitem
)"""

# Silver supply chain: one row per shipment id, the latest ship date wins,
# remaining ties broken by the other columns (all descending, nulls last).
SILVER_SHIP = """silver_ship AS (
  SELECT shipment_id, ship_date, product_id, supplier_id, quantity_received FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY shipment_id
             ORDER BY ship_date DESC NULLS LAST, product_id DESC NULLS LAST,
                      supplier_id DESC NULLS LAST, quantity_received DESC NULLS LAST) AS rn
    FROM raw_ship WHERE shipment_id IS NOT NULL)
  WHERE rn = 1
)"""

ENRICHED = """enriched AS (
  SELECT f.*, pc.category_id, pc.category_name, pc.department_id, sr.region_id, sr.region_name
  FROM fact f
  LEFT JOIN (SELECT p.product_id, p.category_id, c.category_name, c.department_id
             FROM products p LEFT JOIN categories c ON p.category_id = c.category_id) pc
    ON f.product_id = pc.product_id
  LEFT JOIN (SELECT s.store_id, s.region_id, r.region_name
             FROM stores s LEFT JOIN regions r ON s.region_id = r.region_id) sr
    ON f.store_id = sr.store_id
)"""

DAILY = """daily AS (
  SELECT date_key, region_name, category_name,
         CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         CAST(SUM(quantity) AS BIGINT) AS total_units,
         COUNT(DISTINCT transaction_id) AS transaction_count
  FROM enriched GROUP BY date_key, region_name, category_name
)"""

SUPPLY_SUMMARY = """supply_summary AS (
  SELECT product_id, supplier_id, CAST(SUM(quantity_received) AS BIGINT) AS total_quantity_received,
         COUNT(*) AS shipment_count, MAX(ship_date) AS last_shipment_date
  FROM silver_ship GROUP BY product_id, supplier_id
)"""

# Merge scenario: the warehouse holds facts up to 1998; the next extract
# carries 1998 onwards, where low-priority orders were cancelled (quantity
# and revenue 0) and unspecified-priority orders lost their price (null).
MERGE_TARGET = """merge_target AS (SELECT * FROM fact WHERE date_key < DATE '1999-01-01')"""
MERGE_STAGING = """merge_staging AS (
  SELECT transaction_id, transaction_ts, date_key, store_id, product_id,
         CASE WHEN payment_type = '5-LOW' THEN 0 ELSE quantity END AS quantity,
         CASE WHEN payment_type = '4-NOT SPECIFIED' THEN NULL ELSE unit_price END AS unit_price,
         CASE WHEN payment_type = '5-LOW' THEN 0.0
              WHEN payment_type = '4-NOT SPECIFIED' THEN NULL ELSE revenue END AS revenue,
         payment_type
  FROM fact WHERE date_key >= DATE '1998-01-01'
)"""
MERGED = """merged AS (
  SELECT t.transaction_id, t.transaction_ts, t.date_key, t.store_id, t.product_id,
         CASE WHEN s.transaction_id IS NOT NULL THEN s.quantity ELSE t.quantity END AS quantity,
         CASE WHEN s.transaction_id IS NOT NULL THEN s.unit_price ELSE t.unit_price END AS unit_price,
         CASE WHEN s.transaction_id IS NOT NULL THEN s.revenue ELSE t.revenue END AS revenue,
         t.payment_type
  FROM merge_target t LEFT JOIN merge_staging s ON t.transaction_id = s.transaction_id
  UNION ALL
  SELECT s.* FROM merge_staging s
  WHERE NOT EXISTS (SELECT 1 FROM merge_target t WHERE t.transaction_id = s.transaction_id)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


GATE = (RAW_TX, TAGGED)
SILVER = (RAW_TX, TAGGED, SILVER_TX)
GOLD = (RAW_TX, TAGGED, SILVER_TX, FACT)
DIMS = (PRODUCTS, CATEGORIES, STORES, REGIONS)

_WAREHOUSE_FACT = """SELECT transaction_id, transaction_ts, date_key, store_id, product_id, quantity,
       CAST(unit_price AS DECIMAL(10,2)) AS unit_price, CAST(revenue AS DECIMAL(12,2)) AS revenue,
       payment_type FROM fact"""

_TX_WITHOUT_REASON = f"SELECT {RAW_COLS} FROM raw_tx"

ORACLE_SQL: dict[str, str] = {
    # ---- sources and sinks ---------------------------------------------------
    # CSV round trip: an empty field reads back as null.
    "csv_typed_scan": with_(RAW_TX) + """SELECT transaction_id, transaction_ts, store_id, product_id, quantity,
       NULLIF(unit_price, '') AS unit_price, payment_type FROM raw_tx""",
    "bronze_stamp": with_(RAW_TX) + """SELECT transaction_id, transaction_ts, store_id, product_id, quantity,
       NULLIF(unit_price, '') AS unit_price, payment_type,
       'transactions.csv' AS _source_file, TRUE AS ingest_time_set FROM raw_tx""",
    "append_evolve": with_(RAW_TX) + f"""SELECT {RAW_COLS}, CAST(NULL AS VARCHAR) AS channel FROM raw_tx
WHERE CAST(transaction_ts AS DATE) < DATE '1998-01-01'
UNION ALL
SELECT {RAW_COLS}, CASE WHEN payment_type IN ('1-URGENT', '2-HIGH') THEN 'express' ELSE 'standard' END AS channel
FROM raw_tx WHERE CAST(transaction_ts AS DATE) >= DATE '1998-01-01'""",
    "bronze_incremental": with_(RAW_TX) + """SELECT transaction_id, transaction_ts, store_id, product_id, quantity,
       NULLIF(unit_price, '') AS unit_price, payment_type FROM raw_tx""",
    "partitioned_write": with_(*GOLD) + "SELECT * FROM fact",
    "parquet_export": with_(*GOLD) + "SELECT * FROM fact",
    # ---- quality gate --------------------------------------------------------
    "tag_null": with_(RAW_TX) + f"""SELECT {RAW_COLS},
       CASE WHEN {NULL_COND} THEN 'null_required_field' END AS _dq_failure_reason FROM raw_tx""",
    "tag_numeric": with_(RAW_TX) + f"""SELECT {RAW_COLS},
       CASE WHEN {NUM_COND} THEN 'non_numeric_value' END AS _dq_failure_reason FROM raw_tx""",
    "tag_duplicate": with_(RAW_TX) + f"""SELECT {RAW_COLS},
       CASE WHEN COUNT(*) OVER (PARTITION BY transaction_id) > 1 THEN 'duplicate_key' END AS _dq_failure_reason
FROM raw_tx""",
    "dq_quarantine": with_(*GATE) + "SELECT * FROM tagged WHERE _dq_failure_reason IS NOT NULL",
    "dq_clean": with_(*GATE) + f"SELECT {RAW_COLS} FROM tagged WHERE _dq_failure_reason IS NULL",
    "dq_metrics": with_(*GATE) + """SELECT total_rows, quarantined_rows,
       CASE WHEN total_rows > 0 THEN CAST(quarantined_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) * 100.0
            ELSE CAST(0.0 AS DOUBLE) END AS quarantine_pct,
       CAST(5.0 AS DOUBLE) AS max_quarantine_pct,
       CASE WHEN (CASE WHEN total_rows > 0 THEN CAST(quarantined_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) * 100.0
                       ELSE 0.0 END) > 5.0 THEN 'ALERT' ELSE 'OK' END AS status
FROM (SELECT COUNT(*) AS total_rows, COUNT(_dq_failure_reason) AS quarantined_rows FROM tagged)""",
    "quarantine_by_reason": with_(*GATE) + """SELECT _dq_failure_reason AS reason, COUNT(*) AS row_count
FROM tagged WHERE _dq_failure_reason IS NOT NULL GROUP BY _dq_failure_reason""",
    "quarantine_by_reason_legacy": with_(*GATE) + """SELECT ',' || _dq_failure_reason AS reason, COUNT(*) AS row_count
FROM tagged WHERE _dq_failure_reason IS NOT NULL GROUP BY _dq_failure_reason""",
    # ---- silver --------------------------------------------------------------
    "cast_transactions": with_(*SILVER) + "SELECT * FROM silver_tx",
    "conform_reference": with_(RAW_SHIP, SILVER_SHIP) + "SELECT * FROM silver_ship",
    # ---- gold ----------------------------------------------------------------
    "fact_sales": with_(*GOLD) + "SELECT * FROM fact",
    "supply_chain_summary": with_(RAW_SHIP, SILVER_SHIP, SUPPLY_SUMMARY) + "SELECT * FROM supply_summary",
    "snowflake_enrich": with_(*GOLD, *DIMS, ENRICHED) + "SELECT * FROM enriched",
    "daily_summary": with_(*GOLD, *DIMS, ENRICHED, DAILY) + "SELECT * FROM daily",
    "dim_product": with_(PRODUCTS) + "SELECT * FROM products",
    "dim_category": with_(CATEGORIES) + "SELECT * FROM categories",
    "dim_department": with_(DEPARTMENTS) + "SELECT * FROM departments",
    "dim_store": with_(STORES) + "SELECT * FROM stores",
    "dim_region": with_(REGIONS) + "SELECT * FROM regions",
    "dim_supplier": with_(SUPPLIERS) + "SELECT * FROM suppliers",
    # ---- warehouse -----------------------------------------------------------
    "warehouse_conform": with_(*GOLD) + _WAREHOUSE_FACT,
    "merge_upsert": with_(*GOLD, MERGE_TARGET, MERGE_STAGING, MERGED) + "SELECT * FROM merged",
    "merge_idempotent": with_(*GOLD, MERGE_TARGET, MERGE_STAGING, MERGED) + "SELECT * FROM merged",
    # ---- run report ----------------------------------------------------------
    "revenue_total": with_(*GOLD) + """SELECT COUNT(*) AS fact_rows,
       CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM fact""",
    "dim_counts": with_(PRODUCTS, CATEGORIES, DEPARTMENTS, STORES, REGIONS, SUPPLIERS) + """
SELECT 'dim_product' AS dimension, COUNT(DISTINCT product_id) AS distinct_keys FROM products
UNION ALL SELECT 'dim_category', COUNT(DISTINCT category_id) FROM categories
UNION ALL SELECT 'dim_department', COUNT(DISTINCT department_id) FROM departments
UNION ALL SELECT 'dim_store', COUNT(DISTINCT store_id) FROM stores
UNION ALL SELECT 'dim_region', COUNT(DISTINCT region_id) FROM regions
UNION ALL SELECT 'dim_supplier', COUNT(DISTINCT supplier_id) FROM suppliers""",
    "region_category_top8": with_(*GOLD, *DIMS, ENRICHED) + """SELECT region_name, category_name,
       CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       CAST(SUM(quantity) AS BIGINT) AS total_units,
       COUNT(DISTINCT transaction_id) AS transaction_count
FROM enriched WHERE region_name IS NOT NULL AND category_name IS NOT NULL
GROUP BY region_name, category_name
ORDER BY total_revenue DESC, region_name, category_name LIMIT 8""",
    "supplier_top5": with_(RAW_SHIP, SILVER_SHIP) + """SELECT product_id, supplier_id,
       CAST(SUM(quantity_received) AS BIGINT) AS total_quantity_received,
       COUNT(shipment_id) AS shipment_count
FROM silver_ship GROUP BY product_id, supplier_id
ORDER BY total_quantity_received DESC, product_id, supplier_id LIMIT 5""",
}

# Queries whose result is the daily summary written by a full layer run.
ORACLE_SQL["medallion_end_to_end"] = ORACLE_SQL["daily_summary"]
ORACLE_SQL["daily_summary_distinct"] = ORACLE_SQL["daily_summary"]
ORACLE_SQL["tag_duplicate_window"] = ORACLE_SQL["tag_duplicate"]

ORACLE_SQL["warehouse_load"] = with_(*GOLD, *DIMS, DEPARTMENTS, SUPPLIERS, RAW_SHIP, SILVER_SHIP, SUPPLY_SUMMARY,
                                     ENRICHED, DAILY) + """
SELECT 'dim_department' AS table_name, COUNT(*) AS row_count FROM departments
UNION ALL SELECT 'dim_category', COUNT(*) FROM categories
UNION ALL SELECT 'dim_product', COUNT(*) FROM products
UNION ALL SELECT 'dim_region', COUNT(*) FROM regions
UNION ALL SELECT 'dim_store', COUNT(*) FROM stores
UNION ALL SELECT 'dim_supplier', COUNT(*) FROM suppliers
UNION ALL SELECT 'fact_sales', COUNT(*) FROM fact
UNION ALL SELECT 'fact_supply_chain_summary', COUNT(*) FROM supply_summary
UNION ALL SELECT 'gold_daily_merchandising_summary', COUNT(*) FROM daily"""

_FACT_NOT_NULL = ("transaction_id", "transaction_ts", "date_key", "store_id", "product_id", "quantity",
                  "unit_price", "revenue")
ORACLE_SQL["warehouse_violations"] = with_(RAW_TX) + """, ungated AS (
  SELECT transaction_id, transaction_ts, store_id, product_id,
         TRY_CAST(quantity AS INTEGER) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price, payment_type
  FROM raw_tx
), ungated_fact AS (
  SELECT transaction_id, transaction_ts, CAST(transaction_ts AS DATE) AS date_key, store_id, product_id,
         quantity, unit_price, ROUND(quantity * unit_price, 2) AS revenue, payment_type
  FROM ungated
), conformed AS (
  SELECT transaction_id, transaction_ts, date_key, store_id, product_id, quantity,
         CAST(unit_price AS DECIMAL(10,2)) AS unit_price, CAST(revenue AS DECIMAL(12,2)) AS revenue, payment_type,
         NULLIF(CONCAT_WS(',', """ + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 'null_in_not_null:{c}' END" for c in _FACT_NOT_NULL) + """), '') AS _violation
  FROM ungated_fact
)
SELECT * FROM conformed WHERE _violation IS NOT NULL"""
ORACLE_SQL["reingest_batch_scope"] = ORACLE_SQL["cast_transactions"]

# ---- warehouse tables by value, and the pieces of the run report -----------------

ORACLE_SQL["warehouse_fact_merged"] = with_(*GOLD, MERGE_TARGET, MERGE_STAGING, MERGED) + \
    _WAREHOUSE_FACT.replace("FROM fact", "FROM merged")
ORACLE_SQL["warehouse_dim_department"] = with_(DEPARTMENTS) + "SELECT * FROM departments"
ORACLE_SQL["warehouse_dim_category"] = with_(CATEGORIES) + "SELECT * FROM categories"
ORACLE_SQL["warehouse_dim_product"] = with_(PRODUCTS) + """SELECT product_id, product_name, category_id, supplier_id,
       CAST(unit_cost AS DECIMAL(10,2)) AS unit_cost FROM products"""
ORACLE_SQL["warehouse_dim_region"] = with_(REGIONS) + "SELECT * FROM regions"
ORACLE_SQL["warehouse_dim_store"] = with_(STORES) + "SELECT * FROM stores"
ORACLE_SQL["warehouse_dim_supplier"] = with_(SUPPLIERS) + "SELECT * FROM suppliers"
ORACLE_SQL["warehouse_fact_supply_chain_summary"] = with_(RAW_SHIP, SILVER_SHIP, SUPPLY_SUMMARY) + """
SELECT product_id, supplier_id, CAST(total_quantity_received AS INTEGER) AS total_quantity_received,
       CAST(shipment_count AS INTEGER) AS shipment_count, last_shipment_date FROM supply_summary"""
ORACLE_SQL["warehouse_gold_daily_merchandising_summary"] = with_(*GOLD, *DIMS, ENRICHED, DAILY) + """
SELECT date_key, region_name, category_name, CAST(total_revenue AS DECIMAL(14,2)) AS total_revenue,
       CAST(total_units AS INTEGER) AS total_units, CAST(transaction_count AS INTEGER) AS transaction_count FROM daily"""
ORACLE_SQL["warehouse_too_long"] = with_(CATEGORIES) + """SELECT * FROM (
  SELECT category_id, category_name, department_id,
         NULLIF(CONCAT_WS(',', CASE WHEN length(category_id) > 10 THEN 'too_long:category_id' END,
                CASE WHEN length(category_name) > 100 THEN 'too_long:category_name' END,
                CASE WHEN length(department_id) > 10 THEN 'too_long:department_id' END), '') AS _violation
  FROM (SELECT CASE WHEN length(category_name) % 2 = 0 THEN category_id || '-far-too-long' ELSE category_id END
               AS category_id, category_name, department_id FROM categories)) WHERE _violation IS NOT NULL"""

_TOTAL = ORACLE_SQL["revenue_total"]
ORACLE_SQL["revenue_total_text"] = f"""SELECT *, '$' || format('{{:,.2f}}', total_revenue) AS total_revenue_text
FROM ({_TOTAL})"""
ORACLE_SQL["gate_report"] = f"""SELECT *, format('{{:.2f}}', quarantine_pct) AS quarantine_pct_text
FROM ({ORACLE_SQL["dq_metrics"]})"""
ORACLE_SQL["quarantine_listing"] = with_(*GATE) + """SELECT transaction_id, store_id, quantity, unit_price,
       _dq_failure_reason FROM tagged WHERE _dq_failure_reason IS NOT NULL"""
ORACLE_SQL["source_counts"] = with_(RAW_TX, PRODUCTS, CATEGORIES, DEPARTMENTS, STORES, REGIONS, SUPPLIERS, RAW_SHIP) + """
SELECT 'transactions' AS source, COUNT(*) AS row_count FROM raw_tx
UNION ALL SELECT 'products', COUNT(*) FROM products
UNION ALL SELECT 'categories', COUNT(*) FROM categories
UNION ALL SELECT 'departments', COUNT(*) FROM departments
UNION ALL SELECT 'stores', COUNT(*) FROM stores
UNION ALL SELECT 'regions', COUNT(*) FROM regions
UNION ALL SELECT 'suppliers', COUNT(*) FROM suppliers
UNION ALL SELECT 'supply_chain', COUNT(*) FROM raw_ship"""
ORACLE_SQL["supply_pairs_null_ids"] = with_(RAW_SHIP) + """SELECT product_id, supplier_id,
       CAST(SUM(quantity_received) AS BIGINT) AS total_quantity_received,
       COUNT(CASE WHEN CAST(substr(product_id, 2) AS BIGINT) % 7 <> 0 THEN shipment_id END) AS shipment_count
FROM raw_ship GROUP BY product_id, supplier_id
ORDER BY total_quantity_received DESC, product_id, supplier_id LIMIT 50"""
ORACLE_SQL["reingest_reference_latest"] = with_(RAW_SHIP, SILVER_SHIP) + """
SELECT shipment_id, CAST(ship_date - 30 AS DATE) AS ship_date, product_id, supplier_id,
       CAST(quantity_received + 1 AS INTEGER) AS quantity_received FROM silver_ship"""

# Landed as CSV an empty price is null: it is no longer "present but not a number".
_LANDED = TAGGED.replace("tagged AS", "landed_tagged AS").replace("FROM raw_tx", "FROM landed_tx")
ORACLE_SQL["quarantine_table"] = with_(RAW_TX, f"""landed_tx AS (
  SELECT * REPLACE (NULLIF(unit_price, '') AS unit_price) FROM raw_tx)""", _LANDED) + """
SELECT *, 'transactions.csv' AS _source_file, TRUE AS ingest_time_set,
       (SELECT 100.0 * COUNT(_dq_failure_reason) / COUNT(*) > 5.0 FROM landed_tagged) AS alert_raised
FROM landed_tagged WHERE _dq_failure_reason IS NOT NULL"""

# Prices that are numbers but not money: a group that has one is summed as doubles.
_EDGE_TX = RAW_TX.replace("raw_tx AS", "plain_tx AS")
ORACLE_SQL["revenue_edge_prices"] = with_(_EDGE_TX, """raw_tx AS (
  SELECT * REPLACE (CASE WHEN CAST(substr(product_id, 2) AS BIGINT) % 107 = 0 THEN '1e300'
                         WHEN CAST(substr(product_id, 2) AS BIGINT) % 109 = 0 THEN 'NaN'
                         WHEN CAST(substr(product_id, 2) AS BIGINT) % 113 = 0 THEN 'Infinity'
                         ELSE unit_price END AS unit_price) FROM plain_tx)""",
    TAGGED, SILVER_TX, FACT, *DIMS, ENRICHED) + """
SELECT date_key, region_name, category_name,
       CASE WHEN bool_or(isnan(revenue) OR abs(revenue) >= 1e16) THEN SUM(revenue)
            ELSE CAST(SUM(TRY_CAST(CASE WHEN NOT isnan(revenue) AND abs(revenue) < 1e16 THEN revenue END
                                   AS DECIMAL(18,2))) AS DOUBLE) END AS total_revenue,
       CAST(SUM(quantity) AS BIGINT) AS total_units, COUNT(DISTINCT transaction_id) AS transaction_count
FROM enriched GROUP BY date_key, region_name, category_name"""

# ---- batch by batch: as one run over everything, landed as CSV --------------------

_LANDED_TX = """landed_tx AS (SELECT * REPLACE (NULLIF(unit_price, '') AS unit_price) FROM raw_tx)"""
ORACLE_SQL["silver_incremental"] = ORACLE_SQL["cast_transactions"]
ORACLE_SQL["quarantine_incremental"] = with_(RAW_TX, _LANDED_TX, _LANDED) + """
SELECT * FROM landed_tagged WHERE _dq_failure_reason IS NOT NULL"""
ORACLE_SQL["gold_incremental"] = ORACLE_SQL["daily_summary"]

ORACLE_SQL["bucketed_sales_supply"] = with_(*GOLD, RAW_SHIP, SILVER_SHIP, SUPPLY_SUMMARY) + """
SELECT product_id, units_sold, units_received
FROM (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units_sold FROM fact GROUP BY product_id)
FULL JOIN (SELECT product_id, CAST(SUM(total_quantity_received) AS BIGINT) AS units_received
           FROM supply_summary GROUP BY product_id) USING (product_id)"""

# ---- malformed lines and huge amounts ------------------------------------------------

ORACLE_SQL["csv_malformed"] = with_(RAW_TX, """landed_tx AS (
  SELECT * REPLACE (NULLIF(unit_price, '') AS unit_price,
                    CASE WHEN n % 43 <> 0 THEN transaction_ts END AS transaction_ts),
         transaction_id || ',' || CASE WHEN n % 43 = 0 THEN 'soon' ELSE strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') END
           || ',' || coalesce(store_id, '') || ',' || product_id || ',' || quantity || ',' || unit_price
           || CASE WHEN n % 37 = 0 THEN '' WHEN n % 41 = 0 THEN ',' || payment_type || ',surplus'
                   ELSE ',' || payment_type END AS line
  FROM (SELECT *, CAST(substr(product_id, 2) AS BIGINT) AS n FROM raw_tx))""",
    _LANDED.replace("AS _dq_failure_reason", "AS _dq_failure_reason, n, line")) + """
SELECT transaction_id, line, CONCAT_WS(',', _dq_failure_reason, 'malformed_record') AS _dq_failure_reason
FROM landed_tagged WHERE n % 37 = 0 OR n % 41 = 0 OR n % 43 = 0"""

ORACLE_SQL["revenue_huge_prices"] = with_(_EDGE_TX, """raw_tx AS (
  SELECT * REPLACE (CASE WHEN CAST(substr(product_id, 2) AS BIGINT) % 7 = 0 THEN '7e17'
                         WHEN CAST(substr(product_id, 2) AS BIGINT) % 11 = 0 THEN '-7e17'
                         WHEN CAST(substr(product_id, 2) AS BIGINT) % 13 = 0 THEN '3e19'
                         ELSE unit_price END AS unit_price) FROM plain_tx)""",
    TAGGED, SILVER_TX, FACT, *DIMS, ENRICHED) + """
SELECT date_key, region_name, category_name,
       CAST(coalesce(SUM(CASE WHEN abs(revenue) >= 1e16 THEN CAST(revenue AS HUGEINT) END), 0) AS DOUBLE)
         + CAST(coalesce(SUM(CASE WHEN abs(revenue) < 1e16 THEN CAST(revenue AS DECIMAL(18,2)) END), 0) AS DOUBLE)
         AS total_revenue,
       CAST(SUM(quantity) AS BIGINT) AS total_units, COUNT(DISTINCT transaction_id) AS transaction_count
FROM enriched GROUP BY date_key, region_name, category_name"""

ORACLE_SQL["distinct_rollup"] = with_(RAW_TX) + """SELECT strftime(date_key, '%Y-%m') AS month, store_id,
       COUNT(DISTINCT transaction_id) AS transaction_count
FROM (SELECT transaction_id, CAST(transaction_ts AS DATE) AS date_key, store_id FROM raw_tx
      UNION ALL
      SELECT transaction_id, CAST(transaction_ts AS DATE) + 40, 'S0' FROM raw_tx
      WHERE CAST(substr(product_id, 2) AS BIGINT) % 5 = 0)
GROUP BY month, store_id"""
