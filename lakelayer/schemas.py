"""Declared schemas: the eight raw sources and the nine warehouse tables.

Fixed values: table names, column names, column order and types below must
match the retail source files and the warehouse DDL exactly, so they are
written out as plain declarations rather than generated.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in fields])


# ---------------------------------------------------------------------------
# Raw source schemas (measures of transactions stay strings so
# a bad value such as "N/A" survives to the quality gate).
# ---------------------------------------------------------------------------
TRANSACTIONS = _s(
    ("transaction_id", StringType(), False),
    ("transaction_ts", TimestampType(), False),
    ("store_id", StringType(), True),
    ("product_id", StringType(), True),
    ("quantity", StringType(), True),
    ("unit_price", StringType(), True),
    ("payment_type", StringType(), True),
)
PRODUCTS = _s(
    ("product_id", StringType(), False),
    ("product_name", StringType(), False),
    ("category_id", StringType(), True),
    ("supplier_id", StringType(), True),
    ("unit_cost", DoubleType(), True),
)
CATEGORIES = _s(
    ("category_id", StringType(), False),
    ("category_name", StringType(), False),
    ("department_id", StringType(), True),
)
DEPARTMENTS = _s(
    ("department_id", StringType(), False),
    ("department_name", StringType(), False),
)
STORES = _s(
    ("store_id", StringType(), False),
    ("store_name", StringType(), False),
    ("region_id", StringType(), True),
)
REGIONS = _s(
    ("region_id", StringType(), False),
    ("region_name", StringType(), False),
)
SUPPLIERS = _s(
    ("supplier_id", StringType(), False),
    ("supplier_name", StringType(), False),
    ("country", StringType(), True),
)
SUPPLY_CHAIN = _s(
    ("shipment_id", StringType(), False),
    ("ship_date", DateType(), False),
    ("product_id", StringType(), False),
    ("supplier_id", StringType(), False),
    ("quantity_received", IntegerType(), False),
)

# Source registry (file name, schema, bronze table, silver key).
SOURCES = (
    ("transactions.csv", TRANSACTIONS, "transactions", "transaction_id"),
    ("products.csv", PRODUCTS, "products", "product_id"),
    ("categories.csv", CATEGORIES, "categories", "category_id"),
    ("departments.csv", DEPARTMENTS, "departments", "department_id"),
    ("stores.csv", STORES, "stores", "store_id"),
    ("regions.csv", REGIONS, "regions", "region_id"),
    ("suppliers.csv", SUPPLIERS, "suppliers", "supplier_id"),
    ("supply_chain.csv", SUPPLY_CHAIN, "supply_chain", "shipment_id"),
)
SOURCE_SCHEMAS = {table: schema for _, schema, table, _ in SOURCES}
REFERENCE_KEYS = {table: key for _, _, table, key in SOURCES if table != "transactions"}

# Columns stamped at ingest and carried by every silver table and dimension.
INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
METADATA_COLUMNS = (INGESTED_AT, SOURCE_FILE)
# The whole line of a record that does not fit its schema, where bronze captures them.
CORRUPT_RECORD = "_corrupt_record"

# ---------------------------------------------------------------------------
# Warehouse tables (names, column order, types, NOT NULL).
# DATETIME2 carries no time zone, so it maps to TIMESTAMP_NTZ.
# ---------------------------------------------------------------------------
WAREHOUSE = {
    "dim_department": _s(
        ("department_id", StringType(), False),
        ("department_name", StringType(), False),
    ),
    "dim_category": _s(
        ("category_id", StringType(), False),
        ("category_name", StringType(), False),
        ("department_id", StringType(), False),
    ),
    "dim_product": _s(
        ("product_id", StringType(), False),
        ("product_name", StringType(), False),
        ("category_id", StringType(), True),
        ("supplier_id", StringType(), True),
        ("unit_cost", DecimalType(10, 2), True),
    ),
    "dim_region": _s(
        ("region_id", StringType(), False),
        ("region_name", StringType(), False),
    ),
    "dim_store": _s(
        ("store_id", StringType(), False),
        ("store_name", StringType(), False),
        ("region_id", StringType(), True),
    ),
    "dim_supplier": _s(
        ("supplier_id", StringType(), False),
        ("supplier_name", StringType(), False),
        ("country", StringType(), True),
    ),
    "fact_sales": _s(
        ("transaction_id", StringType(), False),
        ("transaction_ts", TimestampNTZType(), False),
        ("date_key", DateType(), False),
        ("store_id", StringType(), False),
        ("product_id", StringType(), False),
        ("quantity", IntegerType(), False),
        ("unit_price", DecimalType(10, 2), False),
        ("revenue", DecimalType(12, 2), False),
        ("payment_type", StringType(), True),
    ),
    "fact_supply_chain_summary": _s(
        ("product_id", StringType(), False),
        ("supplier_id", StringType(), False),
        ("total_quantity_received", IntegerType(), False),
        ("shipment_count", IntegerType(), False),
        ("last_shipment_date", DateType(), True),
    ),
    "gold_daily_merchandising_summary": _s(
        ("date_key", DateType(), False),
        ("region_name", StringType(), True),
        ("category_name", StringType(), True),
        ("total_revenue", DecimalType(14, 2), True),
        ("total_units", IntegerType(), True),
        ("transaction_count", IntegerType(), True),
    ),
}

# Declared lengths of the warehouse's text columns (the same in every table).
TEXT_LENGTHS = {
    "department_id": 10, "department_name": 100,
    "category_id": 10, "category_name": 100,
    "product_id": 20, "product_name": 200,
    "supplier_id": 10, "supplier_name": 200, "country": 50,
    "region_id": 10, "region_name": 50,
    "store_id": 20, "store_name": 200,
    "transaction_id": 20, "payment_type": 20,
}

# Gold table -> silver source for the six pass-through dimensions.
DIMENSION_SOURCES = {
    "dim_product": "products",
    "dim_category": "categories",
    "dim_department": "departments",
    "dim_store": "stores",
    "dim_region": "regions",
    "dim_supplier": "suppliers",
}

# The nine fact_sales columns, in order.
FACT_SALES_COLUMNS = (
    "transaction_id", "transaction_ts", "date_key", "store_id", "product_id",
    "quantity", "unit_price", "revenue", "payment_type",
)
# Columns the warehouse MERGE updates when a key matches.
FACT_SALES_MERGE_UPDATES = ("quantity", "unit_price", "revenue")
