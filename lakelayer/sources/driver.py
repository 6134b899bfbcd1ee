"""Retail sources derived from the driver's TPC-H-like parquet tables.

The layer plans expect eight retail sources (transactions, products, ...).
The test driver ships TPC-H-like tables instead, so this module states each
retail source as a DataFrame over them. Faults (blank stores, non-numeric
quantities, blank prices, products without a category, stores without a
region) are planted by key arithmetic, so any engine applying the same rules
gets the same rows; duplicate transaction ids are natural in the data.

Fixed values: the id prefixes and the planting moduli below define the
derived data, and ``lakelayer.plans.oracle`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Id prefixes of the derived retail tables.
TXN_PREFIX = "TXN"
STORE_PREFIX = "S"
PRODUCT_PREFIX = "P"
CATEGORY_PREFIX = "C-"
DEPARTMENT_PREFIX = "D"
REGION_PREFIX = "R"
SUPPLIER_PREFIX = "SUP"
SHIPMENT_PREFIX = "SH"
# Planted faults (row key modulus -> fault).
STORE_NULL_MOD = 97          # l_partkey % 97 == 0  -> store_id NULL
STORE_BLANK_MOD = 101        # l_partkey % 101 == 0 -> store_id "  "
QTY_BAD_MOD = 89             # (l_partkey + l_suppkey) % 89 == 0 -> quantity "N/A"
PRICE_BLANK_MOD = 103        # l_partkey % 103 == 0 -> unit_price ""
NO_CATEGORY_MOD = 53         # p_partkey % 53 == 0 -> product without category
NO_REGION_MOD = 12           # n_nationkey % 12 == 11 -> store without region
NO_REGION_REM = 11


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _id(prefix: str, *parts: Column) -> Column:
    pieces: list[Column] = [F.lit(prefix)]
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw point-of-sale lines: one row per lineitem, measures as text.

    ``orders`` is joined to ``customer`` first (the smaller join), then the
    line items; all three are equi-joins Spark plans as sort-merge or, for a
    side AQE measures as small, broadcast.
    """
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    order_store = orders.join(customer, orders.o_custkey == customer.c_custkey)
    rows = li.join(order_store, li.l_orderkey == order_store.o_orderkey)
    pk = F.col("l_partkey")
    return rows.select(
        _id(TXN_PREFIX, F.col("l_orderkey"), F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_orderdate").alias("transaction_ts"),
        F.when(pk % STORE_NULL_MOD == 0, F.lit(None).cast("string"))
        .when(pk % STORE_BLANK_MOD == 0, F.lit("  "))
        .otherwise(_id(STORE_PREFIX, F.col("c_nationkey"))).alias("store_id"),
        _id(PRODUCT_PREFIX, pk).alias("product_id"),
        F.when((pk + F.col("l_suppkey")) % QTY_BAD_MOD == 0, F.lit("N/A"))
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(pk % PRICE_BLANK_MOD == 0, F.lit(""))
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("unit_price"),
        F.col("o_orderpriority").alias("payment_type"),
    )


def _category_id(p_type: Column) -> Column:
    return F.concat(F.lit(CATEGORY_PREFIX), p_type)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part; supplier is the lowest supplier key that sold it.

    The supplier comes from a partial aggregate over line items. When a query
    uses only product and category columns, Catalyst drops that join (the
    right side is an aggregate on the join key), so the line items are not
    read.
    """
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    first_supplier = (
        _read(spark, sf_dir, "lineitem").groupBy("l_partkey")
        .agg(F.min("l_suppkey").alias("first_suppkey"))
    )
    joined = part.join(first_supplier, part.p_partkey == first_supplier.l_partkey, "left")
    return joined.select(
        _id(PRODUCT_PREFIX, F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_partkey") % NO_CATEGORY_MOD == 0, F.lit(None).cast("string"))
        .otherwise(_category_id(F.col("p_type"))).alias("category_id"),
        F.when(F.col("first_suppkey").isNotNull(), _id(SUPPLIER_PREFIX, F.col("first_suppkey")))
        .alias("supplier_id"),
        F.col("p_retailprice").alias("unit_cost"),
    )


def _department_id(p_type: Column) -> Column:
    return _id(DEPARTMENT_PREFIX, F.length(p_type) % 3)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part type (a distinct over ``part``, partial-aggregated)."""
    types = _read(spark, sf_dir, "part").select("p_type").distinct()
    return types.select(
        _category_id(F.col("p_type")).alias("category_id"),
        F.col("p_type").alias("category_name"),
        _department_id(F.col("p_type")).alias("department_id"),
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    depts = _read(spark, sf_dir, "part").select(_department_id(F.col("p_type")).alias("department_id")).distinct()
    return depts.select(
        "department_id",
        F.concat(F.lit("Department "), F.col("department_id")).alias("department_name"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    return nation.select(
        _id(STORE_PREFIX, F.col("n_nationkey")).alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.when(F.col("n_nationkey") % NO_REGION_MOD == NO_REGION_REM, F.lit(None).cast("string"))
        .otherwise(_id(REGION_PREFIX, F.col("n_regionkey"))).alias("region_id"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "region").select(
        _id(REGION_PREFIX, F.col("r_regionkey")).alias("region_id"),
        F.col("r_name").alias("region_name"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").select(
        _id(SUPPLIER_PREFIX, F.col("s_suppkey")).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("country"),
    )


def supply_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shipment per line item; shipment ids repeat like transaction ids."""
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        _id(SHIPMENT_PREFIX, F.col("l_orderkey"), F.col("l_linenumber")).alias("shipment_id"),
        F.to_date("l_shipdate").alias("ship_date"),
        _id(PRODUCT_PREFIX, F.col("l_partkey")).alias("product_id"),
        _id(SUPPLIER_PREFIX, F.col("l_suppkey")).alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity_received"),
    )


BUILDERS = {
    "transactions": transactions,
    "products": products,
    "categories": categories,
    "departments": departments,
    "stores": stores,
    "regions": regions,
    "suppliers": suppliers,
    "supply_chain": supply_chain,
}


def retail_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight retail sources as lazy DataFrames."""
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}
