"""Run-report tables (C14), as DataFrames rather than a printed Markdown file.

* A9 ``revenue_total``: fact rows and total revenue (decimal-exact).
* A10 ``dimension_counts``: distinct keys per dimension, one row.
* A12 + T2 ``top_region_categories``: region x category without date, null
  groups dropped, top ``k`` by revenue.
* A11 + T3 ``top_supply_pairs``: product x supplier, units and non-null
  shipment ids, top ``k`` by units.
* ``gate_report``: the gate metrics with percentage text.

Top-k is ``orderBy(...).limit(k)``, which Spark plans as a per-partition
top-k followed by a merge of k rows per partition (``TakeOrderedAndProject``),
never a global sort of the input. Tie-breakers make the k rows deterministic.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.functions.exprs import exact_money_sum, money_text, percent_text
from lakelayer.schemas import DIMENSION_SOURCES, REFERENCE_KEYS


def revenue_total(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.agg(F.count(F.lit(1)).alias("fact_rows"),
                          exact_money_sum("revenue").alias("total_revenue"))


def revenue_total_text(fact_sales: DataFrame) -> DataFrame:
    return revenue_total(fact_sales).withColumn("total_revenue_text", money_text("total_revenue"))


def dimension_counts(dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """One row per dimension: ``dimension``, ``distinct_keys`` (count of distinct key).

    Each count is a scalar aggregate over its own dimension; the one-row
    results are stacked with ``unionByName``.
    """
    parts = [
        dimensions[dim].agg(F.countDistinct(REFERENCE_KEYS[source]).alias("distinct_keys"))
        .select(F.lit(dim).alias("dimension"), "distinct_keys")
        for dim, source in DIMENSION_SOURCES.items() if dim in dimensions
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def top_region_categories(enriched: DataFrame, k: int = 8, ids_unique: bool = True) -> DataFrame:
    """A12 + T2: region x category totals, null groups dropped, top ``k`` by revenue."""
    keys = ["region_name", "category_name"]
    txns = F.count("transaction_id") if ids_unique else F.countDistinct("transaction_id")
    totals = (
        enriched.dropna(subset=keys).groupBy(*keys)
        .agg(exact_money_sum("revenue").alias("total_revenue"),
             F.sum("quantity").alias("total_units"),
             txns.alias("transaction_count"))
    )
    return totals.orderBy(F.desc("total_revenue"), *keys).limit(k)


def top_region_categories_from_fact(fact_sales: DataFrame, products: DataFrame, categories: DataFrame,
                                   stores: DataFrame, regions: DataFrame, k: int = 8,
                                   ids_unique: bool = True) -> DataFrame:
    """A12 + T2 from the fact and the dimensions, through ``summarize_sales``:
    the fact is shrunk before any shuffle join, then null groups are dropped
    and the top ``k`` taken."""
    from lakelayer.operators.marts import summarize_sales

    keys = ["region_name", "category_name"]
    totals = summarize_sales(fact_sales, products, categories, stores, regions, keys, ids_unique)
    return totals.dropna(subset=keys).orderBy(F.desc("total_revenue"), *keys).limit(k)


def top_supply_pairs(supply_chain: DataFrame, k: int = 5) -> DataFrame:
    """A11 + T3: product x supplier units and shipment ids (non-null), top ``k`` by units."""
    keys = ["product_id", "supplier_id"]
    totals = supply_chain.groupBy(*keys).agg(
        F.sum("quantity_received").alias("total_quantity_received"),
        F.count("shipment_id").alias("shipment_count"),
    )
    return totals.orderBy(F.desc("total_quantity_received"), *keys).limit(k)


def sold_against_received(fact_sales: DataFrame, supply_summary: DataFrame) -> DataFrame:
    """Units sold and units received of every product that has either.

    Both sides add up on product_id and join on it, so tables bucketed by
    product_id are read, added up and joined where they lie.
    """
    sold = fact_sales.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    received = supply_summary.groupBy("product_id").agg(F.sum("total_quantity_received").alias("units_received"))
    return sold.join(received, "product_id", "full_outer")


def gate_report(metrics: DataFrame) -> DataFrame:
    """Gate metrics plus ``quarantine_pct_text`` (two decimals)."""
    return metrics.withColumn("quarantine_pct_text", percent_text("quarantine_pct"))
