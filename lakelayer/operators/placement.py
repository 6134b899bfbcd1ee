"""How the warehouse tables are laid out when written.

Nothing here forces a broadcast: whether a dimension is copied to every task of
a join is left to Spark, which decides from byte sizes (of files when planning,
of shuffle output when AQE re-plans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Warehouse table placement (replicate / hash on a key / round robin).
WAREHOUSE_PLACEMENT = {
    "dim_department": ("replicate",),
    "dim_category": ("replicate",),
    "dim_product": ("replicate",),
    "dim_region": ("replicate",),
    "dim_store": ("replicate",),
    "dim_supplier": ("replicate",),
    "fact_sales": ("hash", "product_id"),
    "fact_supply_chain_summary": ("hash", "product_id"),
    "gold_daily_merchandising_summary": ("round_robin",),
}


def place_for_write(df: DataFrame, placement: tuple[str, ...]) -> DataFrame:
    """Lay out a table's files the way its placement asks.

    ``hash``: a rebalance on the key, so rows of one key share files (AQE still
    splits a hot key and sizes the files); ``round_robin``: a rebalance without
    key (even file sizes); ``replicate``: left as is.
    """
    kind = placement[0]
    if kind == "hash":
        return df.hint("rebalance", *placement[1:])
    if kind == "round_robin":
        return df.hint("rebalance")
    if kind == "replicate":
        return df
    raise ValueError(f"unknown placement {placement!r}")
