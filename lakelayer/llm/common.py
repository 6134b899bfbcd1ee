"""Shared pieces of the operators: staged tables, running totals, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.sources.tables import materialize


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: computed once, lineage cut."""
    return materialize(df, label)[0]


def handed_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; then what this worker no longer uses goes back to the system.

    Spark keeps Python workers for later tasks, also through stages without
    Python, where freed memory they still hold stands beside the heap.
    """
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def spare_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def totals_before(sizes: DataFrame, block: str, order: str, amount: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over all rows that come before, by (block, order).

    One window runs inside each block; another runs over one row per block. No
    task sees more than a block, or as many rows as there are blocks.
    """
    blocks = sizes.groupBy(block).agg(F.sum(amount).alias("_sum"))
    ahead = F.sum("_sum").over(Window.orderBy(block)) - F.col("_sum")
    blocks = blocks.select(F.col(block).alias("_block"), ahead.alias("_ahead"))
    inside = F.sum(amount).over(Window.partitionBy(block).orderBy(order)) - F.col(amount)
    return (
        sizes.withColumn("_inside", inside)
        .join(blocks, F.col(block).eqNullSafe(F.col("_block")))
        .withColumn(out, F.col("_ahead") + F.col("_inside"))
        .drop("_block", "_ahead", "_inside")
    )


def smallest_reachable(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components: (node, root) for every node of ``edges`` (a, b), root the least node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014). Each
    step takes a minimum per node, which Spark pre-aggregates before the
    shuffle, and joins it back; AQE splits the rows of a hub. Every round is
    written to the shared folder. Ends when a round changes nothing.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    mark = None
    while True:
        # Large star: all neighbours larger than u move to u's least neighbour.
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        grown = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        grown = grown.where("u <> v").distinct()
        # Small star: smaller neighbours and u itself move to the least of them.
        least = grown.groupBy("u").agg(F.min("v").alias("m"))
        held = grown.join(least, "u")
        small = held.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), label)
        found = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        state = tuple(0 if x is None else int(x) for x in found)
        if state == mark or state[0] == 0:
            break
        mark = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select("v", "v")).distinct()
