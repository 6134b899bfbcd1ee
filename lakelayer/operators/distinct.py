"""Exact distinct counts that can be stored and merged: bitmaps over dense ids.

A ``count(distinct)`` per group cannot be added up over groups: a key that
stands in two of them counts twice. A bitmap of the keys can be merged instead.
Every key gets a number (``dense_ids``), each group keeps one bitmap for each
stretch of numbers it uses (``distinct_bitmaps``), and the count over any union
of groups is the number of bits of their bitmaps taken together
(``merged_counts``), without reading the rows again.

Numbers are given in blocks, by a column that groups follow (the day), so that
a group's keys lie close together and its bitmaps are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET, BITMAP = "_bucket", "_bitmap"
SPLIT = 64  # parts of a block, so that a block with a third of all keys is not one task's


def dense_ids(rows: DataFrame, key: str, block: str, out: str = "_id", split: int = SPLIT) -> DataFrame:
    """(key, out) for every distinct non-null ``key``: numbers from 0 without gaps, in order of the key's first block.

    Keys of a block are dealt to ``split`` parts; one window numbers each part,
    another runs over the part sizes (as many rows as blocks times parts).
    """
    keys = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(block).alias("_block"))
    keys = keys.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(split)))
    sizes = keys.groupBy("_block", "_part").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy(F.col("_block").asc_nulls_first(), "_part")
    before = sizes.select(F.col("_block").alias("_b"), F.col("_part").alias("_p"),
                          (F.sum("_n").over(order) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_block", "_part").orderBy(key)) - 1
    numbered = keys.withColumn("_inside", inside).join(
        before, F.col("_block").eqNullSafe(F.col("_b")) & (F.col("_part") == F.col("_p")))
    return numbered.select(key, (F.col("_before") + F.col("_inside")).cast("long").alias(out))


def distinct_bitmaps(rows: DataFrame, groups: Sequence[str], id_column: str = "_id") -> DataFrame:
    """``groups``, ``_bucket``, ``_bitmap``: which ids each group has, one row for each 32,768 numbers it uses.

    Rows without an id have no bit; a group of such rows alone has a row with a null bucket.
    """
    # bitmap_bucket_number counts from 1, bit positions from 0, so an id of 0 is bit 0 of bucket 1 as id + 1.
    one = F.col(id_column) + 1
    bits = rows.withColumn(BUCKET, F.bitmap_bucket_number(one)).withColumn("_bit", F.bitmap_bit_position(one))
    return bits.groupBy(*groups, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITMAP))


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser ``groups``: the union of those that fall in each."""
    return bitmaps.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def merged_counts(bitmaps: DataFrame, groups: Sequence[str], out: str = "distinct_keys") -> DataFrame:
    """Distinct ids of each of ``groups``, from stored bitmaps of the same or finer groups."""
    bits = F.when(F.col(BUCKET).isNotNull(), F.bitmap_count(BITMAP)).otherwise(F.lit(0))
    counted = merge_bitmaps(bitmaps, groups).withColumn("_bits", bits)
    total = F.sum("_bits").cast("long").alias(out)
    return counted.groupBy(*groups).agg(total) if groups else counted.agg(F.coalesce(total, F.lit(0)).alias(out))
