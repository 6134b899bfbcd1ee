"""Merge-upsert into a partitioned table that rewrites only the partitions it meets.

The target is stored partitioned (by date or month). Where each staging key
stands in the target is found from the key and partition columns alone; only
those partitions, and the ones that new rows go to, are read whole, merged and
replaced. All other partitions keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.operators.merge import assert_unique_keys, merge_upsert
from lakelayer.sources.partitions import overwrite_partitions
from lakelayer.sources.tables import materialize, read_table


@dataclass
class MergeReport:
    partitions: list          # rewritten, as values of the partition column
    rows: int                 # rows of those partitions after the merge
    staged: int               # rows merged in


def month_of(date: str | Column) -> Column:
    """Partition value of a date: its month, as text."""
    return F.date_format(date, "yyyy-MM")


def home_partitions(target: DataFrame, staging: DataFrame, keys: Sequence[str], partition: str) -> list:
    """Partitions that ``staging`` meets: where its keys stand in ``target``, and where its other rows go.

    ``staging`` has the partition its new rows go to under ``partition``. The
    target is read in the key and partition columns only. The list is bounded by
    the number of the table's partitions.
    """
    wanted = staging.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    on = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    met = target.select(*keys, partition).join(wanted, on, "left_semi").select(partition).distinct()
    parts = met.union(staging.select(partition).distinct()).distinct().collect()
    return sorted((r[0] for r in parts), key=lambda v: (v is None, str(v)))


def in_partitions(column: str, values: Sequence) -> Column:
    """``column`` is one of ``values``, null among them."""
    some = F.col(column).isin([v for v in values if v is not None])
    return some | F.col(column).isNull() if None in values else some


def merge_partitions(spark: SparkSession, path: str, staging: DataFrame, keys: Sequence[str],
                     update_columns: Sequence[str], partition: str, partition_of: Column,
                     insert_columns: Sequence[str] | None = None) -> MergeReport:
    """Merge ``staging`` into the table at ``path``, partitioned by column ``partition``.

    ``partition_of`` gives a new row's partition from its other columns. A row
    that is updated stays in its partition, whatever the staging row's own. The
    staging rows are stored once, narrow, and checked for repeated keys there
    (``DuplicateSourceKeys``, before anything is written). A row's partition
    counts as one of its columns and is never updated. Merging the same rows
    again gives the same table.
    """
    target = read_table(spark, path)
    columns = [c for c in target.columns if c != partition]
    insert_columns = list(insert_columns) if insert_columns is not None else columns
    types = dict(target.dtypes)
    used = [c for c in columns if c in {*keys, *update_columns, *insert_columns}]
    staged, n = materialize(staging.select(*used, partition_of.cast(types[partition]).alias(partition)), "merge-staging")
    assert_unique_keys(staged, keys)
    parts = home_partitions(target, staged, keys, partition)
    if not parts:
        return MergeReport([], 0, n)
    hit = target.where(in_partitions(partition, parts))
    merged = merge_upsert(hit, staged, keys, update_columns, [*insert_columns, partition], check_unique_source=False)
    return MergeReport(parts, overwrite_partitions(merged, path, [partition]), n)
