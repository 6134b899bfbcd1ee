"""Keyed merge-upsert of a staging frame into a target table (no MERGE INTO needed).

Semantics, matching a SQL ``MERGE ... WHEN MATCHED THEN UPDATE SET <cols>
WHEN NOT MATCHED THEN INSERT (<cols>)``:

* target row whose key matches a source row: the update columns take the
  source values (a null is applied, not skipped); other columns stay;
* source row with no match: inserted with the insert columns, other target
  columns null;
* target row with no match: kept unchanged;
* a null key never matches.

Plan: one full outer join on the key, each side read and shuffled once, with a
flag on each side telling which rows were there. Rows with a null key part are
spread over partitions with a deterministic salt on both sides, since they can
never match and would otherwise all hash to one task. AQE does not split a full
outer join; that is safe because the source's keys are checked to be unique and
a target that merges keep up has unique keys too. Small sources are broadcast
by Spark only where the join type allows it, never by force.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_SALT_BUCKETS = 1024


class DuplicateSourceKeys(ValueError):
    """A key occurs more than once in the merge source (the update would be ambiguous)."""


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a non-null key repeats in ``source`` (one bounded action)."""
    keyed = source.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    repeated = keyed.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if repeated:
        raise DuplicateSourceKeys(f"merge source repeats key {repeated[0].asDict()}")


def _all_not_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def _null_key_salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 when every key part is set; else 1 + a hash bucket of the whole row."""
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(_SALT_BUCKETS)) + 1
    return F.when(_all_not_null(keys), F.lit(0).cast("long")).otherwise(bucket)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_columns: Sequence[str], insert_columns: Sequence[str] | None = None,
                 check_unique_source: bool = True) -> DataFrame:
    """M1: the target after merging ``source`` into it (nothing is written to the target).

    Lazy but for the check that the source's keys are unique. The target's
    column types stay: source values are cast to them, and with ANSI mode on
    (Spark's default) a value that does not fit fails the merge.
    """
    keys = list(keys)
    insert_columns = list(insert_columns) if insert_columns is not None else list(target.columns)
    missing = [c for c in set(update_columns) | set(insert_columns) | set(keys) if c not in source.columns]
    if missing:
        raise ValueError(f"merge source lacks columns {sorted(missing)}")
    if check_unique_source:
        assert_unique_keys(source, keys)

    types = {f.name: f.dataType for f in target.schema.fields}
    used = [c for c in target.columns if c in {*keys, *update_columns, *insert_columns}]
    src = source.select(*[F.col(c).cast(types[c]).alias(f"_s_{c}") for c in used],
                        _null_key_salt(source, keys).alias("_s_salt"), F.lit(True).alias("_in_source"))
    tgt = target.withColumn("_t_salt", _null_key_salt(target, keys)).withColumn("_in_target", F.lit(True))
    on = [F.col(k) == F.col(f"_s_{k}") for k in keys] + [F.col("_t_salt") == F.col("_s_salt")]
    joined = tgt.join(src, on, "full_outer")
    old, new = F.col("_in_target").isNotNull(), F.col("_in_source").isNotNull()

    def merged(c: str) -> Column:
        inserted = F.col(f"_s_{c}") if c in insert_columns or c in keys else F.lit(None).cast(types[c])
        kept = F.when(new, F.col(f"_s_{c}")).otherwise(F.col(c)) if c in update_columns else F.col(c)
        return F.when(old, kept).otherwise(inserted).alias(c)

    return joined.select(*[merged(c) for c in target.columns])


def merge_fact_sales(target: DataFrame, staging: DataFrame, check_unique_source: bool = True) -> DataFrame:
    """The warehouse load's fact merge: key ``transaction_id``; update quantity,
    unit_price, revenue; insert all nine columns."""
    from lakelayer.schemas import FACT_SALES_COLUMNS, FACT_SALES_MERGE_UPDATES

    return merge_upsert(target, staging, ["transaction_id"], FACT_SALES_MERGE_UPDATES,
                        FACT_SALES_COLUMNS, check_unique_source)
