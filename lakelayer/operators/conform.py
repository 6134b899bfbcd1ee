"""Silver conform steps and the warehouse conform-and-cast step.

* C6 ``clean_and_cast_transactions``: typed measures, one row per id.
* D2 ``conform_reference_table``: one row per non-null key.
* C7 ``conform_reference_tables``: D2 over every reference table.
* P6 ``conform_to_schema``: select by name, cast to the target types, and
  report (not drop) rows that break a NOT NULL column or fail a cast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lakelayer.functions.exprs import to_double, to_int_truncating
from lakelayer.schemas import REFERENCE_KEYS, TEXT_LENGTHS


def clean_and_cast_transactions(df: DataFrame, key: str = "transaction_id",
                                dedupe: bool = True) -> DataFrame:
    """``quantity`` -> int (fraction cut), ``unit_price`` -> double, one row per key.

    ``dropDuplicates`` is a partial aggregate, so a hot key is collapsed
    map-side. When the quality gate already quarantined every repeated
    ``key`` the dedupe is a no-op; ``dedupe=False`` lets the layer plan skip
    its shuffle in that case.
    """
    out = (
        df.withColumn("quantity", to_int_truncating("quantity"))
        .withColumn("unit_price", to_double("unit_price"))
    )
    return out.dropDuplicates([key]) if dedupe else out


def latest_per_key(df: DataFrame, keys: Iterable[str], order_by: Iterable[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties broken by the rest.

    Expressed as ``max(struct(order_by..., other columns...))`` per key, an
    aggregate Spark computes partially on the map side, so a key holding a
    third of all rows costs one partial row per map task, not a one-task sort.
    Nulls order below values, as with ``ORDER BY ... DESC NULLS LAST``.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest]).alias("_latest")
    best = df.groupBy(*keys).agg(F.max(packed).alias("_latest"))
    return best.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in order_by + rest]).select(*df.columns)


def conform_reference_table(df: DataFrame, key: str, order_by: Iterable[str] | None = None) -> DataFrame:
    """Drop null keys, keep one row per key.

    Without ``order_by`` any row of a repeated key may survive (``dropDuplicates``).
    With it the survivor is the greatest row by those columns, fully
    tie-broken, so reruns give the same table. Columns that ``df`` lacks (an
    ingest time before stamping) are passed over.
    """
    keyed = df.where(F.col(key).isNotNull())
    if order_by is None:
        return keyed.dropDuplicates([key])
    return latest_per_key(keyed, [key], [c for c in order_by if c in df.columns])


def conform_reference_tables(tables: Mapping[str, DataFrame],
                             keys: Mapping[str, str] = REFERENCE_KEYS,
                             order_by: Mapping[str, Iterable[str]] | None = None) -> dict[str, DataFrame]:
    """D2 over every reference table present in ``tables``."""
    order_by = order_by or {}
    return {name: conform_reference_table(tables[name], key, order_by.get(name))
            for name, key in keys.items() if name in tables}


@dataclass
class ConformResult:
    rows: DataFrame          # input rows, selected by name and cast (nullable)
    violations: DataFrame    # rows that break the target, with ``_violation``


def conform_to_schema(df: DataFrame, schema: StructType, violation_col: str = "_violation",
                      lengths: Mapping[str, int] = TEXT_LENGTHS, on_violation: str = "report") -> ConformResult:
    """Select the target columns by name, cast, and report violations.

    Extra input columns (ingest metadata) are dropped; a missing one raises
    ``ValueError``. Reported are a cast that fails or overflows (``try_cast``
    gives null for a non-null input), a null in a NOT NULL column, and text
    longer than ``lengths`` allows. ``on_violation="report"`` keeps every input
    row in ``rows``, whose fields are all nullable; ``"reject"`` keeps only rows
    without violation.
    """
    if on_violation not in ("report", "reject"):
        raise ValueError(f"unknown on_violation {on_violation!r}")
    if missing := [c for c in schema.fieldNames() if c not in df.columns]:
        raise ValueError(f"input lacks columns {missing}")
    casts, problems = [], []
    for field in schema.fields:
        src = F.col(field.name)
        if df.schema[field.name].dataType == field.dataType:
            value = src
        else:
            value = src.try_cast(field.dataType)
            problems.append((src.isNotNull() & value.isNull(), f"cast_failed:{field.name}"))
        if not field.nullable:
            problems.append((value.isNull(), f"null_in_not_null:{field.name}"))
        if isinstance(field.dataType, StringType) and field.name in lengths:
            problems.append((F.coalesce(F.length(value) > lengths[field.name], F.lit(False)), f"too_long:{field.name}"))
        casts.append(value.alias(field.name))
    if not problems:
        rows = df.select(*casts)
        return ConformResult(rows, rows.withColumn(violation_col, F.lit(None).cast("string")).limit(0))
    # Filter on a plain OR of the checks; spell out the reasons only for the
    # rows that fail (the filter may be pushed into a join condition, where a
    # cheap predicate matters). Every check is true or false, never null.
    fails = reduce(lambda a, b: a | b, [cond for cond, _ in problems])
    reason = F.concat_ws(",", *[F.when(cond, F.lit(text)) for cond, text in problems])
    violations = df.where(fails).select(*casts, reason.alias(violation_col))
    rows = (df if on_violation == "report" else df.where(~fails)).select(*casts)
    return ConformResult(rows, violations)
