"""Data-quality gate: tag rows with failure reasons, then split clean from bad.

The gate applies three checks in a fixed order (required fields, numeric
fields, duplicate keys) and appends one tag per failed check to
``_dq_failure_reason``. Rows with a reason are quarantined with the reason;
the rest continue without the column.

Scale notes
-----------
* The null and numeric tags are projections; Catalyst collapses them into one
  ``Project`` inside the scan's codegen stage.
* The duplicate tag counts keys with a *partial* aggregate over the key columns
  (``groupBy(keys).count()``), so a key that holds a third of all rows is
  reduced map-side before the shuffle, and joins the repeated keys back. It is
  one lazy plan at any size: AQE broadcasts the repeated keys when their bytes
  are few, else sort-merges and splits the hot key's rows over tasks.
  The window form (``method="window"``) shuffles every row and puts all rows of
  one key in one task; it is kept for comparison only.
* Metrics are one aggregate (``count(*)``, ``count(reason)``) over the tagged
  frame; the layer plans gather them with ``observe`` during the write instead
  of a second pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.functions.exprs import (
    DUPLICATE_KEY,
    MALFORMED_RECORD,
    NON_NUMERIC_VALUE,
    NULL_REQUIRED_FIELD,
    REASON_COL,
    any_of,
    append_reason,
    is_beyond_money,
    is_blank,
    is_non_numeric,
    to_int_truncating,
)
from lakelayer.schemas import CORRUPT_RECORD

_DUP_FLAG = "_dq_dup"


@dataclass(frozen=True)
class QualityRules:
    """Which columns each check covers, and the alert threshold in percent."""

    not_null_columns: tuple[str, ...] = ()
    numeric_columns: tuple[str, ...] = ()
    unique_columns: tuple[str, ...] = ()
    max_quarantine_pct: float = 5.0
    # Strict types: numeric columns that silver casts to int. A value that
    # parses as a number but not as an int ("1e3", "NaN", overflow) then fails
    # the numeric check instead of becoming a null quantity in silver.
    integer_columns: tuple[str, ...] = ()
    # Strict types: amounts that are not finite, or too large to sum exactly, fail too.
    money_columns: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, rules: Mapping) -> "QualityRules":
        return cls(
            not_null_columns=tuple(rules.get("not_null_columns", ())),
            numeric_columns=tuple(rules.get("numeric_columns", ())),
            unique_columns=tuple(rules.get("unique_columns", ())),
            max_quarantine_pct=float(rules.get("max_quarantine_pct", 5.0)),
            integer_columns=tuple(rules.get("integer_columns", ())),
            money_columns=tuple(rules.get("money_columns", ())),
        )


# The rule set configured for raw transactions.
TRANSACTION_RULES = QualityRules(
    not_null_columns=("transaction_id", "transaction_ts", "store_id", "product_id",
                      "quantity", "unit_price"),
    numeric_columns=("quantity", "unit_price"),
    unique_columns=("transaction_id",),
    max_quarantine_pct=5.0,
)


# The same rules with strict types: quantity must cast to int, unit_price be finite and below MONEY_LIMIT.
STRICT_TRANSACTION_RULES = QualityRules(
    not_null_columns=TRANSACTION_RULES.not_null_columns,
    numeric_columns=TRANSACTION_RULES.numeric_columns,
    unique_columns=TRANSACTION_RULES.unique_columns,
    max_quarantine_pct=TRANSACTION_RULES.max_quarantine_pct,
    integer_columns=("quantity",),
    money_columns=("unit_price",),
)


class QuarantineRateExceeded(RuntimeError):
    """Raised by ``enforce_threshold`` when the bad-row rate is above the limit."""


def _with_reason(df: DataFrame, reason_col: str) -> DataFrame:
    if reason_col in df.columns:
        return df
    return df.withColumn(reason_col, F.lit(None).cast("string"))


def _tag(df: DataFrame, condition: Column | None, tag: str, reason_col: str,
         legacy_prefix: bool) -> DataFrame:
    df = _with_reason(df, reason_col)
    if condition is None:  # empty column list: the check is skipped
        return df
    return df.withColumn(reason_col, append_reason(F.col(reason_col), condition, tag, legacy_prefix))


def tag_null_check(df: DataFrame, not_null_columns: Iterable[str], reason_col: str = REASON_COL,
                   legacy_prefix: bool = False) -> DataFrame:
    """Tag ``null_required_field`` once per row if any listed column is null or blank."""
    return _tag(df, any_of(is_blank(c) for c in not_null_columns), NULL_REQUIRED_FIELD,
                reason_col, legacy_prefix)


def tag_numeric_check(df: DataFrame, numeric_columns: Iterable[str], reason_col: str = REASON_COL,
                      legacy_prefix: bool = False, integer_columns: Iterable[str] = (),
                      money_columns: Iterable[str] = ()) -> DataFrame:
    """Tag ``non_numeric_value`` if any listed column is present but not a number.

    Columns also in ``integer_columns`` must in addition cast to int, and those
    in ``money_columns`` be finite and below the exact limit (strict types).
    """
    integer_columns = set(integer_columns)
    checks = [is_non_numeric(c) | (F.col(c).isNotNull() & to_int_truncating(c).isNull())
              if c in integer_columns else is_non_numeric(c) for c in numeric_columns]
    checks += [is_beyond_money(c) for c in money_columns]
    return _tag(df, any_of(checks), NON_NUMERIC_VALUE, reason_col, legacy_prefix)


def tag_malformed_check(df: DataFrame, corrupt_col: str = CORRUPT_RECORD, reason_col: str = REASON_COL,
                        legacy_prefix: bool = False) -> DataFrame:
    """Tag ``malformed_record`` where bronze kept the line of a record that does not fit its schema."""
    return _tag(df, F.col(corrupt_col).isNotNull(), MALFORMED_RECORD, reason_col, legacy_prefix)


def duplicate_keys(df: DataFrame, unique_columns: Iterable[str]) -> DataFrame:
    """Keys that occur more than once (null is a key value), one row each.

    ``groupBy().count()`` is planned as partial + final aggregate, so however
    many rows share one key, only one partial count per map task and key is
    shuffled.
    """
    keys = list(unique_columns)
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_dq_n"))
        .where(F.col("_dq_n") > 1)
        .select(*[F.col(k).alias(f"_dq_key{i}") for i, k in enumerate(keys)],
                F.lit(True).alias(_DUP_FLAG))
    )


def mark_duplicates(df: DataFrame, unique_columns: Iterable[str], method: str = "aggregate",
                    flag_col: str = "_dq_is_duplicate") -> DataFrame:
    """Add boolean ``flag_col``: true on *every* copy of a repeated key.

    ``method="aggregate"`` (default): the repeated keys are found with a
    partial aggregate over the key columns only and joined back null-safely,
    without a hint, a job or a stored table. ``df`` is planned twice, so it must
    be deterministic (a table is).
    ``method="window"``: ``count(*) over (partition by keys)``, which sends
    every row of one key to one task.
    """
    keys = list(unique_columns)
    if not keys:
        return df.withColumn(flag_col, F.lit(False))
    if method == "window":
        from pyspark.sql.window import Window

        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        return df.withColumn(flag_col, n > 1)
    if method != "aggregate":
        raise ValueError(f"unknown duplicate method {method!r}")
    dups = duplicate_keys(df, keys)
    cond = [F.col(k).eqNullSafe(F.col(f"_dq_key{i}")) for i, k in enumerate(keys)]
    joined = df.join(dups, cond, "left")
    return joined.select(*[F.col(c) for c in df.columns],
                         F.coalesce(F.col(_DUP_FLAG), F.lit(False)).alias(flag_col))


def tag_duplicate_check(df: DataFrame, unique_columns: Iterable[str], reason_col: str = REASON_COL,
                        legacy_prefix: bool = False, method: str = "aggregate") -> DataFrame:
    """Tag ``duplicate_key`` on every copy of a repeated (composite) key."""
    keys = list(unique_columns)
    df = _with_reason(df, reason_col)
    if not keys:
        return df
    flagged = mark_duplicates(df, keys, method=method, flag_col="_dq_dup_flag")
    return (
        flagged.withColumn(reason_col, append_reason(F.col(reason_col), F.col("_dq_dup_flag"),
                                                     DUPLICATE_KEY, legacy_prefix))
        .drop("_dq_dup_flag")
    )


def tag_quality(df: DataFrame, rules: QualityRules, reason_col: str = REASON_COL,
                legacy_prefix: bool = False, duplicate_method: str = "aggregate") -> DataFrame:
    """All rows, each with its reason (null when the row passed every check)."""
    tagged = df.withColumn(reason_col, F.lit(None).cast("string"))
    tagged = tag_null_check(tagged, rules.not_null_columns, reason_col, legacy_prefix)
    tagged = tag_numeric_check(tagged, rules.numeric_columns, reason_col, legacy_prefix,
                               rules.integer_columns, rules.money_columns)
    return tag_duplicate_check(tagged, rules.unique_columns, reason_col, legacy_prefix,
                               method=duplicate_method)


def split_tagged(tagged: DataFrame, reason_col: str = REASON_COL) -> tuple[DataFrame, DataFrame]:
    """(clean without the reason column, quarantined with it)."""
    quarantined = tagged.where(F.col(reason_col).isNotNull())
    clean = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    return clean, quarantined


def gate_metrics(tagged: DataFrame, max_quarantine_pct: float = 5.0,
                 reason_col: str = REASON_COL) -> DataFrame:
    """One row ``total_rows, quarantined_rows, quarantine_pct, status``.

    ``status`` is ``ALERT`` when the percentage is strictly above the limit;
    an empty input gives 0 % and ``OK``.
    """
    counts = tagged.agg(F.count(F.lit(1)).alias("total_rows"),
                        F.count(reason_col).alias("quarantined_rows"))
    return metrics_frame(counts, max_quarantine_pct)


def metrics_frame(counts: DataFrame, max_quarantine_pct: float) -> DataFrame:
    pct = (
        F.when(F.col("total_rows") > 0,
               F.col("quarantined_rows").cast("double") / F.col("total_rows").cast("double")
               * F.lit(100.0))
        .otherwise(F.lit(0.0))
    )
    return (
        counts.withColumn("quarantine_pct", pct)
        .withColumn("max_quarantine_pct", F.lit(float(max_quarantine_pct)))
        .withColumn("status", F.when(F.col("quarantine_pct") > F.col("max_quarantine_pct"),
                                     F.lit("ALERT")).otherwise(F.lit("OK")))
    )


def enforce_threshold(total_rows: int, quarantined_rows: int, max_quarantine_pct: float,
                      fail_on_alert: bool = False, logger=None) -> tuple[float, str]:
    """Log the gate result; raise when asked to fail on an alert."""
    pct = (quarantined_rows / total_rows * 100.0) if total_rows else 0.0
    status = "ALERT" if pct > max_quarantine_pct else "OK"
    if logger is not None:
        logger.info("gate: %d of %d rows set aside, %.2f%%", quarantined_rows, total_rows, pct)
        if status == "ALERT":
            logger.warning("gate alert: %.2f%% set aside, limit %.2f%%", pct, max_quarantine_pct)
    if status == "ALERT" and fail_on_alert:
        raise QuarantineRateExceeded(
            f"quarantine rate {pct:.2f}% exceeds threshold {max_quarantine_pct:.2f}%")
    return pct, status


@dataclass
class GateResult:
    tagged: DataFrame
    clean: DataFrame
    quarantined: DataFrame
    metrics: DataFrame


def run_quality_gate(df: DataFrame, rules: QualityRules | Mapping = TRANSACTION_RULES,
                     reason_col: str = REASON_COL, legacy_prefix: bool = False,
                     duplicate_method: str = "aggregate") -> GateResult:
    """C4: tag in order null, numeric, duplicate; split; describe (all lazy)."""
    if not isinstance(rules, QualityRules):
        rules = QualityRules.from_mapping(rules)
    tagged = tag_quality(df, rules, reason_col, legacy_prefix, duplicate_method)
    clean, quarantined = split_tagged(tagged, reason_col)
    return GateResult(tagged, clean, quarantined,
                      gate_metrics(tagged, rules.max_quarantine_pct, reason_col))


def quarantine_by_reason(quarantined: DataFrame, reason_col: str = REASON_COL) -> DataFrame:
    """Row count per distinct reason text."""
    return quarantined.groupBy(F.col(reason_col).alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count"))
