"""Column expressions shared by the operators (all built-in Spark functions).

Nothing here runs Python per row: every helper returns a ``Column`` that
stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quarantine reason tags, in the order the gate applies them.
NULL_REQUIRED_FIELD = "null_required_field"
NON_NUMERIC_VALUE = "non_numeric_value"
DUPLICATE_KEY = "duplicate_key"
QUARANTINE_REASONS = (NULL_REQUIRED_FIELD, NON_NUMERIC_VALUE, DUPLICATE_KEY)
# The gate's own tag, for lines that are not records of the declared schema.
MALFORMED_RECORD = "malformed_record"
REASON_SEPARATOR = ","
REASON_COL = "_dq_failure_reason"

# Characters the legacy string->int cast strips from both ends (code points
# 0 to 32: controls and space), and the plain-decimal shape whose fraction it
# cuts off.
_EDGE_CHARS = "".join(chr(i) for i in range(0x21))
_PLAIN_DECIMAL = r"^[+-]?[0-9]*[.][0-9]*$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(conditions: Iterable[Column]) -> Column | None:
    """OR-fold a list of conditions; ``None`` for an empty list (check skipped)."""
    conditions = list(conditions)
    if not conditions:
        return None
    return reduce(lambda a, b: a | b, conditions)


def is_blank(c: str | Column) -> Column:
    """Required-field failure: null, or empty after trimming spaces."""
    c = col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def is_non_numeric(c: str | Column) -> Column:
    """Present but not parseable as a double (``try_cast`` keeps ANSI mode on)."""
    c = col(c)
    return c.isNotNull() & c.try_cast("double").isNull()


def append_reason(reason: Column, condition: Column, tag: str,
                  legacy_prefix: bool = False) -> Column:
    """Append ``tag`` to a comma-separated reason when ``condition`` holds.

    ``concat_ws`` skips a null reason, so the first tag has no leading comma.
    ``legacy_prefix=True`` turns the null reason into ``""`` first, which keeps
    the empty leading field (``",duplicate_key"``) of the original job.
    """
    base = F.coalesce(reason, F.lit("")) if legacy_prefix else reason
    return F.when(condition, F.concat_ws(REASON_SEPARATOR, base, F.lit(tag))).otherwise(reason)


def to_int_truncating(c: str | Column) -> Column:
    """String -> int with the legacy (non-ANSI) cast's results, null on failure.

    The legacy cast accepts a plain decimal such as ``"2.5"`` and cuts the
    fraction (2), while ``try_cast("int")`` returns null for it. Strip control
    characters and spaces at both ends, reduce a plain decimal to its sign and
    integer digits (``"0"`` when there are none), then ``try_cast``. Exponents,
    suffixes such as ``"1d"``, NaN and overflow stay null. One ``rlike`` is
    the only regular expression: the expression is cheap enough to inline
    wherever the optimizer copies it (join conditions get no common
    subexpression elimination).
    """
    stripped = F.trim(col(c).cast("string"), F.lit(_EDGE_CHARS))
    head = F.substring_index(stripped, ".", 1)  # sign and integer digits of a plain decimal
    whole = F.when(head.isin("", "+", "-"), F.lit("0")).otherwise(head)
    candidate = F.when(stripped.rlike(_PLAIN_DECIMAL), whole).otherwise(stripped)
    return candidate.try_cast("int")


def to_double(c: str | Column) -> Column:
    """String -> double, null on failure."""
    return col(c).try_cast("double")


def money_text(c: str | Column) -> Column:
    """``$1,234.50`` style text."""
    return F.concat(F.lit("$"), F.format_number(col(c), 2))


def percent_text(c: str | Column) -> Column:
    """``0.71`` style text (two decimals, no grouping)."""
    return F.format_string("%.2f", col(c))


# Amounts from here on do not fit decimal(18,2).
MONEY_LIMIT = 1e16
# From MONEY_LIMIT up to here amounts are whole numbers (as all doubles of that size are), summed apart.
HUGE_LIMIT = 1e26


def _below(c: Column, limit: float) -> Column:
    """A finite amount under ``limit`` (a comparison with NaN counts NaN as the greatest)."""
    return F.abs(c) < F.lit(limit)


def is_beyond_money(c: str | Column) -> Column:
    """A number too large for decimal(18,2), or not finite."""
    return F.coalesce(~_below(col(c).try_cast("double"), MONEY_LIMIT), F.lit(False))


def _money_parts(c: Column) -> dict[str, Column]:
    """An amount in one of three columns: two decimals, whole number, or a double (huge or not finite)."""
    return {
        "cents": F.when(_below(c, MONEY_LIMIT), c.try_cast("decimal(18,2)")),
        "whole": F.when(_below(c, HUGE_LIMIT) & ~_below(c, MONEY_LIMIT), c.try_cast("decimal(27,0)")),
        "rest": F.when(~_below(c, HUGE_LIMIT), c),
    }


def _together(sums: list[Column]) -> Column:
    """The parts' sums as one double; null where no part has any amount."""
    any_part = F.coalesce(*[s.cast("double") for s in sums])
    total = reduce(lambda a, b: a + b, [F.coalesce(s.cast("double"), F.lit(0.0)) for s in sums])
    return F.when(any_part.isNotNull(), total)


def money_partials(c: str | Column, name: str) -> list[Column]:
    """Aggregates that ``money_total`` completes: the sum of each part."""
    return [F.sum(part).alias(f"{name}_{kind}") for kind, part in _money_parts(col(c)).items()]


def money_total(name: str) -> Column:
    """Sum of groups aggregated with ``money_partials``."""
    return _together([F.sum(f"{name}_{kind}") for kind in ("cents", "whole", "rest")])


def exact_money_sum(c: str | Column) -> Column:
    """Sum of doubles that does not depend on the order of rows, for amounts below ``HUGE_LIMIT``.

    A double sum depends on the order rows arrive in; sums of decimals do not.
    Amounts below ``MONEY_LIMIT`` are summed with two decimals, those up to
    ``HUGE_LIMIT`` as whole numbers, so that large amounts that cancel out leave
    the small ones exact. NaN and infinities give what a double sum gives. Only
    finite amounts beyond ``HUGE_LIMIT`` are summed as doubles.
    """
    return _together([F.sum(part) for part in _money_parts(col(c)).values()])
