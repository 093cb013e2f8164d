"""Arithmetic that keeps IEEE semantics under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ieee_divide(num, den) -> Column:
    """``num / den`` with float semantics: x/0 -> +inf or -inf, 0/0 -> NaN.

    ANSI Spark raises DIVIDE_BY_ZERO instead; nulls stay null.
    """
    num, den = _c(num).cast("double"), _c(den).cast("double")
    return (
        F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(den != 0, num / den)
        .when(F.isnan(num) | (num == 0), F.lit(float("nan")))
        .when(num > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )


def pct_change(value, window: WindowSpec) -> Column:
    """Percent change against the most recent non-null earlier value.

    The value itself is forward-filled first, so a null current value gives
    0.0 (after a non-null one) and the first row gives null.
    """
    v = _c(value)
    filled = F.last(v, ignorenulls=True).over(window.rowsBetween(-(1 << 62), 0))
    prev = F.lag(filled, 1).over(window)
    return ieee_divide(filled - prev, prev)


def change_from_previous(value, window: WindowSpec) -> tuple[Column, Column]:
    """Absolute and relative change from the previous row (no filling)."""
    v = _c(value)
    prev = F.lag(v, 1).over(window)
    diff = v - prev
    return diff, ieee_divide(diff, prev)


def finite_or_kind(x) -> tuple[Column, Column]:
    """Split a double into (value with non-finite -> null, kind text)."""
    x = _c(x)
    kind = (F.when(x.isNull(), F.lit("null")).when(F.isnan(x), F.lit("nan"))
            .when(x == float("inf"), F.lit("+inf")).when(x == float("-inf"), F.lit("-inf"))
            .otherwise(F.lit("finite")))
    return F.when(kind == "finite", x), kind
