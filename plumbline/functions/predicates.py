"""Column expressions shared by checks, profiles, defects and repairs; all built-in, inside code generation."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats, sentinels and tolerances the checks are stated in.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
OPEN_END = dt.date(9999, 12, 31)
CENT = Decimal("0.01")


def anchored(pattern: str) -> str:
    """Java's ``$`` also matches before a trailing newline; ``\\z`` is the strict end of text."""
    if pattern.endswith("$") and not pattern.endswith(r"\$"):
        return pattern[:-1] + r"\z"
    return pattern


def as_date(as_of: dt.date | str | None) -> Column:
    """``as_of`` as a date column; the current date only when nothing is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def literal(value) -> Column:
    """A number as an exact decimal or integer literal, so that no bound is compared in floating point."""
    if isinstance(value, float):
        return F.lit(Decimal(str(value)))
    return F.lit(value)


def bound(value, as_of=None, data_type: str = "") -> Column:
    """A bound of a range check: number, ISO date, or the word ``today``."""
    if value == "today":
        return as_date(as_of)
    if isinstance(value, str) and data_type == "string":
        return F.lit(value)
    if isinstance(value, str):
        return F.lit(value).cast(data_type if data_type in ("date", "timestamp", "timestamp_ntz") else "date")
    return literal(value)


def outside(value: Column, low: Column | None, high: Column | None) -> Column:
    """True when a non-null value lies outside the inclusive range; NULL for NULL."""
    tests = ([value < low] if low is not None else []) + ([value > high] if high is not None else [])
    if not tests:
        return F.lit(False)
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def computed_revenue() -> Column:
    return F.col("quantity") * F.col("unit_price") - F.col("discount_amount")


def computed_profit() -> Column:
    return F.col("net_revenue") - F.col("quantity") * F.col("unit_cost")


def revenue_gap() -> Column:
    return F.abs(F.col("net_revenue") - computed_revenue())


def profit_gap() -> Column:
    return F.abs(F.col("gross_profit") - computed_profit())


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Exact decimal percentage, rounded half up, NULL for an empty whole."""
    share = F.lit(100) * part.cast("decimal(18,0)") / F.nullif(whole.cast("decimal(18,0)"), F.lit(0))
    return F.round(share, digits).cast("double")


def rounded(value: Column, digits: int) -> Column:
    """Rounded double without a negative zero."""
    return F.round(value, digits).cast("double") + F.lit(0.0)
