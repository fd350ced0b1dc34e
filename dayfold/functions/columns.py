"""Column expressions used across operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("day", "week", "month", "quarter", "year")


def money(amount: Column | str, scale: int = 2) -> Column:
    """An exact decimal, so that sums do not depend on how rows are partitioned."""
    return as_column(amount).cast(f"decimal(18,{scale})")


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of(ts: Column | str) -> Column:
    return as_column(ts).cast("date")


def period_start(ts: Column | str, period: str) -> Column:
    """First day of the period that holds ``ts``."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    return day_of(ts) if period == "day" else F.trunc(day_of(ts), period)


def period_index(start: Column | str, period: str) -> Column:
    """A running number for a period start; neighbours differ by one."""
    start = as_column(start)
    months = F.year(start).cast("bigint") * 12 + F.month(start) - 1
    if period == "day":
        return F.unix_date(start).cast("bigint")
    if period == "week":
        # 1970-01-05 was a Monday.
        return F.floor((F.unix_date(start) - 4) / 7).cast("bigint")
    return F.floor(months / {"month": 1, "quarter": 3, "year": 12}[period]).cast("bigint")


def surrogate_key(*keys: str) -> Column:
    """SHA-256 over the business key.

    Every part carries its length, and NULL has a mark of its own, so that no
    two different keys give the same text.
    """
    parts = []
    for key in keys:
        text = F.col(key).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def all_null_safe_equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    condition = pairs[0][0].eqNullSafe(pairs[0][1])
    for left, right in pairs[1:]:
        condition = condition & left.eqNullSafe(right)
    return condition
