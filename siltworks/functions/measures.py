"""Expressions used by the reporting tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

TOTAL = "decimal(38,2)"
# sum() widens by ten digits, so summing this type gives TOTAL without overflow.
_SUMMAND = "decimal(28,2)"


def total(c: str) -> Column:
    """Sum of a money column as decimal(38,2)."""
    return F.sum(F.col(c).cast(_SUMMAND))


def mean_money(c: str) -> Column:
    """Average of a money column, rounded once, half away from zero, to cents.

    Divides whole cents: dividing decimals first and casting afterwards would
    round twice.  Shares the running sum with ``total``.
    """
    cents = (total(c) * 100).cast("decimal(38,0)")
    n = F.count(c)
    half_up = F.call_function("div", F.abs(cents) * 2 + n, n * 2)
    sign = F.when(cents < 0, F.lit(-1)).otherwise(F.lit(1))
    return ((sign * half_up).cast("decimal(18,0)") / 100).cast("decimal(10,2)")


def or_zero(c: str | Column, as_type: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0).cast(as_type)).cast(as_type)


def elapsed_days(start: str, end: str) -> Column:
    """Complete 24-hour days between two timestamps, truncated toward zero."""
    return F.timestamp_diff("DAY", F.col(start), F.col(end))


def no_later_than(moment: str, deadline: str) -> Column:
    """True only when both are known and ``moment`` is not after ``deadline``."""
    return F.coalesce(F.col(moment) <= F.col(deadline), F.lit(False))


def moment(as_of: datetime | Column | None) -> Column:
    """The clock as a parameter: a given time, or the time of the query."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
