"""Predicates and small derived columns used by the quality and fact operators."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a plain non-negative decimal number (digits, optional fraction).
NUMBER_PATTERN = r"^[0-9]+(\.[0-9]+)?$"


def any_null(cols) -> Column:
    """True when any of ``cols`` is NULL (OR fold)."""
    return reduce(or_, [F.col(c).isNull() for c in cols])


def invalid_number(c: str, pattern: str = NUMBER_PATTERN) -> Column:
    """True when a non-NULL value's text does not match ``pattern``.

    NULL stays NULL (so it is not reported as a format error: that is the
    job of the null check)."""
    return ~F.col(c).cast("string").rlike(pattern)


def month_of(ts: str | Column) -> Column:
    """First day of the month of a timestamp, as a DATE."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(F.to_date(c), "month")


def month_range(lo, hi, month_col: str = "transaction_month", ts_col: str | None = "transaction_date_time"):
    """Predicate for ``lo <= ts < hi`` on a month-partitioned table, stated on
    the partition column as well (a generated partition column's filter is
    not inferred for parquet tables), so whole months are pruned.  ``lo`` /
    ``hi`` are zone-free timestamp texts or datetimes; either may be None."""
    from lakeloom.operators.casting import ts_literal
    conds = []
    if lo is not None:
        conds.append(F.col(month_col) >= F.trunc(F.to_date(ts_literal(lo)), "month"))
        if ts_col:
            conds.append(F.col(ts_col) >= ts_literal(lo))
    if hi is not None:
        conds.append(F.col(month_col) <= F.trunc(F.to_date(ts_literal(hi)), "month"))
        if ts_col:
            conds.append(F.col(ts_col) < ts_literal(hi))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)
