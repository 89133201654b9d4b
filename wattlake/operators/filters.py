"""Row predicates and flags with the warehouse's null semantics.

Plain comparisons stay plain ``F`` expressions at the call site; the helpers
here exist where the reference's semantics are easy to get wrong (nulls
counted as zero, null status still valid, open ends, year-blind months).
All of them are Catalyst expressions, so they are pushed into the scan or
fused into whole-stage code.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import INVALID_STATUSES, NO_DATA, OPEN_END, USAGE_OUTLIER_BOUND


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(d: _dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d)


def sentinel_map(col: str | Column, sentinel: str = NO_DATA, value: int = -1,
                 dtype: str = "bigint") -> Column:
    """``CASE WHEN c = sentinel THEN value ELSE c::int END``; null stays null."""
    c = _c(col)
    return F.when(c == sentinel, F.lit(value).cast(dtype)).otherwise(c.cast("int").cast(dtype))


def within_bound(cols: Sequence[str], bound: int = USAGE_OUTLIER_BOUND) -> Column:
    """Every column <= bound, a null counting as 0."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.coalesce(F.col(c), F.lit(0)) <= bound)
    return cond


def outlier_filter(df: DataFrame, cols: Sequence[str] = ("usage", "usagenet"),
                   bound: int = USAGE_OUTLIER_BOUND) -> DataFrame:
    return df.where(within_bound(cols, bound))


def validity_flag(status: str | Column = "status",
                  invalid: Sequence[str] = INVALID_STATUSES) -> Column:
    """FALSE for the listed statuses, TRUE otherwise (null status included)."""
    return F.when(_c(status).isin(*invalid), F.lit(False)).otherwise(F.lit(True))


def active_on(start: str | Column, end: str | Column, on: _dt.date | Column) -> Column:
    """Started on or before ``on`` and ended (null = open) on or after it."""
    d = _d(on)
    return (_c(start) <= d) & (F.coalesce(_c(end), F.lit(OPEN_END)) >= d)


def month_before_matches(snapshot: str | Column, created: str | Column) -> Column:
    """month(snapshot - 1 month) = month(created), year ignored as coded."""
    return F.month(F.add_months(_c(snapshot), -1)) == F.month(_c(created))


def before(col: str | Column, as_of: _dt.date | Column) -> Column:
    """``col < as_of``; the as-of date replaces CURRENT_DATE."""
    return _c(col) < _d(as_of)
