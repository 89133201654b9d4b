"""Date helpers.

All of them are built-in expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(end: str | Column, start: str | Column) -> Column:
    """``end - start`` in days as INT (a date difference, not an interval)."""
    return F.datediff(col_(end), col_(start))


def year_start(d: str | Column) -> Column:
    """``date_trunc('year', d)`` kept as DATE."""
    return F.trunc(col_(d), "year")


def year_end(d: str | Column) -> Column:
    """31 December of the year of ``d``."""
    return F.make_date(F.year(col_(d)), F.lit(12), F.lit(31))


def add_years(d: str | Column, n: str | Column | int) -> Column:
    """``d + n years`` (29 Feb falls back to 28 Feb in common years)."""
    n_ = F.lit(n) if isinstance(n, int) else col_(n)
    return F.add_months(col_(d), (n_ * 12).cast("int"))


def yearly_step(start: str | Column, k: str | Column, drift: bool = True) -> Column:
    """The k-th element of a one-year series starting at ``start``.

    With ``drift`` (the warehouse's series semantics) each step adds a year to
    the previous element, so a 29 Feb start becomes 28 Feb from the first step
    on and stays there.  Without it every element is ``start + k years``.
    """
    s, k_ = col_(start), col_(k)
    plain = add_years(s, k_)
    if not drift:
        return plain
    leap_start = (F.month(s) == 2) & (F.dayofmonth(s) == 29)
    return F.when(leap_start & (k_ >= 1),
                  F.make_date(F.year(s) + k_, F.lit(2), F.lit(28))).otherwise(plain)


def parse_month_first(text: str | Column) -> Column:
    """Date literals written ``MM.dd.yyyy`` (month first)."""
    return F.to_date(col_(text), "MM.dd.yyyy")
