"""Exact decimal arithmetic for proration.

Spark keeps at least 6 fractional digits in a decimal quotient and, when
operands are wide, drops scale before the caller rounds.  So inputs are
narrowed first - prices to ``decimal(18,10)`` (prices below 10^8 with up to
ten decimals), day counts to ``decimal(6,0)`` or ``decimal(7,0)`` for sums,
quantities (INT) to ``decimal(10,0)`` - products are taken before quotients, and
each quotient keeps at least 12 digits before the single final rounding,
half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(18,10)"
DAYS = "decimal(6,0)"
TOTAL_DAYS = "decimal(7,0)"
QTY = "decimal(10,0)"  # consumption is an INT


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def day_share(days: str | Column, total: str | Column, scale: int = 6) -> Column:
    """round(days / nullif(total, 0), scale): a quotient of two day counts."""
    return F.round(col_(days).cast(DAYS).cast("decimal(16,10)")
                   / nullif_zero(col_(total).cast(TOTAL_DAYS)), scale)


def amount_share(amount: str | Column, days: str | Column, total: str | Column,
                 scale: int = 6) -> Column:
    """round(amount * days / nullif(total, 0), scale), multiplying first."""
    return F.round(col_(amount).cast(PRICE) * col_(days).cast(DAYS)
                   / nullif_zero(col_(total).cast(TOTAL_DAYS)), scale)


def per_year_of_days(qty_days: Column, scale: int = 6, amount: Column | None = None,
                     divisor: int = 365) -> Column:
    """round([amount *] qty_days / divisor, scale); qty_days is an exact integer."""
    if amount is None:
        return F.round(qty_days.cast("decimal(26,10)") / F.lit(divisor).cast("decimal(5,0)"), scale)
    return F.round(amount.cast(PRICE) * qty_days / F.lit(divisor).cast("decimal(5,0)"), scale)
