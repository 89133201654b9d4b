"""Join helpers: broadcast only behind a size check.

Spark's static broadcast decision rests on estimated sizes, which can be
far off after explodes (too small) or joins (too large), and AQE can only
demote a shuffle join that has not started yet.  For sides that are
bounded by the catalogue (prices, products), the size is checked instead:
a count (one number per task, added up) decides between a broadcast and the
ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bound: about a million narrow rows (tens of MB) per broadcast.
DEFAULT_MAX_ROWS = 1_000_000


def rows_at_most(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A two-phase count: a global limit would send every task's rows to one.
    """
    return df.count() <= max_rows


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df
