"""Deduplication and "latest row per key" (D1, E1, E4, E5).

``latest_per_key`` is a grouped ``max_by`` over a struct of ordering
columns rather than a ``row_number`` window: the aggregate is partial, so
duplicates of a hot key are combined on the map side before anything is
shuffled, and no task ever receives a whole unbounded group.  The ordering
struct must be a total order for the result to be deterministic; callers
pass full tie-breaks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW = "__row"


def _ord_field(c: str | Column, i: int) -> Column:
    return (F.col(c) if isinstance(c, str) else c).alias(f"o{i}")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order`` tuple.

    Equivalent to ``DISTINCT ON (keys) ... ORDER BY keys, order DESC`` with
    nulls ordered last, i.e. ``row_number() over (partition by keys order by
    order desc nulls last) = 1``.  Output columns keep the input order.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[_ord_field(c, i) for i, c in enumerate(order)])
    agg = (df.groupBy(*keys)
             .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), ordering).alias(_ROW)))
    return agg.select(*[F.col(c) for c in keys], *[F.col(f"{_ROW}.{c}").alias(c) for c in payload]) \
              .select(*df.columns)


def dedup_max_lineage(df: DataFrame, business_cols: Sequence[str],
                      lineage_col: str = "source_table") -> DataFrame:
    """Collapse rows equal on every business column; keep the newest lineage."""
    return df.groupBy(*business_cols).agg(F.max(lineage_col).alias(lineage_col))


def window_max(df: DataFrame, partition: Sequence[str], col: str, alias: str) -> DataFrame:
    """``MAX(col) OVER (PARTITION BY partition)`` with no ordering.

    Computed as a partial aggregate joined back (null keys match null keys,
    as window partitions do): a key holding a large share of the rows is
    combined map-side, and the join back is one AQE can split or broadcast,
    where a window would hand the whole group to one task.
    """
    keys = list(partition)
    agg = df.groupBy(*keys).agg(F.max(col).alias(alias))
    agg = agg.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], alias)
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(agg[f"__k{i}"])
        cond = c if cond is None else cond & c
    return df.join(agg, cond, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def any_per_key(df: DataFrame, keys: Sequence[str], lineage_col: str = "source_table",
                tiebreak: Sequence[str] | None = None) -> DataFrame:
    """``DISTINCT ON (keys)`` without an order, plus ``MAX(lineage) OVER keys`` (E5).

    Made deterministic: the kept row is the one with the newest lineage, then
    the largest remaining columns; its lineage is then the key's maximum.
    """
    rest = [c for c in df.columns if c not in keys and c != lineage_col]
    order = [lineage_col] + list(tiebreak if tiebreak is not None else rest)
    return latest_per_key(df, keys, order)

