"""Row hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: separator of the hashed attribute list.
HASH_SEPARATOR = "::"


def _as_text(c: Column, dtype: T.DataType | None) -> Column:
    # Dates print as yyyy-MM-dd and integers without decimals, like the
    # warehouse's text casts.  Nulls are skipped by concat_ws.
    return c.cast("string")


def row_hash(*cols: str | Column) -> Column:
    """``md5(concat_ws('::', cols...))``; null attributes are skipped."""
    parts = [_as_text(F.col(c) if isinstance(c, str) else c, None) for c in cols]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def surrogate_key(*cols: str | Column) -> Column:
    """A stable 64-bit key from the business key and version date.

    A dense ``row_number()`` over the whole table would need one task for all
    rows; a hash is computed where the row is.
    """
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])
