"""Lineage columns derived from the staging table name.

A staging table is named ``<YYYYMMDDHHMMSS>_<entity>_staging_<load_id>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern that recognises a 6-digit load-time tail.
LOAD_TAIL = r"^.*_(\d{8})_(\d{6})$"


def extracted_at(source_table: Column | str) -> Column:
    """Extraction timestamp of a staged row (TIMESTAMP_NTZ).

    If the name ends in ``_<8 digits>_<6 digits>`` those 14 digits are the
    timestamp; otherwise (load ids carry 9 digits after the underscore) the
    first 14 characters, the file's own timestamp, are used.
    """
    s = F.col(source_table) if isinstance(source_table, str) else source_table
    tail = F.regexp_replace(s, LOAD_TAIL, "$1$2")
    digits = F.when(s.rlike(LOAD_TAIL), tail).otherwise(F.substring(s, 1, 14))
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def snapshot_date(source_table: Column | str) -> Column:
    """Snapshot date of a staged row: the first 8 characters as ``yyyyMMdd``."""
    s = F.col(source_table) if isinstance(source_table, str) else source_table
    return F.to_date(F.substring(s, 1, 8), "yyyyMMdd")


def load_id(ts: Column) -> Column:
    """Load identifier ``yyyyMMdd_HHmmssSSS`` from a timestamp."""
    return F.date_format(ts, "yyyyMMdd_HHmmssSSS")
