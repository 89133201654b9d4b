"""Type-2 history loads for products, prices and contracts (I1-I3, C1, C2,
C11, C12, A16-A18).

Each load is ``(staging, history | None, params) -> new history``.  With
``history=None`` (the reference's drop-and-recreate run) the target is
empty; with a history DataFrame the same code performs the incremental
merge.  History tables are immutable snapshots: callers write the result to
a new version folder instead of overwriting what they read.

Scale notes: the staging dedup is a partial aggregation (hot keys are
combined map-side).  The closing window runs after that dedup, on rows
unique per (key, version date), so one key's group is bounded by the number
of distinct dates, not by the number of staged copies.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import row_hash, surrogate_key
from ..functions.lineage import extracted_at, snapshot_date
from ..schema import INVALID_STATUSES, NO_DATA, OPEN_END, USAGE_OUTLIER_BOUND, typed_projection
from ..session import written
from .dedup import latest_per_key, window_max
from .filters import sentinel_map, validity_flag, within_bound
from .joins import DEFAULT_MAX_ROWS, maybe_broadcast, rows_at_most

PRODUCT_COLUMNS = ["product_sk", "product_id", "productcode", "productname", "energy",
                   "consumptiontype", "deleted", "releasedversion", "valid_from", "valid_until",
                   "is_current", "modificationdate", "extracted_at", "source_table", "hash_value",
                   "inserted_at"]
PRICE_COLUMNS = ["price_sk", "price_id", "product_id", "pricecomponentid", "pricecomponent", "price",
                 "unit", "valid_from", "valid_until", "modificationdate", "is_current",
                 "extracted_at", "source_table", "inserted_at"]
CONTRACT_COLUMNS = ["contract_sk", "contract_id", "product_id", "type", "energy", "usage",
                    "usagenet", "createdat", "startdate", "enddate", "filingdatecancellation",
                    "cancellationreason", "city", "status", "modificationdate", "snapshot_date",
                    "source_table", "is_current", "is_valid", "valid_from", "valid_until",
                    "inserted_at", "hash_value"]

# The attributes hashed into a version's hash_value, in order.
PRODUCT_HASHED = ["productcode", "productname", "energy", "consumptiontype", "deleted",
                  "releasedversion"]
CONTRACT_HASHED = ["product_id", "type", "energy", "usage", "usagenet", "createdat", "startdate",
                   "enddate", "filingdatecancellation", "cancellationreason", "city", "status"]


def _ts(run_ts: _dt.datetime | Column | None) -> Column:
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp_ntz")
    return F.lit(run_ts).cast("timestamp_ntz")


def _extra(df: DataFrame, tiebreak: Sequence[str] | None) -> list[str]:
    return [c for c in (tiebreak or []) if c in df.columns]


# ---------------------------------------------------------------- generic

def anti_join_new_rows(new: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key does not exist yet (``NOT EXISTS``, C1)."""
    if existing is None:
        return new
    return new.join(existing.select(*keys), on=list(keys), how="left_anti")


def newest_flag(df: DataFrame, key: str | Sequence[str], version: str, alias: str = "is_current",
                many_rows_per_key: bool = False) -> DataFrame:
    """``alias`` = no row of the same key has a larger ``version``.

    The two correlated EXISTS / NOT EXISTS updates collapse into one
    comparison with the per-key maximum.  (key, version) unique: a window, whose
    groups the calendar bounds.  ``many_rows_per_key``: the maximum is a
    partial aggregate joined back, so no key's rows meet in one task.
    """
    if many_rows_per_key:
        top = window_max(df, [key] if isinstance(key, str) else list(key), version, "__newest")
        return top.withColumn(alias, F.col(version) == F.col("__newest")).drop("__newest")
    return df.withColumn(alias, F.col(version) == F.max(version).over(Window.partitionBy(key)))


def close_superseded(df: DataFrame, key: str | Sequence[str], version: str, current_col: str = "is_current",
                     until_col: str = "valid_until", recompute: bool = False) -> DataFrame:
    """Close every current version except the newest one per key.

    ``valid_until`` becomes the next version date minus one day.  By default
    only rows still current take part (a late old version is closed against
    the next *current* one and may overlap closed rows, as coded);
    ``recompute=True`` runs the lead over all versions.  Requires (key,
    version) to be unique.

    One window, no split and union: the next current version is the last
    non-null "current version" among the rows after this one, computed as a
    running frame in descending order (incremental, not quadratic), so the
    key's hash distribution survives for the operators downstream.
    """
    after = (Window.partitionBy(key).orderBy(F.col(version).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    if recompute:
        nxt = F.last(F.col(version), ignorenulls=True).over(after)
        return (df.withColumn("__next", nxt)
                  .withColumn(until_col, F.when(F.col("__next").isNull(), F.lit(OPEN_END))
                              .otherwise(F.date_sub(F.col("__next"), 1)))
                  .withColumn(current_col, F.col("__next").isNull())
                  .drop("__next"))
    cur = F.col(current_col)
    nxt = F.last(F.when(cur, F.col(version)), ignorenulls=True).over(after)
    hit = cur & F.col("__next").isNotNull()
    return (df.withColumn("__next", nxt)
              .withColumn(until_col, F.when(hit, F.date_sub(F.col("__next"), 1))
                          .otherwise(F.col(until_col)))
              .withColumn(current_col, F.when(hit, F.lit(False)).otherwise(cur))
              .drop("__next"))


def insert_ignore(existing: DataFrame | None, new: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING`` made deterministic.

    One row per key survives (largest ``order``); keys already present in
    ``existing`` are skipped.  Returns only the rows to insert.
    """
    one = latest_per_key(new, keys, order)
    return anti_join_new_rows(one, existing, keys)


# ---------------------------------------------------------------- contracts

def stage_contracts_raw(staging: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Typed, outlier-filtered contract rows with warehouse names and lineage."""
    extra = _extra(staging, tiebreak)
    typed = typed_projection(staging, "contracts", keep=("source_table", *extra))
    return (typed
            .where(within_bound(["usage", "usagenet"], USAGE_OUTLIER_BOUND))
            .select(F.col("id").alias("contract_id"), F.col("productid").alias("product_id"),
                    "type", "energy", "usage", "usagenet", "createdat", "startdate", "enddate",
                    "filingdatecancellation", "cancellationreason", "city", "status",
                    "modificationdate", snapshot_date("source_table").alias("snapshot_date"),
                    "source_table", *extra))


def stage_contracts(staging: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Outlier filter, lineage, newest staged copy per (contract, date), hash."""
    extra = _extra(staging, tiebreak)
    s = stage_contracts_raw(staging, tiebreak).withColumn("hash_value", row_hash(*CONTRACT_HASHED))
    order = ["source_table", *extra, "hash_value"]
    return latest_per_key(s, ["contract_id", "modificationdate"], order).drop(*extra)


def contract_versions(new: DataFrame, run_ts: _dt.datetime | Column | None = None) -> DataFrame:
    """Staged contract rows as open versions."""
    return new.select(
        surrogate_key("contract_id", "modificationdate").alias("contract_sk"),
        *[c for c in CONTRACT_COLUMNS if c in new.columns and c != "hash_value"],
        F.lit(True).alias("is_current"),
        validity_flag("status", INVALID_STATUSES).alias("is_valid"),
        F.col("modificationdate").alias("valid_from"),
        F.lit(OPEN_END).alias("valid_until"),
        _ts(run_ts).alias("inserted_at"),
        "hash_value",
    ).select(*CONTRACT_COLUMNS)


def split_touched(history: DataFrame, new_keys: DataFrame, key: str,
                  max_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(history rows of keys in the new load, all other history rows).

    Only keys present in a load can change, so an incremental load needs to
    reprocess those alone.  The stored history is split by a semi and an anti
    join: with the load's distinct keys broadcast when their count allows it (the
    history is not shuffled), else as shuffled joins with the same result.
    """
    keys = new_keys.select(key).distinct()
    small = rows_at_most(keys, DEFAULT_MAX_ROWS if max_rows is None else max_rows)
    k = maybe_broadcast(keys, small)
    return history.join(k, key, "left_semi"), history.join(k, key, "left_anti")


def scd2_contracts(staging: DataFrame, history: DataFrame | None = None,
                   run_ts: _dt.datetime | Column | None = None, recompute: bool = False,
                   tiebreak: Sequence[str] | None = None,
                   max_broadcast_rows: int | None = None) -> DataFrame:
    """Contracts history load.

    New (contract_id, modificationdate) versions are appended; every current
    version but the newest per contract is closed with the next version date
    minus one day.  ``is_valid`` is false for cancelled or terminated rows.
    Incremental loads only reprocess the contracts present in the load, except
    with ``recompute``, which repairs every contract of the history.  The size
    of the load chooses the join, never the scope.  With a history, the staged
    rows are written once: its keys, the split and the new rows all read them.
    """
    staged = stage_contracts(staging, tiebreak)
    untouched = None
    if history is not None:
        staged = written(staged, "staged-contracts")
        history = history.select(*CONTRACT_COLUMNS)
        if not recompute:
            history, untouched = split_touched(history, staged, "contract_id", max_broadcast_rows)
    new = anti_join_new_rows(staged, history, ["contract_id", "modificationdate"])
    inserted = contract_versions(new, run_ts)
    rows = inserted if history is None else history.unionByName(inserted)
    out = close_superseded(rows, "contract_id", "modificationdate", recompute=recompute) \
        .select(*CONTRACT_COLUMNS)
    return out if untouched is None else untouched.unionByName(out)


# ---------------------------------------------------------------- prices

def stage_prices(staging: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per (price_id, modificationdate) with the newest lineage (E5)."""
    extra = _extra(staging, tiebreak)
    typed = typed_projection(staging, "prices", keep=("source_table", *extra))
    if "source_table" not in typed.columns:
        typed = typed.withColumn("source_table", F.lit(None).cast("string"))
    raw = typed.select(F.col("id").alias("price_id"), F.col("productid").alias("product_id"),
                       "pricecomponentid", "pricecomponent", "price", "unit", "valid_from",
                       "valid_until", "modificationdate", "source_table", *extra)
    rest = ["product_id", "pricecomponentid", "pricecomponent", "price", "unit", "valid_from",
            "valid_until"]
    order = ["source_table", *extra, *rest]
    one = latest_per_key(raw, ["price_id", "modificationdate"], order).drop(*extra)
    return one.withColumn("extracted_at", extracted_at("source_table"))


def price_versions(new: DataFrame, run_ts: _dt.datetime | Column | None = None) -> DataFrame:
    """Staged price rows as versions, flagged current until compared."""
    return new.select(
        surrogate_key("price_id", "modificationdate").alias("price_sk"),
        "price_id", "product_id", "pricecomponentid", "pricecomponent", "price", "unit",
        "valid_from", "valid_until", "modificationdate", F.lit(True).alias("is_current"),
        "extracted_at", "source_table", _ts(run_ts).alias("inserted_at"))


def scd2_prices(staging: DataFrame, history: DataFrame | None = None,
                run_ts: _dt.datetime | Column | None = None,
                tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Prices history load (I2): append unseen versions, flag the newest.

    Incremental loads only re-flag the price ids present in the load.
    """
    staged = stage_prices(staging, tiebreak)
    untouched = None
    if history is not None:
        staged = written(staged, "staged-prices")
        history = history.select(*PRICE_COLUMNS)
        history, untouched = split_touched(history, staged, "price_id")
    new = anti_join_new_rows(staged, history, ["price_id", "modificationdate"])
    inserted = price_versions(new, run_ts)
    rows = inserted if history is None else history.unionByName(inserted)
    out = newest_flag(rows, "price_id", "modificationdate").select(*PRICE_COLUMNS)
    return out if untouched is None else untouched.unionByName(out)


# ---------------------------------------------------------------- products

def stage_products(staging: DataFrame) -> DataFrame:
    """Collapse duplicates, hash six attributes, keep the newest per product."""
    typed = typed_projection(staging, "products")
    raw = typed.select(
        F.col("id").alias("product_id"), "productcode", "productname", "energy",
        "consumptiontype", "deleted",
        sentinel_map("releasedversion", NO_DATA, -1).alias("releasedversion"),
        "modificationdate", "source_table")
    business = [c for c in raw.columns if c != "source_table"]
    dedup = raw.groupBy(*business).agg(F.max("source_table").alias("source_table"))
    prepared = (dedup.withColumn("extracted_at", extracted_at("source_table"))
                     .withColumn("hash_value", row_hash(*PRODUCT_HASHED)))
    return latest_per_key(prepared, ["product_id"],
                          ["modificationdate", "source_table", "hash_value"])


def scd2_products(staging: DataFrame, history: DataFrame | None = None,
                  run_ts: _dt.datetime | Column | None = None,
                  on_change: str = "close_only") -> DataFrame:
    """Products history merge.

    Matched on product_id against current rows: a changed hash closes the
    current row at the new modificationdate minus one day.  A product with
    no current row is inserted unless (product_id, valid_from) exists.
    ``on_change="close_only"`` is the as-coded behaviour (the changed
    version arrives on the next load); ``"close_and_open"`` inserts it now.

    One pass: stored and staged rows meet in one shuffle by product, where each
    row gets its action (keep, close, insert, skip).  A product's rows are its
    versions and at most one staged row, bounded by the calendar.
    """
    if on_change not in ("close_only", "close_and_open"):
        raise ValueError(f"on_change must be close_only or close_and_open, not {on_change!r}")
    src = stage_products(staging)

    def as_rows(df: DataFrame) -> DataFrame:
        return df.select(
            surrogate_key("product_id", "modificationdate").alias("product_sk"),
            "product_id", "productcode", "productname", "energy", "consumptiontype", "deleted",
            "releasedversion", F.col("modificationdate").alias("valid_from"),
            F.lit(OPEN_END).alias("valid_until"), F.lit(True).alias("is_current"),
            "modificationdate", "extracted_at", "source_table", "hash_value",
            _ts(run_ts).alias("inserted_at"))

    if history is None:
        return as_rows(src).select(*PRODUCT_COLUMNS)

    rows = (history.select(*PRODUCT_COLUMNS, F.lit(False).alias("__staged"))
            .unionByName(as_rows(src).select(*PRODUCT_COLUMNS, F.lit(True).alias("__staged"))))
    staged, stored = F.col("__staged"), ~F.col("__staged")
    product = Window.partitionBy("product_id")
    rows = (rows
            .withColumn("__new", F.max(F.when(staged, F.struct("hash_value", "modificationdate"))).over(product))
            .withColumn("__current", F.max(F.when(stored & F.col("is_current"), F.col("hash_value"))).over(product))
            .withColumn("__exists", F.max(stored).over(Window.partitionBy("product_id", "valid_from"))))
    # A null product or date matches nothing.
    no_key = F.col("product_id").isNull()
    opens = no_key | F.col("__current").isNull()
    if on_change == "close_and_open":
        opens = opens | (F.col("__current") != F.col("hash_value"))
    inserts = opens & (no_key | F.col("valid_from").isNull() | ~F.col("__exists"))
    closes = (~no_key & F.col("is_current") & (F.col("__new.hash_value") != F.col("hash_value")))
    action = (F.when(staged, F.when(inserts, F.lit("insert")).otherwise(F.lit("skip")))
              .otherwise(F.when(closes, F.lit("close")).otherwise(F.lit("keep"))))
    hit = F.col("__action") == "close"
    return (rows.withColumn("__action", action).where("__action <> 'skip'")
            .withColumn("valid_until", F.when(hit, F.date_sub(F.col("__new.modificationdate"), 1))
                        .otherwise(F.col("valid_until")))
            .withColumn("is_current", F.when(hit, F.lit(False)).otherwise(F.col("is_current")))
            .select(*PRODUCT_COLUMNS))
