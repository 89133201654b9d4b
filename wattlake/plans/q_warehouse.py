"""Registered queries: history loads, price periods, revenue mart, reports
(SURVEY §2.I, §2.D, A15-A17)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import extracted_at, snapshot_date
from ..operators import checks, dense_keys, intervals, revenue, scd2
from ..plans import reports
from ..session import scratch_path
from ..sources import history_parts
from ..sources.adapters import x_contracts, x_prices, x_prices_clean, x_products
from .common import (QUERIES, SQL, AS_OF, NEWEST_EXTRACT, SPLIT_TABLE, clean_price_history,
                     clean_price_periods, comparable, contracts_history, mart, products_history,
                     published, raw_price_history, raw_price_periods, register)
from .oracle import AS_OF as AS_OF_SQL
from .oracle import _P_HIST, _P_PERIODS, _P_PIECES, _P_RAW, CTE

# Each product's copies all sit in one monthly file of the feed, so the
# product merge splits by modification date: versions dated before 1998 are
# the existing history, later ones the new load.
PRODUCT_SPLIT = _dt.date(1998, 1, 1)  # the oracle CTEs split on the same date

# ------------------------------------------------------------------ oracle CTEs for incremental cases



def _products_early(df: DataFrame) -> DataFrame:
    return df.where(F.col("modificationdate") < F.lit(PRODUCT_SPLIT))


def _products_late(df: DataFrame) -> DataFrame:
    return df.where(F.col("modificationdate") >= F.lit(PRODUCT_SPLIT))


def _early(df: DataFrame) -> DataFrame:
    return df.where(F.col("source_table") < SPLIT_TABLE)


def _late(df: DataFrame) -> DataFrame:
    return df.where(F.col("source_table") >= SPLIT_TABLE)


_HIST_COLS = ("contract_id, product_id, type, energy, usage, usagenet, createdat, startdate, enddate, "
              "filingdatecancellation, cancellationreason, city, status, modificationdate, "
              "snapshot_date, source_table, is_current, is_valid, valid_from, valid_until, hash_value")

# ------------------------------------------------------------------ I1-I3 history loads


@register("scd2_contracts", "SELECT * FROM c_hist")
def q_scd2_contracts(spark: SparkSession, d: str) -> DataFrame:
    return comparable(contracts_history(spark, d))


@register("update_from", f"""
SELECT {_HIST_COLS}
FROM (
  SELECT h.* EXCLUDE (is_current, valid_until),
         CASE WHEN h.is_current AND n.nxt IS NOT NULL THEN false ELSE h.is_current END AS is_current,
         CASE WHEN h.is_current AND n.nxt IS NOT NULL THEN cast(n.nxt - 1 AS date) ELSE h.valid_until END AS valid_until
  FROM (SELECT {_HIST_COLS} FROM c_hist_early
        UNION ALL
        SELECT s.contract_id, s.product_id, s.type, s.energy, s.usage, s.usagenet, s.createdat,
               s.startdate, s.enddate, s.filingdatecancellation, s.cancellationreason, s.city, s.status,
               s.modificationdate, s.snapshot_date, s.source_table, true,
               CASE WHEN s.status IN ('cancelled', 'terminated') THEN false ELSE true END,
               s.modificationdate, DATE '9999-12-31', s.hash_value
        FROM c_stage_late s
        WHERE NOT EXISTS (SELECT 1 FROM c_hist_early e
                          WHERE e.contract_id = s.contract_id AND e.modificationdate = s.modificationdate)) h
  LEFT JOIN (SELECT contract_id, modificationdate,
                    lead(modificationdate) OVER (PARTITION BY contract_id ORDER BY modificationdate) AS nxt
             FROM (SELECT contract_id, modificationdate FROM c_hist_early WHERE is_current
                   UNION ALL
                   SELECT s.contract_id, s.modificationdate FROM c_stage_late s
                   WHERE NOT EXISTS (SELECT 1 FROM c_hist_early e
                                     WHERE e.contract_id = s.contract_id
                                       AND e.modificationdate = s.modificationdate)) c) n
    ON h.contract_id = n.contract_id AND h.modificationdate = n.modificationdate
) t""")
def q_update_from(spark: SparkSession, d: str) -> DataFrame:
    """Incremental contracts load: June history + July/August load (C11, Q23)."""
    feed = x_contracts(spark, d)
    base = published(scd2.scd2_contracts(_early(feed), tiebreak=["seq"]))
    return comparable(scd2.scd2_contracts(_late(feed), history=base, tiebreak=["seq"]))


SQL["update_from_parts"] = SQL["update_from"]


@register("update_from_parts")
def q_update_from_parts(spark: SparkSession, d: str) -> DataFrame:
    """The incremental contracts load on a history stored as current and closed parts (C11)."""
    feed, base = x_contracts(spark, d), scratch_path(spark, "contracts-parts")
    history_parts.apply_load(_early(feed), history_parts.CONTRACTS, base, "early", tiebreak=["seq"], buckets=32)
    return comparable(history_parts.apply_load(_late(feed), history_parts.CONTRACTS, base, "late", previous="early",
                                               tiebreak=["seq"]))


@register("scd2_prices", """
SELECT price_id, product_id, pricecomponentid, pricecomponent, cast(price AS double) AS price, unit,
       valid_from, valid_until, modificationdate, is_current,
       cast(NULL AS timestamp) AS extracted_at, source_table
FROM pc_hist""")
def q_scd2_prices(spark: SparkSession, d: str) -> DataFrame:
    return comparable(clean_price_history(spark, d))


@register("scd2_products", "SELECT * FROM pr_hist")
def q_scd2_products(spark: SparkSession, d: str) -> DataFrame:
    return comparable(products_history(spark, d))


_MERGE_SQL = """
SELECT h.product_id, h.productcode, h.productname, h.energy, h.consumptiontype, h.deleted,
       h.releasedversion, h.valid_from,
       CASE WHEN h.is_current AND c.product_id IS NOT NULL THEN cast(c.modificationdate - 1 AS date)
            ELSE h.valid_until END AS valid_until,
       CASE WHEN h.is_current AND c.product_id IS NOT NULL THEN false ELSE h.is_current END AS is_current,
       h.modificationdate, h.extracted_at, h.source_table, h.hash_value
FROM pr_hist_early h
LEFT JOIN (SELECT s.* FROM pr_src_late s JOIN pr_hist_early t
             ON t.product_id = s.product_id AND t.is_current AND t.hash_value <> s.hash_value) c
  ON h.product_id = c.product_id
UNION ALL
SELECT product_id, productcode, productname, energy, consumptiontype, deleted, releasedversion,
       modificationdate, DATE '9999-12-31', true, modificationdate, extracted_at, source_table, hash_value
FROM pr_src_late s
WHERE {insert_when}
  AND NOT EXISTS (SELECT 1 FROM pr_hist_early p
                  WHERE p.product_id = s.product_id AND p.valid_from = s.modificationdate)"""


@register("merge_scd", _MERGE_SQL.format(insert_when=(
    "NOT EXISTS (SELECT 1 FROM pr_hist_early t WHERE t.product_id = s.product_id AND t.is_current)")))
def q_merge_scd(spark: SparkSession, d: str) -> DataFrame:
    """Products merge of the post-1997 versions into the earlier history, as coded."""
    feed = x_products(spark, d)
    base = scd2.scd2_products(_products_early(feed))
    return comparable(scd2.scd2_products(_products_late(feed), history=base))


@register("merge_scd_close_and_open", _MERGE_SQL.format(insert_when=(
    "(NOT EXISTS (SELECT 1 FROM pr_hist_early t WHERE t.product_id = s.product_id AND t.is_current)"
    " OR EXISTS (SELECT 1 FROM pr_hist_early t WHERE t.product_id = s.product_id AND t.is_current"
    " AND t.hash_value <> s.hash_value))")))
def q_merge_scd_open(spark: SparkSession, d: str) -> DataFrame:
    """The README variant: a changed product is closed and its new version opened."""
    feed = x_products(spark, d)
    base = scd2.scd2_products(_products_early(feed))
    return comparable(scd2.scd2_products(_products_late(feed), history=base,
                                         on_change="close_and_open"))


# ------------------------------------------------------------------ I4, I5 price periods
_PIECE_COLS = ("product_id, pricecomponentid, price_id, cast(price AS double) AS price, period_start, "
               "period_end, snapshot_date")


@register("price_period_split", f"SELECT {_PIECE_COLS} FROM pc_pieces")
def q_price_period_split(spark: SparkSession, d: str) -> DataFrame:
    return comparable(intervals.price_period_split(clean_price_history(spark, d),
                                                   max_date=NEWEST_EXTRACT))


@register("lateral_series", f"SELECT {_PIECE_COLS} FROM px_pieces")
def q_lateral_series(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping feed with 29 Feb starts: the series keeps 28 Feb after a leap start."""
    return comparable(intervals.price_period_split(raw_price_history(spark, d),
                                                   max_date=NEWEST_EXTRACT))


CTE["pd_raw"] = _P_RAW.format(src="x_prices").replace(
    "cast(NULL AS varchar) AS source_table",
    "strftime(valid_from + cast(365 + id % 30 AS int), '%Y%m%d') || '220039_prices_staging_20260101_220057123' AS source_table")
CTE["pd_hist"] = _P_HIST.format(raw="pd_raw")
CTE["pd_pieces"] = _P_PIECES.format(
    hist="pd_hist", as_of="(SELECT max(cast(strptime(substr(source_table, 1, 14), '%Y%m%d%H%M%S') AS date)) FROM pd_hist)")


@register("price_period_split_newest", f"SELECT {_PIECE_COLS} FROM pd_pieces")
def q_price_period_split_newest(spark: SparkSession, d: str) -> DataFrame:
    """The same with the snapshot date from the data: the newest extraction of the price history."""
    day = F.date_format(F.date_add("valid_from", (F.lit(365) + F.col("id") % 30).cast("int")), "yyyyMMdd")
    feed = x_prices(spark, d).withColumn("source_table", F.concat(day, F.lit("220039_prices_staging_20260101_220057123")))
    return comparable(intervals.price_period_split(published(scd2.scd2_prices(feed))))


_PERIOD_COLS = ("snapshot_date, product_id, base_pricecomponentid, working_pricecomponentid, base_id, "
                "working_id, valid_from, valid_until, cast(baseprice AS double) AS baseprice, "
                "cast(workingprice AS double) AS workingprice")


@register("price_periods", f"SELECT {_PERIOD_COLS} FROM pc_periods")
def q_price_periods(spark: SparkSession, d: str) -> DataFrame:
    return comparable(clean_price_periods(spark, d))


@register("left_multi_key_join", f"SELECT {_PERIOD_COLS} FROM px_periods")
def q_left_multi_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Unaligned base/working pieces meet only on identical bounds."""
    return comparable(raw_price_periods(spark, d))


CTE["pcc_pieces"] = CTE["pc_pieces"].replace(
    "FROM pc_hist WHERE pricecomponentid IN (1, 2)",
    "FROM pc_hist WHERE pricecomponentid IN (1, 2) AND is_current")
CTE["pcc_periods"] = _P_PERIODS.format(pieces="pcc_pieces", as_of=AS_OF_SQL)


@register("price_periods_current", f"SELECT {_PERIOD_COLS} FROM pcc_periods")
def q_price_periods_current(spark: SparkSession, d: str) -> DataFrame:
    """``pick="current"``: periods from each price's current version (Q8)."""
    pieces = intervals.price_period_split(clean_price_history(spark, d), max_date=NEWEST_EXTRACT,
                                          pick="current")
    return comparable(intervals.price_periods(pieces))


# ------------------------------------------------------------------ I6-I13 mart


@register("contract_input", "SELECT * FROM ci")
def q_contract_input(spark: SparkSession, d: str) -> DataFrame:
    return comparable(revenue.contract_input(contracts_history(spark, d)))


@register("contract_breakpoints", "SELECT * FROM c_breaks")
def q_contract_breakpoints(spark: SparkSession, d: str) -> DataFrame:
    ci = revenue.contract_input(contracts_history(spark, d))
    return intervals.contract_breakpoints(ci, clean_price_periods(spark, d))


CTE["pp_latest_px"] = CTE["pp_latest"].replace("pc_periods", "px_periods")
CTE["c_breaks_px"] = CTE["c_breaks"].replace("pp_latest", "pp_latest_px")


@register("lateral_union", "SELECT * FROM c_breaks_px")
def q_lateral_union(spark: SparkSession, d: str) -> DataFrame:
    """Breakpoints against the overlapping price feed."""
    ci = revenue.contract_input(contracts_history(spark, d))
    return intervals.contract_breakpoints(ci, raw_price_periods(spark, d))


@register("contract_periods", "SELECT * FROM c_periods")
def q_contract_periods(spark: SparkSession, d: str) -> DataFrame:
    ci = revenue.contract_input(contracts_history(spark, d))
    return intervals.contract_periods(intervals.contract_breakpoints(ci, clean_price_periods(spark, d)))


@register("delete_where", """
SELECT contract_id, productid, period_start, period_end FROM c_periods""")
def q_delete_where(spark: SparkSession, d: str) -> DataFrame:
    """Open-ended and zero-length intervals removed."""
    ci = revenue.contract_input(contracts_history(spark, d))
    return intervals.contract_periods(intervals.contract_breakpoints(ci, clean_price_periods(spark, d)))


@register("delete_where_removed", """
SELECT * FROM (
  SELECT contract_id, productid, date_value AS period_start,
         lead(date_value) OVER (PARTITION BY contract_id ORDER BY date_value, productid) AS period_end
  FROM c_breaks) t
WHERE period_end IS NULL OR period_start = period_end""")
def q_delete_where_removed(spark: SparkSession, d: str) -> DataFrame:
    """The rows that the delete takes away."""
    ci = revenue.contract_input(contracts_history(spark, d))
    return intervals.removed_periods(intervals.contract_breakpoints(ci, clean_price_periods(spark, d)))


@register("contract_price_periods", """
SELECT contract_id, productid, period_start, period_end, status, consumption, startdate, enddate,
       createdat, cast(baseprice AS double) AS baseprice, cast(workingprice AS double) AS workingprice
FROM cpp""")
def q_contract_price_periods(spark: SparkSession, d: str) -> DataFrame:
    ci = revenue.contract_input(contracts_history(spark, d))
    return comparable(revenue.contract_price_periods(ci, clean_price_periods(spark, d), AS_OF))


CTE["cpp_px"] = (CTE["cpp"].replace("ci_head h", "ci_head h").replace("LEFT JOIN jp", "LEFT JOIN jp_px")
                 .replace("jp.", "jp_px.").replace("FROM c_periods p", "FROM c_periods_px p"))
CTE["jp_px"] = CTE["jp"].replace("pp_latest", "pp_latest_px")
CTE["c_periods_px"] = CTE["c_periods"].replace("FROM c_breaks", "FROM c_breaks_px")


@register("left_range_join", """
SELECT contract_id, productid, period_start, period_end, cast(baseprice AS double) AS baseprice,
       cast(workingprice AS double) AS workingprice
FROM cpp_px""")
def q_left_range_join(spark: SparkSession, d: str) -> DataFrame:
    """Range join against overlapping price periods; latest valid_from wins."""
    ci = revenue.contract_input(contracts_history(spark, d))
    cpp = revenue.contract_price_periods(ci, raw_price_periods(spark, d), AS_OF)
    return comparable(cpp.select("contract_id", "productid", "period_start", "period_end",
                                 "baseprice", "workingprice"))


SQL["left_range_join_binned"] = SQL["left_range_join"]


@register("left_range_join_binned")
def q_left_range_join_binned(spark: SparkSession, d: str) -> DataFrame:
    """The same join as a shuffle by product and month, for prices too many to broadcast."""
    ci = revenue.contract_input(contracts_history(spark, d))
    cpp = revenue.contract_price_periods(ci, raw_price_periods(spark, d), AS_OF, small_prices=False)
    return comparable(cpp.select("contract_id", "productid", "period_start", "period_end",
                                 "baseprice", "workingprice"))


_MART_COLS = ("contract_id, productid, period_start, period_end, status, consumption, startdate, enddate, "
              "createdat, baseprice, workingprice, days_in_period, days_since_start, contract_year, "
              "total_contract_years, final_end, terminated_mid_year, total_days_in_year, period_share, "
              "base_cost, variable_cost, weighted_consumption, consumption_share, revenue, "
              "baseprice_total_due")


@register("contract_revenue", f"SELECT {_MART_COLS} FROM mart")
def q_contract_revenue(spark: SparkSession, d: str) -> DataFrame:
    return comparable(mart(spark, d))


@register("contract_year", """
SELECT contract_id, productid, period_start, days_in_period, days_since_start, contract_year,
       total_contract_years, final_end FROM mart""")
def q_contract_year(spark: SparkSession, d: str) -> DataFrame:
    return mart(spark, d).select("contract_id", "productid", "period_start", "days_in_period",
                                 "days_since_start", "contract_year", "total_contract_years",
                                 "final_end")


@register("terminated_mid_year", """
SELECT contract_id, productid, period_start, startdate, final_end, total_contract_years,
       terminated_mid_year FROM mart""")
def q_terminated_mid_year(spark: SparkSession, d: str) -> DataFrame:
    return mart(spark, d).select("contract_id", "productid", "period_start", "startdate",
                                 "final_end", "total_contract_years", "terminated_mid_year")


@register("proration", """
SELECT contract_id, productid, period_start, total_days_in_year, period_share, base_cost,
       variable_cost, weighted_consumption, consumption_share FROM mart""")
def q_proration(spark: SparkSession, d: str) -> DataFrame:
    return comparable(mart(spark, d).select(
        "contract_id", "productid", "period_start", "total_days_in_year", "period_share",
        "base_cost", "variable_cost", "weighted_consumption", "consumption_share"))


@register("group_sum_max", """
SELECT contract_id, contract_year, cast(sum(days_in_period) AS bigint) AS total_days_in_year,
       max(baseprice) AS baseprice
FROM mart GROUP BY contract_id, contract_year""")
def q_group_sum_max(spark: SparkSession, d: str) -> DataFrame:
    return comparable(reports.year_totals(mart(spark, d)))


@register("group_as_distinct", """
SELECT contract_id, startdate, enddate, total_contract_years, final_end
FROM mart GROUP BY contract_id, startdate, enddate, total_contract_years, final_end""")
def q_group_as_distinct(spark: SparkSession, d: str) -> DataFrame:
    return reports.contract_terms(mart(spark, d))


@register("extract_lineage", """
SELECT DISTINCT source_table,
       try_strptime(substr(source_table, 1, 14), '%Y%m%d%H%M%S') AS extracted_at,
       cast(strptime(substr(source_table, 1, 8), '%Y%m%d') AS date) AS snapshot_date
FROM (SELECT source_table FROM x_contracts UNION ALL SELECT source_table FROM x_products) s""")
def q_extract_lineage(spark: SparkSession, d: str) -> DataFrame:
    names = (x_contracts(spark, d).select("source_table")
             .unionByName(x_products(spark, d).select("source_table")))
    return names.select("source_table", extracted_at("source_table").alias("extracted_at"),
                        snapshot_date("source_table").alias("snapshot_date")).distinct()


# ------------------------------------------------------------------ D6-D10 reports
_D7_FROM, _D7_TO = _dt.date(1995, 3, 1), _dt.date(1995, 6, 1)
_IN_DELIVERY_ON = _dt.date(1998, 1, 1)


@register("revenue_by_created_product", """
SELECT createdat, productid, cast(sum(u_revenue) AS double) / 1000000 AS sum_revenue,
       cast(sum(consumption) AS bigint) AS sum_consumption
FROM mart GROUP BY createdat, productid""")
def q_revenue_by_created_product(spark: SparkSession, d: str) -> DataFrame:
    return comparable(reports.revenue_by_created_product(mart(spark, d)))


@register("full_load", """
SELECT createdat, productid, cast(sum(u_revenue) AS double) / 1000000 AS sum_revenue,
       cast(sum(consumption) AS bigint) AS sum_consumption
FROM mart GROUP BY createdat, productid""")
def q_full_load(spark: SparkSession, d: str) -> DataFrame:
    """Staging feeds -> every warehouse table -> the first README report."""
    from .warehouse_job import build_tables
    tables = build_tables(
        products=x_products(spark, d), prices=_clean_prices_feed(spark, d),
        contracts=x_contracts(spark, d), as_of=AS_OF, newest_extract=NEWEST_EXTRACT,
        contract_tiebreak=["seq"], materialize=published)
    # The report reads the mart only; the products history is computed and written too.
    published(tables["products"])
    return comparable(reports.revenue_by_created_product(tables["contract_price_enriched"]))


# SURVEY's own key for the same composite.
QUERIES["full_pipeline"], SQL["full_pipeline"] = QUERIES["full_load"], SQL["full_load"]


def _clean_prices_feed(spark: SparkSession, d: str) -> DataFrame:
    return x_prices_clean(spark, d)


@register("revenue_by_created", f"""
SELECT createdat, cast(sum(u_revenue) AS double) / 1000000 AS sum_revenue,
       cast(sum(consumption) AS bigint) AS sum_consumption
FROM mart WHERE createdat BETWEEN DATE '{_D7_FROM}' AND DATE '{_D7_TO}'
GROUP BY createdat""")
def q_revenue_by_created(spark: SparkSession, d: str) -> DataFrame:
    return comparable(reports.revenue_by_created(mart(spark, d), _D7_FROM, _D7_TO))


@register("first_last_change", f"""
WITH s AS (SELECT createdat, sum(u_revenue) AS u FROM mart
           WHERE createdat BETWEEN DATE '{_D7_FROM}' AND DATE '{_D7_TO}' GROUP BY createdat),
     fl AS (SELECT min(createdat) AS first_day, max(createdat) AS last_day,
                   arg_min_null(u, createdat) AS fu, arg_max_null(u, createdat) AS lu FROM s)
SELECT first_day, last_day, cast(fu AS double) / 1000000 AS first_value,
       cast(lu AS double) / 1000000 AS last_value,
       cast(CASE WHEN lu - fu >= 0 THEN (2 * (lu - fu) * 1000000 + fu) // (2 * fu)
                 ELSE -((2 * (fu - lu) * 1000000 + fu) // (2 * fu)) END AS double) / 1000000 AS change_ratio
FROM fl""")
def q_first_last_change(spark: SparkSession, d: str) -> DataFrame:
    series = reports.revenue_by_created(mart(spark, d), _D7_FROM, _D7_TO)
    return comparable(reports.first_last_change(series, "createdat", "sum_revenue"))


@register("count_distinct_in_delivery", f"""
SELECT count(DISTINCT contract_id) AS contracts_in_delivery FROM c_hist
WHERE status = 'indelivery' AND startdate <= DATE '{_IN_DELIVERY_ON}'
  AND coalesce(enddate, DATE '9999-12-31') >= DATE '{_IN_DELIVERY_ON}'""")
def q_count_distinct_in_delivery(spark: SparkSession, d: str) -> DataFrame:
    return reports.count_in_delivery(contracts_history(spark, d), _IN_DELIVERY_ON)


@register("new_contracts", f"""
SELECT {_HIST_COLS} FROM c_hist
WHERE month(snapshot_date - INTERVAL 1 MONTH) = month(createdat)""")
def q_new_contracts(spark: SparkSession, d: str) -> DataFrame:
    return comparable(reports.new_contracts(contracts_history(spark, d)))


@register("month_shift_filter", """
SELECT count(*) AS new_contracts FROM c_hist
WHERE month(snapshot_date - INTERVAL 1 MONTH) = month(createdat)""")
def q_month_shift_filter(spark: SparkSession, d: str) -> DataFrame:
    """The published figure: how many rows the month-shift filter keeps."""
    return reports.new_contracts(contracts_history(spark, d)).agg(F.count(F.lit(1)).alias("new_contracts"))


@register("row_count", """
SELECT source_table, count(*) AS rows_loaded FROM x_contracts GROUP BY source_table""")
def q_row_count(spark: SparkSession, d: str) -> DataFrame:
    return reports.rows_per_source(x_contracts(spark, d))


@register("global_max", """
SELECT max(modificationdate) AS max_modificationdate, max(snapshot_date) AS max_snapshot_date
FROM c_hist""")
def q_global_max(spark: SparkSession, d: str) -> DataFrame:
    h = contracts_history(spark, d)
    return h.agg(F.max("modificationdate").alias("max_modificationdate"),
                 F.max("snapshot_date").alias("max_snapshot_date"))


@register("group_multi_max", """
SELECT product_id, valid_from, valid_until, cast(max(baseprice) AS double) AS baseprice,
       cast(max(workingprice) AS double) AS workingprice
FROM pp_latest_px GROUP BY product_id, valid_from, valid_until""")
def q_group_multi_max(spark: SparkSession, d: str) -> DataFrame:
    return comparable(intervals.price_dedup(raw_price_periods(spark, d)))


# ------------------------------------------------------------------ A15-A17 checks
@register("constraint_check", """
SELECT 'unique' AS check_name, concat_ws('|', contract_id, modificationdate) AS key_text,
       count(*) AS violations
FROM c_raw GROUP BY contract_id, modificationdate HAVING count(*) > 1
UNION ALL
SELECT 'not_null:' || c AS check_name, NULL AS key_text, n AS violations
FROM (SELECT 'enddate' AS c, count(*) - count(enddate) AS n FROM c_raw
      UNION ALL SELECT 'usagenet', count(*) - count(usagenet) FROM c_raw
      UNION ALL SELECT 'status', count(*) - count(status) FROM c_raw) z
WHERE n > 0""")
def q_constraint_check(spark: SparkSession, d: str) -> DataFrame:
    """Violation report on the outlier-filtered contract feed."""
    raw = scd2.stage_contracts_raw(x_contracts(spark, d))
    return checks.constraint_report(raw, ["contract_id", "modificationdate"],
                                    ["enddate", "usagenet", "status"])


@register("mart_constraints", """
SELECT 'unique' AS check_name, concat_ws('|', contract_id, productid, period_start) AS key_text,
       count(*) AS violations
FROM mart GROUP BY contract_id, productid, period_start HAVING count(*) > 1""")
def q_mart_constraints(spark: SparkSession, d: str) -> DataFrame:
    """The mart's unique key holds: the report is empty (A15 on I13)."""
    return checks.constraint_report(mart(spark, d), ["contract_id", "productid", "period_start"], [])


@register("surrogate_key", """
SELECT count(*) AS n_rows, count(DISTINCT (contract_id, modificationdate)) AS n_keys FROM c_hist""")
def q_surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    h = contracts_history(spark, d)
    return h.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.countDistinct("contract_sk").alias("n_keys"))


@register("surrogate_key_dense", """
WITH k AS (SELECT id, modificationdate, min(CASE WHEN modificationdate < DATE '1997-01-01' THEN 1 ELSE 2 END) AS load
           FROM x_contracts GROUP BY ALL),
n AS (SELECT load, count(*) AS n_keys FROM k GROUP BY load)
SELECT a.load::INTEGER AS load, a.n_keys, 1 + coalesce(sum(b.n_keys), 0)::BIGINT AS first_sk,
       (a.n_keys + coalesce(sum(b.n_keys), 0))::BIGINT AS last_sk, a.n_keys AS distinct_sk
FROM n a LEFT JOIN n b ON b.load < a.load GROUP BY a.load, a.n_keys""")
def q_surrogate_key_dense(spark: SparkSession, d: str) -> DataFrame:
    """Gap-free keys of contract versions over two loads; the second repeats the first's rows."""
    feed = x_contracts(spark, d)
    path, keys = scratch_path(spark, "dense-keys"), ["id", "modificationdate"]
    early = feed.where(F.col("modificationdate") < "1997-01-01")
    one = dense_keys.assign(early, keys, path, "1").withColumn("load", F.lit(1))
    both = dense_keys.assign(feed, keys, path, "2")
    two = both.join(one.select("sk"), "sk", "left_anti").withColumn("load", F.lit(2))
    return one.unionByName(two).groupBy("load").agg(
        F.count("*").alias("n_keys"), F.min("sk").alias("first_sk"), F.max("sk").alias("last_sk"),
        F.count_distinct("sk").alias("distinct_sk"))


@register("column_defaults", """
SELECT is_current, count(*) AS n_rows,
       cast(sum(CASE WHEN valid_until = DATE '9999-12-31' THEN 1 ELSE 0 END) AS bigint) AS n_open_end,
       cast(sum(CASE WHEN valid_from = modificationdate THEN 1 ELSE 0 END) AS bigint) AS n_from_version
FROM c_hist GROUP BY is_current""")
def q_column_defaults(spark: SparkSession, d: str) -> DataFrame:
    h = contracts_history(spark, d)
    return h.groupBy("is_current").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("valid_until") == F.lit(_dt.date(9999, 12, 31)), 1).otherwise(0))
         .cast("bigint").alias("n_open_end"),
        F.sum(F.when(F.col("valid_from") == F.col("modificationdate"), 1).otherwise(0))
         .cast("bigint").alias("n_from_version"))


# ------------------------------------------------------------------ options of SURVEY §8
@register("temp_tables", """
SELECT contract_id, productid, status, consumption, startdate, enddate, createdat FROM ci_head""")
def q_temp_tables(spark: SparkSession, d: str) -> DataFrame:
    """A materialised intermediate used twice (A19): contract_input is
    checkpointed to the shared checkpoint dir, then read by two consumers."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    ci = revenue.contract_input(contracts_history(spark, d)).checkpoint()
    head = revenue.latest_contract(ci)
    return head.join(ci.select("contract_id").distinct(), "contract_id", "left_semi")


@register("price_periods_aligned", """
WITH cuts AS (SELECT DISTINCT snapshot_date, product_id, c AS cut
              FROM px_pieces, unnest([period_start, cast(period_end + 1 AS date)]) t(c)),
segs AS (SELECT snapshot_date, product_id, cut AS valid_from, cast(nxt - 1 AS date) AS valid_until
         FROM (SELECT *, lead(cut) OVER (PARTITION BY snapshot_date, product_id ORDER BY cut) AS nxt
               FROM cuts) z WHERE nxt IS NOT NULL),
cover AS (SELECT s.*, p.pricecomponentid, p.price_id, p.price FROM segs s
          JOIN px_pieces p ON s.product_id = p.product_id AND s.snapshot_date = p.snapshot_date
                          AND s.valid_from BETWEEN p.period_start AND p.period_end)
SELECT snapshot_date, product_id,
       CASE WHEN max(price_id) FILTER (WHERE pricecomponentid = 1) IS NOT NULL THEN 1 END AS base_pricecomponentid,
       CASE WHEN max(price_id) FILTER (WHERE pricecomponentid = 2) IS NOT NULL THEN 2 END AS working_pricecomponentid,
       max(price_id) FILTER (WHERE pricecomponentid = 1) AS base_id,
       max(price_id) FILTER (WHERE pricecomponentid = 2) AS working_id,
       valid_from, valid_until,
       cast(arg_max(price, price_id) FILTER (WHERE pricecomponentid = 1) AS double) AS baseprice,
       cast(arg_max(price, price_id) FILTER (WHERE pricecomponentid = 2) AS double) AS workingprice
FROM cover GROUP BY snapshot_date, product_id, valid_from, valid_until""")
def q_price_periods_aligned(spark: SparkSession, d: str) -> DataFrame:
    """``align=True``: unaligned base and working pieces intersected (Q12)."""
    pieces = published(intervals.price_period_split(raw_price_history(spark, d),
                                                    max_date=NEWEST_EXTRACT))
    return comparable(intervals.price_periods_aligned(pieces, yearly_pieces=True))


@register("average_revenue_by_created", f"""
SELECT createdat,
       cast((2 * sum(u_revenue) + count(u_revenue)) // (2 * count(u_revenue)) AS double) / 1000000 AS avg_revenue,
       avg(consumption) AS avg_consumption
FROM mart WHERE createdat BETWEEN DATE '{_D7_FROM}' AND DATE '{_D7_TO}'
GROUP BY createdat""")
def q_average_revenue_by_created(spark: SparkSession, d: str) -> DataFrame:
    """The README question read literally: average, not sum (Q24)."""
    return comparable(reports.average_revenue_by_created(mart(spark, d), _D7_FROM, _D7_TO))


@register("new_contracts_in_month", f"""
SELECT {_HIST_COLS} FROM (
  SELECT * REPLACE (CASE WHEN contract_id % 2 = 0
                         THEN cast(createdat + to_years(cast(year(snapshot_date) - year(createdat) AS INTEGER)) AS date)
                         ELSE createdat END AS createdat) FROM c_hist) h
WHERE month(snapshot_date - INTERVAL 1 MONTH) = month(createdat)
  AND year(snapshot_date - INTERVAL 1 MONTH) = year(createdat)""")
def q_new_contracts_in_month(spark: SparkSession, d: str) -> DataFrame:
    """Year-aware variant of new_contracts (Q24).

    The feed's contracts are all older than its snapshots, so every second one
    moves to its snapshot's year; the others show that the year counts.
    """
    years = F.year("snapshot_date") - F.year("createdat")
    moved = contracts_history(spark, d).withColumn("createdat", F.when(
        F.col("contract_id") % 2 == 0, F.add_months("createdat", years * 12)).otherwise(F.col("createdat")))
    return comparable(reports.new_contracts_in_month(moved))
