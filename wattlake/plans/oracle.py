"""DuckDB oracle SQL for the registered queries.

Each query's SQL is a ``WITH`` chain over the pre-registered test tables.
The CTEs restate each table's definition in DuckDB's own terms (window
ranks for "latest per key", generate_series for the yearly series, grouped
picks, unnest + joins for breakpoints, integer arithmetic for roundings);
they are checked against the goldens of FIXTURES through the queries, and
tie-breaks are written out in full on both sides.

Numbers: decimal results are compared as DOUBLE.  Half-up rounding of an
exact quotient is done with integer arithmetic ``(2*a + b) // (2*b)`` so
that DuckDB's double division cannot move a value across a rounding edge.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-01'"

CTE: dict[str, str] = {}

# ------------------------------------------------------------------ adapters
CTE["x_files"] = """
SELECT concat(replace(substr(cast(o_orderdate AS string), 1, 7), '-', ''),
              lpad(cast(o_orderkey % 28 + 1 AS string), 2, '0'), '220037_',
              CASE o_orderkey % 4 WHEN 0 THEN 'products' WHEN 1 THEN 'prices'
                                  WHEN 2 THEN 'contracts' ELSE 'misc' END, '.csv') AS file_name
FROM orders"""

CTE["x_products"] = """
SELECT p_partkey % 200 AS id, p_name AS productname, p_type AS energy,
       p_brand AS consumptiontype, cast(p_size % 2 AS int) AS deleted,
       CASE WHEN p_size % 5 = 0 THEN 'no_data' ELSE cast(p_size AS string) END AS releasedversion,
       date '1995-01-01' + cast(p_partkey % 2000 AS int) AS modificationdate,
       concat(cast(20010401 + (p_partkey % 5) * 100 AS string), '220037_products_staging_20260101_220057123') AS source_table,
       p_partkey AS seq
FROM part"""

CTE["x_prices"] = """
SELECT p_partkey AS id, p_partkey % 50 AS productid, cast(1 + p_size % 3 AS int) AS pricecomponentid,
       cast(p_retailprice AS decimal(18,4)) AS price,
       date '1995-01-01' + cast((p_partkey * 37) % 2000 AS int) AS valid_from,
       CASE WHEN p_partkey % 4 = 0 THEN date '9999-12-31'
            ELSE date '1995-01-01' + cast((p_partkey * 37) % 2000 + p_size * 30 AS int) END AS valid_until,
       date '1994-12-01' + cast(p_partkey % 28 AS int) AS modificationdate
FROM part"""

CTE["x_contracts"] = """
SELECT o_custkey AS id, o_custkey % 50 AS productid,
       CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'indelivery' ELSE 'terminated' END AS status,
       cast(floor(o_totalprice / 25) AS int) AS usage,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(floor(o_totalprice / 26) AS int) END AS usagenet,
       date '1995-01-01' + cast(o_custkey % 365 AS int) AS createdat,
       date '1995-01-31' + cast(o_custkey % 365 AS int) AS startdate,
       CASE WHEN o_orderkey % 4 = 0 THEN cast(o_orderdate AS date) + 365 ELSE NULL END AS enddate,
       o_orderpriority AS type,
       cast(o_orderdate AS date) AS modificationdate,
       concat(cast(20010401 + (o_orderkey % 5) * 100 AS string), '220037_contracts_staging_20260101_220057123') AS source_table,
       o_orderkey AS seq
FROM orders"""

CTE["x_prices_clean"] = """
SELECT cast((p_partkey % 350) * 3 + k AS bigint) AS id, p_partkey % 50 AS productid, k AS pricecomponentid,
       cast(CASE WHEN k = 2 THEN p_size + 4 ELSE p_retailprice / 100 END AS decimal(18,4)) AS price,
       make_date(cast(1995 + floor((p_partkey % 350) / 50) AS int), CASE WHEN p_partkey % 5 = 0 THEN 7 ELSE 1 END, 1) AS valid_from,
       CASE WHEN floor((p_partkey % 350) / 50) = 6 THEN date '9999-12-31'
            WHEN p_partkey % 5 = 0 THEN make_date(cast(1996 + floor((p_partkey % 350) / 50) AS int), 6, 30)
            ELSE make_date(cast(1995 + floor((p_partkey % 350) / 50) AS int), 12, 31) END AS valid_until,
       date '1994-12-01' + cast(floor(p_partkey / 350) AS int) AS modificationdate
FROM part CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3) c"""

# ------------------------------------------------------------------ contracts history
_C_RAW = """
SELECT id AS contract_id, cast(productid AS int) AS product_id, type,
       cast(NULL AS varchar) AS energy, usage, usagenet, createdat, startdate, enddate,
       cast(NULL AS date) AS filingdatecancellation, cast(NULL AS varchar) AS cancellationreason,
       cast(NULL AS varchar) AS city, status, modificationdate,
       cast(strptime(substr(source_table, 1, 8), '%Y%m%d') AS date) AS snapshot_date,
       source_table, seq
FROM {src}
WHERE coalesce(usage, 0) <= 15000 AND coalesce(usagenet, 0) <= 15000"""

_C_STAGE = """
SELECT * EXCLUDE (rn, seq) FROM (
  SELECT *, md5(concat_ws('::', product_id, type, energy, usage, usagenet, createdat, startdate,
                          enddate, filingdatecancellation, cancellationreason, city, status)) AS hash_value,
         row_number() OVER (PARTITION BY contract_id, modificationdate
                            ORDER BY source_table DESC NULLS LAST, seq DESC NULLS LAST) AS rn
  FROM {raw}) t
WHERE rn = 1"""

_C_HIST = """
SELECT contract_id, product_id, type, energy, usage, usagenet, createdat, startdate, enddate,
       filingdatecancellation, cancellationreason, city, status, modificationdate, snapshot_date,
       source_table, nxt IS NULL AS is_current,
       CASE WHEN status IN ('cancelled', 'terminated') THEN false ELSE true END AS is_valid,
       modificationdate AS valid_from,
       CASE WHEN nxt IS NULL THEN DATE '9999-12-31' ELSE cast(nxt - 1 AS date) END AS valid_until,
       hash_value
FROM (SELECT *, lead(modificationdate) OVER (PARTITION BY contract_id ORDER BY modificationdate) AS nxt
      FROM {stage}) t"""

CTE["c_raw"] = _C_RAW.format(src="x_contracts")
CTE["c_stage"] = _C_STAGE.format(raw="c_raw")
CTE["c_hist"] = _C_HIST.format(stage="c_stage")

# Incremental cases: loads before July 2001 are the existing history, July
# and August the new load (the feed's source_table carries the month).
CTE["c_raw_early"] = _C_RAW.format(src="x_contracts") + " AND source_table < '20010701'"
CTE["c_raw_late"] = _C_RAW.format(src="x_contracts") + " AND source_table >= '20010701'"
CTE["c_stage_early"] = _C_STAGE.format(raw="c_raw_early")
CTE["c_stage_late"] = _C_STAGE.format(raw="c_raw_late")
CTE["c_hist_early"] = _C_HIST.format(stage="c_stage_early")

# ------------------------------------------------------------------ products history
# The product merge splits the feed by modification date (1998-01-01):
# each product's copies all sit in one monthly file, so a month split would
# never match an existing product.
_PR_SRC = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id
                               ORDER BY modificationdate DESC, source_table DESC NULLS LAST,
                                        hash_value DESC) AS rn
  FROM (SELECT *,
               CASE WHEN regexp_matches(source_table, '^.*_(\\d{{8}})_(\\d{{6}})$')
                    THEN try_strptime(regexp_replace(source_table, '^.*_(\\d{{8}})_(\\d{{6}})$', '\\1\\2'), '%Y%m%d%H%M%S')
                    ELSE try_strptime(substr(source_table, 1, 14), '%Y%m%d%H%M%S') END AS extracted_at,
               md5(concat_ws('::', productcode, productname, energy, consumptiontype, deleted,
                             releasedversion)) AS hash_value
        FROM (SELECT product_id, productcode, productname, energy, consumptiontype, deleted,
                     releasedversion, modificationdate, max(source_table) AS source_table
              FROM (SELECT id AS product_id, cast(NULL AS varchar) AS productcode, productname, energy,
                           consumptiontype, cast(deleted AS smallint) AS deleted,
                           cast(CASE WHEN releasedversion = 'no_data' THEN -1
                                     ELSE cast(releasedversion AS int) END AS bigint) AS releasedversion,
                           modificationdate, source_table
                    FROM x_products {where}) r
              GROUP BY ALL) d) p) t
WHERE rn = 1"""

_PR_ROWS = """
SELECT product_id, productcode, productname, energy, consumptiontype, deleted, releasedversion,
       modificationdate AS valid_from, DATE '9999-12-31' AS valid_until, true AS is_current,
       modificationdate, extracted_at, source_table, hash_value
FROM {src}"""

CTE["pr_src"] = _PR_SRC.format(where="")
CTE["pr_src_early"] = _PR_SRC.format(where="WHERE modificationdate < DATE '1998-01-01'")
CTE["pr_src_late"] = _PR_SRC.format(where="WHERE modificationdate >= DATE '1998-01-01'")
CTE["pr_hist"] = _PR_ROWS.format(src="pr_src")
CTE["pr_hist_early"] = _PR_ROWS.format(src="pr_src_early")

# ------------------------------------------------------------------ prices history (clean feed)
_P_RAW = """
SELECT id AS price_id, cast(productid AS int) AS product_id, pricecomponentid,
       cast(NULL AS varchar) AS pricecomponent, cast(price AS decimal(38,10)) AS price,
       cast(NULL AS varchar) AS unit, valid_from, valid_until, modificationdate,
       cast(NULL AS varchar) AS source_table
FROM {src}"""

_P_HIST = """
SELECT price_id, product_id, pricecomponentid, pricecomponent, price, unit, valid_from, valid_until,
       modificationdate, modificationdate = max(modificationdate) OVER (PARTITION BY price_id) AS is_current,
       source_table
FROM (SELECT *, row_number() OVER (PARTITION BY price_id, modificationdate
                                   ORDER BY source_table DESC NULLS LAST, product_id DESC, pricecomponentid DESC,
                                            pricecomponent DESC NULLS LAST, price DESC, unit DESC NULLS LAST,
                                            valid_from DESC, valid_until DESC) AS rn
      FROM {raw}) t
WHERE rn = 1"""

_P_PIECES = """
SELECT product_id, pricecomponentid, price_id, price,
       cast(gs AS date) AS period_start,
       least(valid_until, make_date(year(gs), 12, 31)) AS period_end,
       {as_of} AS snapshot_date
FROM (SELECT product_id, pricecomponentid, price_id, price, valid_from,
             least(valid_until, {as_of}) AS valid_until
      FROM (SELECT *, row_number() OVER (PARTITION BY price_id
                                         ORDER BY valid_until DESC, modificationdate DESC,
                                                  source_table DESC NULLS LAST) AS rn
            FROM {hist} WHERE pricecomponentid IN (1, 2)) f
      WHERE rn = 1) c,
     unnest(generate_series(cast(valid_from AS timestamp), cast(valid_until AS timestamp),
                            INTERVAL 1 YEAR)) AS s(gs)
WHERE valid_from <= valid_until"""

_P_PERIODS = """
SELECT {as_of} AS snapshot_date, product_id,
       CASE WHEN max(price_id) FILTER (WHERE pricecomponentid = 1) IS NOT NULL THEN 1 END AS base_pricecomponentid,
       CASE WHEN max(price_id) FILTER (WHERE pricecomponentid = 2) IS NOT NULL THEN 2 END AS working_pricecomponentid,
       max(price_id) FILTER (WHERE pricecomponentid = 1) AS base_id,
       max(price_id) FILTER (WHERE pricecomponentid = 2) AS working_id,
       period_start AS valid_from, period_end AS valid_until,
       arg_max(price, price_id) FILTER (WHERE pricecomponentid = 1) AS baseprice,
       arg_max(price, price_id) FILTER (WHERE pricecomponentid = 2) AS workingprice
FROM {pieces}
GROUP BY product_id, period_start, period_end"""

CTE["pc_raw"] = _P_RAW.format(src="x_prices_clean")
CTE["pc_hist"] = _P_HIST.format(raw="pc_raw")
CTE["pc_pieces"] = _P_PIECES.format(hist="pc_hist", as_of=AS_OF)
CTE["pc_periods"] = _P_PERIODS.format(pieces="pc_pieces", as_of=AS_OF)

CTE["px_raw"] = _P_RAW.format(src="x_prices")
CTE["px_hist"] = _P_HIST.format(raw="px_raw")
CTE["px_pieces"] = _P_PIECES.format(hist="px_hist", as_of=AS_OF)
CTE["px_periods"] = _P_PERIODS.format(pieces="px_pieces", as_of=AS_OF)

# ------------------------------------------------------------------ mart chain
CTE["ci_newest"] = """
SELECT contract_id, product_id, max(snapshot_date) AS newest
FROM c_hist WHERE status <> 'indelivery' GROUP BY contract_id, product_id"""

CTE["ci"] = """
SELECT DISTINCT h.contract_id, h.product_id AS productid, h.status,
       coalesce(h.usagenet, h.usage) AS consumption, h.valid_from AS startdate,
       if(h.valid_until = DATE '9999-12-31', n.newest, h.valid_until) AS enddate, h.createdat
FROM c_hist h JOIN ci_newest n ON h.contract_id = n.contract_id AND h.product_id = n.product_id
WHERE h.status <> 'indelivery'"""

CTE["pp_latest"] = """
SELECT * FROM pc_periods WHERE snapshot_date = (SELECT max(snapshot_date) FROM pc_periods)"""

CTE["c_breaks"] = """
SELECT DISTINCT contract_id, productid, date_value FROM (
  SELECT contract_id, productid, unnest([startdate, createdat, enddate]) AS date_value FROM ci
  UNION ALL
  SELECT p.contract_id, p.productid, unnest([b.valid_from, b.valid_until])
  FROM (SELECT DISTINCT contract_id, productid FROM ci) p
  JOIN pp_latest b ON b.product_id = p.productid
) x
WHERE date_value IS NOT NULL"""

CTE["c_periods"] = """
SELECT * FROM (
  SELECT contract_id, productid, date_value AS period_start,
         lead(date_value) OVER (PARTITION BY contract_id ORDER BY date_value, productid) AS period_end
  FROM c_breaks) t
WHERE period_end IS NOT NULL AND period_start <> period_end"""

CTE["ci_head"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY contract_id
                               ORDER BY createdat DESC NULLS LAST, startdate DESC NULLS LAST,
                                        productid DESC NULLS LAST, enddate DESC NULLS LAST,
                                        status DESC NULLS LAST, consumption DESC NULLS LAST) AS rn
  FROM ci) t
WHERE rn = 1"""

CTE["jp"] = """
SELECT product_id, valid_from, valid_until, max(baseprice) AS baseprice, max(workingprice) AS workingprice
FROM pp_latest GROUP BY product_id, valid_from, valid_until"""

CTE["cpp"] = """
SELECT * EXCLUDE (rn, jf, ju) FROM (
  SELECT p.contract_id, p.productid, p.period_start, p.period_end, h.status, h.consumption,
         h.startdate, h.enddate, h.createdat, jp.baseprice, jp.workingprice,
         jp.valid_from AS jf, jp.valid_until AS ju,
         row_number() OVER (PARTITION BY p.contract_id, p.productid, p.period_start
                            ORDER BY jp.valid_from DESC NULLS LAST, jp.valid_until DESC NULLS LAST) AS rn
  FROM c_periods p
  JOIN ci_head h ON p.contract_id = h.contract_id
  LEFT JOIN jp ON p.productid = jp.product_id AND p.period_start BETWEEN jp.valid_from AND jp.valid_until
  WHERE p.period_start >= h.startdate
    AND (h.enddate IS NULL OR p.period_start < h.enddate)
    AND p.period_start < DATE '2001-08-01'
) t WHERE rn = 1"""

# Exact integer forms of the roundings; prices in the feed carry 4 decimals,
# so price * 10000 is an integer.  Values are in millionths (cents for due).
CTE["mart_base"] = """
SELECT b.*,
       cast(ceil(date_diff('day', b.startdate, coalesce(b.enddate, DATE '2001-08-01')) / 365.0) AS int) AS total_contract_years,
       coalesce(b.enddate, DATE '2001-08-01') AS final_end
FROM (
  SELECT *, cast(period_end - period_start AS int) AS days_in_period,
         cast(period_start - startdate AS int) AS days_since_start,
         cast(floor((period_start - startdate) / 365.0) AS int) AS contract_year
  FROM cpp) b"""

CTE["mart_years"] = """
SELECT j.*,
       j.final_end < cast(j.startdate + to_years(j.total_contract_years) AS date) AS terminated_mid_year,
       y.total_days_in_year, y.year_bp
FROM mart_base j
JOIN (SELECT contract_id, contract_year, cast(sum(days_in_period) AS bigint) AS total_days_in_year,
             max(baseprice) AS year_bp
      FROM mart_base GROUP BY contract_id, contract_year) y
  ON j.contract_id = y.contract_id AND j.contract_year = y.contract_year"""

CTE["mart_units"] = """
SELECT *,
  CASE WHEN total_days_in_year <> 0
       THEN (cast(days_in_period AS hugeint) * 2000000 + total_days_in_year) // (2 * total_days_in_year) END AS u_share,
  CASE WHEN total_days_in_year <> 0
       THEN (cast(year_bp * 10000 AS hugeint) * days_in_period * 200 + total_days_in_year) // (2 * total_days_in_year) END AS u_base,
  (cast(coalesce(workingprice, 0) * 10000 AS hugeint) * consumption * days_in_period * 2 + 365) // 730 AS u_var,
  (cast(consumption AS hugeint) * days_in_period * 2000000 + 365) // 730 AS u_weighted,
  CASE WHEN consumption <> 0 THEN (cast(days_in_period AS hugeint) * 2000000 + 365) // 730 END AS u_cshare,
  (cast(baseprice * 10000 AS hugeint) * total_contract_years * 2 + 100) // 200 AS u_due
FROM mart_years"""

CTE["mart"] = """
SELECT contract_id, productid, period_start, period_end, status, consumption, startdate, enddate,
       createdat, cast(baseprice AS double) AS baseprice, cast(workingprice AS double) AS workingprice,
       days_in_period, days_since_start, contract_year, total_contract_years, final_end,
       terminated_mid_year, total_days_in_year,
       cast(u_share AS double) / 1000000 AS period_share,
       cast(u_base AS double) / 1000000 AS base_cost,
       cast(u_var AS double) / 1000000 AS variable_cost,
       cast(u_weighted AS double) / 1000000 AS weighted_consumption,
       cast(u_cshare AS double) / 1000000 AS consumption_share,
       cast(u_base + u_var AS double) / 1000000 AS revenue,
       cast(u_due AS double) / 100 AS baseprice_total_due,
       u_base + u_var AS u_revenue
FROM mart_units"""

_REF = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str, seen: list[str]) -> None:
    if name in seen:
        return
    body = CTE[name]
    for tok in set(_REF.findall(body)):
        if tok in CTE and tok != name:
            _deps(tok, seen)
    seen.append(name)


def with_ctes(body: str) -> str:
    """Prefix ``body`` with every CTE it (transitively) references, in order."""
    order: list[str] = []
    for tok in sorted(set(_REF.findall(body))):
        if tok in CTE:
            _deps(tok, order)
    body = body.strip()
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in order)
    if body[:5].upper() == "WITH ":
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
