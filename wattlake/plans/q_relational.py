"""Registered queries: projections, filters, joins, aggregations, windows,
set operations and scalar functions (SURVEY §2.B-H)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.hashing import row_hash
from ..functions.lineage import extracted_at, load_id, snapshot_date
from ..operators import dedup, filters, intervals, scd2
from ..schema import OPEN_END, typed_projection
from ..sources import staging
from ..sources.adapters import x_contracts, x_files, x_prices, x_products
from .common import (NEWEST_EXTRACT, SPLIT_TABLE, comparable, products_history, published,
                     raw_price_history, register)

BOM = "\ufeff"
_B8_FROM, _B8_TO = _dt.date(1995, 3, 1), _dt.date(1995, 6, 1)
_B9_ON = _dt.date(1996, 1, 1)
_B14_AS_OF = _dt.date(1999, 1, 1)
_C13_SPLIT = _dt.date(1994, 12, 15)

# ------------------------------------------------------------------ B projections and filters


@register("project_rename", """
SELECT id AS contract_id, productid AS product_id, status, modificationdate, seq FROM x_contracts""")
def q_project_rename(spark: SparkSession, d: str) -> DataFrame:
    return x_contracts(spark, d).select(
        F.col("id").alias("contract_id"), F.col("productid").alias("product_id"),
        "status", "modificationdate", "seq")


@register("typed_cast", """
SELECT id, type, usage, usagenet, createdat, startdate, enddate, status,
       cast(productid AS int) AS productid, modificationdate, seq
FROM x_contracts""")
def q_typed_cast(spark: SparkSession, d: str) -> DataFrame:
    """Landing text -> contract types (B2): every column as text, cast back once."""
    text = x_contracts(spark, d).select(*[F.col(c).cast("string").alias(c)
                                          for c in x_contracts(spark, d).columns])
    typed = typed_projection(text, "contracts", keep=("seq",))
    return typed.select("id", "type", "usage", "usagenet", "createdat", "startdate", "enddate",
                        "status", "productid", "modificationdate",
                        F.col("seq").cast("bigint").alias("seq"))


# A feed of text cells, some of which do not fit: words, fractions of no number, days that are none.
_BAD_CELLS = {
    "usage": ("seq % 11 = 0", "concat(usage, ' kWh')"), "startdate": ("seq % 13 = 0", "concat(startdate, ' soon')"),
    "productid": ("seq % 17 = 0", "concat('P', productid)"), "usagenet": ("seq % 19 = 0", "concat(usagenet, '.0')")}


@register("typed_cast_quarantine", """
WITH bad AS (
  SELECT seq, usagenet, CASE WHEN seq % 11 = 0 THEN usage::VARCHAR || ' kWh' ELSE usage::VARCHAR END AS usage,
         CASE WHEN seq % 13 = 0 THEN startdate::VARCHAR || ' soon' ELSE startdate::VARCHAR END AS startdate,
         CASE WHEN seq % 17 = 0 THEN 'P' || productid::VARCHAR ELSE productid::VARCHAR END AS productid
  FROM x_contracts),
cells AS (
  SELECT seq, 'usage' AS c, usage AS text, 'not a int' AS reason FROM bad WHERE usage LIKE '% kWh'
  UNION ALL SELECT seq, 'startdate', startdate, 'not a date' FROM bad WHERE startdate LIKE '% soon'
  UNION ALL SELECT seq, 'productid', productid, 'not a int' FROM bad WHERE productid LIKE 'P%')
SELECT seq, c AS "column", text, reason FROM cells
UNION ALL
SELECT seq, 'typed', coalesce(usage, '-') || ' ' || coalesce(usagenet::VARCHAR, '-') || ' ' || coalesce(startdate, '-'),
       'fits'
FROM bad WHERE seq NOT IN (SELECT seq FROM cells)""")
def q_typed_cast_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Rows that fit, typed, and every cell that does not, with its text (B2 with a quarantine)."""
    feed = x_contracts(spark, d)
    text = feed.select(*[F.col(c).cast("string").alias(c) for c in feed.columns])
    for name, (rows, cell) in _BAD_CELLS.items():
        text = text.withColumn(name, F.expr(f"CASE WHEN {rows} THEN {cell} ELSE {name} END"))
    typed, rejects = staging.split_rejects(text, "contracts", "quarantine", keep=("seq",))
    fits = typed.select(F.col("seq").cast("bigint").alias("seq"), F.lit("typed").alias("column"), F.concat_ws(
        " ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("usage", "usagenet", "startdate")])
        .alias("text"), F.lit("fits").alias("reason"))
    return fits.unionByName(rejects.withColumn("seq", F.col("seq").cast("bigint")))


@register("sentinel_map", """
SELECT seq, releasedversion AS raw_version,
       cast(CASE WHEN releasedversion = 'no_data' THEN -1 ELSE cast(releasedversion AS int) END AS bigint)
         AS releasedversion
FROM x_products""")
def q_sentinel_map(spark: SparkSession, d: str) -> DataFrame:
    p = x_products(spark, d)
    return p.select("seq", F.col("releasedversion").alias("raw_version"),
                    filters.sentinel_map("releasedversion").alias("releasedversion"))


@register("outlier_filter", """
SELECT seq, usage, usagenet FROM x_contracts
WHERE coalesce(usage, 0) <= 15000 AND coalesce(usagenet, 0) <= 15000""")
def q_outlier_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.outlier_filter(x_contracts(spark, d)).select("seq", "usage", "usagenet")


@register("validity_flag", """
SELECT seq, status, CASE WHEN status IN ('cancelled', 'terminated') THEN false ELSE true END AS is_valid
FROM x_contracts""")
def q_validity_flag(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.select("seq", "status", filters.validity_flag("status").alias("is_valid"))


@register("in_filter", """
SELECT id, pricecomponentid, pricecomponentid = 1 AS is_base FROM x_prices
WHERE pricecomponentid IN (1, 2)""")
def q_in_filter(spark: SparkSession, d: str) -> DataFrame:
    p = x_prices(spark, d).where(F.col("pricecomponentid").isin(1, 2))
    return p.select("id", "pricecomponentid", (F.col("pricecomponentid") == 1).alias("is_base"))


@register("not_equal_filter", """
SELECT seq, status FROM x_contracts WHERE status <> 'indelivery'""")
def q_not_equal_filter(spark: SparkSession, d: str) -> DataFrame:
    return x_contracts(spark, d).where(F.col("status") != "indelivery").select("seq", "status")


@register("between_filter", f"""
SELECT seq, createdat FROM x_contracts WHERE createdat BETWEEN DATE '{_B8_FROM}' AND DATE '{_B8_TO}'""")
def q_between_filter(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.where(F.col("createdat").between(F.lit(_B8_FROM), F.lit(_B8_TO))).select("seq", "createdat")


@register("as_of_filter", f"""
SELECT seq, startdate, enddate FROM x_contracts
WHERE startdate <= DATE '{_B9_ON}' AND coalesce(enddate, DATE '9999-12-31') >= DATE '{_B9_ON}'""")
def q_as_of_filter(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.where(filters.active_on("startdate", "enddate", _B9_ON)).select("seq", "startdate", "enddate")


@register("null_filter", """
SELECT seq, usage, usagenet IS NULL AS usagenet_missing FROM x_contracts WHERE enddate IS NOT NULL""")
def q_null_filter(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d).where(F.col("enddate").isNotNull())
    return c.select("seq", "usage", F.col("usagenet").isNull().alias("usagenet_missing"))


@register("suffix_like", """
SELECT file_name FROM x_files WHERE file_name LIKE '199_0%' AND file_name LIKE '%\\_contracts.csv' ESCAPE '\\'""")
def q_suffix_like(spark: SparkSession, d: str) -> DataFrame:
    """LIKE with ``_`` as a one-character wildcard, and an escaped literal ``_``."""
    f = x_files(spark, d)
    return f.where(F.col("file_name").like("199_0%")
                   & F.col("file_name").like("%\\_contracts.csv")).select("file_name")


@register("not_future", f"""
SELECT seq, modificationdate FROM x_contracts WHERE modificationdate < DATE '{_B14_AS_OF}'""")
def q_not_future(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.where(filters.before("modificationdate", _B14_AS_OF)).select("seq", "modificationdate")


# ------------------------------------------------------------------ C joins
def _staged_halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    feed = x_contracts(spark, d)
    early = scd2.stage_contracts(feed.where(F.col("source_table") < SPLIT_TABLE), ["seq"])
    late = scd2.stage_contracts(feed.where(F.col("source_table") >= SPLIT_TABLE), ["seq"])
    return early, late


@register("anti_join_new_rows", """
SELECT s.contract_id, s.modificationdate, s.source_table FROM c_stage_late s
WHERE NOT EXISTS (SELECT 1 FROM c_stage_early e
                  WHERE e.contract_id = s.contract_id AND e.modificationdate = s.modificationdate)""")
def q_anti_join_new_rows(spark: SparkSession, d: str) -> DataFrame:
    early, late = _staged_halves(spark, d)
    new = scd2.anti_join_new_rows(late, early, ["contract_id", "modificationdate"])
    return new.select("contract_id", "modificationdate", "source_table")


@register("exists_newer", """
SELECT id, productid, modificationdate,
       EXISTS (SELECT 1 FROM x_prices n WHERE n.productid = p.productid
                                          AND n.modificationdate > p.modificationdate) AS has_newer
FROM x_prices p""")
def q_exists_newer(spark: SparkSession, d: str) -> DataFrame:
    p = x_prices(spark, d).select("id", "productid", "modificationdate")
    flagged = scd2.newest_flag(p, "productid", "modificationdate", "is_newest",
                               many_rows_per_key=True)
    return flagged.select("id", "productid", "modificationdate", (~F.col("is_newest")).alias("has_newer"))


@register("inner_equi_join", """
SELECT c.seq, c.productid, h.productname FROM x_contracts c
JOIN pr_hist h ON c.productid = h.product_id AND h.is_current""")
def q_inner_equi_join(spark: SparkSession, d: str) -> DataFrame:
    current = products_history(spark, d).where("is_current").select("product_id", "productname")
    c = x_contracts(spark, d).select("seq", "productid")
    return c.join(current, c.productid == current.product_id, "inner").select("seq", "productid",
                                                                           "productname")


@register("null_safe_join", """
SELECT c.seq, c.id, c.enddate, g.n_same_end FROM x_contracts c
JOIN (SELECT id, enddate, count(*) AS n_same_end FROM x_contracts GROUP BY id, enddate) g
  ON c.id = g.id AND c.enddate IS NOT DISTINCT FROM g.enddate""")
def q_null_safe_join(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d).select("seq", "id", "enddate")
    g = c.groupBy("id", "enddate").agg(F.count(F.lit(1)).alias("n_same_end")) \
         .withColumnRenamed("id", "g_id").withColumnRenamed("enddate", "g_end")
    j = c.join(g, (c.id == g.g_id) & c.enddate.eqNullSafe(g.g_end), "inner")
    return j.select("seq", "id", "enddate", "n_same_end")


@register("cross_join_scalar", """
SELECT p.id, p.modificationdate, cast(m.max_mod - p.modificationdate AS int) AS days_behind
FROM x_prices p CROSS JOIN (SELECT max(modificationdate) AS max_mod FROM x_prices) m""")
def q_cross_join_scalar(spark: SparkSession, d: str) -> DataFrame:
    """Cross join with a one-row aggregate (C7): broadcasting one row is bounded."""
    p = x_prices(spark, d)
    one = p.agg(F.max("modificationdate").alias("max_mod"))
    j = p.crossJoin(F.broadcast(one))
    return j.select("id", "modificationdate",
                    D.days_between("max_mod", "modificationdate").alias("days_behind"))


@register("scalar_subquery", """
SELECT seq, modificationdate FROM x_contracts
WHERE modificationdate = (SELECT max(modificationdate) FROM x_contracts)""")
def q_scalar_subquery(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    newest = c.agg(F.max("modificationdate")).scalar()
    return c.where(F.col("modificationdate") == newest).select("seq", "modificationdate")


@register("insert_ignore", f"""
SELECT productid, valid_from, id FROM (
  SELECT productid, valid_from, id,
         row_number() OVER (PARTITION BY productid, valid_from ORDER BY id DESC) AS rn
  FROM x_prices WHERE modificationdate >= DATE '{_C13_SPLIT}') n
WHERE rn = 1
  AND NOT EXISTS (SELECT 1 FROM x_prices e WHERE e.modificationdate < DATE '{_C13_SPLIT}'
                                            AND e.productid = n.productid AND e.valid_from = n.valid_from)""")
def q_insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    """ON CONFLICT DO NOTHING: one row per key, keys already stored skipped."""
    p = x_prices(spark, d).select("productid", "valid_from", "id", "modificationdate")
    existing = p.where(F.col("modificationdate") < F.lit(_C13_SPLIT))
    new = p.where(F.col("modificationdate") >= F.lit(_C13_SPLIT)).drop("modificationdate")
    return scd2.insert_ignore(existing, new, ["productid", "valid_from"], ["id"])


# ------------------------------------------------------------------ D1, E windows
@register("dedup_max_lineage", """
SELECT id, productname, energy, consumptiontype, deleted, releasedversion, modificationdate,
       max(source_table) AS source_table
FROM x_products GROUP BY ALL""")
def q_dedup_max_lineage(spark: SparkSession, d: str) -> DataFrame:
    p = x_products(spark, d)
    business = ["id", "productname", "energy", "consumptiontype", "deleted", "releasedversion",
                "modificationdate"]
    return dedup.dedup_max_lineage(p, business)


@register("window_max_partition", """
SELECT id, productid, max(valid_until) OVER (PARTITION BY productid) AS max_valid_until FROM x_prices""")
def q_window_max_partition(spark: SparkSession, d: str) -> DataFrame:
    p = x_prices(spark, d).select("id", "productid", "valid_until")
    return dedup.window_max(p, ["productid"], "valid_until", "max_valid_until").drop("valid_until")


@register("window_lead", """
SELECT contract_id, modificationdate,
       lead(modificationdate) OVER (PARTITION BY contract_id ORDER BY modificationdate) AS next_modificationdate
FROM c_stage""")
def q_window_lead(spark: SparkSession, d: str) -> DataFrame:
    s = scd2.stage_contracts(x_contracts(spark, d), ["seq"])
    w = Window.partitionBy("contract_id").orderBy("modificationdate")
    return s.select("contract_id", "modificationdate",
                    F.lead("modificationdate").over(w).alias("next_modificationdate"))


@register("window_row_number", """
SELECT contract_id, modificationdate,
       row_number() OVER (PARTITION BY contract_id ORDER BY modificationdate DESC) AS rn
FROM c_stage""")
def q_window_row_number(spark: SparkSession, d: str) -> DataFrame:
    s = scd2.stage_contracts(x_contracts(spark, d), ["seq"])
    w = Window.partitionBy("contract_id").orderBy(F.col("modificationdate").desc())
    return s.select("contract_id", "modificationdate", F.row_number().over(w).alias("rn"))


@register("latest_per_key", """
SELECT contract_id, modificationdate, status, usage, source_table FROM (
  SELECT *, row_number() OVER (PARTITION BY contract_id ORDER BY modificationdate DESC) AS rn
  FROM c_stage) t WHERE rn = 1""")
def q_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    s = scd2.stage_contracts(x_contracts(spark, d), ["seq"])
    latest = dedup.latest_per_key(s, ["contract_id"], ["modificationdate"])
    return latest.select("contract_id", "modificationdate", "status", "usage", "source_table")


@register("any_per_key", """
SELECT price_id, product_id, pricecomponentid, cast(price AS double) AS price, valid_from, valid_until,
       modificationdate, source_table
FROM px_hist""")
def q_any_per_key(spark: SparkSession, d: str) -> DataFrame:
    """DISTINCT ON without order + MAX(lineage) OVER the key, made deterministic (E5, Q14)."""
    s = scd2.stage_prices(x_prices(spark, d))
    return comparable(s.select("price_id", "product_id", "pricecomponentid", "price", "valid_from",
                               "valid_until", "modificationdate", "source_table"))


# ------------------------------------------------------------------ F, G
@register("order_by", """
SELECT seq, id, createdat FROM x_contracts ORDER BY createdat, id, seq""")
def q_order_by(spark: SparkSession, d: str) -> DataFrame:
    return x_contracts(spark, d).select("seq", "id", "createdat").orderBy("createdat", "id", "seq")


@register("union_all", """
SELECT contract_id, modificationdate, source_table FROM c_stage_early
UNION ALL
SELECT contract_id, modificationdate, source_table FROM c_stage_late""")
def q_union_all(spark: SparkSession, d: str) -> DataFrame:
    early, late = _staged_halves(spark, d)
    cols = ["contract_id", "modificationdate", "source_table"]
    return early.select(*cols).unionByName(late.select(*cols))


@register("union_distinct", """
SELECT product_id, period_start AS valid_from, period_end AS valid_until FROM px_pieces WHERE pricecomponentid = 1
UNION
SELECT product_id, period_start, period_end FROM px_pieces WHERE pricecomponentid = 2""")
def q_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    pieces = published(intervals.price_period_split(raw_price_history(spark, d),
                                                    max_date=NEWEST_EXTRACT))
    cols = [F.col("product_id"), F.col("period_start").alias("valid_from"),
            F.col("period_end").alias("valid_until")]
    base = pieces.where(F.col("pricecomponentid") == 1).select(*cols)
    working = pieces.where(F.col("pricecomponentid") == 2).select(*cols)
    return base.union(working).distinct()


@register("distinct", "SELECT DISTINCT productid, status FROM x_contracts")
def q_distinct(spark: SparkSession, d: str) -> DataFrame:
    return x_contracts(spark, d).select("productid", "status").distinct()


# ------------------------------------------------------------------ H scalar functions
@register("scalar_string", """
SELECT seq,
       concat_ws('::', productname, energy, deleted, releasedversion) AS joined,
       md5(concat_ws('::', productname, energy, deleted, releasedversion)) AS hashed,
       regexp_replace(source_table, '^(\\d{8})(\\d{6})_.*$', '\\1 \\2') AS stamp,
       left(source_table, 8) AS head,
       left(source_table, 8) || '_' || energy AS tagged,
       regexp_matches(source_table, '_staging_\\d{8}_\\d{9}$') AS is_staged,
       regexp_extract(source_table, '^(\\d{14})_', 1) AS file_stamp,
       trim('  ' || consumptiontype || ' ') AS trimmed,
       replace(chr(65279) || productname, chr(65279), '') AS no_bom
FROM x_products""")
def q_scalar_string(spark: SparkSession, d: str) -> DataFrame:
    p = x_products(spark, d)
    src = F.col("source_table")
    return p.select(
        "seq",
        F.concat_ws("::", "productname", "energy", "deleted", "releasedversion").alias("joined"),
        row_hash("productname", "energy", "deleted", "releasedversion").alias("hashed"),
        F.regexp_replace(src, r"^(\d{8})(\d{6})_.*$", "$1 $2").alias("stamp"),
        F.left(src, F.lit(8)).alias("head"),
        F.concat(F.left(src, F.lit(8)), F.lit("_"), F.col("energy")).alias("tagged"),
        src.rlike(r"_staging_\d{8}_\d{9}$").alias("is_staged"),
        F.regexp_extract(src, r"^(\d{14})_", 1).alias("file_stamp"),
        F.trim(F.concat(F.lit("  "), F.col("consumptiontype"), F.lit(" "))).alias("trimmed"),
        F.replace(F.concat(F.lit(BOM), F.col("productname")), F.lit(BOM), F.lit(""))
         .alias("no_bom"))


@register("scalar_date", """
SELECT seq,
       try_strptime(substr(source_table, 1, 14), '%Y%m%d%H%M%S') AS extracted_at,
       cast(strptime(substr(source_table, 1, 8), '%Y%m%d') AS date) AS snapshot_date,
       cast(date_trunc('year', startdate) AS date) AS year_start,
       make_date(year(startdate), 12, 31) AS year_end,
       month(createdat) AS created_month,
       cast(enddate - startdate AS int) AS days,
       cast(startdate - 1 AS date) AS day_before,
       cast(startdate - INTERVAL 1 MONTH AS date) AS month_before,
       cast(startdate + to_years(cast(id % 4 AS int)) AS date) AS plus_years,
       cast(generate_series(cast(modificationdate AS timestamp),
                            cast(modificationdate + INTERVAL 4 YEAR AS timestamp),
                            INTERVAL 1 YEAR)[4] AS date) AS third_step
FROM x_contracts""")
def q_scalar_date(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.select(
        "seq",
        extracted_at("source_table").alias("extracted_at"),
        snapshot_date("source_table").alias("snapshot_date"),
        D.year_start("startdate").alias("year_start"),
        D.year_end("startdate").alias("year_end"),
        F.month("createdat").alias("created_month"),
        D.days_between("enddate", "startdate").alias("days"),
        F.date_sub("startdate", 1).alias("day_before"),
        F.add_months("startdate", -1).alias("month_before"),
        D.add_years("startdate", (F.col("id") % 4).cast("int")).alias("plus_years"),
        D.yearly_step("modificationdate", F.lit(3)).alias("third_step"))


@register("scalar_math", """
SELECT id, cast(round(price, 1) AS double) AS price_1,
       cast(floor((valid_until - valid_from) / 365.0) AS int) AS years_floor,
       cast(ceil((valid_until - valid_from) / 365.0) AS int) AS years_ceil
FROM x_prices""")
def q_scalar_math(spark: SparkSession, d: str) -> DataFrame:
    p = x_prices(spark, d)
    days = D.days_between("valid_until", "valid_from")
    return p.select("id", F.round("price", 1).cast("double").alias("price_1"),
                    F.floor(days / F.lit(365)).cast("int").alias("years_floor"),
                    F.ceil(days / F.lit(365)).cast("int").alias("years_ceil"))


@register("scalar_null", """
SELECT seq, coalesce(usagenet, usage) AS consumption, nullif(usage % 7, 0) AS usage_mod,
       coalesce(enddate, DATE '9999-12-31') AS end_or_open
FROM x_contracts""")
def q_scalar_null(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.select("seq", F.coalesce("usagenet", "usage").alias("consumption"),
                    F.nullif(F.col("usage") % 7, F.lit(0)).alias("usage_mod"),
                    F.coalesce(F.col("enddate"), F.lit(OPEN_END)).alias("end_or_open"))


@register("scalar_compare", """
SELECT seq, greatest(startdate, createdat, enddate) AS latest_date,
       least(enddate, modificationdate) AS earliest_date
FROM x_contracts""")
def q_scalar_compare(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.select("seq", F.greatest("startdate", "createdat", "enddate").alias("latest_date"),
                    F.least("enddate", "modificationdate").alias("earliest_date"))


@register("scalar_case", """
SELECT seq,
       CASE status WHEN 'active' THEN 1 WHEN 'terminated' THEN 2 ELSE 0 END AS status_code,
       CASE WHEN enddate IS NULL THEN 'open' ELSE 'closed' END AS end_kind
FROM x_contracts""")
def q_scalar_case(spark: SparkSession, d: str) -> DataFrame:
    c = x_contracts(spark, d)
    return c.select(
        "seq",
        F.when(F.col("status") == "active", 1).when(F.col("status") == "terminated", 2)
         .otherwise(0).alias("status_code"),
        F.when(F.col("enddate").isNull(), "open").otherwise("closed").alias("end_kind"))


# H20 is SURVEY's "cond." group: the same CASE query under its group key.
register("scalar_cond", """
SELECT seq,
       CASE status WHEN 'active' THEN 1 WHEN 'terminated' THEN 2 ELSE 0 END AS status_code,
       CASE WHEN enddate IS NULL THEN 'open' ELSE 'closed' END AS end_kind
FROM x_contracts""")(q_scalar_case)


@register("scalar_similarity", """
SELECT seq, cast(levenshtein(productname, energy) AS int) AS edit_distance FROM x_products""")
def q_scalar_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Edit distance, the SQL-checkable name similarity."""
    p = x_products(spark, d)
    return p.select("seq", F.levenshtein("productname", "energy").alias("edit_distance"))


@register("load_id", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S')
                   || lpad(cast(millisecond(o_orderdate) % 1000 AS varchar), 3, '0') AS load_id
FROM orders""")
def q_load_id(spark: SparkSession, d: str) -> DataFrame:
    """``yyyyMMdd_HHmmssSSS`` identifiers from a timestamp column."""
    o = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    return o.select("o_orderkey", load_id(F.col("o_orderdate")).alias("load_id"))
