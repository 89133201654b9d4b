"""Landing units with drifted headers, derived from the orders: one per day and customer.

A unit's name, header and confirmed rule follow from its day and key, so their
number grows with the orders.  Headers drop, rename or add a column, use either
delimiter, quote, pad, or begin with a byte order mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EXPECTED_COLUMNS
from ..sources.landing import BOM, expected_names
from .oracle import CTE


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("k")
    entity = F.element_at(F.array(*map(F.lit, ("contracts", "products", "prices"))), (k % 3 + 1).cast("int"))
    rows = (orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("day"), (F.col("o_custkey") % 1_000_000).alias("k6"))
            .agg(F.max("o_custkey").alias("k")).withColumn("entity", entity)
            .withColumn("names", expected_names("entity"))
            .withColumn("at", (k % F.size("names")).cast("int"))
            .withColumn("dropped", k % 5 == 0).withColumn("renamed", (k % 7 == 0) & (k % 5 != 0))
            .withColumn("target", F.element_at("names", F.col("at") + 1)))
    return rows.select(
        F.concat("day", F.lpad(F.col("k6").cast("string"), 6, "0"), F.lit("_"), "entity", F.lit(".csv")).alias("file_name"),
        "entity", "k", "names", "at", "dropped", "renamed", "target",
        F.concat(F.substring("target", 1, 1), "target").alias("new"),
        F.when(k % 2 == 0, F.lit(";")).otherwise(F.lit(",")).alias("sep"))


def drifted_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_name, entity, header) of every unit."""
    k = F.col("k")

    def cell(x: Column, i: Column) -> Column:
        x = F.when(F.col("renamed") & (i == F.col("at")), F.col("new")).otherwise(x)
        return F.when(k % 13 == 0, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x)

    kept = F.filter(F.transform("names", cell), lambda x, i: ~(F.col("dropped") & (i == F.col("at"))))
    cells = F.when(k % 4 == 0, F.concat(kept, F.array(F.lit("tariff")))).otherwise(kept)
    pad = F.when(k % 6 == 0, F.lit(" ")).otherwise(F.lit(""))
    mark = F.when(k % 11 == 0, F.lit(BOM)).otherwise(F.lit(""))
    joined = F.array_join(F.transform(cells, lambda x: F.concat(x, pad)), "\x00")
    return _units(spark, sf_dir).select("file_name", "entity",
                                        F.concat(mark, F.replace(joined, F.lit("\x00"), F.col("sep"))).alias("header"))


def confirmed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules a person saved for half of the drifted units, some without a delimiter."""
    k = F.col("k")
    known = (F.col("dropped") | F.col("renamed")) & (F.floor(k / 10) % 2 == 0)
    return _units(spark, sf_dir).where(known).select(
        "file_name", F.when(k % 17 != 0, F.col("sep")).alias("delimiter"), "target",
        F.when(F.col("renamed"), F.col("new")).alias("suggested"),
        F.when(F.col("renamed"), F.floor(k / 20) % 2).otherwise(0).cast("int").alias("user_submitted"),
        (F.floor(k / 40) % 2).cast("int").alias("pass_as_null"))


_NAMES = "CASE entity " + " ".join(
    f"WHEN '{e}' THEN [{', '.join(repr(c) for c in cols)}]" for e, cols in EXPECTED_COLUMNS.items()) + " END"

CTE["d_units"] = f"""
SELECT *, CASE WHEN k % 2 = 0 THEN ';' ELSE ',' END AS sep, names[pos] AS target, names[pos][1] || names[pos] AS new
FROM (SELECT *, (k % len(names) + 1)::INTEGER AS pos, k % 5 = 0 AS dropped, k % 7 = 0 AND k % 5 <> 0 AS renamed
  FROM (SELECT day || lpad(k6::VARCHAR, 6, '0') || '_' || entity || '.csv' AS file_name, entity, k, {_NAMES} AS names
    FROM (SELECT *, ['contracts', 'products', 'prices'][k % 3 + 1] AS entity
      FROM (SELECT strftime(o_orderdate, '%Y%m%d') AS day, o_custkey % 1000000 AS k6, max(o_custkey) AS k
            FROM orders GROUP BY ALL) a) b) c) e"""

CTE["d_headers"] = """
SELECT u.*, CASE WHEN k % 11 = 0 THEN chr(65279) ELSE '' END || replace(array_to_string(list_transform(
    list_filter(list_transform(names, lambda x, i: CASE WHEN renamed AND i = pos THEN new ELSE x END),
                            lambda x, i: NOT (dropped AND i = pos)),
    lambda x: CASE WHEN k % 13 = 0 THEN '"' || x || '"' ELSE x END || CASE WHEN k % 6 = 0 THEN ' ' ELSE '' END), '|'), '|', sep)
  || CASE WHEN k % 4 = 0 THEN sep || 'tariff' || CASE WHEN k % 6 = 0 THEN ' ' ELSE '' END ELSE '' END AS header
FROM d_units u"""

CTE["d_cells"] = """
SELECT *, list_transform(string_split(replace(header, chr(65279), ''), ';'),
                         lambda x: regexp_replace(trim(x), '^"(.*)"$', '\\1')) AS by_semi,
  list_transform(string_split(replace(header, chr(65279), ''), ','),
                 lambda x: regexp_replace(trim(x), '^"(.*)"$', '\\1')) AS by_comma
FROM d_headers"""

CTE["d_detected"] = """
SELECT file_name, entity, k, names, delimiter, CASE delimiter WHEN ';' THEN by_semi ELSE by_comma END AS cols,
  list_filter(names, lambda x: NOT list_contains(CASE delimiter WHEN ';' THEN by_semi ELSE by_comma END, x)) AS missing
FROM (SELECT *, CASE WHEN len(list_filter(names, lambda x: NOT list_contains(by_semi, x)))
                       <= len(list_filter(names, lambda x: NOT list_contains(by_comma, x))) THEN ';' ELSE ',' END AS delimiter
      FROM d_cells) x"""

CTE["d_rules"] = """
SELECT file_name, CASE WHEN k % 17 <> 0 THEN sep END AS delimiter, target, CASE WHEN renamed THEN new END AS suggested,
  CASE WHEN renamed THEN k // 20 % 2 ELSE 0 END::INTEGER AS user_submitted, (k // 40 % 2)::INTEGER AS pass_as_null
FROM d_units WHERE (dropped OR renamed) AND k // 10 % 2 = 0"""

CTE["d_suggested"] = """
SELECT m.file_name, m.target, b.suggested, b.score
FROM (SELECT file_name, unnest(missing) AS target FROM d_detected) m
LEFT JOIN (
  SELECT file_name, target, arg_max(candidate, (score, candidate)) AS suggested, max(score) AS score
  FROM (SELECT *, 1.0 - levenshtein(candidate, target) / greatest(length(candidate), length(target)) AS score
        FROM (SELECT file_name, target, unnest(cols) AS candidate
              FROM (SELECT file_name, cols, unnest(missing) AS target FROM d_detected) t) c) s
  WHERE score >= 0.6 GROUP BY file_name, target) b ON m.file_name = b.file_name AND m.target = b.target"""

CTE["d_plan"] = """
SELECT file_name, entity, renames, fills, still,
  CASE WHEN len(still) > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM (
  SELECT file_name, entity, CASE WHEN tidy OR NOT confirmed THEN '' ELSE suggested || '>' || target END AS renames,
    CASE WHEN NOT tidy AND NOT confirmed AND pass_as_null = 1 THEN target ELSE '' END AS fills,
    CASE WHEN delimiter IS NULL THEN names WHEN tidy THEN []
         ELSE list_filter(missing, lambda x: x <> target OR NOT (confirmed OR pass_as_null = 1)) END AS still
  FROM (SELECT *, delimiter IS NULL OR len(missing) = 0 AS tidy,
               user_submitted = 1 AND coalesce(list_contains(cols, suggested), false) AS confirmed
        FROM (SELECT c.file_name, entity, names, r.delimiter, r.target, r.suggested, user_submitted, pass_as_null,
                CASE r.delimiter WHEN ',' THEN by_comma ELSE by_semi END AS cols,
                list_filter(names, lambda x: NOT list_contains(CASE r.delimiter WHEN ',' THEN by_comma ELSE by_semi END, x))
                  AS missing
              FROM d_cells c JOIN d_rules r USING (file_name)) x) y
  UNION ALL
  SELECT file_name, entity, '', '', missing FROM d_detected WHERE file_name NOT IN (SELECT file_name FROM d_rules)) z"""
