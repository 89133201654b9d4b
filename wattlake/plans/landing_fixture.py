"""Landing snapshots derived from the test feeds, with the drift cases of
FIXTURES §1, and the human-confirmed matching rules for them.

Every row of ``x_contracts``, ``x_products`` and ``x_prices`` is written to
a landing unit named after its source month, so the landing work grows
with the scale factor.  The files go to a fresh folder under the session's
checkpoint dir (shared storage on a cluster).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import staging
from ..sources.adapters import x_contracts, x_prices, x_products

LOAD_ID = "20260101_220057123"
PRICES_UNIT = "20010801220039_prices.csv"
BOM = "\ufeff"

# Fixed drift cases per source month: delimiter and header changes.
CONTRACT_CASES = {
    "20010401": {"sep": ";", "rename": {"filingdatecancellation": "fillingdatecancellation"}},
    "20010501": {"sep": ","},
    "20010601": {"sep": ";", "bom": True, "pad": True},
    "20010701": {"sep": ";", "extra": {"tariff": "type"}},
    "20010801": {"sep": ";", "drop": ["city"]},
}
PRODUCT_CASES = {
    "20010401": {"sep": ";"},
    "20010501": {"sep": ";"},
    "20010601": {"sep": ";"},
    "20010701": {"sep": ";"},
    "20010801": {"sep": ","},
}

# Fixed matching rules as a person would confirm them (saved-file format).
CONTRACT_RULES = {
    "20010401": '{"__delimiter__": ";", "filingdatecancellation": {"suggested": '
                '"fillingdatecancellation", "user_submitted": 1, "pass_as_null": 0}}',
    "20010801": '{"__delimiter__": ";", "city": {"suggested": null, "user_submitted": 0, '
                '"pass_as_null": 1}}',
}
PRODUCT_RULES = {
    "20010401": '{"__delimiter__": ";", "productcode": {"suggested": null, "user_submitted": 0, '
                '"pass_as_null": 1}}',
    "20010601": '{"__delimiter__": ";", "productcode": {"suggested": "product_code", '
                '"user_submitted": 1, "pass_as_null": 0}}',
    "20010701": '{"productcode": {"suggested": null, "user_submitted": 0, "pass_as_null": 1}}',
    "20010801": '{"__delimiter__": ",", "productcode": {"suggested": null, "user_submitted": 0, '
                '"pass_as_null": 1}}',
}
PRICE_RULES = ('{"__delimiter__": ",", "pricecomponent": {"suggested": "productcomponent", '
               '"user_submitted": 1, "pass_as_null": 0}, "unit": {"suggested": null, '
               '"user_submitted": 0, "pass_as_null": 1}}')


@dataclass(frozen=True)
class LandingPaths:
    root: str
    landing: str
    rules: str
    drafts: str
    staging: str
    log: str


def _unit(entity: str) -> Column:
    return F.concat(F.substring("source_table", 1, 14), F.lit(f"_{entity}.csv"))


def _month() -> Column:
    return F.substring("source_table", 1, 8)


def _write(df: DataFrame, path: str, sep: str, keep_spaces: bool = False) -> None:
    w = (df.write.mode("overwrite").partitionBy("unit").option("header", "true")
         .option("sep", sep))
    if keep_spaces:
        w = w.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    w.csv(path)


def write_landing(spark: SparkSession, sf_dir: str, landing: str) -> None:
    c = x_contracts(spark, sf_dir).withColumn("unit", _unit("contracts"))
    base = {
        "id": F.col("id"), "type": F.col("type"), "energy": F.lit(None).cast("string"),
        "usage": F.col("usage"), "usagenet": F.col("usagenet"), "createdat": F.col("createdat"),
        "startdate": F.col("startdate"), "enddate": F.col("enddate"),
        "filingdatecancellation": F.lit(None).cast("date"),
        "cancellationreason": F.lit(None).cast("string"), "city": F.lit(None).cast("string"),
        "status": F.col("status"), "productid": F.col("productid"),
        "modificationdate": F.col("modificationdate"),
    }
    for month, case in CONTRACT_CASES.items():
        cols = []
        for name, expr in base.items():
            if name in case.get("drop", []):
                continue
            label = case.get("rename", {}).get(name, name)
            if case.get("pad"):
                label = f"  {label} "
            if case.get("bom") and name == "id":
                label = BOM + label
            cols.append(expr.alias(label))
        for extra, src in case.get("extra", {}).items():
            cols.append(base[src].alias(extra))
        rows = c.where(_month() == month).select(*cols, "unit")
        _write(rows, f"{landing}/contracts_{month}", case["sep"], keep_spaces=bool(case.get("pad")))

    p = x_products(spark, sf_dir).withColumn("unit", _unit("products"))
    for month, case in PRODUCT_CASES.items():
        rows = p.where(_month() == month).select(
            "id", "productname", "energy", "consumptiontype", "deleted", "releasedversion",
            "modificationdate", "unit")
        _write(rows, f"{landing}/products_{month}", case["sep"])

    comp = F.col("pricecomponentid")
    pr = x_prices(spark, sf_dir).select(
        "id", "productid", "pricecomponentid",
        F.when(comp == 1, "baseprice").when(comp == 2, "workingprice").otherwise("other")
         .alias("productcomponent"),
        "price", "valid_from", "valid_until", "modificationdate", F.lit(PRICES_UNIT).alias("unit"))
    _write(pr, f"{landing}/prices", ",")


def write_rules_table(spark: SparkSession, sf_dir: str, rules: str) -> None:
    """The confirmed rules as a JSON-lines rules table, one row per unit."""
    def doc(cases: dict[str, str]) -> Column:
        out = F.lit(None).cast("string")
        for month, text in cases.items():
            out = F.when(_month() == month, F.lit(text)).otherwise(out)
        return out

    # A unit's rules follow from its name alone: found once a unit, not on every row.
    c = x_contracts(spark, sf_dir).select("source_table").distinct().select(
        _unit("contracts").alias("file_name"), doc(CONTRACT_RULES).alias("rules_json"))
    p = x_products(spark, sf_dir).select("source_table").distinct().select(
        _unit("products").alias("file_name"), doc(PRODUCT_RULES).alias("rules_json"))
    pr = x_prices(spark, sf_dir).select(F.lit(PRICES_UNIT).alias("file_name"),
                                        F.lit(PRICE_RULES).alias("rules_json"))
    table = c.unionByName(p).unionByName(pr).where(F.col("rules_json").isNotNull()).distinct()
    table.write.mode("overwrite").json(rules)


_RUNS: dict[tuple[str, str], tuple[LandingPaths, staging.LandingResult]] = {}


def landed(spark: SparkSession, sf_dir: str) -> tuple[LandingPaths, staging.LandingResult]:
    """Write the landing files and rules, run the landing job once per session."""
    key = (spark.conf.get("spark.app.id", None) or str(id(spark)), sf_dir)
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "landing")
    paths = LandingPaths(root=root, landing=f"{root}/landing", rules=f"{root}/rules",
                         drafts=f"{root}/drafts", staging=f"{root}/staging", log=f"{root}/load_log")
    write_landing(spark, sf_dir, paths.landing)
    write_rules_table(spark, sf_dir, paths.rules)
    result = staging.run_landing(spark, paths.landing, paths.staging, LOAD_ID,
                                 entities="products,prices,contracts", start="200104",
                                 end="200108", rules_dir=paths.rules, drafts_dir=paths.drafts,
                                 log_dir=paths.log)
    _RUNS[key] = (paths, result)
    return _RUNS[key]
