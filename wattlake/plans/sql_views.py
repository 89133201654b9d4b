"""The warehouse tables as SQL views, and the analyst questions over them.

Users who query the warehouse in SQL register the tables (built in one plan
or read from their published folders) and write any Spark SQL over them; the
questions that have a report in ``reports.py`` are asked by name.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import history_parts
from ..sources.staging import path_is_missing
from . import reports
from .warehouse_job import parts_folder

TABLES = ("products", "prices", "contracts", "price_periods", "contract_price_enriched")

# The analyst questions, asked of the registered views: the reports of
# ``reports.py``, with date parameters as columns.
QUESTIONS = {
    "revenue_by_created_product":
        lambda spark: reports.revenue_by_created_product(spark.table("contract_price_enriched")),
    "revenue_by_created":
        lambda spark, start, end: reports.revenue_by_created(
            spark.table("contract_price_enriched"), start, end),
    "count_distinct_in_delivery":
        lambda spark, on: reports.count_in_delivery(spark.table("contracts"), on),
    "new_contracts": lambda spark: reports.new_contracts(spark.table("contracts")),
}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Register each given warehouse table as a temp view of the same name."""
    for name, df in tables.items():
        if name not in TABLES:
            raise ValueError(f"unknown warehouse table {name!r}")
        df.createOrReplaceTempView(name)


def read_published(spark: SparkSession, warehouse: str, version: str) -> dict[str, DataFrame]:
    """The checked tables of one published version (``warehouse_job.run``).

    A table folder without its ``_checked`` marker (a failed or interrupted
    run) is not returned; any read error but a missing path is raised.  Histories
    stored in parts are read as of that version.
    """
    out = {}
    for name in ("prices", "contracts"):
        base = parts_folder(warehouse, name)
        if history_parts.read_manifest(spark, base, version) is not None:
            out[name] = history_parts.read_table(spark, base, version)
    for name in TABLES:
        if name in out:
            continue
        path = f"{warehouse.rstrip('/')}/{name}/v={version}"
        try:
            spark.read.json(f"{path}/_checked").first()
            out[name] = spark.read.parquet(path)
        except AnalysisException as e:
            if not path_is_missing(e):
                raise
            continue  # not part of this run, or not checked
    return out


def ask(spark: SparkSession, question: str, **params: str) -> DataFrame:
    """Run one of QUESTIONS; params are SQL expressions of dates, e.g. ``DATE '2020-10-01'``."""
    return QUESTIONS[question](spark, **{name: F.expr(text) for name, text in params.items()})
