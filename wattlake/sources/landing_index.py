"""The landing index: which files were seen, by which load, and which units still wait.

Three small Parquet datasets under one folder:

* ``files``: one row per file and load that saw it, by month and load.  A
  replayed load replaces its own rows.
* ``pending``: the units that a load failed and none has staged since, by load.
  Loads without failures write nothing here, so reading it does not grow with
  the history of good loads.

A batch of new files reads the index for the earlier files of its units (only
of their months) instead of listing the landing folder, and a load may ask for
new or changed files only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import empty, scratch_path

FILE_SCHEMA = "path string, length long, modificationTime timestamp, file_name string, yyyymm string, load_id string"
PENDING_SCHEMA = "file string, load_id string"


def path_is_missing(e: AnalysisException) -> bool:
    """Whether a read failed because its path does not exist, and for nothing else."""
    return e.getCondition() == "PATH_NOT_FOUND"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        return empty(spark, schema)


def _replace(df: DataFrame, path: str, *parts: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def remember(files: DataFrame, index_dir: str, load_id: str) -> None:
    """Record the files that a load saw (columns path, length, modificationTime, file_name)."""
    rows = files.select("path", "length", "modificationTime", "file_name",
                        F.substring("file_name", 1, 6).alias("yyyymm"), F.lit(load_id).alias("load_id"))
    _replace(rows, f"{index_dir.rstrip('/')}/files", "yyyymm", "load_id")


def known_files(spark: SparkSession, index_dir: str, months: list[str] | None = None) -> DataFrame:
    """The latest state of every file seen, of some months only if given (a partition-pruned read)."""
    rows = _read(spark, f"{index_dir.rstrip('/')}/files", FILE_SCHEMA)
    if months is not None:
        rows = rows.where(F.col("yyyymm").isin(months))
    return (rows.groupBy("path", "file_name").agg(
        F.max_by(F.struct("length", "modificationTime"), F.struct("modificationTime", "length")).alias("s"))
        .select("path", "s.length", "s.modificationTime", "file_name"))


def high_water(spark: SparkSession, index_dir: str):
    """The newest modification time of a file seen, None for an empty index."""
    return known_files(spark, index_dir).agg(F.max("modificationTime")).first()[0]


def with_earlier_files(batch: DataFrame, index_dir: str) -> DataFrame:
    """The files of a batch and those that came earlier for the same units, each once.

    The months read from the index are those of the batch's units.
    """
    spark = batch.sparkSession
    months = [r[0] for r in batch.select(F.substring("file_name", 1, 6).alias("m")).distinct().collect()]
    earlier = known_files(spark, index_dir, months).join(batch.select("file_name").distinct(), "file_name", "left_semi")
    cols = ["path", "length", "modificationTime", "file_name"]
    return batch.select(*cols).unionByName(earlier.join(batch.select("path"), "path", "left_anti").select(*cols))


def new_units(listed: DataFrame, index_dir: str) -> DataFrame:
    """The listed files of units that have a file the index does not know in this state."""
    seen = known_files(listed.sparkSession, index_dir).select("path", "length", "modificationTime")
    fresh = listed.join(seen, ["path", "length", "modificationTime"], "left_anti").select("file_name").distinct()
    return listed.join(fresh, "file_name", "left_semi")


def pending(spark: SparkSession, index_dir: str) -> DataFrame:
    """(load_id, file): units that a load failed and no load has staged since."""
    rows = _read(spark, f"{index_dir.rstrip('/')}/pending", PENDING_SCHEMA)
    return (rows.where("file is not null").groupBy("file").agg(F.max("load_id").alias("load_id"))
            .select("load_id", "file"))


def settle(log: DataFrame, index_dir: str, load_id: str) -> None:
    """Bring ``pending`` up to date with a load's log rows.

    Rewrites this load's rows and those of loads that waited for a unit this
    load staged; a load with nothing left keeps one empty row.
    """
    spark = log.sparkSession
    path = f"{index_dir.rstrip('/')}/pending"
    now = scratch_path(spark, "settled")
    log.where(F.col("file") != "N/A").select("file", "status").write.parquet(now)
    done = spark.read.schema("file string, status string").parquet(now)
    failed = done.where("status = 'FAILED'").select("file", F.lit(load_id).alias("load_id"))
    good = done.where("status = 'SUCCESS'").select("file")
    before = _read(spark, path, PENDING_SCHEMA)
    touched = (before.join(good, "file", "left_semi").select("load_id")
               .union(before.where(F.col("load_id") == load_id).select("load_id"))
               .union(failed.select("load_id"))).distinct()
    kept = before.where("file is not null").join(good, "file", "left_anti").join(
        touched, "load_id", "left_semi").select("file", "load_id")
    tried = done.select("file", F.lit(load_id).alias("load_id"))
    rows = kept.join(tried, ["file", "load_id"], "left_anti").unionByName(failed).distinct()
    empty = touched.join(rows, "load_id", "left_anti").select(F.lit(None).cast("string").alias("file"), "load_id")
    out = scratch_path(spark, "pending")
    rows.unionByName(empty).write.parquet(out)
    both = spark.read.schema(PENDING_SCHEMA).parquet(out)
    _replace(both, path, "load_id")
