"""Dense surrogate keys: gap-free whole numbers, unique over all loads.

A natural key gets its number once.  Each load numbers the keys that no load
before it numbered: every task counts its rows, the counts become offsets (one
number per task, on the driver), and a row's number is the high-water mark of
the loads before, its task's offset and its place in the task.  No row passes
through a single task, and nothing is sorted.

Numbers are written by load beside their high-water mark.  A repeated load
starts from the loads before it and replaces its own numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# Low bits of monotonically_increasing_id: the row's place in its task.
PLACE_BITS = 33


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def numbered(rows: DataFrame, start: int, name: str = "sk") -> tuple[DataFrame, int]:
    """``rows`` with ``name`` = start + 1, start + 2, ... in no order, and the last number given."""
    spark = rows.sparkSession
    place = F.monotonically_increasing_id()
    placed = rows.withColumn("__part", F.shiftright(place, PLACE_BITS)).withColumn(
        "__place", place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
    path = scratch_path(spark, "numbered")
    placed.write.parquet(path)  # a row's place is fixed here, whatever is recomputed later
    placed = spark.read.schema(placed.schema).parquet(path)
    offsets, last = [], start
    for r in placed.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect():
        offsets.append((r["__part"], last))
        last += r["n"]
    small = spark.createDataFrame(offsets, "__part long, __offset long")  # one row per task
    out = placed.join(F.broadcast(small), "__part")
    return out.withColumn(name, F.col("__offset") + F.col("__place") + 1).drop("__part", "__place", "__offset"), last


def assign(rows: DataFrame, keys: Sequence[str], path: str, load_id: str, name: str = "sk") -> DataFrame:
    """(keys, ``name``) of every natural key of ``rows``: known ones as they are, new ones numbered.

    Nulls are values of a key like any other.  ``path`` holds the numbers, by
    load; load ids sort in the order of the loads.
    """
    spark = rows.sparkSession
    fields = [rows.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField(name, T.LongType()), T.StructField("load_id", T.StringType())])
    marks = T.StructType([T.StructField("high", T.LongType()), T.StructField("load_id", T.StringType())])
    folder = path.rstrip("/")
    before = _table(spark, f"{folder}/keys", schema).where(F.col("load_id") < load_id)
    high = _table(spark, f"{folder}/high", marks).where(F.col("load_id") < load_id).agg(F.max("high")).first()[0] or 0
    wanted = rows.select(*keys).distinct()
    old = before.drop("load_id")
    same = [wanted[k].eqNullSafe(old[k]) for k in keys]
    new, last = numbered(wanted.join(old, same, "left_anti"), high, name)
    for df, part in ((new.select(*keys, name), "keys"), (spark.createDataFrame([(last,)], "high long"), "high")):
        (df.withColumn("load_id", F.lit(load_id)).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(f"{folder}/{part}"))
    known = _table(spark, f"{folder}/keys", schema).where(F.col("load_id") <= load_id).drop("load_id")
    same = [wanted[k].eqNullSafe(known[k]) for k in keys]
    return wanted.join(known, same).select(*[wanted[k].alias(k) for k in keys], known[name].alias(name))
