"""Shared helpers of the training-data operators.

Working columns carry the prefix ``__w_`` and the caller's row travels as one
struct (:func:`packed` / :func:`unpacked`), so extra columns of an input table
can have any name without clashing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

ROW = "__w_row"

# A key that holds more than 1/HOT_KEYS of all rows is hot; there are fewer
# than HOT_KEYS of them whatever the size of the table.
HOT_KEYS = 256
SPREAD = 1024

# Rows of whole texts that a Python worker holds at a time.
TEXT_BATCH_ROWS = 256

# Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one struct column beside nothing else."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias(ROW))


def field(name: str) -> Column:
    """A column of the packed row."""
    return F.col(ROW).getField(name)


def unpacked(df: DataFrame, columns: list[str], *extra: str | Column) -> DataFrame:
    """The packed row's columns again, followed by ``extra``."""
    return df.select(*[field(c).alias(c) for c in columns], *extra)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder under the shared checkpoint dir and read back.

    Cuts lineage (a lost executor re-reads files) and computes a frame that
    several branches use only once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str,
           spread_by: Column, drop_weight: bool = True) -> DataFrame:
    """Left join ``rows`` with ``table`` (one row per key) without a hot task.

    ``weight`` is the number of rows of each key, counted by the caller.  Keys
    above 1/HOT_KEYS of the total are fewer than HOT_KEYS, so that part of the
    table is broadcast whatever the input's size; every other key goes through
    a shuffled join, where no key holds more than 1/HOT_KEYS of the rows.  Rows
    answered by the broadcast are spread over the shuffle by ``spread_by``.
    ``table`` is read twice: pass a written one.  Null keys match nothing.
    """
    values = [c for c in table.columns if c not in keys and c != weight]
    total = table.agg(F.sum(weight)).first()[0] or 0
    bound = max(1, total // HOT_KEYS)
    hot = table.where(F.col(weight) > bound).select(
        *keys, *[F.col(v).alias(f"__w_hot_{v}") for v in values], F.lit(True).alias("__w_is_hot"))
    cold = table.where(F.col(weight) <= bound).select(
        *keys, *values, F.lit(0).cast("long").alias("__w_spread"))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    spread = F.when(F.col("__w_is_hot") | missing, F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)) + 1
                    ).otherwise(F.lit(0)).cast("long")
    first = (rows.join(F.broadcast(hot), keys, "left").withColumn("__w_spread", spread))
    both = first.join(cold, [*keys, "__w_spread"], "left")
    out = [F.when(F.col("__w_is_hot"), F.col(f"__w_hot_{v}")).otherwise(F.col(v)).alias(v) for v in values]
    return both.select(*[c for c in rows.columns], *out)


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches lowered to TEXT_BATCH_ROWS.

    Whole texts go to Python workers, and Spark's default of 10,000 rows a
    batch would make a worker's memory grow with the length of the texts.  The
    setting is read when a plan runs, so it stays lowered for the session.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    now = int(conf.get(key, "10000"))
    if not 0 < now <= TEXT_BATCH_ROWS:
        conf.set(key, str(TEXT_BATCH_ROWS))
    return df


def pieces(n: int, each: int) -> int:
    """How many parts of about ``each`` rows ``n`` rows make."""
    return max(1, -(-int(n) // each))
