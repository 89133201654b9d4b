"""Session helpers.

The library never creates a session inside an operator; callers pass one
in.  ``build_session`` is what tests, the bench and the CLI use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job of this repo is tuned for.  AQE turns a sort-merge
# join into a broadcast join only after it has measured the smaller side at
# runtime, which is the size check we rely on instead of blind hints.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "wattlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS") or os.environ.get("WATTLAKE_CPUS") or "8"
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", os.environ.get("WATTLAKE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions expose no SparkContext
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return (master or "").startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read.  Only
    when it is unset on a local master (tests, bench) do we set one ourselves.
    """
    sc = _context(spark)
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = sc.getCheckpointDir() if sc is not None else None
    if current:
        if sc is not None and not sc_dir:
            sc.setCheckpointDir(current)
        return current
    if sc_dir:
        spark.conf.set("spark.checkpoint.dir", sc_dir)
        return sc_dir
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage "
                           "(scratch tables and checkpoints must survive executor loss)")
    local = tempfile.mkdtemp(prefix="wattlake-ckpt-")  # local mode only (tests, bench)
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a scratch table: computed once for all that read it, its lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows of ``schema``, known to the planner as such: no Python worker starts for them."""
    fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
