"""A type-2 history stored as current and closed parts.

Rows are dealt into buckets by a hash of their key.  A load writes one folder,
``load=<id>/part=<current|closed>/b=<bucket>``: the current rows of the buckets
it touches (those of its own keys changed, the others copied) and the rows it
closes or adds closed.  Closed rows are never written again, and buckets without
a key of the load are not rewritten.  A manifest per load names, for every
bucket, the load whose folder holds its current rows, and the loads with closed
rows; it is written last, so a folder without one is not part of any table, and
earlier loads stay readable.

What a load reads of closed rows are the keys and versions in its own buckets.
Every filter on load, part and bucket is on partition columns: files of other
buckets are not opened.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, scd2
from ..operators.joins import DEFAULT_MAX_ROWS, maybe_broadcast, rows_at_most
from ..schema import NOT_NULL
from ..session import written
from .staging import path_is_missing

BUCKETS = 256
_PARTITIONS = "load string, part string, b int"


@dataclass(frozen=True)
class History:
    """What a history's load does: its key, staging, new versions and closing."""

    table: str
    key: str
    columns: tuple[str, ...]
    stage: Callable[[DataFrame, Sequence[str] | None], DataFrame]
    versions: Callable[[DataFrame, _dt.datetime | Column | None], DataFrame]
    close: Callable[[DataFrame, Sequence[str]], DataFrame]


CONTRACTS = History("contracts", "contract_id", tuple(scd2.CONTRACT_COLUMNS), scd2.stage_contracts,
                    scd2.contract_versions, lambda df, key: scd2.close_superseded(df, key, "modificationdate"))
PRICES = History("prices", "price_id", tuple(scd2.PRICE_COLUMNS), scd2.stage_prices,
                 scd2.price_versions, lambda df, key: scd2.newest_flag(df, key, "modificationdate"))


@dataclass(frozen=True)
class Manifest:
    """The folders that make up a table as of one load."""

    load: str
    buckets: int
    schema: str
    current: dict[int, str]
    closed: list[str]


def read_manifest(spark: SparkSession, base: str, load: str) -> Manifest | None:
    """The manifest of ``load``, or None if that load was never finished."""
    path = f"{base.rstrip('/')}/_manifest/{load}"
    try:
        row = spark.read.schema("load string, buckets int, columns string, holders array<string>, closed array<string>"
                                ).json(path).first()
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        return None
    if row is None:
        return None
    return Manifest(row.load, row.buckets, row.columns,
                    {b: h for b, h in enumerate(row.holders) if h}, list(row.closed))


def _write_manifest(spark: SparkSession, base: str, m: Manifest) -> None:
    row = (m.load, m.buckets, m.schema, [m.current.get(b, "") for b in range(m.buckets)], m.closed)
    spark.createDataFrame([row], "load string, buckets int, columns string, holders array<string>, "
                                 "closed array<string>").coalesce(1).write.mode("overwrite").json(
        f"{base.rstrip('/')}/_manifest/{m.load}")


def _scan(spark: SparkSession, base: str, m: Manifest, part: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of one part with their bucket ``b``, of the given buckets only."""
    wanted = set(m.current) if buckets is None else set(buckets)
    if part == "current":
        held = {b: m.current[b] for b in sorted(wanted) if b in m.current}
        loads = sorted(set(held.values()))
        # Grouped by load: one term for each load that still holds buckets.
        here = [(F.col("load") == load) & F.col("b").isin([b for b, h in held.items() if h == load]) for load in loads]
    else:
        loads = m.closed
        here = [F.lit(True) if buckets is None else F.col("b").isin(sorted(wanted))]
    if not loads or not here:
        return spark.createDataFrame([], f"{m.schema}, b int")
    root = base.rstrip("/")
    rows = (spark.read.schema(f"{m.schema}, {_PARTITIONS}").option("basePath", root)
            .parquet(*[f"{root}/load={load}" for load in loads]))
    anywhere = here[0]
    for term in here[1:]:
        anywhere = anywhere | term
    return rows.where((F.col("part") == part) & anywhere).drop("load", "part")


def read_table(spark: SparkSession, base: str, load: str) -> DataFrame:
    """The whole history as of ``load``: current and closed rows."""
    m = read_manifest(spark, base, load)
    if m is None:
        raise ValueError(f"no finished load {load!r} in {base}")
    return _scan(spark, base, m, "current").unionByName(_scan(spark, base, m, "closed")).drop("b")


def read_current(spark: SparkSession, base: str, load: str) -> DataFrame:
    """The current rows as of ``load``; closed files are not opened."""
    m = read_manifest(spark, base, load)
    if m is None:
        raise ValueError(f"no finished load {load!r} in {base}")
    return _scan(spark, base, m, "current").drop("b")


def apply_load(staging: DataFrame, history: History, base: str, load: str, previous: str | None = None,
               run_ts: _dt.datetime | Column | None = None, tiebreak: Sequence[str] | None = None,
               buckets: int = BUCKETS, check: bool = True) -> DataFrame:
    """Merge a staged load into the table as of ``previous``; the table as of ``load``.

    The rows equal those of :func:`scd2.scd2_contracts` / ``scd2_prices`` on the
    same load and history.  Staged rows are computed once and written.  ``check``
    looks for nulls and repeated keys among the rows this load writes: versions
    already stored are left out of it beforehand, so no other row can clash.
    ``buckets`` holds for a new table; an existing one keeps its own.  Loading an
    id again replaces its folder; it must not be one that ``previous`` reads.
    """
    spark = staging.sparkSession
    old = None
    if previous is not None:
        old = read_manifest(spark, base, previous)
        if old is None:
            raise ValueError(f"no finished load {previous!r} in {base}")
        if load in old.closed or load in old.current.values():
            raise ValueError(f"load {load!r} is part of {previous!r}")
        buckets = old.buckets
    bucket = F.pmod(F.xxhash64(history.key), F.lit(buckets)).cast("int")
    staged = written(history.stage(staging, tiebreak).withColumn("b", bucket), f"staged-{history.table}")
    # At most ``buckets`` numbers.
    touched = sorted(r.b for r in staged.select("b").distinct().collect())
    version = [history.key, "modificationdate"]
    new, rows = staged, None
    if old is not None:
        rows = _scan(spark, base, old, "current", touched)
        known = rows.select(*version).unionByName(_scan(spark, base, old, "closed", touched).select(*version))
        keys = staged.select(history.key).distinct()
        if rows_at_most(keys, DEFAULT_MAX_ROWS):
            known = known.join(maybe_broadcast(keys, True), history.key, "left_semi")
        new = scd2.anti_join_new_rows(staged, known, version)
    added = history.versions(new, run_ts).withColumn("b", bucket)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added.drop("b").schema.fields)
    rows = added if rows is None else rows.unionByName(added)
    # One exchange, by bucket: the closing window keeps it, and each bucket is one task's files.
    closed = history.close(rows.repartition("b"), ["b", history.key])
    part = F.when(F.col("is_current"), F.lit("current")).otherwise(F.lit("closed"))
    folder = f"{base.rstrip('/')}/load={load}"
    closed.select(*history.columns, part.alias("part"), "b").write.mode("overwrite").partitionBy("part", "b").parquet(folder)
    if check:
        own = spark.read.schema(f"{schema}, part string, b int").parquet(folder)
        checks.assert_constraints(own, version, NOT_NULL.get(history.table, []))
    holders = dict(old.current) if old is not None else {}
    holders.update(dict.fromkeys(touched, load))
    _write_manifest(spark, base, Manifest(load, buckets, schema, holders,
                                          [*(old.closed if old is not None else []), load]))
    return read_table(spark, base, load)
