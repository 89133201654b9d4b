"""Staging: read reconciled landing units, write them per load, log, view
(A2, A10, A11, A13, A14, A18).

Staging is one Parquet dataset per entity, partitioned by ``load_id`` and
``source_table`` (``<unit>_staging_<load_id>``).  Writing uses dynamic
partition overwrite, so re-running a load replaces only its own partitions;
the staging view of a load is a partition-pruned read of that dataset,
replacing the per-table UNION ALL view.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import maybe_broadcast, rows_at_most
from ..schema import EXPECTED_COLUMNS, NO_DATA, STAGING_TYPES, typed_projection
from ..session import empty, scratch_path
from . import csv_records, landing, landing_index
from .landing_index import path_is_missing


def new_load_id(ts: _dt.datetime) -> str:
    """``yyyyMMdd_HHmmssSSS`` from the job's start time (UTC)."""
    return ts.strftime("%Y%m%d_%H%M%S") + f"{ts.microsecond // 1000:03d}"


def staging_table_name(unit: Column, load_id: str) -> Column:
    """``<unit without .csv>_staging_<load_id>``; evaluated on every staged row, so without a pattern."""
    name = F.when(F.endswith(unit, F.lit(".csv")), F.left(unit, F.length(unit) - 4)).otherwise(unit)
    return F.concat(name, F.lit(f"_staging_{load_id}"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """One row per unit, written once: what reads it later plans a plain scan."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _unit_depth(path: str) -> int:
    """How many folders below its unit a file lies; -1 if the path names no unit."""
    unit = re.search(landing._UNIT, path, re.ASCII)
    return path.count("/", unit.end(1)) if unit else -1


def _unit_of_file(file: str, depth: int = -1) -> Column:
    """The unit of a row's file; found without a pattern if it lies ``depth`` folders below it (-1: not known)."""
    if depth < 0:
        return F.regexp_extract(file, landing._UNIT, 1)
    name = F.substring_index(F.substring_index(file, "/", -depth - 1), "/", 1)
    return F.substring_index(name, "=", -1)


def _layouts(plan: DataFrame) -> DataFrame:
    """How each passing unit's cells are named: one row per unit."""
    def renamed(n: Column) -> Column:
        hits = F.filter("renames", lambda r: r.source == n)
        return F.when(F.size(hits) > 0, F.element_at(hits, -1).target).otherwise(n)
    return plan.where(F.col("status") == "SUCCESS").select(
        F.col("file_name").alias("__unit"), "entity", "delimiter", F.size("columns").alias("width"),
        F.transform("columns", renamed).alias("names"), "fills", *[c for c in plan.columns if c == "untidy"])


def _own_files(files: DataFrame, layouts: DataFrame) -> DataFrame:
    """The listed files of the units in ``layouts``."""
    return files.join(layouts.select(F.col("__unit").alias("file_name")), "file_name", "left_semi")


def _as_paths(paths: Iterable[str]) -> list[str]:
    """Paths as the readers take them, characters of path patterns escaped.

    One string per file of the load, as Spark's own file index holds them.
    """
    return sorted(re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths)


def _text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of these files, split at line feeds only; a file that breaks off gives the lines before."""
    return (spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
            .option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").text(paths))


def _line_stats(spark: SparkSession, paths: list[str], delimiter: str) -> DataFrame:
    """What :func:`_line_report` needs of each file's lines: a row per file, keyed by nothing but its path.

    A line meets neither its unit nor a join: the delimiter is that of all
    these files, and widths are compared with the file's largest count.
    """
    sep = f"\\Q{delimiter}\\E"
    quoted = f'(^|{sep})"[^"]*+(?:""[^"]*+)*+"(?={sep}|\\z)'
    # Most lines hold no quote: they are taken as they are, without a pattern.
    text = F.replace("value", F.lit(landing.BOM), F.lit(""))
    plain = F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)
    rest = _text(spark, paths).select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__size"),
        F.octet_length("value").alias("__bytes"), plain.alias("plain")).withColumn(
        "rest", F.when(F.contains("plain", F.lit('"')), F.regexp_replace("plain", quoted, "$1"))
                 .otherwise(F.col("plain")))
    spare = F.octet_length("rest") - F.octet_length(F.replace("rest", F.lit(delimiter), F.lit("")))
    return rest.groupBy("__file").agg(
        F.max(F.contains("rest", F.lit('"')) | F.contains("rest", F.lit("\r"))).alias("__odd"),
        F.max(spare).alias("__spare"), F.max("__size").alias("__size"), F.sum(F.col("__bytes") + 1).alias("__read"))


def _line_report(spark: SparkSession, files: DataFrame, layouts: DataFrame, few: bool) -> DataFrame:
    """(__unit, untidy, __whole): one pass over the text of the units' own files.

    ``untidy`` units cannot be read line by line: some line holds a quote
    outside a plain quoted cell (a cell may span lines) or more cells than the
    header.  What is left of a line once its quoted cells are taken out has no
    quotes and at most ``width - 1`` delimiters in every other unit, so those
    need no further check.  ``__whole`` counts the files of which every byte
    was read (a byte order mark is not part of a line, nor is a last line feed
    that is not there).
    """
    small = layouts.select("__unit", "delimiter", "width")
    found = files.select("path", F.col("file_name").alias("__unit")).join(small, "__unit").select("path", "delimiter")
    per_file = empty(spark, "__file string, __odd boolean, __spare int, __size long, __read long")
    for delimiter, own in groupby(sorted(found.collect(), key=lambda r: r["delimiter"]), key=lambda r: r["delimiter"]):
        per_file = per_file.unionByName(_line_stats(spark, _as_paths(r["path"] for r in own), delimiter))
    rows = per_file.withColumn("__unit", _unit_of_file("__file")).join(
        maybe_broadcast(small, few), "__unit")
    untidy = F.col("__odd") | (F.col("__spare") > (F.col("width") - 1) * F.octet_length("delimiter"))
    whole = F.col("__read").between(F.col("__size") - 3, F.col("__size") + 1)
    return rows.groupBy("__unit").agg(F.max(untidy).alias("untidy"), F.count_if(whole).alias("__whole"))


def _scan(spark: SparkSession, paths: list[str], delimiter: str, width: int, depth: int = -1) -> DataFrame:
    """(__unit, __cells) of files that can be read line by line; the cell after the last is ``no_data``."""
    fields = [f"__c{i}" for i in range(width)]
    raw = (spark.read.schema(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
           .option("recursiveFileLookup", "true").option("header", "true").option("sep", delimiter)
           .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
           .option("maxColumns", max(20480, 2 * width)).csv(paths))
    return raw.select(_unit_of_file("_metadata.file_path", depth).alias("__unit"),
                      F.array(*fields, F.lit(NO_DATA)).alias("__cells"))


def _scan_records(spark: SparkSession, paths: list[str], delimiter: str, width: int, depth: int = -1) -> DataFrame:
    """(__unit, __cells, __record, __closed) of files whose quoted cells may hold line breaks.

    Read by blocks like any other (:mod:`csv_records`).  ``__record`` has the
    text of records whose cell count is not ``width``; ``__closed`` is false in
    a file that ends inside a quoted cell.
    """
    lines = csv_records.placed(_text(spark, paths)).withColumn("__delimiter", F.lit(delimiter)).withColumn(
        "__unit", _unit_of_file("__file", depth))
    fields = [f"__c{i}" for i in range(width)]
    schema = ", ".join(f"`{f}` string" for f in [*fields, "__record"])
    parsed = F.from_csv(F.col("__record"), schema, {
        "sep": delimiter, "quote": '"', "escape": '"', "maxColumns": str(max(20480, 2 * width)),
        "columnNameOfCorruptRecord": "__record"})
    rows = csv_records.records(lines).where((F.trim("__record") != "") | ~F.col("__closed"))
    return rows.withColumn("__p", parsed).select(
        "__unit", F.array(*[F.col(f"__p.{f}") for f in fields]).alias("__cells"),
        F.col("__p.__record").alias("__record"), "__closed")


def _scans(spark: SparkSession, files: DataFrame, layouts: DataFrame):
    """One scan per entity, delimiter and depth of folders below the unit, and one more per width for untidy units."""
    def kind(row) -> tuple:
        return (row["entity"], row["delimiter"], _unit_depth(row["path"]), row["untidy"],
                row["width"] if row["untidy"] else 0)
    found = (files.select("path", F.col("file_name").alias("__unit"))
             .join(layouts.select("__unit", "entity", "delimiter", "untidy", "width"), "__unit").collect())
    for (entity, delimiter, depth, untidy, exact), own in groupby(sorted(found, key=kind), key=kind):
        own = list(own)
        width = max(r["width"] for r in own)
        rows = (_scan_records if untidy else _scan)(spark, _as_paths(r["path"] for r in own), delimiter, width, depth)
        if untidy:  # as in the other scan, the cell after the last is no_data
            rows = rows.withColumn("__cells", F.concat("__cells", F.array(F.lit(NO_DATA))))
        mine = layouts.where((F.col("entity") == entity) & (F.col("delimiter") == delimiter)
                             & (F.col("untidy") == untidy))
        yield entity, delimiter, width, rows, mine.where(F.col("width") == exact) if untidy else mine


def check_rows(spark: SparkSession, files: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with ``untidy``; units that would lose cells FAIL.

    Such are files that cannot be read to their end, rows longer than their
    header, and files that end inside a quoted cell.  Shorter rows are read
    with nulls.  Only files of ``files`` are opened.
    """
    layouts = _layouts(plan)
    few = rows_at_most(layouts)
    if layouts.isEmpty():
        return plan.withColumn("untidy", F.lit(False))
    wanted = _own_files(files, layouts).groupBy(F.col("file_name").alias("__unit")).agg(
        F.count_if(F.col("length") > 3).alias("__files"))
    report = _written(wanted.join(_line_report(spark, files, layouts, few), "__unit", "left").select(
        "__unit", F.coalesce("untidy", F.lit(False)).alias("untidy"), "__files",
        F.coalesce("__whole", F.lit(0)).alias("__whole")), "line-report")
    broken = F.col("__whole") < F.col("__files")
    marked = layouts.join(report.where(~broken).select("__unit", "untidy"), "__unit")
    counts = empty(spark, "__unit string, __long bigint, __open boolean")
    for _, delimiter, width, rows, _ in _scans(spark, files, marked.where("untidy")):
        last = F.element_at("__cells", width)
        more = F.size(landing.split_header("__record", delimiter)) > width
        too_long = F.col("__record").isNotNull() & (last.isNotNull() | more) & F.col("__closed")
        counts = counts.unionByName(rows.groupBy("__unit").agg(
            F.count_if(too_long).alias("__long"), (~F.min("__closed")).alias("__open")))
    # A unit whose files lie at several depths has a row for each.
    counts = counts.groupBy("__unit").agg(F.sum("__long").alias("__long"), F.max("__open").alias("__open"))
    out = (plan.join(report, plan["file_name"] == F.col("__unit"), "left").drop("__unit")
           .join(counts, plan["file_name"] == F.col("__unit"), "left").drop("__unit"))
    error = (F.when(broken, F.concat((F.col("__files") - F.col("__whole")).cast("string"),
                                     F.lit(" file(s) cannot be read to their end")))
              .when(F.col("__open"), F.lit("a quoted cell does not end"))
              .when(F.col("__long") > 0, F.concat(F.col("__long").cast("string"),
                                                  F.lit(" row(s) with more cells than the header"))))
    return (out.withColumn("__found", error).withColumn("untidy", F.coalesce("untidy", F.lit(False)))
               .withColumn("status", F.when(F.col("__found").isNotNull(), F.lit("FAILED")).otherwise(F.col("status")))
               .withColumn("error", F.coalesce("__found", "error"))
               .drop("__found", "__long", "__open", "__files", "__whole"))


def read_units(spark: SparkSession, files: DataFrame, plan: DataFrame) -> dict[str, DataFrame]:
    """Read every passing unit of a checked plan as text columns, reconciled.

    Cells are read by position and named by joining each row's unit with its
    layout, so the number of reads does not grow with the number of headers or
    files; only the distinct column names reach the driver.  Renames are
    applied, pass-as-null columns hold ``no_data``, columns that a unit lacks
    are null.  Returns one frame per entity with a ``__unit`` column; a unit is
    read whole, all its files together.
    """
    layouts = _layouts(plan).withColumn("lower", F.transform("names", F.lower))
    few = rows_at_most(layouts)
    found = (layouts.select("entity", F.explode(F.concat("names", "fills")).alias("name"))
             .where(F.col("name") != "").groupBy("entity", F.lower("name").alias("key"))
             .agg(F.sort_array(F.collect_set("name")).alias("spelled")).collect())
    frames: dict[str, DataFrame] = {}
    for entity, _, width, rows, mine in _scans(spark, files, layouts):
        expected = EXPECTED_COLUMNS[entity]
        outs = []
        for r in sorted((r for r in found if r["entity"] == entity), key=lambda r: r["key"]):
            name = next((n for n in r["spelled"] if n in expected), r["spelled"][0])
            outs.append((name, r["key"]))
        # A column's cell is found once a unit; a row only takes it, absent ones being null.
        where = mine.select("__unit", *[
            F.when(F.array_contains("lower", key), (F.array_position("lower", key) - 1).cast("int"))
             .when(F.array_contains("fills", name), F.lit(width)).alias(f"__at{i}") for i, (name, key) in enumerate(outs)])
        at = rows.join(maybe_broadcast(where, few), "__unit")
        df = at.select("__unit", *[F.get("__cells", f"__at{i}").alias(name) for i, (name, _) in enumerate(outs)])
        prev = frames.get(entity)
        frames[entity] = df if prev is None else prev.unionByName(df)
    return frames


def stage(units: DataFrame, load_id: str) -> DataFrame:
    """Attach lineage: ``source_table`` and ``load_id`` (A10)."""
    return (units.withColumn("source_table", staging_table_name(F.col("__unit"), load_id))
                 .withColumn("load_id", F.lit(load_id)).drop("__unit"))


def write_staging(staged: DataFrame, root: str, entity: str) -> None:
    """One dataset per entity, partitioned by load and staged table; a rerun
    replaces only its own partitions (A10, A14)."""
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("load_id", "source_table").parquet(f"{root.rstrip('/')}/{entity}"))


def _staged(spark: SparkSession, root: str, entity: str, load_id: str) -> DataFrame:
    """Text rows of one load: a pruned read of the load's partitions.

    The schema is given (contract columns as text), so extra columns of
    individual files do not matter and no schema merge is needed.
    """
    cols = [T.StructField(c, T.StringType(), True) for c in EXPECTED_COLUMNS[entity]]
    schema = T.StructType(cols + [T.StructField("load_id", T.StringType(), True),
                                  T.StructField("source_table", T.StringType(), True)])
    path = f"{root.rstrip('/')}/{entity}"
    try:
        raw = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        raw = empty(spark, schema)  # nothing of this entity staged yet (Q31)
    return raw.where(F.col("load_id") == load_id)


def staging_view(spark: SparkSession, root: str, entity: str, load_id: str,
                 missing_as_null: bool = False) -> DataFrame:
    """Typed rows of one load (A13); a cell that does not fit its type fails the read."""
    return typed_projection(_staged(spark, root, entity, load_id), entity, missing_as_null=missing_as_null)


def split_rejects(raw: DataFrame, entity: str, name: str, missing_as_null: bool = False,
                  keep: tuple[str, ...] = ("source_table",)) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects) of text rows: one pass, written once, two outputs.

    A row with a cell that does not fit its type is in neither the typed rows
    nor the pass's failure: ``rejects`` has a row for each such cell (kept
    columns, column, text, reason).
    """
    spark = raw.sparkSession
    typed = typed_projection(raw, entity, keep=keep, missing_as_null=missing_as_null, rejects="__rejects")
    path = scratch_path(spark, name)
    marked = typed.withColumn("__good", F.size("__rejects") == 0)
    marked.write.partitionBy("__good").parquet(path)
    back = spark.read.schema(marked.schema).parquet(path)
    kept = [c for c in typed.columns if c not in {n for n, _ in STAGING_TYPES[entity]} and c != "__rejects"]
    rejects = (back.where(~F.col("__good")).select(*kept, F.explode("__rejects").alias("r"))
               .select(*kept, "r.column", "r.text", "r.reason"))
    return back.where("__good").drop("__rejects", "__good"), rejects


def quarantined_view(spark: SparkSession, root: str, entity: str, load_id: str, log_dir: str | None = None,
                     missing_as_null: bool = False) -> DataFrame:
    """Typed rows of one load without those that do not fit; they are kept aside.

    Rejects go to ``<root>/_rejects/<entity>``, by load (a rerun replaces its
    own), and the load log gets a row per staged file with rejects: status
    REJECTED, the rows kept aside, and the columns they fail in.
    """
    raw = _staged(spark, root, entity, load_id).withColumn("__row", F.monotonically_increasing_id())
    typed, rejects = split_rejects(raw, entity, f"typed-{entity}", missing_as_null, ("source_table", "__row"))
    path = f"{root.rstrip('/')}/_rejects/{entity}"
    (rejects.withColumn("load_id", F.lit(load_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(path))
    if log_dir:
        unit = F.concat(F.regexp_replace("source_table", f"_staging_{re.escape(load_id)}$", ""), F.lit(".csv"))
        by_column = (rejects.groupBy("source_table", "column").agg(F.count("*").alias("n")).groupBy("source_table")
                     .agg(F.array_join(F.array_sort(F.collect_list(F.concat("column", F.lit(": "), "n"))), ", ").alias("c")))
        counted = rejects.groupBy("source_table").agg(F.count_distinct("__row").alias("n")).join(by_column, "source_table")
        append_log(counted.select(F.lit(load_id).alias("load_id"), F.lit(entity).alias("entity"), unit.alias("file"),
                                  F.lit("REJECTED").alias("status"), F.col("n").cast("bigint").alias("rows_loaded"),
                                  F.concat(F.lit("cells that do not fit: "), "c").alias("error")), log_dir)
    return typed.drop("__row")


def load_log(plan: DataFrame, staging_root: str, spark: SparkSession, load_id: str) -> DataFrame:
    """One log row per unit: SUCCESS with rows loaded, or FAILED with the error.

    Row counts come from the written staging partitions (Parquet footers).
    """
    counts = []
    for entity in EXPECTED_COLUMNS:
        path = f"{staging_root.rstrip('/')}/{entity}"
        try:
            df = spark.read.parquet(path)
        except AnalysisException as e:
            if not path_is_missing(e):
                raise
            continue  # entity not staged in any load yet
        counts.append(df.where(F.col("load_id") == load_id)
                        .groupBy("source_table").agg(F.count(F.lit(1)).alias("rows_loaded")))
    p = plan.select("entity", F.col("file_name").alias("file"), "status", "error",
                    staging_table_name(F.col("file_name"), load_id).alias("source_table"))
    if counts:
        c = counts[0]
        for more in counts[1:]:
            c = c.unionByName(more)
        p = p.join(c, "source_table", "left")
    else:
        p = p.withColumn("rows_loaded", F.lit(None).cast("bigint"))
    return p.select(F.lit(load_id).alias("load_id"), "entity", "file", "status",
                    F.when(F.col("status") == "SUCCESS", F.coalesce("rows_loaded", F.lit(0)))
                     .otherwise(F.lit(0)).cast("bigint").alias("rows_loaded"),
                    "error")


def append_log(log: DataFrame, path: str) -> None:
    """Append rows to the load log, partitioned by load (A18: insert-select)."""
    log.write.mode("append").partitionBy("load_id").parquet(path)


def write_log(log: DataFrame, path: str, keep_others: bool = False) -> None:
    """Record one load's log rows (A11), replacing that load's partition only.

    A load id names one run over a fixed set of files, so a replayed run (a
    stream batch retried after a failure, a job restarted) leaves exactly one
    set of rows; other loads' rows are untouched.  ``keep_others`` keeps the
    rows of the same load's other files: a run that repeats some units.
    """
    if keep_others:
        spark = log.sparkSession
        now = scratch_path(spark, "log")
        log.write.parquet(now)
        again = spark.read.schema(log.schema).parquet(now)
        old = spark.read.schema(log.schema).parquet(path).join(again.select("load_id").distinct(),
                                                               "load_id", "left_semi")
        both = scratch_path(spark, "log")
        (old.join(again.select("load_id", "file"), ["load_id", "file"], "left_anti")
            .unionByName(again).write.parquet(both))
        log = spark.read.schema(log.schema).parquet(both)
    (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_id").parquet(path))


@dataclass
class LandingResult:
    plan: DataFrame
    drafts: DataFrame
    log: DataFrame
    units: DataFrame | None = None

    def release(self) -> None:
        """Drop the cached per-unit frames (call once the result is used)."""
        for df in (self.plan, self.units):
            if df is not None:
                df.unpersist()


def run_landing(spark: SparkSession, landing_root: str, staging_root: str, load_id: str,
                entities: str | Sequence[str] = "products,prices,contracts",
                start: str = "000000", end: str = "999999", rules_dir: str | None = None,
                drafts_dir: str | None = None, log_dir: str | None = None,
                method: str = "difflib", files: DataFrame | None = None,
                repeat: bool = False, index_dir: str | None = None, only_new: bool = False) -> LandingResult:
    """List, reconcile, check, read, stage and log one load (A1-A13 end to end).

    Entities are reconciled per unit from the file name (the unit's own
    entity), so a comma-separated entity list still checks every file.
    Failed units are logged, not raised; drafts for new drift are written
    to ``drafts_dir`` for confirmation.  ``files`` (a listing) restricts the
    load to its units; ``repeat`` runs some units of an earlier load again.
    With an index (``index_dir``) the files are remembered, and ``only_new``
    leaves out units whose files it knows unchanged.

    No file outside the load is opened, and one that cannot be read fails its
    own unit only.
    """
    listed = files if files is not None else landing.list_landing(spark, landing_root)
    chosen = landing.select_files(listed, entities, start, end)
    if index_dir and only_new:
        chosen = landing_index.new_units(chosen, index_dir)
    chosen = _written(chosen, "files")
    units = landing.unit_headers(chosen).persist()
    rules = landing.read_rules(spark, rules_dir) if rules_dir else None
    plan, drafts = landing.reconcile(units.where("read_error is null").drop("read_error"), rules, method=method)
    unread = units.where("read_error is not null").select(
        "file_name", "entity", "n_files", F.lit("FAILED").alias("status"), F.col("read_error").alias("error"))
    plan = _written(plan.unionByName(unread, allowMissingColumns=True), "plan")
    plan = _written(check_rows(spark, chosen, plan), "checked-plan")
    if drafts_dir:
        landing.write_rules(drafts, drafts_dir)
    for entity, rows in read_units(spark, chosen, plan).items():
        write_staging(stage(rows, load_id), staging_root, entity)
    log = load_log(plan, staging_root, spark, load_id)
    if log_dir:
        write_log(log, log_dir, keep_others=repeat)
    if index_dir:
        landing_index.remember(chosen, index_dir, load_id)
        landing_index.settle(log, index_dir, load_id)
    return LandingResult(plan=plan, drafts=drafts, log=log, units=units)



def failed_units(spark: SparkSession, log_dir: str) -> DataFrame:
    """(load_id, file): units that a load failed and no load has staged since."""
    try:
        log = spark.read.parquet(log_dir).where("file <> 'N/A'")
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        return empty(spark, "load_id string, file string")
    done = log.where("status = 'SUCCESS'").select("file").distinct()
    return (log.where("status = 'FAILED'").groupBy("file").agg(F.max("load_id").alias("load_id"))
               .join(done, "file", "left_anti").select(F.col("load_id").cast("string").alias("load_id"), "file"))


def retry_failed(spark: SparkSession, landing_root: str, staging_root: str, log_dir: str,
                 index_dir: str | None = None, **options) -> int:
    """Run failed units again, each under the load that failed it; how many were tried.

    Rules may have been confirmed since.  ``options`` are those of
    :func:`run_landing`; the other units' log rows of these loads stay.  With
    an index, the units and their files come from it; else from the log and a
    listing of the landing folder.
    """
    path = scratch_path(spark, "failed-units")
    waiting = landing_index.pending(spark, index_dir) if index_dir else failed_units(spark, log_dir)
    waiting.write.parquet(path)
    pending = spark.read.schema("load_id string, file string").parquet(path)
    tried = 0
    for load in pending.groupBy("load_id").agg(F.count("file").alias("n")).orderBy("load_id").collect():
        mine = pending.where(F.col("load_id") == load["load_id"]).select(F.col("file").alias("file_name"))
        if index_dir:
            months = [r[0] for r in mine.select(F.substring("file_name", 1, 6)).distinct().collect()]
            listed = landing_index.known_files(spark, index_dir, months)
        else:
            listed = landing.list_landing(spark, landing_root)
        files = listed.join(mine, "file_name", "left_semi")
        run_landing(spark, landing_root, staging_root, load["load_id"], log_dir=log_dir, files=files,
                    repeat=True, index_dir=index_dir, **options).release()
        tried += load["n"]
    return tried
