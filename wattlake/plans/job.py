"""Batch entry point: one load from landing files to the published mart.

    spark-submit --py-files wattlake.zip run_load.py --landing s3://.../landing \\
        --rules s3://.../rules --staging s3://.../staging --warehouse s3://.../dwh \\
        --start 202010 --end 202101 --as-of 2021-01-02

Steps: the landing job (list, reconcile, read, stage, log) for the month
range, then the warehouse job over that load's staging view (histories,
price periods, mart), every table published as a new version.  The load id
and run timestamp are taken once here and passed down; no operator reads
the clock.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir
from ..sources import staging
from . import warehouse_job


def run_load(spark: SparkSession, landing: str, staging_root: str, warehouse: str,
             start: str | None, end: str, as_of: _dt.date, rules: str | None = None,
             entities: str = "products,prices,contracts", run_ts: _dt.datetime | None = None,
             previous_version: str | None = None, keep_snapshots: bool = False,
             check: str = "full", allow_partial: bool = False, quarantine: bool = False,
             missing_as_null: bool = False, only_new: bool = False, **rules_kept) -> dict:
    """Stage one load and publish every warehouse table built from it.

    A landing file that fails stops the load before anything is published,
    unless ``allow_partial``; so does a ``previous_version`` without its tables.
    A cell that does not fit its type ends the load too, unless ``quarantine``
    keeps its row aside; ``missing_as_null`` (Q28) reads ``no_data`` fills as null.
    ``only_new`` leaves out files that the landing index knows unchanged.
    ``rules_kept`` are the options of :func:`warehouse_job.run`.
    """
    ensure_checkpoint_dir(spark)
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    load_id = staging.new_load_id(run_ts)
    log_dir = f"{staging_root.rstrip('/')}/_load_log"
    step = "landing"
    try:
        result = staging.run_landing(spark, landing, staging_root, load_id, entities=entities,
                                     start=start, end=end, rules_dir=rules,
                                     drafts_dir=f"{staging_root.rstrip('/')}/_drafts",
                                     log_dir=log_dir, index_dir=f"{staging_root.rstrip('/')}/_files", only_new=only_new)
        failed = result.log.where("status = 'FAILED'").count()
        if failed and not allow_partial:
            raise FailedFiles(f"{failed} landing file(s) failed, see the load log of {load_id}")
        _log_step(spark, log_dir, load_id, step)
        step = "warehouse"
        names = ("products", "prices", "contracts")
        if quarantine:
            views = {e: staging.quarantined_view(spark, staging_root, e, load_id, log_dir, missing_as_null)
                     for e in names}
        else:
            views = {e: staging.staging_view(spark, staging_root, e, load_id, missing_as_null) for e in names}
        previous = None
        if previous_version:
            from .sql_views import read_published
            previous = {k: v for k, v in read_published(spark, warehouse, previous_version).items()
                        if k in ("products", "prices", "contracts")}
            if not {"prices", "contracts"} <= set(previous):
                raise ValueError(f"no published, checked tables of version {previous_version!r}")
        tables = warehouse_job.run(spark, views, warehouse, load_id, as_of, run_ts,
                                   previous=previous, keep_snapshots=keep_snapshots, check=check,
                                   previous_version=previous_version, **rules_kept)
    except Exception as exc:
        # A failed step is logged like the per-file rows, then the job fails.
        _log_step(spark, log_dir, load_id, step, str(exc))
        raise
    _log_step(spark, log_dir, load_id, step)
    return {"load_id": load_id, "log": result.log, "tables": tables}


class FailedFiles(RuntimeError):
    """Landing files failed and the load may not be partial."""


def _log_step(spark: SparkSession, log_dir: str, load_id: str, step: str,
              error: str | None = None) -> None:
    """Append a step's row (file "N/A") to the load log, with its whole error text."""
    row = [(load_id, step, "N/A", "FAILED" if error is not None else "SUCCESS", 0, error)]
    staging.append_log(spark.createDataFrame(
        row, "load_id string, entity string, file string, status string, "
             "rows_loaded bigint, error string"), log_dir)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--staging", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--rules")
    ap.add_argument("--entities", default="products,prices,contracts")
    ap.add_argument("--start", help="first month yyyymm (defaults to --end)")
    ap.add_argument("--end", required=True, help="last month yyyymm")
    ap.add_argument("--as-of", required=True, type=_dt.date.fromisoformat,
                    help="the date that stands for CURRENT_DATE")
    ap.add_argument("--previous-version", help="incremental: merge into this published version")
    ap.add_argument("--keep-snapshots", action="store_true")
    ap.add_argument("--check", default="full", choices=["full", "nulls", "none"],
                    help="constraint report on each published table")
    ap.add_argument("--allow-partial", action="store_true",
                    help="publish although landing files failed")
    ap.add_argument("--quarantine", action="store_true",
                    help="keep rows with cells that do not fit their type aside instead of failing")
    ap.add_argument("--missing-as-null", action="store_true", help="read no_data fills of typed columns as null")
    ap.add_argument("--only-new", action="store_true", help="leave out files an earlier load saw unchanged")
    ap.add_argument("--on-change", default="close_only", choices=["close_only", "close_and_open"])
    ap.add_argument("--pick", default="longest", choices=["longest", "current"],
                    help="price version that defines periods")
    ap.add_argument("--no-drift", action="store_true", help="yearly pieces that began on 29 February return to it")
    ap.add_argument("--calendar-year", action="store_true", help="yearly pieces after the first start on 1 January")
    ap.add_argument("--align", action="store_true", help="intersect base and working price periods")
    ap.add_argument("--overlap", default="latest", choices=["latest", "error"],
                    help="several price periods for one contract period: the latest, or fail")
    ap.add_argument("--parts", action="store_true",
                    help="store prices and contracts as current and closed parts: a load writes what it changes")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("wattlake-load").getOrCreate()
    out = run_load(spark, args.landing, args.staging, args.warehouse, args.start, args.end,
                   args.as_of, rules=args.rules, entities=args.entities,
                   previous_version=args.previous_version, keep_snapshots=args.keep_snapshots,
                   check=args.check, allow_partial=args.allow_partial, quarantine=args.quarantine,
                   missing_as_null=args.missing_as_null, only_new=args.only_new, on_change=args.on_change,
                   pick=args.pick, drift=not args.no_drift, calendar_year=args.calendar_year, align=args.align,
                   overlap=args.overlap, parts=args.parts)
    failed = out["log"].where("status = 'FAILED'")
    total = failed.count()
    for r in failed.select("file", "error").limit(20).collect():
        print(f"FAILED {r.file}: {r.error}", file=sys.stderr)
    if total:
        print(f"{total} file(s) failed in all; the load log has every one", file=sys.stderr)
    print(f"load {out['load_id']} published")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
