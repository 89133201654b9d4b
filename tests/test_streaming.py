"""The landing stream: each file once, restartable from its checkpoint."""

from pyspark.sql import functions as F

from samples import MONTHS
from test_end_to_end import _write_landing, _write_rules
from wattlake.sources import staging
from wattlake.streaming.landing_stream import start_landing_stream


def _run(spark, tmp_path, batches):
    q = start_landing_stream(spark, str(tmp_path / "landing"), str(tmp_path / "staging"),
                             str(tmp_path / "ckpt"), load_id_for=lambda b: f"L{len(batches)}_{b}",
                             start=MONTHS[0], end=MONTHS[3], rules_dir=str(tmp_path / "rules"),
                             log_dir=str(tmp_path / "log"))
    q.awaitTermination()
    assert q.exception() is None
    batches.append(q.lastProgress)


def test_stream_stages_each_file_once_and_resumes(spark, tmp_path):
    _write_landing(tmp_path / "landing", months=set(MONTHS[:3]))
    _write_rules(tmp_path / "rules")
    batches = []
    _run(spark, tmp_path, batches)
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 6 and log.where("status = 'SUCCESS'").count() == 6

    _run(spark, tmp_path, batches)  # restart, nothing new
    assert spark.read.parquet(str(tmp_path / "log")).count() == 6

    _write_landing(tmp_path / "landing", months={MONTHS[3]})  # the last month arrives later
    _run(spark, tmp_path, batches)
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 8
    jan = log.where(F.col("file").startswith(MONTHS[3])).collect()
    assert len(jan) == 2 and {r.rows_loaded for r in jan} == {4, 11}
    loads = [r.load_id for r in log.select("load_id").distinct().collect()]
    assert len(loads) == 2
    view = staging.staging_view(spark, str(tmp_path / "staging"), "prices",
                                [lid for lid in loads if lid.startswith("L2")][0])
    assert view.count() == 11


def test_replayed_load_keeps_one_log(spark, tmp_path):
    _write_landing(tmp_path / "landing", months={MONTHS[0]})
    _write_rules(tmp_path / "rules")
    for _ in range(2):  # the same load run twice, as a retried batch would
        staging.run_landing(spark, str(tmp_path / "landing"), str(tmp_path / "staging"), "L1",
                            start=MONTHS[0], end=MONTHS[0], rules_dir=str(tmp_path / "rules"),
                            log_dir=str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 2
    assert staging.staging_view(spark, str(tmp_path / "staging"), "prices", "L1").count() == 9


def test_stream_with_a_processing_time_trigger(spark, tmp_path):
    _write_landing(tmp_path / "landing", months={MONTHS[0]})
    _write_rules(tmp_path / "rules")
    q = start_landing_stream(spark, str(tmp_path / "landing"), str(tmp_path / "staging"),
                             str(tmp_path / "ckpt"), load_id_for=lambda b: f"P{b}",
                             start=MONTHS[0], end=MONTHS[3], rules_dir=str(tmp_path / "rules"),
                             log_dir=str(tmp_path / "log"), available_now=False,
                             processing_time="1 second")
    try:
        q.processAllAvailable()
        _write_landing(tmp_path / "landing", months={MONTHS[1]})
        q.processAllAvailable()
    finally:
        q.stop()
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 4 and log.where("status = 'SUCCESS'").count() == 4
