"""The batch entry point end to end on reference-format files."""

import datetime as dt

from pyspark.sql import functions as F

from samples import MONTHS
from test_end_to_end import _write_landing, _write_rules
from wattlake.plans.job import run_load


def test_run_load_publishes_every_table(spark, tmp_path):
    _write_landing(tmp_path / "landing")
    _write_rules(tmp_path / "rules")
    out = run_load(spark, str(tmp_path / "landing"), str(tmp_path / "staging"),
                   str(tmp_path / "dwh"), MONTHS[0], MONTHS[3], dt.date(2023, 2, 2),
                   rules=str(tmp_path / "rules"), run_ts=dt.datetime(2023, 2, 2, 3, 4, 5, 678000))
    assert out["load_id"] == "20230202_030405678"
    assert out["log"].where("status = 'SUCCESS'").count() == 8
    t = out["tables"]
    assert t["prices"].count() == 13 and t["products"].count() == 4
    assert t["price_periods"].count() == 18
    assert t["contracts"].count() == 0 and t["contract_price_enriched"].count() == 0  # no contract files
    back = spark.read.parquet(str(tmp_path / "dwh" / "price_periods" / "v=20230202_030405678"))
    assert back.where(F.col("snapshot_date") == F.lit(dt.date(2023, 2, 1))).count() == 18


def test_failed_step_is_logged(spark, tmp_path):
    import pytest
    _write_landing(tmp_path / "landing")
    _write_rules(tmp_path / "rules")
    with pytest.raises(Exception):
        run_load(spark, str(tmp_path / "landing"), str(tmp_path / "staging"), str(tmp_path / "dwh"),
                 MONTHS[0], MONTHS[3], dt.date(2023, 2, 2), rules=str(tmp_path / "rules"),
                 run_ts=dt.datetime(2023, 2, 2), check="bogus")
    log = spark.read.parquet(str(tmp_path / "staging" / "_load_log"))
    failed = log.where("status = 'FAILED' AND file = 'N/A'").collect()
    assert len(failed) == 1 and failed[0].entity == "warehouse" and "check must be" in failed[0].error
    done = log.where("status = 'SUCCESS'")
    assert done.where("file <> 'N/A'").count() == 8  # the landing step's rows stay
    assert [r.entity for r in done.where("file = 'N/A'").collect()] == ["landing"]


def test_failed_file_or_unknown_version_stops_the_load(spark, tmp_path):
    import pytest
    from wattlake.plans.job import FailedFiles
    _write_landing(tmp_path / "landing")
    args = (spark, str(tmp_path / "landing"), str(tmp_path / "staging"), str(tmp_path / "dwh"),
            MONTHS[0], MONTHS[3], dt.date(2023, 2, 2))
    with pytest.raises(FailedFiles):  # drifted headers without confirmed rules
        run_load(*args, run_ts=dt.datetime(2023, 2, 2))
    assert not (tmp_path / "dwh").exists()
    out = run_load(*args, run_ts=dt.datetime(2023, 2, 3), allow_partial=True)
    assert out["log"].where("status = 'FAILED'").count() > 0 and (tmp_path / "dwh").exists()
    _write_rules(tmp_path / "rules")
    with pytest.raises(ValueError, match="no published"):
        run_load(*args, run_ts=dt.datetime(2023, 2, 4), rules=str(tmp_path / "rules"), previous_version="typo")
