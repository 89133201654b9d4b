"""Loads open their own files only; the index remembers files and units that wait."""

import shutil

from wattlake.schema import EXPECTED_COLUMNS
from wattlake.sources import landing, landing_index, staging
from wattlake.streaming.landing_stream import start_landing_stream

NAMES = EXPECTED_COLUMNS["products"]


def _unit(root, stamp, *keys):
    root.mkdir(parents=True, exist_ok=True)
    path = root / f"{stamp}_products.csv"
    rows = [";".join({"id": str(k), "modificationdate": "2020-01-01"}.get(c, "1") for c in NAMES) for k in keys]
    path.write_text("\n".join([";".join(NAMES), *rows]) + "\n")
    return path


def _damage(path):
    """A checksum that does not fit: Spark's reads of this file fail."""
    (path.parent / f".{path.name}.crc").write_bytes(b"crc\x00\x00\x00\x02\x00" + b"\x01\x02\x03\x04")


def _load(spark, tmp_path, load_id, **options):
    out = staging.run_landing(spark, str(tmp_path / "in"), str(tmp_path / "staging"), load_id, entities="products",
                              index_dir=str(tmp_path / "index"), log_dir=str(tmp_path / "log"), **options)
    return {r.file[:6]: (r.status, r.rows_loaded) for r in out.log.collect()}, out


def test_a_damaged_old_file_does_not_touch_a_later_load(spark, tmp_path):
    _damage(_unit(tmp_path / "in", "20220101000000", 1, 2))
    _unit(tmp_path / "in", "20230201000000", 3)
    got, _ = _load(spark, tmp_path, "L1", start="202302", end="202302")
    assert got == {"202302": ("SUCCESS", 1)}


def test_a_damaged_file_fails_its_own_unit(spark, tmp_path):
    _unit(tmp_path / "in", "20230101000000", 1)
    _damage(_unit(tmp_path / "in", "20230201000000", 2))
    gone = tmp_path / "in" / "20230301000000_products.csv"
    gone.symlink_to(tmp_path / "nowhere")
    got, out = _load(spark, tmp_path, "L1")
    assert got == {"202301": ("SUCCESS", 1), "202302": ("FAILED", 0)}
    assert "cannot be read to their end" in out.log.where("status = 'FAILED'").first()["error"]
    assert [r["file"][:6] for r in landing_index.pending(spark, str(tmp_path / "index")).collect()] == ["202302"]
    (tmp_path / "in" / ".20230201000000_products.csv.crc").unlink()
    tried = staging.retry_failed(spark, str(tmp_path / "in"), str(tmp_path / "staging"), str(tmp_path / "log"),
                                 index_dir=str(tmp_path / "index"), entities="products")
    assert tried == 1 and landing_index.pending(spark, str(tmp_path / "index")).count() == 0
    assert staging.staging_view(spark, str(tmp_path / "staging"), "products", "L1").count() == 2


def test_an_unreadable_header_fails_its_own_unit(spark, tmp_path):
    good, bad = _unit(tmp_path / "in", "20230101000000", 1), _unit(tmp_path / "in", "20230201000000", 2)
    listed = _written(landing.list_landing(spark, str(tmp_path / "in")), tmp_path)
    bad.unlink()
    got, out = _load(spark, tmp_path, "L1", files=listed)
    assert got == {"202301": ("SUCCESS", 1), "202302": ("FAILED", 0)}
    assert out.log.where("status = 'FAILED'").first()["error"].startswith("cannot be read")
    assert good.exists()


def _written(df, tmp_path):
    df.write.parquet(str(tmp_path / "listing"))
    return df.sparkSession.read.parquet(str(tmp_path / "listing"))


def test_only_new_files(spark, tmp_path):
    _unit(tmp_path / "in", "20230101000000", 1)
    assert landing_index.high_water(spark, str(tmp_path / "index")) is None
    assert _load(spark, tmp_path, "L1", only_new=True)[0] == {"202301": ("SUCCESS", 1)}
    _unit(tmp_path / "in", "20230201000000", 2, 3)
    assert _load(spark, tmp_path, "L2", only_new=True)[0] == {"202302": ("SUCCESS", 2)}
    assert _load(spark, tmp_path, "L3", only_new=True)[0] == {}
    _unit(tmp_path / "in", "20230101000000", 1, 4, 5)  # changed
    assert _load(spark, tmp_path, "L4", only_new=True)[0] == {"202301": ("SUCCESS", 3)}
    known = landing_index.known_files(spark, str(tmp_path / "index")).collect()
    assert len(known) == 2 and landing_index.known_files(spark, str(tmp_path / "index"), ["202301"]).count() == 1


def test_a_batch_reads_only_its_own_files(spark, tmp_path):
    """Files of earlier batches may be gone or damaged."""
    def run():
        q = start_landing_stream(spark, str(tmp_path / "in"), str(tmp_path / "staging"), str(tmp_path / "ckpt"),
                                 load_id_for=lambda b: f"B{b}", entities="products", log_dir=str(tmp_path / "log"))
        q.awaitTermination()
        assert q.exception() is None

    first = _unit(tmp_path / "in", "20230101000000", 1)
    run()
    _damage(first)
    shutil.copy(_unit(tmp_path / "other", "20230201000000", 2, 3), tmp_path / "in")
    run()
    rows = {r.file[:6]: (r.load_id, r.status, r.rows_loaded) for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert rows == {"202301": ("B0", "SUCCESS", 1), "202302": ("B1", "SUCCESS", 2)}


def test_settled_units_leave_the_waiting_list(spark, tmp_path):
    index = str(tmp_path / "index")
    log = "file string, status string"
    landing_index.settle(spark.createDataFrame([("a", "FAILED"), ("b", "FAILED"), ("c", "SUCCESS")], log), index, "L1")
    landing_index.settle(spark.createDataFrame([("a", "SUCCESS"), ("d", "FAILED")], log), index, "L2")
    waiting = {tuple(r) for r in landing_index.pending(spark, index).collect()}
    assert waiting == {("L1", "b"), ("L2", "d")}
    landing_index.settle(spark.createDataFrame([("b", "SUCCESS"), ("d", "SUCCESS")], log), index, "L3")
    assert landing_index.pending(spark, index).count() == 0
