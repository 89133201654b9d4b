import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm_fixtures import same_rows
from wattlake.llm import warc_merge as W
from wattlake.session import scratch_path

PAGES = "page_id long, url string, html string, run string, payload string"


def brute(rows, min_bytes=0):
    digest = {}
    for i, _, html in rows:
        d = hashlib.sha1((html or "").encode()).digest()
        digest.setdefault(d, []).append(i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        ids = [x for x in digest[hashlib.sha1(raw).digest()] if x is not None]
        last = max(ids) if ids else None
        visit = len(raw) >= min_bytes and i != last
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if visit else "response", last if visit else None))
    return out


ROWS = [(1, "http://www.b.com/x?q=1#f", "<p>é☃</p>"), (2, "http://a.com/", None), (3, None, ""),
        (4, "http://a.com/\r\nInjected: 1", "<p>é☃</p>"), (5, "nothing", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
        (6, "http://b.com/x?q=1", "\n"), (6, "http://b.com/x?q=1", "\n"), (None, "http://c.org", "only"),
        (None, "http://c.org", "<p>é☃</p>"), (-7, "http://c.org/long", "y" * 300_000),
        (8, "http://c.org/2", "text\rwith\x00odd\tbytes\r\n\r\n")]


def index(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "r", "p") for r in rows], PAGES)
    return W.archive_and_index(df, **kw)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_matches_brute_force(spark, min_bytes):
    got = index(spark, ROWS, min_bytes=min_bytes).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    same_rows(map(tuple, got), brute(ROWS, min_bytes))


def test_empty_table(spark):
    assert index(spark, []).count() == 0


def test_global_order_over_many_runs_and_ranges(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h{rng.choice([0, 0, 0, 1, 2, 3])}.com/{rng.randrange(9)}", f"page {i}") for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    caps = W.captures(df)
    path = scratch_path(spark, "warc")
    runs = W.capture_runs(W.read_archives(spark, path, W.write_archives(caps, path)))
    assert runs.select("run").distinct().count() > 1
    merged = W.merge_runs(runs, rows_per_merge=100).collect()
    merged.sort(key=lambda r: (r["merge_part"], r["merge_pos"]))
    keys = [(r["urlkey"], r["captured_at"], r["page_id"]) for r in merged]
    assert keys == sorted(keys) and len(keys) == 600 and len({r["merge_part"] for r in merged}) > 2


def test_loser_tree_is_a_merge():
    rng = random.Random(2)
    for k in range(9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(12))) for _ in range(k)]
        tagged = [[(x, i, j) for j, x in enumerate(r)] for i, r in enumerate(runs)]
        assert list(W.loser_tree_merge(tagged)) == sorted(x for r in tagged for x in r)


def test_damaged_record_is_refused(spark):
    df = spark.createDataFrame([(1, "http://a.com", "good")], "page_id long, url string, html string")
    caps = W.captures(df).withColumn("payload", F.lit("evil"))
    path = scratch_path(spark, "warc")
    token = W.write_archives(caps, path)
    with pytest.raises(Exception, match="damaged record 1"):
        W.read_archives(spark, path, token).collect()


def test_archive_text_is_warc(spark):
    df = spark.createDataFrame([(1, "http://a.com", "good")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    W.write_archives(W.captures(df), path, compression="none")
    raw = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").option(
        "pathGlobFilter", "*.txt").load(path).collect())
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and b"WARC-Type: response\r\n" in raw
