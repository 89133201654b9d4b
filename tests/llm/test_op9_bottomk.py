import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import MESSY, empty, messy
from wattlake.llm import bottomk as B


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        seed = seed
    return seed - (1 << 64) if seed >> 63 else seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def slow_sketch(text, k=B.K):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    s = {chain(h[i:i + 5]) for i in range(len(h) - 4)} if len(h) >= 5 else ({chain(h)} if h else set())
    return sorted(s)[:k]


def test_sketch_by_definition(spark):
    rng = random.Random(1)
    texts = [r[1] for r in MESSY] + [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 4, 5, 6, 50, 700)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    for r in B.with_sketch(df, F.col("t"), "s").collect():
        assert r["s"] == slow_sketch(r["t"]), r["t"]


def test_estimates(spark):
    a, b = [f"w{i}" for i in range(4000)], [f"w{i}" for i in range(1000, 5000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string")
    df = B.with_sketch(B.with_sketch(df, F.col("a"), "x", 512), F.col("b"), "y", 512)
    r = df.select(B.resemblance(F.col("x"), F.col("y"), 512).alias("j"), B.containment(F.col("x"), F.col("y"), 512).alias("c"),
                  B.distinct_shingles(F.col("x"), 512).alias("n"), B.distinct_shingles(
                      B.merged(F.col("x"), F.col("y"), 512), 512).alias("u")).first()
    assert abs(r["j"] - 0.6) < 0.08 and abs(r["c"] - 0.75) < 0.12
    assert abs(r["n"] / 3996 - 1) < 0.15 and abs(r["u"] / 4996 - 1) < 0.15


def test_merge_equals_sketch_of_the_whole(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.7 else None, " ".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(30))))
            for _ in range(80)] + [("none", "")]
    df = B.with_sketch(spark.createDataFrame(rows, "g string, t string"), F.col("t"), "s", 16)
    got = {r["g"]: r["s"] for r in B.merge_groups(df, ["g"], "s", 16, salts=4).collect()}
    want = {}
    for g, t in rows:
        want[g] = sorted(set(want.get(g, [])) | set(slow_sketch(t, 10**9)))
    assert got == {g: s[:16] for g, s in want.items()}


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[:len(t) - q] + following[:q]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("per_range", [3, 4096])
def test_next_document_and_edit(spark, per_range, monkeypatch):
    monkeypatch.setattr(B, "ROWS_PER_RANGE", per_range)
    got = B.fingerprints(messy(spark)).select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256),
                                              "near_edited", "near_next").collect()
    assert sorted(map(repr, (tuple(r)[:3] for r in got))) == sorted(map(repr, brute([r[:2] for r in MESSY])))
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_one_and_no_document(spark):
    assert B.fingerprints(empty(spark)).count() == 0
    one = spark.createDataFrame([(4, "abcd efgh")], "doc_id long, text string")
    r = B.fingerprints(one).first()
    assert r["edited"] == "abcd efab" and r["near_next"] == 1.0


def test_likeness_by_definition(spark):
    rows = B.fingerprints(messy(spark)).select("text", "edited", "next_text", "near_edited", "near_next").collect()

    def near(a, b):
        a, b = slow_sketch(a), slow_sketch(b)
        if a == b:
            return 1.0
        union = sorted(set(a) | set(b))[:B.K]
        return len([h for h in union if h in a and h in b]) / len(union) if a and b else 0.0
    for r in rows:
        assert r["near_edited"] == pytest.approx(near(r["text"], r["edited"]))
        assert r["near_next"] == pytest.approx(near(r["text"], r["next_text"]))


def test_rows_without_id_and_repeated_ids_are_dealt_like_others(spark, monkeypatch):
    monkeypatch.setattr(B, "ROWS_PER_RANGE", 4)
    rng = random.Random(3)
    rows = [(None, " ".join(rng.choice("aé☃𝄞xyz") * rng.randrange(1, 5) for _ in range(12))) for _ in range(60)]
    rows += [(None, None), (None, "same"), (None, "same")] + [(rng.randrange(40), f"text {i}" * 3) for i in range(60)]
    rows += [(7, f"hot {i % 5} of one id") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = B.fingerprints(df).select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))


def test_ranges_follow_the_rows_and_have_a_task_each(spark, monkeypatch):
    monkeypatch.setattr(B, "ROWS_PER_RANGE", 10)
    rows = [(i * i, f"text {i}") for i in range(400)] + [(None, f"{i:03d} without id") for i in range(200)]
    found = B.with_next(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The texts move once, by the number of their range; the window reuses that.
    assert plan.count("REPARTITION_BY_NUM") == 1 and "hashpartitioning(part" not in plan.split("Window", 1)[1].split(
        "REPARTITION_BY_NUM")[0]
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 600 and len(sizes) >= 50 and max(sizes) <= 20
