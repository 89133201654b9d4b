import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import MESSY, empty, messy
from wattlake.llm import pii_crf as P
from wattlake.llm.queries import op6_pii_crf


def slow_base(text):
    """The contract's patterns as they stand."""
    def luhn(d):
        d = [int(c) for c in reversed(d)]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["a.b", "@", "x-y.com", ".", "+", "1", "255", "256", "10.0.0.1", " ", "-", "4111111111111111", "(", ")",
             "é", "٣", "4111 1111-1111 1111", "+1 (555) 555-1234", "a@b.c", "a@b..c", "\n", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert P.base_spans(text) == slow_base(text), text


def test_long_runs_are_fast():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "@" * 100_000, "+1" + "." * 200_000):
        P.label(text, P.Potentials())


def test_second_mentions_are_added_and_base_stays():
    text = ("Call +1 (555) 555-1234 or write jane.roe@mail.example.com. Later 555-1234 rang; ask jane.roe again. "
            "Version 12.0.1 and 4111111111111112 are not personal.")
    base, added = P.label(text, P.Potentials())
    assert base == slow_base(text)
    assert [(text[a:b], P.KINDS[k]) for a, b, k in added] == [("555-1234", "phone"), ("jane.roe", "email")]
    assert P.redact(text, P.Potentials()).startswith("Call [PHONE] or write [EMAIL]. Later [PHONE] rang; ask [EMAIL] again")
    # Nothing else in the document: no evidence, nothing added.
    assert P.label("Later 555-1234 rang; ask jane.roe.", P.Potentials()) == ([], [])


def test_propagation_is_exact_on_a_tree():
    rng = np.random.default_rng(3)
    unary = rng.normal(size=(4, 3))
    edges = [(0, 1, 1.0), (1, 2, 2.0), (1, 3, 0.5)]
    total = np.zeros((4, 3))
    for y in np.ndindex(3, 3, 3, 3):
        w = np.exp(sum(unary[i, y[i]] for i in range(4)) + sum(g for a, b, g in edges if y[a] == y[b]))
        for i in range(4):
            total[i, y[i]] += w
    assert np.allclose(P.propagate(unary, edges, rounds=200), total / total.sum(1, keepdims=True), atol=1e-4)


def test_weights_come_from_counts():
    many = P.potentials({"same0": 5000, "same1": 10, "u3\t9999": 40, "u0\t9999": 4})
    assert many.weights["same"] == 0.0 and many.shapes["9999"] == (4, 0, 0, 40, 0)
    assert P.potentials({}).weights["same"] > 4


def test_query_columns(spark, tmp_path):
    texts = [r[:2] for r in MESSY] + [(50, "4111 1111 1111 1111, 10.0.0.1; +1 (555) 555-1234 a@b.co 555-1234")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["base_sha256"]): r for r in op6_pii_crf(spark, str(tmp_path)).collect()}
    for i, t in texts:
        spans = slow_base(t or "")
        text = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, b, k in spans)
        r = got[i, hashlib.sha256(text.encode()).hexdigest()]
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s[2] == j for s in spans) for j in range(4)]
        assert set(text.split(",")) <= set(r["spans"].split(","))
    last = next(r for r in got.values() if r["doc_id"] == 50)
    assert last["spans"].endswith(",phone:56:64") and last["n_phone"] == 1


def test_redacted_keeps_columns(spark):
    df = messy(spark)
    out = P.redacted(df)
    assert out.columns == df.columns and out.schema == df.schema and out.count() == df.count()
    r = out.where("doc_id = 6").first()
    assert r["text"] == "mail [EMAIL] or [PHONE] now" and r["n_chars"] == len(r["text"])
    assert out.where("text is null").count() == 2
    texts = {r["text"] for r in df.collect()}
    assert [x["doc_id"] for x in out.collect() if x["text"] not in texts] == [6]
    assert P.redacted(empty(spark)).count() == 0 and P.find(empty(spark)).count() == 0
    assert df.where(F.col("text").isNull()).count() == 2


def test_field_is_the_same_on_the_table_ten_times_over(spark):
    # Phones with their number repeated, some of them without a pattern, and names of addresses.
    rows = [f"Call +1 (555) 555-{i:04d}, that is +1 (555) 555-{i:04d}." for i in range(150)]
    rows += [f"Part 777-{i:04d} is out." for i in range(3)]
    planted = [f"Call +1 (555) 556-{i:04d} now. Later 556-{i:04d} rang." for i in range(12)]
    planted += [f"Write jane.roe{'abcdefgh'[i]}@mail.example.com and ask jane.roe{'abcdefgh'[i]} again." for i in range(8)]
    found = []
    for times in (1, 10):
        texts = (rows + planted) * times
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        spans = {texts[r["doc_id"]]: (len(r["base"]), len(r["spans"])) for r in P.find(df).collect()}
        assert {spans[t] for t in planted} == {(1, 2)}
        found.append(spans)
    assert found[0] == found[1]


def test_rates_not_counts_and_missed_mentions_are_no_evidence():
    text = "Call +1 (555) 555-1234 now. Later 555-1234 rang. Part 777-1234."
    found = P.events(text)
    assert "same0" not in found and sum(e.startswith("u0") for e in found) == 1
    counts = {"same0": 1, "same1": 75, "alike1": 9, "u0\t7/2-": 2, "u4\t7/2-": 150, "c1": 3, "c0": 2}
    many = P.potentials({k: 1000 * n for k, n in counts.items()})
    assert many.weights == P.potentials(counts).weights
    assert np.allclose(many.unary("555-1234"), P.potentials(counts).unary("555-1234"))
    assert P.shape("9" * 100) == P.shape("9" * 1000) and P.shape("a" * 70 + "1") != P.shape("a" * 70)
