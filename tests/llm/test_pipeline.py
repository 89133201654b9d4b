import random

import corpus_pipeline
from llm_fixtures import CLASHING, DOC_SCHEMA, doc, empty, labels, messy
from wattlake.llm import decontam, pii_crf, quality_pu, simhash_variants
from wattlake.llm import source_mix as M
from wattlake.llm.common import materialize

SF = "/root/testdata/sf0.001"


def tables(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    labels(spark).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "a benchmark question that nobody may train on")], "item_id long, text string"
                          ).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "redact", "mix"]


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = materialize(stage(spark, docs, SF), "stage")
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before) and len(after) == out.count()
        if name != "mix":
            assert out.columns == columns
        if name == "quality":
            scores = quality_pu.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
            assert set(after) == {r["doc_id"] for r in scores if r["score"] >= 0.3}
        if name == "near_dedup":
            fps = {i: simhash_variants.fingerprint(r["text"]) for i, r in before.items()}
            root = {i: i for i in fps}
            for _ in range(len(fps)):
                new = {i: min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4) for i in fps}
                if new == root:
                    break
                root = new
            assert set(after) == {i for i in fps if root[i] == i}
        if name == "decontaminate":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            m = decontam.Matcher(items)
            assert set(after) == {i for i, r in before.items() if not m.find(r["text"])}
            assert not any(decontam.normalised(t) in decontam.normalised(r["text"]) for r in after.values() for _, t in items)
        if name == "redact":
            assert set(after) == set(before)
            assert all(not pii_crf.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after.values())
        if name == "mix":
            sizes = {r["doc_id"]: r for r in M.mix_sizes(docs).collect()}
            assert {i: r["taken"] for i, r in after.items()} == {i: r["taken"] for i, r in sizes.items() if r["taken"]}
            assert all(len(r["text"].split()) == min(r["size"], r["taken"]) for r in after.values())
        docs = out
    run = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(str, run)) == sorted(map(str, docs.collect()))


def test_messy_tables(spark, tmp_path):
    sf = tables(spark, tmp_path, messy(spark))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "stage")
        assert docs.columns[:len(DOC_SCHEMA.names)] == DOC_SCHEMA.names
        assert all(r[c] == "x" for r in docs.collect() for c in CLASHING)


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, empty(spark))).count() == 0


def test_planted_leak_and_copy_go_and_clean_stays(spark, tmp_path):
    rng = random.Random(1)
    clean = [doc(i, " ".join(rng.choice("river stone house green light paper".split()) + rng.choice(["", "s", "."])
                             for _ in range(80)), f"s{i % 2}") for i in range(100, 130)]
    extra = [doc(200, clean[0][1]), doc(201, clean[1][1] + " A benchmark question that nobody may train upon.")]
    sf = tables(spark, tmp_path, spark.createDataFrame(clean + extra, DOC_SCHEMA))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = materialize(stage(spark, docs, sf), "stage")
    assert sorted(r["doc_id"] for r in docs.collect()) == [r[0] for r in clean]
