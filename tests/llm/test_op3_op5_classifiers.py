import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import empty, labels, messy
from wattlake.llm import labelled
from wattlake.llm import quality_pu as Q
from wattlake.llm import toxicity_gbt as T

WORDS = "the of and river house under light table green walk seven paper stone cloud early".split()


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def corpus(n=900, seed=1):
    """Clean, junk (quality 0) and insulting (toxic 1) texts; a new insult that only labels reveal."""
    rng = random.Random(seed)
    docs, marks = [], []
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "s", ".", ","]) for _ in range(rng.randrange(30, 200))]
        kind = rng.random()
        toxic, quality = int(kind < 0.25), int(kind < 0.75)
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), "you " + rng.choice(["moron", "snorbel", "snorbelish"]))
        text = " ".join(words)
        if not quality:
            text = rng.choice([text.upper().replace(" ", "!! "), "He " * 200, " | ".join(words),
                               " ".join(w + "&&&" for w in words)])
        docs.append((i, text))
        marks.append((i, quality, toxic))
    return docs, marks


@pytest.fixture(scope="module")
def data(spark):
    docs, marks = corpus()
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4).cache(),
            spark.createDataFrame(marks, "doc_id long, quality int, toxic int").cache(), marks)


def test_fold_is_crc32_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in [*range(-30, 200), None]], "i long")
    for r in df.select("i", labelled.held_out(F.col("i")).alias("h")).collect():
        assert r["h"] == (r["i"] is not None and held(r["i"]))


@pytest.mark.parametrize("module,label", [(Q, "quality"), (T, "toxic")])
def test_held_out_accuracy_and_blindness_to_held_out_labels(data, module, label):
    docs, marks, plain = data
    truth = {m[0]: m[1 if label == "quality" else 2] for m in plain}
    first = {r["doc_id"]: r for r in module.classify(docs, marks).collect()}
    assert len(first) == len(truth) and all(r["held_out"] == held(i) for i, r in first.items())
    right = [r["predicted"] == truth[i] for i, r in first.items() if held(i)]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in first.values())
    assert all(r["predicted"] == int(r["score"] >= module.THRESHOLD) for r in first.values())
    flipped = marks.withColumn(label, F.when(labelled.held_out(F.col("doc_id")), 1 - F.col(label)).otherwise(F.col(label)))
    second = {r["doc_id"]: r["score"] for r in module.classify(docs, flipped).collect()}
    assert all(second[i] == r["score"] for i, r in first.items())


@pytest.mark.parametrize("module", [Q, T])
def test_messy_and_empty(spark, module):
    out = module.classify(messy(spark), labels(spark))
    assert out.count() == messy(spark).count() and out.where("score is null or predicted is null").count() == 0
    assert module.classify(empty(spark), labels(spark)).count() == 0
    assert module.classify(messy(spark), labels(spark, ())).count() == messy(spark).count()


def test_keep_good_takes_effect(data):
    docs, marks, plain = data
    kept = {r["doc_id"] for r in Q.keep_good(docs, marks).collect()}
    scores = {r["doc_id"]: r["predicted"] for r in Q.classify(docs, marks).collect()}
    assert kept == {i for i, p in scores.items() if p}


def test_non_negative_risk_reaches_the_prior(spark):
    rng = np.random.default_rng(0)
    d = len(Q.FEATURES)
    pos, neg = rng.normal(6, 1, (1400, d)), rng.normal(4, 1, (600, d))
    rows = [(x.tolist(), i < 500) for i, x in enumerate([*pos, *neg])]
    model = Q.fit(spark.createDataFrame(rows, "x array<double>, trusted boolean").repartition(3), 0.7)
    unlabelled = np.vstack([pos, neg])
    assert (model.score(pos) > 0.5).mean() > 0.95 and (model.score(neg) < 0.5).mean() > 0.95
    assert abs((model.score(unlabelled) > 0.5).mean() - 0.7) < 0.05
    df = spark.createDataFrame([(x.tolist(),) for x in unlabelled[:50]], "x array<double>")
    assert np.allclose([r[0] for r in df.select(model.score_of(F.col("x"))).collect()], model.score(unlabelled[:50]))


def test_scales_are_quantiles_of_all_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.gamma(2.0, 0.3, (3000, len(Q.FEATURES)))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>")
    middle, spread = Q.scales(df.repartition(5))
    assert np.allclose(middle, np.median(x, axis=0), rtol=0.03)
    wide = (np.percentile(x, 90, axis=0) - np.percentile(x, 10, axis=0)) / 2.56
    assert np.allclose(spread, np.maximum(wide, 0.25 * x.std(axis=0) + 1e-3), rtol=0.05)
    again = Q.scales(df.repartition(2))
    assert (again[0] == middle).all() and (again[1] == spread).all()


def test_many_null_ids_and_repeated_rows_fit_alike(data, spark):
    docs, marks, _ = data
    mixed = docs.withColumn("doc_id", F.when(F.col("doc_id") % 10 < 3, F.lit(None)).otherwise(F.col("doc_id")))
    mixed = mixed.union(mixed.where("doc_id % 10 = 4"))
    runs = [sorted(((r["doc_id"] or -1, r["score"]) for r in Q.classify(mixed.repartition(n), marks).collect()))
            for n in (2, 7)]
    assert len(runs[0]) == mixed.count() and np.allclose([s for _, s in runs[0]], [s for _, s in runs[1]], atol=1e-6)


def test_lexicon_learns_whole_words_and_beginnings(spark):
    docs, marks = corpus()
    rows = spark.createDataFrame([(t, m[2]) for (_, t), m in zip(docs, marks)], "text string, label int")
    lexicon = T.learn_lexicon(rows)
    assert {"moron", "snorb*", "snorbel"} <= set(lexicon) and "river" not in lexicon


def test_features_count_what_they_say():
    x = dict(zip(T.FEATURES, T.features("You M0RON!!! what a MORON, sooo bad", {"moron": 3.0})))
    assert x["fixed_hits"] == pytest.approx(np.log1p(1)) and x["deobfuscated_hits"] == pytest.approx(np.log1p(1))
    assert x["near_you"] == 1.0 and x["stretched"] > 0 and x["camouflaged"] > 0 and x["mark_runs"] > 0
    assert T.features(None, {}) == T.features(" ", {}) == [0.0] * len(T.FEATURES)
