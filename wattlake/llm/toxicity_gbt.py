"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Three disjoint parts of the labelled training rows (never the held-out fold)
do three jobs: one learns a lexicon (whole words and word beginnings that mark
toxic texts), one trains the boosted trees, one fits the isotonic map from tree
probability to calibrated score.  The trees see lexicon densities, how near hits
stand to second-person pronouns, capitals, punctuation and obfuscation rates -
nothing else of the text and no other column.

Fitting uses at most ``TRAIN_ROWS`` labelled rows; every whole text is scored.
A null or empty text has all features zero and gets that vector's score.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, materialize
from .labelled import held_out, training_rows

TRAIN_ROWS = 30_000
THRESHOLD = 0.5
TREES = 25
DEPTH = 3
LEXICON_SIZE = 600
STEMS = (4, 5)
NEAR = 5
# A small list of plain insults, and second-person pronouns of
# the corpus languages; the lexicon learned from labels extends the first.
INSULTS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
YOU = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
       "tu", "te", "toi", "ton", "ta", "vous", "votre", "ti", "usted", "ustedes", "vosotros", "vos")
STRIP = ".,;:!?\"'()[]{}<>«»“”‘’…*_~-"
_CAMOUFLAGE = re.compile(r"[^\W\d_][0-9@$!|*#]+[^\W\d_]")
_STRETCH = re.compile(r"([^\W\d_])\1{2,}")
_RUN = re.compile(r"[!?.]{2,}|[^\w\s]{3,}")
# Digits and marks that stand for letters in obfuscated words.
_PLAIN = str.maketrans("013457@$!", "oieastasi")
FEATURES = ("log_words", "fixed_density", "fixed_hits", "learned_density", "learned_hits", "learned_weight",
            "best_weight", "near_you", "you_density", "capitals", "shouted", "punctuation", "mark_runs",
            "camouflaged", "stretched", "deobfuscated_hits")


def entries(word: str) -> list[str]:
    """Lexicon keys of a word: itself and its beginnings ("chll*")."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def _best(word: str, lexicon: dict[str, float]) -> float:
    return max((lexicon.get(e, 0.0) for e in entries(word)), default=0.0)


def features(text: str | None, lexicon: dict[str, float], seen: dict[str, tuple] | None = None) -> list[float]:
    """Dense features of one whole text, in the order of FEATURES.

    ``seen`` remembers what a raw word contributes, for texts with a common
    vocabulary.
    """
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    seen = {} if seen is None else seen
    if len(seen) > 200_000:
        seen.clear()
    n = len(words)
    fixed = learned = deobfuscated = you = shouted = camouflaged = stretched = punctuation = 0
    capitals = chars = 0
    total = best = 0.0
    hits, people = [], []
    for i, raw in enumerate(words):
        got = seen.get(raw)
        if got is None:
            word = raw.strip(STRIP).lower()
            weight, in_fixed = _best(word, lexicon), word in INSULTS
            hidden = 0
            if not in_fixed and not weight and _CAMOUFLAGE.search(word):
                plain = word.translate(_PLAIN)
                hidden = int(plain in INSULTS or _best(plain, lexicon) > 0)
            plain_flags = (int(len(raw) > 1 and raw.isupper()), int(bool(_CAMOUFLAGE.search(word))),
                           int(bool(_STRETCH.search(word))), sum(not x.isalnum() for x in raw),
                           sum(map(str.isupper, raw)), len(raw))
            seen[raw] = got = (in_fixed, weight, hidden, word in YOU, any(plain_flags[:4]), plain_flags)
        in_fixed, weight, hidden, is_you, odd, flags = got
        if in_fixed or weight or hidden:
            fixed += in_fixed
            learned += weight > 0
            deobfuscated += hidden
            total += weight
            best = max(best, weight)
            hits.append(i)
        if is_you:
            people.append(i)
        if odd:
            shouted += flags[0]
            camouflaged += flags[1]
            stretched += flags[2]
            punctuation += flags[3]
        capitals += flags[4]
        chars += flags[5]
    near, j = 0, 0
    for i in hits:
        while j < len(people) and people[j] < i - NEAR:
            j += 1
        near += j < len(people) and people[j] <= i + NEAR
    return [math.log1p(n), fixed / n, math.log1p(fixed), learned / n, math.log1p(learned), total / math.sqrt(n),
            best, near / max(1, len(hits)), len(people) / n, capitals / chars, shouted / n, punctuation / chars,
            len(_RUN.findall(text)) / n, camouflaged / n, stretched / n, math.log1p(deobfuscated)]


def features_column(text: Column, lexicon: dict[str, float]) -> Column:
    seen: dict[str, tuple] = {}

    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, lexicon, seen) for t in texts], dtype=object)
    return dense(text)


def learn_lexicon(rows: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Entries far likelier in toxic than in other rows, with their smoothed log-odds.

    ``rows`` (text, label) is bounded by the caller; at most ``size`` entries
    come to the driver.
    """
    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({e for w in {x.strip(STRIP).lower() for x in (t or "").split()} if w
                                  for e in entries(w)}) for t in texts], dtype=object)

    n, toxic = rows.agg(F.count("*"), F.sum("label")).first()
    toxic = toxic or 0
    if not toxic or toxic == n:
        return {}
    counted = (rows.select("label", F.explode(of("text")).alias("entry")).groupBy("entry")
               .agg(F.sum("label").alias("bad"), F.count("*").alias("all")))
    odds = F.log(((F.col("bad") + 0.5) / F.lit(toxic + 1.0))
                 / ((F.col("all") - F.col("bad") + 0.5) / F.lit(n - toxic + 1.0)))
    least = max(3, round(0.004 * toxic))
    kept = (counted.withColumn("odds", odds).where((F.col("bad") >= least) & (F.col("odds") >= 2.5))
            .orderBy(F.desc(F.col("odds") * F.sqrt(F.col("bad"))), "entry").limit(size).collect())
    return {r["entry"]: float(r["odds"]) for r in kept}


class ToxicityModel:
    """Lexicon, boosted trees and isotonic map; ``score`` adds a calibrated column."""

    def __init__(self, lexicon, trees, isotonic, base: float):
        self.lexicon, self.trees, self.isotonic, self.base = lexicon, trees, isotonic, base

    def score(self, df: DataFrame, text: Column, name: str = "score") -> DataFrame:
        if self.trees is None:
            return df.withColumn(name, F.lit(self.base))
        x = df.withColumn("__w_x", features_column(text, self.lexicon))
        raw = _raw(self.trees, x)
        if self.isotonic is None:
            return raw.withColumn(name, F.col("__w_raw")).drop("__w_raw", "__w_x")
        fitted = self.isotonic.transform(raw)
        # A thousandth of the tree probability orders the ties of the step function.
        score = F.col("__w_fit") * 0.999 + F.col("__w_raw") * 0.001
        return fitted.withColumn(name, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))).drop(
            "__w_raw", "__w_fit", "__w_x")


def _raw(trees, df: DataFrame) -> DataFrame:
    out = trees.transform(df.withColumn("__w_v", array_to_vector("__w_x")))
    return out.withColumn("__w_raw", F.get(vector_to_array("__w_p"), 1)).drop("__w_v", "__w_p", "__w_margin", "__w_y")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    rows = materialize(training_rows(docs, labels, label, bound, "toxic", id_col, text_col)
                       .select("doc_id", "text", "label",
                               F.pmod(F.xxhash64(F.lit("job"), "doc_id"), F.lit(10)).alias("job")), "toxic-rows")
    n, positive = rows.agg(F.count("*"), F.sum("label")).first()
    base = ((positive or 0) + 0.5) / (n + 1)
    lexicon = learn_lexicon(rows.where("job < 4").select("text", "label"))
    x = materialize(rows.where("job >= 4").select("doc_id", "label", "job",
                                                  features_column(F.col("text"), lexicon).alias("__w_x")), "toxic-x")
    fitting = (x.where("job < 8").withColumn("__w_v", array_to_vector("__w_x"))
               .withColumn("label", F.col("label").cast("double")).coalesce(4).cache())
    try:
        if fitting.select("label").distinct().count() < 2:
            return ToxicityModel(lexicon, None, None, base)
        trees = GBTClassifier(featuresCol="__w_v", labelCol="label", predictionCol="__w_y", maxIter=TREES,
                              maxDepth=DEPTH, stepSize=0.2, maxBins=64, minInstancesPerNode=5, seed=7
                              ).setProbabilityCol("__w_p").setRawPredictionCol("__w_margin").fit(fitting)
    finally:
        fitting.unpersist()
    held = _raw(trees, x.where("job >= 8")).select(F.col("label").cast("double").alias("label"), "__w_raw")
    # One pseudo-row of either class at the ends keeps the ends off certainty.
    ends = docs.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "label double, __w_raw double")
    isotonic = IsotonicRegression(featuresCol="__w_raw", labelCol="label", predictionCol="__w_fit").fit(
        held.union(ends).coalesce(1))
    return ToxicityModel(lexicon, trees, isotonic, base)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = TRAIN_ROWS,
             threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(docs, labels, label, bound, id_col, text_col)
    scored = model.score(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("__w_text")), F.col("__w_text"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
