"""Quality classifier by positive-unlabelled learning.

Trusted positives (labelled quality 1) and unlabelled web text train a logistic
model on dense text features; the loss is the non-negative unbiased risk

    prior * E_pos[l(+)] + max(0, E_unl[l(-)] - prior * E_pos[l(-)])

minimised by damped Newton steps (where the bracket turns negative, the step
reverses its gradient, as the method prescribes).  Labels 0 enter nothing but
the estimate of the class prior: the smoothed share of positives among labelled
training rows.  ``TRAIN_ROWS`` bounds the labelled ids used as trusted
positives.  The unlabelled side is every row outside the held-out fold: its
scales are quantiles of whole histograms, its risk, gradient and curvature sums
over all rows, taken by Spark once a round from the written features; only
those sums reach the driver.

A null or empty text has the feature vector of no characters and gets that
vector's score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, col, field, materialize, packed, text_batches, unpacked
from .labelled import fold, held_out, sampled

TRAIN_ROWS = 12_000
THRESHOLD = 0.3
ROUNDS = 12
RATE = 0.1
L2 = 1e-4
# Few trusted rows weigh less against small weights: this many rows' worth of penalty.
PRIOR_ROWS = 3.0
LARGEST_STEP = 2.0
SETTLED = 1e-5
# Histogram bins of a feature: 64 for each e-fold of 1 + 1000 x.
BIN_UNIT = 1000.0
BINS_PER_FOLD = 64
MARKS = "#$%&*|<>{}[]\\^~=_@+/"
ENDS = ".!?"
_LETTERS = re.compile(r"[^\W\d_]")
FEATURES = ("log_words", "word_length", "marks", "bangs", "pipes", "digits", "capitals", "shouted",
            "distinct", "top_word", "echoes", "lines_repeated", "line_length", "sentence_ends", "commas",
            "non_ascii", "bare_marks")


def features(text: str | None) -> list[float]:
    """Dense features of one whole text, in the order of FEATURES."""
    text = text or ""
    words = text.split()
    n, c = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    shouted = sum(k for w, k in counts.items() if len(w) > 1 and w.isupper())
    bare = sum(k for w, k in counts.items() if len(w) <= 3 and not _LETTERS.search(w) and not w.isalnum())
    echoes = sum(map(str.__eq__, words, words[1:]))
    marks = sum(map(text.count, MARKS))
    lines = [x for x in text.split("\n") if x]
    # The same words lower-cased differ in as many letters as were capitals.
    lowered = text.lower()
    capitals = (sum(map(str.__ne__, text, lowered)) if len(lowered) == c
                else sum(x.isupper() for x in text))
    return [
        np.log1p(n), c / n, marks / n, text.count("!") / n, text.count("|") / n,
        sum(map(text.count, "0123456789")) / c, capitals / c, shouted / n,
        len(counts) / n ** 0.8, max(counts.values()) / n, echoes / n,
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(c / max(1, len(lines))),
        sum(map(text.count, ENDS)) / n, text.count(",") / n,
        (len(text.encode("utf-8", "surrogatepass")) - c) / c, bare / n,
    ]


@dataclass(frozen=True)
class PuModel:
    """A logistic model on standardised, clipped features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z * z / 6])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weight + self.bias, -30, 30)))

    def score_of(self, x: Column) -> Column:
        """The score of a features column, as a Spark expression."""
        f = F.lit(self.bias)
        d = len(self.mean)
        for i in range(d):
            z = F.greatest(F.least((F.get(x, F.lit(i)) - float(self.mean[i])) / float(self.scale[i]), F.lit(6.0)),
                           F.lit(-6.0))
            f = f + z * float(self.weight[i]) + z * z / 6 * float(self.weight[d + i])
        return 1 / (1 + F.exp(-F.greatest(F.least(f, F.lit(30.0)), F.lit(-30.0))))


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, bin, rows) of each batch."""
    for batch in batches:
        if batch.num_rows:
            bins = np.floor(np.log1p(np.maximum(_vectors(batch), 0) * BIN_UNIT) * BINS_PER_FOLD).astype(np.int64)
            for i in range(bins.shape[1]):
                values, rows = np.unique(bins[:, i], return_counts=True)
                yield pa.RecordBatch.from_pydict({"feature": pa.array([i] * len(values), pa.int32()),
                                                  "bin": pa.array(values, pa.int64()), "n": pa.array(rows, pa.int64())})


def scales(features: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Median and spread of every feature, from the histograms of all rows.

    Bins are counted as whole numbers, so the result does not depend on the order
    of rows; there are as many as a feature has orders of magnitude, not rows.
    """
    found = (features.select("x").mapInArrow(_bins, "feature int, bin long, n long")
             .groupBy("feature", "bin").agg(F.sum("n").alias("n")).orderBy("feature", "bin").toPandas())
    middle, spread = np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    for i, own in found.groupby("feature"):
        value = np.expm1((own["bin"].to_numpy() + 0.5 * (own["bin"].to_numpy() > 0)) / BINS_PER_FOLD) / BIN_UNIT
        n = own["n"].to_numpy()
        share = np.cumsum(n) / n.sum()
        low, mid, high = (value[np.searchsorted(share, q)] for q in (0.1, 0.5, 0.9))
        deviation = np.sqrt(np.average((value - np.average(value, weights=n)) ** 2, weights=n))
        middle[i], spread[i] = mid, max((high - low) / 2.56, 0.25 * deviation + 1e-3)
    return middle, spread


def _risk_sums(model: PuModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over a task's rows for one round: one (place, value) row per number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = 2 * len(FEATURES) + 1
        total = np.zeros(5 + 3 * d + d * d)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.hstack([model.design(_vectors(batch)), np.ones((batch.num_rows, 1))])
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            f = np.clip(x @ np.append(model.weight, model.bias), -30, 30)
            s, soft = 1 / (1 + np.exp(-f)), np.logaddexp(0, f)
            total += np.concatenate([
                [len(f), trusted.sum(), soft.sum(), soft[trusted].sum(), (soft - f)[trusted].sum()],
                x.T @ s, x[trusted].T @ s[trusted], x[trusted].sum(axis=0), ((x * (s * (1 - s))[:, None]).T @ x).ravel()])
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(total)), pa.int32()),
                                          "value": pa.array(total, pa.float64())})
    return run


def fit(rows: DataFrame, prior: float, rounds: int = ROUNDS) -> PuModel:
    """Minimise the non-negative PU risk over ``rows`` (x, trusted): all of them unlabelled, some trusted too.

    Weights are rounded after every round, so the order in which partial sums
    arrive does not show; the weights of smallest risk are kept.
    """
    d = 2 * len(FEATURES) + 1
    theta = np.zeros(d)
    theta[-1] = np.log(prior / (1 - prior))
    middle, spread = scales(rows)
    best, smallest = None, np.inf
    for _ in range(rounds):
        model = PuModel(middle, spread, theta[:-1], float(theta[-1]), prior)
        sums = (rows.select("x", "trusted").mapInArrow(_risk_sums(model), "place int, value double")
                .groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").toPandas()["value"].to_numpy())
        if not len(sums) or not sums[0] or not sums[1]:
            return model  # nothing to learn from: the prior is every row's score
        n, n_p = sums[0], sums[1]
        grad_u, grad_p, mean_p = (sums[5 + i * d:5 + (i + 1) * d] / m for i, m in enumerate((n, n_p, n_p)))
        l2 = L2 + PRIOR_ROWS / n_p
        curve = sums[5 + 3 * d:].reshape(d, d) / n + np.diag(np.append(np.full(d - 1, l2), 1e-9))
        penalty = np.append(l2 * theta[:-1], 0.0)
        negative = sums[2] / n - prior * sums[3] / n_p
        risk = prior * sums[4] / n_p + max(0.0, negative) + 0.5 * l2 * float(theta[:-1] @ theta[:-1])
        if risk < smallest - 1e-9:
            best, smallest = model, risk
        grad_negative = grad_u - prior * grad_p
        if negative >= 0:
            step = np.linalg.solve(curve, prior * (grad_p - mean_p) + grad_negative + penalty)
        else:
            step = RATE * np.linalg.solve(curve, -grad_negative + penalty)
        size = np.abs(step).max()
        if size < SETTLED:
            break
        theta = np.round(theta - step * min(1.0, LARGEST_STEP / size), 9)
    return best


def features_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)
    return dense(text)


def train(features: DataFrame, labels: DataFrame, label: str = "quality", bound: int = TRAIN_ROWS) -> PuModel:
    """The model of written (doc_id, x) rows; at most about ``bound`` labelled ids are trusted positives."""
    known = (labels.select(col("doc_id").alias("doc_id"), col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != 0))
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    n, positive = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    prior = ((positive or 0) + 1) / (n + 2)
    # At most about ``bound`` ids: small enough to send to every task.
    trusted = (known.where("label = 1").where(sampled(F.col("doc_id"), bound, positive or 0, "pu-positive"))
               .select("doc_id", F.lit(True).alias("__w_trusted")))
    rows = (features.where(~held_out(F.col("doc_id"))).join(F.broadcast(trusted), "doc_id", "left")
            .select("x", F.coalesce("__w_trusted", F.lit(False)).alias("trusted")))
    return fit(rows, prior)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = TRAIN_ROWS,
             threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    x = materialize(text_batches(docs).select(col(id_col).alias("doc_id"), features_column(col(text_col)).alias("x")),
                    "pu-features")
    score = train(x, labels, label, bound).score_of(F.col("x"))
    return x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = TRAIN_ROWS,
              threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, their features computed once beside them."""
    rows = materialize(packed(text_batches(docs)).withColumn("doc_id", field(id_col)).withColumn(
        "x", features_column(field(text_col))), "pu-rows")
    model = train(rows.select("doc_id", "x"), labels, label, bound)
    return unpacked(rows.where(model.score_of(F.col("x")) >= threshold).select(ROW), docs.columns)
