"""Labelled rows, their folds and bounded samples, for the two classifiers.

A row's fold is crc32 of its doc_id as text, mod 5; fold 0 is held out and its
labels are never read by training.  Rows without a doc_id or label are not
labelled; an id labelled more than once counts with its smallest label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, text_batches

FOLDS = 5


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def held_out(doc_id: Column) -> Column:
    """True in fold 0; a null doc_id is never held out."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int,
                  seed: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, fold, label): at most about ``bound`` labelled rows of folds 1 to 4.

    A hash of the id chooses them, so the sample does not depend on row order;
    ``bound`` rows are expected when there are more.
    """
    known = (labels.select(col("doc_id").alias("doc_id"), col(label).cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)")
             .withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0")
             .groupBy("doc_id", "fold").agg(F.min("label").alias("label")))
    n = known.count()
    chosen = known.where(sampled(F.col("doc_id"), bound, n, seed)) if n > bound else known
    texts = text_batches(docs).select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    # At most about ``bound`` ids: small enough to send to every task.
    return texts.join(F.broadcast(chosen), "doc_id")


def sampled(doc_id: Column, bound: int, n: int, seed: str) -> Column:
    """Keeps about ``bound`` of ``n`` rows by a hash of their id (null ids count as one id)."""
    share = min(1.0, bound / max(n, 1))
    return F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
