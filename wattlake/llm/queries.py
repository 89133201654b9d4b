"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bottomk, decontam, main_text, orchard, pii_crf, quality_pu, quote_threads, simhash_variants, source_mix,
               spelling, toxicity_gbt, url_templates, warc_merge)
from .sql import SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc_merge.archive_and_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey",
                        "captured_at")


def op2_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_variants.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_gbt.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sizes(table(spark, sf_dir, "documents"))


def op5_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", pii_crf.of_kind(k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(pii_crf.KINDS)]
    return found.select("doc_id", *counts,
                        F.sha2(pii_crf.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii_crf.written(F.col("spans")).alias("spans"))


def op7_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_threads.threads(table(spark, sf_dir, "conversations"))


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"))


def op9_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bottomk.fingerprints(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        bottomk.digest(F.col("sketch")).alias("fingerprint"),
        bottomk.digest(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next",
        bottomk.distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
        bottomk.containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_in_edited"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(table(spark, sf_dir, "embeddings"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text.main_texts(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), drop_every=spelling.DROP_EVERY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc_merge, op2_simhash_variants, op3_toxicity_gbt, op4_source_mix, op5_quality_pu, op6_pii_crf,
    op7_quote_threads, op8_url_templates, op9_bottomk, op10_decontam, op11_orchard, op12_main_text, op13_spelling)}

__all__ = ["QUERIES", "SQL"]
