"""Mixing sources to target weights: hash-random keys, prefix sums, exact cuts.

Sources in code-point order (null last) weigh 5, 2, 1 in turn and share
``factor`` times all words; a source's target stops at ``cap`` times its own
words and the excess is shared again by weight (water filling).  Inside a
source documents are ordered by a hash-random key.  The key space is dealt into
equal ranges; word counts per (source, range) give distributed prefix sums, so
only the one range of each source in which its budget runs out is ever sorted
row by row.  Everything before the cut is taken, everything after is not, the
document at the cut gives the words that are left; whole epochs come first
when the budget exceeds the source.

A document's size is its number of words (null text: 0).  Rows equal in id,
source and size have the same key; at a cut they share the rest evenly, rounded
down.  DataFrame operations only.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, WORD, col, field, lookup, materialize, packed

WEIGHTS = (5, 2, 1)
FACTOR = 1.5
CAP = 2.0
KEY_SEED = "mix"
KEY_BITS = 60
# One row per source is broadcast up to this count of sources.
FEW_SOURCES = 10_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str) -> Column:
    """60 hash-random bits of a document id."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, factor: float = FACTOR, weights: tuple = WEIGHTS,
            cap: float = CAP) -> DataFrame:
    """``sizes`` (src, no_src, source_size) plus ``target``: one row per source.

    A source is full if the level reached without the sources before it, in
    order of words per weight, would lift it above its cap; the level at the
    first source that isn't full is the final one.
    """
    by_name = Window.orderBy("no_src", "src")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    everything = Window.partitionBy()
    by_fill = Window.orderBy("__fill", "no_src", "src")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (sizes.withColumn("__weight", weight)
              .withColumn("__cap", F.col("source_size") * F.lit(cap))
              .withColumn("__fill", F.col("__cap") / F.col("__weight"))
              .withColumn("__left", F.sum("source_size").over(everything) * F.lit(factor)
                          - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
              .withColumn("__open", F.sum("__weight").over(everything)
                          - F.coalesce(F.sum("__weight").over(before), F.lit(0.0)))
              .withColumn("__level", F.col("__left") / F.col("__open")))
    level = F.min(F.when(F.col("__level") * F.col("__weight") <= F.col("__cap"),
                         F.struct("__fill", "no_src", "src", "__level"))).over(everything)["__level"]
    return ranked.withColumn("__final", level).select(
        "src", "no_src", "source_size",
        F.when(F.col("__final").isNull() | (F.col("__final") * F.col("__weight") > F.col("__cap")),
               F.col("__cap")).otherwise(F.col("__final") * F.col("__weight")).cast("double").alias("target"))


def ranges(n_rows: int) -> int:
    """Ranges of the key space: as many as rows in one, so that a source's prefix
    sums and the rows of its cut range both grow with the input's square root only."""
    return isqrt(n_rows) + 1


def cuts(slim: DataFrame, n_rows: int, factor: float = FACTOR, weights: tuple = WEIGHTS,
         cap: float = CAP) -> DataFrame:
    """One row per source: its size, target, whole epochs and where the last epoch is cut.

    ``slim`` has doc_id, src, no_src, size, key.
    """
    step = -(-(1 << KEY_BITS) // ranges(n_rows))
    slim = slim.withColumn("part", F.expr(f"key div {step}"))
    per_part = materialize(slim.groupBy("src", "no_src", "part").agg(
        F.sum("size").alias("words"), F.count("*").alias("n")), "mix-ranges")
    sizes = per_part.groupBy("src", "no_src").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    goals = targets(sizes, factor, weights, cap).join(
        sizes.select("src", "no_src", "n"), ["src", "no_src"])
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    goals = materialize(goals.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", budget - F.col("epochs") * F.col("source_size")), "mix-targets")
    by_part = Window.partitionBy("src", "no_src").orderBy("part")
    prefix = F.sum("words").over(by_part) - F.col("words")
    cut_part = (per_part.withColumn("before", prefix)
                .join(goals.select("src", "no_src", "rest"), ["src", "no_src"])
                .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
                .select("src", "no_src", "part", (F.col("rest") - F.col("before")).alias("rest")))
    tied = (slim.join(F.broadcast(cut_part) if goals.count() <= FEW_SOURCES else cut_part, ["src", "no_src", "part"])
            .groupBy("src", "no_src", "key", "doc_id", "size").agg(F.count("*").alias("ties"),
                                                                  F.first("rest").alias("rest")))
    in_order = Window.partitionBy("src", "no_src").orderBy("key", "doc_id", "size")
    run = F.sum(F.col("size") * F.col("ties")).over(in_order)
    at = (tied.withColumn("after", run).withColumn("before", F.col("after") - F.col("size") * F.col("ties"))
          .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("after")))
          .select("src", "no_src", F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"),
                  F.col("size").alias("cut_size"),
                  F.expr("(rest - before) div ties").alias("cut_words")))
    return materialize(goals.join(at, ["src", "no_src"], "left"), "mix-cuts")


def mix(docs: DataFrame, factor: float = FACTOR, weights: tuple = WEIGHTS, cap: float = CAP,
        seed: str = KEY_SEED, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """``docs`` packed, with size, source_size, target and taken for every row.

    ``taken`` is the number of words the mix takes from the row, repeats
    counted: ``epochs * size`` plus what the last epoch takes before its cut.
    """
    n_rows = docs.count()
    slim = materialize(docs.select(
        col(id_col).alias("doc_id"), F.coalesce(col(source_col), F.lit("")).alias("src"),
        col(source_col).isNull().alias("no_src"), words(col(text_col)).alias("size"),
        random_key(col(id_col), seed).alias("key")), "mix-sizes")
    table = cuts(slim, n_rows, factor, weights, cap)
    rows = packed(docs).select(
        ROW, field(id_col).alias("doc_id"), F.coalesce(field(source_col), F.lit("")).alias("src"),
        field(source_col).isNull().alias("no_src"), words(field(text_col)).alias("size"),
        random_key(field(id_col), seed).alias("key"))
    return _taken(rows, table)


def _taken(rows: DataFrame, table: DataFrame) -> DataFrame:
    joined = lookup(rows, table, ["src", "no_src"], "n", F.col("doc_id"))
    # A null id sorts first, in the running sums as here.
    here = F.struct("key", "doc_id", "size")
    cut = F.struct(F.col("cut_key").alias("key"), F.col("cut_id").alias("doc_id"), F.col("cut_size").alias("size"))
    last = (F.when(F.col("cut_key").isNull(), F.lit(0)).when(here < cut, F.col("size"))
            .when(here == cut, F.col("cut_words")).otherwise(F.lit(0)))
    return joined.withColumn("taken", (F.col("epochs") * F.col("size") + last).cast("long"))


def mix_sizes(docs: DataFrame, factor: float = FACTOR, weights: tuple = WEIGHTS, cap: float = CAP,
              seed: str = KEY_SEED, id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text") -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the texts are read only once."""
    n_rows = docs.count()
    slim = materialize(docs.select(
        col(id_col).alias("doc_id"), F.coalesce(col(source_col), F.lit("")).alias("src"),
        col(source_col).isNull().alias("no_src"), words(col(text_col)).alias("size"),
        random_key(col(id_col), seed).alias("key")), "mix-sizes")
    out = _taken(slim, cuts(slim, n_rows, factor, weights, cap))
    return out.select("doc_id", F.when(~F.col("no_src"), F.col("src")).alias("source"), "size",
                      "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: the columns of ``docs`` with size, target, copies and taken.

    Documents of which nothing is taken are gone.  ``copies`` says how often
    the document appears (its last appearance may be cut: ``taken`` is the
    total of words).  A document taken only in part keeps just those words.
    """
    out = mix(docs, **params).where("taken > 0")
    text = params.get("text_col", "text")
    part = F.col("taken") < F.col("size")
    kept = [F.when(part, cut_first_words(field(c), F.col("taken"))).otherwise(field(c)).alias(c) if c == text
            else field(c).alias(c) for c in docs.columns]
    extra = {"size": F.col("size"), "target": F.col("target"),
             "copies": F.ceil(F.col("taken") / F.col("size")).cast("long"), "taken": F.col("taken")}
    return out.select(*kept, *[v.alias(k) for k, v in extra.items() if k not in docs.columns])


def cut_first_words(text: Column, n_words: Column) -> Column:
    """The first ``n_words`` words joined by single spaces."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.array_join(F.slice(found, F.lit(1), n_words.cast("int")), " ")
