"""SimHash near-duplicates by deletion variants of fingerprint segments.

The 64 bits are cut into three segments.  Two fingerprints within four bits
differ by at most one bit in at least one segment (three segments with two or
more differences each would be six), so after wiping that one bit from the
segment they share it exactly.  Every distinct fingerprint is indexed under
its 64 one-wildcard variants - segment, wiped position, remaining bits - and an
equality join on the variant brings candidates together.  A candidate counts
only under the first variant its pair shares and only if the whole
fingerprints are within the distance, both tested inside the join, so no
unverified pair leaves it.

Copies are joined as one fingerprint; components of the links are found by
alternating large and small stars, each round a written table.

Texts: null is the empty text; no words gives fingerprint zero, which links
like any other; words are runs of non-white-space of the A-Z-lowered text,
fewer than ``shingle`` of them make one shingle.  Rows that repeat a doc_id
stay; a null doc_id never names a component unless no other id is in it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, col, field, lookup, materialize, packed, text_batches, unpacked

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# (lowest bit, width) of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Bytes hashed per numpy step when the bits of a long text are counted.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:len(words) - shingle].tolist()]
        stops = (ends[shingle - 1:] - 1).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), CHUNK):
        part = np.array(hashes[k:k + CHUNK], dtype=">u8").view(np.uint8)
        ones += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        out = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(out.view(np.int64))
    return simhash(text)


def _segment(x: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def variants(fp: Column) -> Column:
    """The one-wildcard variants of a fingerprint, one long per variant."""
    out, index = [], 0
    for low, width in SEGMENTS:
        value = _segment(fp, low, width)
        for bit in range(width):
            kept = value.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)).cast("long"))
            out.append(kept + F.lit(index << 22).cast("long"))
            index += 1
    return F.array(*out)


def first_shared_variant(x: Column) -> Column:
    """Index of the first variant that two fingerprints with xor ``x`` share."""
    chosen, index = F.lit(-1).cast("long"), sum(w for _, w in SEGMENTS)
    for low, width in reversed(SEGMENTS):
        index -= width
        part = _segment(x, low, width)
        n = F.bit_count(part)
        chosen = (F.when(n == 0, F.lit(index).cast("long"))
                  .when(n == 1, F.bit_count(part - 1).cast("long") + index).otherwise(chosen))
    return chosen


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column ``fp``) within the distance.

    ``max_bits`` up to 5 is complete with three segments.
    """
    if max_bits >= 2 * len(SEGMENTS):
        raise ValueError(f"{len(SEGMENTS)} segments are complete up to {2 * len(SEGMENTS) - 1} bits")
    index = fps.select("fp", F.explode(variants(F.col("fp"))).alias("variant"))
    # 64 rows per fingerprint: Spark sizes the sides without the explode and could
    # broadcast one, so ask for the sorted join.
    a, b = index.hint("merge").alias("a"), index.hint("merge").alias("b")
    xor = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    return a.join(b, (F.col("a.variant") == F.col("b.variant")) & (F.col("a.fp") < F.col("b.fp"))
                  & (F.bit_count(xor) <= max_bits)
                  & (first_shared_variant(xor) == F.shiftrightunsigned(F.col("a.variant"), 22))
                  ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an undirected graph; root is its smallest node.

    Alternating large and small stars: each round replaces the links of every
    node by links to the smallest neighbour, until nothing changes.  The links
    then form one star around each component's smallest node.  No node's
    neighbours are ever gathered: they meet their minimum by :func:`lookup`,
    weighted by degree, so a hub's links spread over all tasks.
    """
    current = materialize(edges.select("a", "b"), "links")
    before = None
    while True:
        both = current.select("a", "b").union(current.select(F.col("b"), F.col("a")))
        low = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"),
                                                F.count("*").alias("n")), "nearest")
        large = (lookup(both.where("b > a"), low, ["a"], "n", F.col("b"))
                 .select(F.col("b").alias("u"), F.col("m").alias("v")).where("u != v"))
        down = large.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
        down = materialize(down, "large-star")
        least = materialize(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        small = (lookup(down, least, ["a"], "n", F.col("b")).select(F.col("b").alias("u"), F.col("m").alias("v")).where("u != v")
                 .union(least.select(F.col("a").alias("u"), F.col("m").alias("v"))))
        small = small.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
        current = materialize(small, "small-star")
        after = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(after) == before:
            break
        before = tuple(after)
    stars = current.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.union(roots.join(stars, "node", "left_anti"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long), component_id for every row of ``docs``."""
    return _rooted(docs, shingle, max_bits, id_col, text_col).select("doc_id", "fp", "component_id")


def _rooted(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, hash of the text, fp, root fingerprint and component_id for every row."""
    slim = materialize(text_batches(docs).select(
        col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("text_hash"),
        fingerprint_column(col(text_col), shingle).alias("fp")), "simhash")
    fps = materialize(slim.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")),
                      "fingerprints")
    roots = materialize(components(near_pairs(fps, max_bits)), "roots")
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "rep", "n", F.coalesce("root", "fp").alias("root"))
    smallest = materialize(rooted.groupBy("root").agg(F.min("rep").alias("component_id"),
                                                      F.count("*").alias("members")), "smallest")
    named = materialize(lookup(rooted, smallest, ["root"], "members", F.col("fp"))
                        .select("fp", "n", "root", "component_id"), "components")
    return lookup(slim, named, ["fp"], "n", F.col("doc_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near-duplicates: one row of each component, one with its smallest doc_id.

    The row is found by doc_id and text, so rows that share a doc_id stand for
    their own components.  A component without any doc_id keeps one row too.
    """
    found = _rooted(docs, shingle, max_bits, id_col, text_col)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("doc_id").alias("kept_id"), F.min("text_hash").alias("kept_hash"))
    kept = materialize(kept.select("kept_id", "kept_hash"), "kept")
    rows = packed(docs).withColumn("__w_id", field(id_col)).withColumn("__w_hash", F.xxhash64(field(text_col)))
    once = Window.partitionBy("__w_id", "__w_hash").orderBy("__w_hash")
    same = F.col("__w_hash") == F.col("kept_hash")
    named = (rows.where("__w_id is not null")
             .join(kept.where("kept_id is not null"), (F.col("__w_id") == F.col("kept_id")) & same, "left_semi")
             .withColumn("__w_n", F.row_number().over(once)).where("__w_n = 1").select(ROW))
    rest = (rows.where("__w_id is null").withColumn("__w_n", F.row_number().over(once)).where("__w_n = 1")
            .join(kept.where("kept_id is null"), same, "left_semi").select(ROW))
    return unpacked(named.union(rest), docs.columns)
