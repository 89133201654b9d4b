"""Centroid clustering whose assignment is Orchard's nearest-centroid search.

Components are integers, floor(scale * x) of the double x, so distances, sums
and centroids are exact and no result depends on the order of rows or tasks.

Every centroid has the list of all others, nearest first.  A vector starts at
centroid 0 and walks the list of the nearest centroid found so far; a closer
one (or one as close with a smaller number) is jumped to, and the walk goes on
along its list; a centroid looked at once is marked and never measured again;
the walk ends where the list is farther from its owner than strictly twice the
vector's distance (a centroid there cannot be as close).  Rows of an Arrow
batch walk side by side.

The vectors stay where they are: a round reads them, and each task sends one
sum and count per centroid.  Only k x dims sums come to the driver, which
holds the centroids and their lists: k, dims are parameters and k is at most
MAX_CENTROIDS.

Kept are vectors with exactly ``dims`` components, none null, NaN or infinite;
others (null vectors too) have no row in the result.  Repeated rows count as
often as they occur; a null id is kept and comes last among the first
centroids.  With fewer kept vectors than k there are as many centroids as
vectors; an empty table gives an empty result.  Other columns are ignored,
whatever their names.  A distance beyond a long is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, materialize

K, DIMS, ROUNDS, SCALE, SEED = 8, 64, 10, 1024, 3
MAX_CENTROIDS = 4096
# Squared distances under this fit 64 bits with room for the fourfold of them.
SAFE = 1 << 60


def kept(df: DataFrame, dims: int = DIMS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors with exactly ``dims`` finite components."""
    def odd(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = col(vec_col)
    return (df.where(v.isNotNull() & (F.size(v) == dims) & ~F.exists(v, odd))
            .select(col(id_col).alias("vec_id"), v.cast("array<double>").alias("v")))


def integers(v: pa.Array | pa.ChunkedArray, dims: int, scale: int) -> np.ndarray:
    """Rows of integer components; Python integers where 64 bits may not do."""
    x = np.floor(v.flatten().to_numpy(zero_copy_only=False) * float(scale)).reshape(-1, dims)
    if x.size and (2 * np.abs(x).max()) ** 2 * dims >= SAFE:
        return np.array([[int(c) for c in row] for row in x], dtype=object).reshape(-1, dims)
    return x.astype(np.int64)


@dataclass(frozen=True)
class Centroids:
    """Centroids with, for each, the others by distance and those squared distances."""
    points: np.ndarray
    order: np.ndarray
    gaps: np.ndarray

    @classmethod
    def of(cls, rows: list[list[int]]) -> Centroids:
        wide = bool(rows) and (2 * max(abs(c) for r in rows for c in r)) ** 2 * len(rows[0]) >= SAFE
        points = np.array(rows, dtype=object if wide else np.int64)
        k = len(points)
        order, gaps = np.zeros((k, k - 1), dtype=np.int64), np.zeros((k, k - 1), dtype=points.dtype)
        for c in range(k):
            d = squared(points, points[c])
            near = [j for j in sorted(range(k), key=lambda j: (d[j], j)) if j != c]
            order[c], gaps[c] = near, d[near]
        return cls(points, order, gaps)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def nearest(x: np.ndarray, cents: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of every row's nearest centroid (ties: smaller number)."""
    points = cents.points
    if x.dtype != points.dtype:
        x, points = x.astype(object), points.astype(object)
    n, k = len(x), len(points)
    best, at = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    dist = squared(x, points[0])
    seen = np.zeros((n, k), dtype=bool)
    seen[:, 0] = True
    live = np.arange(n) if k > 1 else np.arange(0)
    while len(live):
        gap, other = cents.gaps[best[live], at[live]], cents.order[best[live], at[live]]
        near = (gap <= 4 * dist[live]).astype(bool)
        live, other = live[near], other[near]
        at[live] += 1
        fresh = ~seen[live, other]
        look, other = live[fresh], other[fresh]
        seen[look, other] = True
        d = squared(x[look], points[other])
        closer = ((d < dist[look]) | ((d == dist[look]) & (other < best[look]))).astype(bool)
        jump = look[closer]
        best[jump], dist[jump], at[jump] = other[closer], d[closer], 0
        live = live[at[live] < k - 1]
    return best, dist


def _sums(cents: Centroids, dims: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(cents.points)
        totals, counts = [[0] * dims for _ in range(k)], [0] * k
        for batch in batches:
            x = integers(batch.column("v"), dims, scale)
            cluster, _ = nearest(x, cents)
            for c in np.unique(cluster).tolist():
                mine = x[cluster == c]
                counts[c] += len(mine)
                totals[c] = [a + int(b) for a, b in zip(totals[c], mine.sum(axis=0), strict=True)]
        used = [c for c in range(k) if counts[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([counts[c] for c in used], pa.int64()),
             pa.array([[str(t) for t in totals[c]] for c in used], pa.list_(pa.string()))], ["cluster", "n", "total"])
    return run


def _assign(cents: Centroids, dims: int, scale: int, id_type: pa.DataType
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, dist = nearest(integers(batch.column("v"), dims, scale), cents)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").cast(id_type), pa.array(cluster, pa.int32()),
                 pa.array([int(d) for d in dist], pa.int64())], ["vec_id", "cluster", "distance"])
    return run


def first_centroids(vectors: DataFrame, k: int, seed: int, scale: int) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``seed:id`` (then smallest vector), as integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return [[int(c) for c in integers(pa.array([r["v"]]), len(r["v"]), scale)[0]] for r in rows]


def moved(vectors: DataFrame, points: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """The centroids after one round: floor of each component's mean; an empty one stays."""
    partial = vectors.select("v").mapInArrow(_sums(Centroids.of(points), dims, scale),
                                             "cluster int, n long, total array<string>")
    rows = (partial.select("cluster", "n", F.posexplode("total").alias("i", "s"))
            .groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
            .collect())  # k x dims rows
    out = [list(p) for p in points]
    for r in rows:
        out[r["cluster"]][r["i"]] = int(r["s"]) // r["n"]
    return out


def cluster(df: DataFrame, k: int = K, dims: int = DIMS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    ``rounds`` times every vector goes to its nearest centroid and each centroid
    to the mean of its vectors; rounds that would change nothing are left out.
    """
    if not 0 < k <= MAX_CENTROIDS:
        raise ValueError(f"k must be 1 to {MAX_CENTROIDS}")
    vectors = materialize(kept(df, dims, id_col, vec_col), "vectors")
    points = first_centroids(vectors, k, seed, scale)
    id_type = vectors.schema["vec_id"].dataType
    schema = f"vec_id {id_type.simpleString()}, cluster int, distance long"
    if not points:
        return vectors.sparkSession.createDataFrame(
            [], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        after = moved(vectors, points, dims, scale)
        if after == points:
            break
        points = after
    from pyspark.sql.pandas.types import to_arrow_type
    found = materialize(vectors.mapInArrow(_assign(Centroids.of(points), dims, scale, to_arrow_type(id_type)), schema),
                        "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    about = found.sparkSession.createDataFrame(
        [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
         for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia",
                                                           "inertia", "centroid_sha256")
