"""Clustering of integer vectors by a tournament of bisecting planes (operator 13).

The plane between centroids i < j holds the points equally far from both:
``x . n = t`` with normal ``n = 2 (c_j - c_i)`` and threshold
``t = |c_j|**2 - |c_i|**2``, all integers. ``x . n > t`` says that j is nearer;
otherwise i wins, at zero as the smaller number. Normals and thresholds of all
pairs are made once per round, on the driver; then centroid 0 meets 1, the
winner 2, and so on: k - 1 signs per vector leave its nearest centroid. The
distance is computed once, to the winner, exactly.

The vectors are written once, as integers, under ``spark.checkpoint.dir``. A
round reads them, and each task sends k sums at most; the driver holds the k
centroids and their sums (k * dims numbers) and nothing else of the data. The
planes take k * k * dims * 8 bytes in every worker (0.8 MB for 40 centroids of
64 components), so this is made for k up to a few hundred.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.arrow import arrow_map, column, out
from tideline.llm.scratch import Scratch

SLICE = 4096  # vectors in play at once
LONG = (1 << 63) - 1
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def component_limit(dims: int) -> int:
    """Components below this in magnitude keep every product and distance within 64 bits."""
    return int((2 ** 60 / dims) ** 0.5)


def integer_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the usable vectors, v their components as floor(scale * x)."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
            .where(F.size("x") == dims))
    limit = component_limit(dims)

    def run(it):
        for b in it:
            flat = column(b, "x").flatten()
            x = np.floor(flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims) * scale)
            ok = np.flatnonzero((np.abs(x) < limit).all(axis=1))  # false for nan and infinite ones too
            v = pa.array(x[ok].astype(np.int32).ravel())
            ends = pa.array(np.arange(len(ok) + 1, dtype=np.int32) * dims)
            yield out(["vec_id", "v"], column(b, "vec_id").take(pa.array(ok)), pa.ListArray.from_arrays(ends, v))

    return rows.transform(arrow_map, run, "vec_id long, v array<int>")


class Bisectors:
    """The planes between all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        c = self.centroids = np.asarray(centroids, np.int64)
        self.normals = 2 * (c[None, :, :] - c[:, None, :])  # [i, j]: from i to j
        square = (c * c).sum(axis=1)
        self.thresholds = square[None, :] - square[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of the centroid nearest to each row, the smaller one of equally near ones."""
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", x, self.normals[best, j])
            best[side > self.thresholds[best, j]] = j
        return best

    def distance(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        return ((x - self.centroids[best]) ** 2).sum(axis=1)


def slices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, components) of up to SLICE vectors at a time."""
    for b in batches:
        ids, v = column(b, "vec_id"), column(b, "v")
        for lo in range(0, len(ids), SLICE):
            part = v.slice(lo, SLICE)
            yield ids.slice(lo, SLICE), part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the least hashes, in hash order (rows of one id by their components)."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id is not null").select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of each one's vectors, empty ones as they were."""
    k, dims = centroids.shape
    planes = Bisectors(centroids)

    def run(it):
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, x in slices(it, dims):
            best = planes.nearest(x)
            order = np.argsort(best, kind="stable")
            some, first = np.unique(best[order], return_index=True)
            total[some] += np.add.reduceat(x[order], first)
            n += np.bincount(best, minlength=k)
        some = np.flatnonzero(n)
        yield out(["cluster", "n", "total"], pa.array(some, pa.int32()), pa.array(n[some]),
                  pa.array(total[some].tolist(), pa.list_(pa.int64())))

    sums = (vectors.transform(arrow_map, run, "cluster int, n long, total array<long>")
            .select("cluster", "n", F.posexplode("total").alias("at", "part"))
            .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("part").alias("total")))
    after = centroids.copy()
    for r in sums.collect():  # k * dims rows at most
        after[r.cluster, r["at"]] = r.total // r.n
    return after


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    planes, dims = Bisectors(centroids), centroids.shape[1]

    def run(it):
        for ids, x in slices(it, dims):
            best = planes.nearest(x)
            yield out(["vec_id", "cluster", "distance"], ids, pa.array(best, pa.int32()), pa.array(planes.distance(x, best)))

    return vectors.transform(arrow_map, run, "vec_id long, cluster int, distance long")


def _summary(spark: SparkSession, found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, cluster_inertia, inertia, centroid_sha256) of the clusters that have vectors."""
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(  # k rows at most
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    every = sum(sums.values())
    rows = [(c, s if s <= LONG else None, every if every <= LONG else None,
             sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    return spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per usable vector.

    Usable are vectors of exactly ``dims`` components, none null, nan or
    infinite; a component x counts as floor(scale * x). Those with a component
    of 2**27 or more in magnitude (at 64 dims), whose squared distances
    would not fit a long, are left out like infinite ones. Centroids start as
    the ``k`` vectors with the least sha256 of ``<seed>:<vec_id>`` (all, if
    there are fewer), move ``rounds`` times to the floor of their vectors'
    mean, and every vector is assigned once more. Repeated rows all count; a
    vector without an id starts no centroid but is clustered (if no vector
    has an id there is no centroid and no row). A sum of distances beyond a
    long is null. An empty table gives no row; other columns are ignored.
    """
    spark, keep = vectors.sparkSession, Scratch(vectors.sparkSession, "centroids").keep
    kept = keep(integer_vectors(vectors, dims, scale, id_col, vec_col))
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    found = keep(assigned(kept, centroids))
    # a row per centroid: k is a parameter, so this side is small
    return (found.join(F.broadcast(_summary(spark, found, centroids)), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
