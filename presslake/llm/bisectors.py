"""Centroid clustering of vectors, where a tournament of bisectors finds the nearest centroid.

Components become integers, so every comparison is exact. The points nearer to centroid b than to centroid a lie on one
side of their bisector: with the normal 2(b - a) and the threshold |b|^2 - |a|^2, one linear sign test tells which of the
two loses, and the smaller number wins at zero. k - 1 tests leave one centroid; only its distance is computed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from presslake.sources.workspace import materialize

#: Integers stop at these bounds, so that a distance of 64 such components fits in a long. A component of a usual
#: embedding is far below (2^26 / 64 is a million).
LIMIT = 1 << 26
#: Vectors that are compared at once.
TOGETHER = 4096


def _clean(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Which rows hold exactly ``width`` components, none of them null, infinite or not a number."""
    lists = batch.column("vector")
    n = np.where(lists.is_valid().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(), -1)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes nan
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(np.maximum(n, 0))
    return (n == width) & (bad[ends] == bad[ends - np.maximum(n, 0)])


def quantized(batch: pa.RecordBatch, width: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The kept rows' numbers, and their components as integers: ``floor(scale * x)`` in doubles."""
    rows = np.flatnonzero(_clean(batch, width))
    values = batch.column("vector").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(np.clip(values * scale, -LIMIT, LIMIT)).astype(np.int64)
    return rows, whole.reshape(len(rows), width)


class Tournament:
    """Integer normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        squares = (centroids * centroids).sum(1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid, the smaller one at a tie, and the squared distance to it."""
        best = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", vectors, self.normals[best, rival])
            best[side > self.thresholds[best, rival]] = rival
        apart = vectors - self.centroids[best]
        return best, np.einsum("ij,ij->i", apart, apart)


def _parts(batches: Iterator[pa.RecordBatch], width: int, scale: float) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(first, TOGETHER)
            yield part, *quantized(part, width, scale)


def _sums(batches: Iterator[pa.RecordBatch], contest: Tournament, scale: float) -> Iterator[pa.RecordBatch]:
    k, width = contest.centroids.shape
    total = np.zeros((k, width + 1), np.int64)
    for _, _, vectors in _parts(batches, width, scale):
        best, _ = contest.nearest(vectors)
        np.add.at(total, best, np.column_stack([vectors, np.ones(len(best), np.int64)]))
    cluster, place = np.nonzero(total)
    yield pa.RecordBatch.from_pydict({"cluster": cluster, "place": place, "total": total[cluster, place]})


def _nearest(batches: Iterator[pa.RecordBatch], contest: Tournament, scale: float) -> Iterator[pa.RecordBatch]:
    for part, rows, vectors in _parts(batches, contest.centroids.shape[1], scale):
        best, distance = contest.nearest(vectors)
        ids = part.column("vec_id").take(pa.array(rows))
        yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])


def _vectors(table: DataFrame, column: str) -> DataFrame:
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))


def _is_kept(vector: Column, width: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == width) & finite, F.lit(False))


def first_centroids(table: DataFrame, k: int = 16, width: int = 64, scale: float = 64.0, seed: str = "1", column: str = "embedding") -> np.ndarray:
    """The ``k`` kept vectors whose ids have the smallest hashes, in that order; equal hashes are told apart by the vectors."""
    kept = _vectors(table, column).filter(_is_kept(F.col("vector"), width))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = kept.select(order.alias("order"), "vec_id", "vector").orderBy("order", "vector").limit(k).collect()
    held = pa.RecordBatch.from_pydict({"vector": pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))})
    return quantized(held, width, scale)[1]


def train(table: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: float = 64.0, seed: str = "1", column: str = "embedding") -> np.ndarray:
    """Centroids after ``rounds`` passes over all vectors, as integers.

    A pass assigns every kept vector to its nearest centroid and replaces each centroid that has vectors by the
    componentwise floor of their mean. A task sends one row per cluster and component, so the driver gets
    ``k * (width + 1)`` numbers a pass, however many vectors there are.
    """
    centroids = first_centroids(table, k, width, scale, seed, column)
    for _ in range(rounds if len(centroids) else 0):
        contest = Tournament(centroids)
        parts = _vectors(table, column).mapInArrow(lambda b, c=contest: _sums(b, c, scale), "cluster long, place long, total long")
        total = np.zeros((len(centroids), width + 1), np.int64)
        for row in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
            total[row["cluster"], row["place"]] = row["total"]
        count = total[:, width:]
        centroids = np.where(count > 0, total[:, :width] // np.maximum(count, 1), centroids)
    return centroids


def assign(table: DataFrame, centroids: np.ndarray, scale: float = 64.0, column: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance`` of every kept vector, ``distance`` squared; no rows where there is no centroid."""
    if not len(centroids):
        return _vectors(table, column).filter(F.lit(False)).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    contest = Tournament(centroids)
    return _vectors(table, column).mapInArrow(lambda b: _nearest(b, contest, scale), "vec_id long, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    table: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: float = 64.0, seed: str = "1", column: str = "embedding"
) -> DataFrame:
    """Per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors with another number of components, or with a null, infinite or undefined one, are left out. Repeated rows
    and rows that share a ``vec_id`` (or have none) stay separate, each counted. Components beyond ``LIMIT / scale``
    count as that bound. A sum of distances that does not fit in a long is null. With fewer than ``k`` kept vectors, all
    of them are centroids; with none, there are no rows. Other columns are ignored.
    """
    centroids = train(table, k, rounds, width, scale, seed, column)
    found = materialize(assign(table, centroids, scale, column), "clusters")
    # One row per cluster.
    names = found.sparkSession.createDataFrame([(n, digest(c)) for n, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    all_ = F.try_sum("cluster_inertia").over(Window.partitionBy(F.lit(1)))
    return found.join(sums.withColumn("inertia", all_).join(names, "cluster"), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
