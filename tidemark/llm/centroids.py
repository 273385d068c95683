"""Exact k-means on integer vectors, with centroids filtered by N-simplex projection.

A few vectors are pivots. Their distances to each other span a simplex; the distances of any vector to
them place it as the apex over that base: one coordinate for each pivot, the last being its altitude.
For two apexes the Euclidean distance is no more than the vectors' own, and with one altitude turned
over no less. Distances to pivots are taken once and the apexes stored with the vectors. A round drops
each centroid whose lower bound is above the least upper bound, and compares the rest exactly, in
64-bit integers. Centroids are few and small: they alone travel between driver and tasks, and a task
gives back one sum for each centroid.

Defined cases: vectors that are null, of another length, or hold null or non-finite components take no
part; rows that repeat a vec_id count one by one, those of equal hash start as centroids in the order of
their components; a null vec_id has no hash and comes last there; fewer vectors than k make that many
centroids; ties go to the smaller centroid; an empty centroid stays; components so large that a squared
distance may not fit 64 bits raise an error; extra columns and texts are not looked at; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Vectors of a task that are compared with the centroids at a time.
BLOCK = 4096
#: A pivot must stand this far above the simplex of those before it, as a part of its distance to the first.
ALTITUDE = 0.01
#: Bounds are widened by this part of the squared lengths that they are made of, for rounding.
SLACK = 1e-6


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """key and v, the components as floor(scale * x); only of vectors of `dims` finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    most = isqrt((1 << 62) // dims) // 2
    small = F.forall("v", lambda x: F.abs(x) <= most)
    checked = F.when(small, F.col("v")).otherwise(F.raise_error(F.lit("a component is too large for distances of 64 bits")))
    kept = df.where((F.size(vector) == dims) & finite)
    return kept.select(F.col(key).alias("vec_id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v")).withColumn("v", checked)


def first_vectors(vectors: DataFrame, n: int, seed: int = 1) -> np.ndarray:
    """The n vectors with the smallest hashes of their ids, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(order.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(n).collect()
    return np.array([r["v"] for r in rows], np.int64)


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact, of every row of x to every row of y (few)."""
    out = np.empty((len(x), len(y)), np.int64)
    for k, c in enumerate(y):
        d = x - c
        out[:, k] = np.einsum("ij,ij->i", d, d)
    return out


class Simplex:
    """The base that pivots span, and the apexes of other vectors over it."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots[:1]
        self._base: list[np.ndarray] = []  # of each pivot but the first, its apex over those before it
        self.add(pivots[1:])

    def add(self, pivots: np.ndarray) -> None:
        """Pivots (nearly) in the span of those before them are left out; equal ones are, in particular."""
        for p in pivots:
            apex = self.project(p[None])[0]
            if apex[-1] > ALTITUDE * np.sqrt((apex**2).sum()):
                self._base.append(apex)
                self.pivots = np.vstack([self.pivots, p])

    def project(self, x: np.ndarray, apexes: np.ndarray | None = None) -> np.ndarray:
        """Apexes of vectors, the altitude last; where those over the first pivots are known, they grow.

        Over one more pivot the altitude parts into a coordinate along that pivot's and a new altitude.
        """
        if apexes is None:
            apexes = np.sqrt(squared_distances(x, self.pivots[:1]).astype(np.float64))
        for n in range(apexes.shape[1], len(self.pivots)):
            base, far = self._base[n - 1], squared_distances(x, self.pivots[n : n + 1])[:, 0]
            foot, height = apexes[:, :-1], apexes[:, -1]
            along = (height**2 + base[-1] ** 2 + ((foot - base[:-1]) ** 2).sum(axis=1) - far) / (2 * base[-1])
            apexes = np.column_stack([foot, along, np.sqrt(np.maximum(height**2 - along**2, 0))])
        return apexes


def candidates(apexes: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """(vector, centroid): whether the centroid may be the nearest, by the bounds."""
    a, c = (apexes**2).sum(axis=1), (of_centroids**2).sum(axis=1)
    flat = a[:, None] + c - 2 * apexes[:, :-1] @ of_centroids[:, :-1].T
    turned = 2 * apexes[:, -1:] * of_centroids[:, -1]
    slack = SLACK * (1 + a + c.max())
    return flat - turned <= ((flat + turned).min(axis=1) + slack)[:, None]


def nearest(v: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, of_centroids: np.ndarray, all_distances: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's nearest centroid, its squared distance, and how many distances were taken.

    Without all_distances a vector with a single candidate is not measured (its distance is -1).
    """
    may = candidates(apexes, of_centroids)
    far = np.where(may, -1, np.iinfo(np.int64).max)
    row, k = np.nonzero(may if all_distances else may & (may.sum(axis=1) > 1)[:, None])
    d = v[row] - centroids[k]
    far[row, k] = np.einsum("ij,ij->i", d, d)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(v)), best], len(row)


def _blocks(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            b = batch.slice(at, BLOCK)
            flat = [b.column(n).flatten().to_numpy(zero_copy_only=False) for n in names]
            yield b, [x.reshape(b.num_rows, -1) for x in flat]


def with_apexes(points: DataFrame, simplex: Simplex) -> DataFrame:
    """vec_id, v and the apex over all pivots; from the apex over the first ones where there is one."""
    key, names = points.schema["vec_id"].dataType.simpleString(), [c for c in points.columns if c in ("v", "apex")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, arrays in _blocks(batches, *names):
            apex = simplex.project(*arrays)
            ends = pa.array(np.arange(len(apex) + 1, dtype=np.int32) * apex.shape[1])
            apex = pa.ListArray.from_arrays(ends, pa.array(apex.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), apex], ["vec_id", "v", "apex"])

    return points.select("vec_id", *names).mapInArrow(run, f"vec_id {key}, v array<bigint>, apex array<double>")


def moved(points: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round: floors of the means of the vectors nearest to each."""
    of_centroids = simplex.project(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, (v, apex) in _blocks(batches, "v", "apex"):
            at, _, _ = nearest(v, apex, centroids, of_centroids, all_distances=False)
            n += np.bincount(at, minlength=len(n))
            for k in np.unique(at):
                total[k] += v[at == k].sum(axis=0)
        some = np.flatnonzero(n)
        ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * total.shape[1])
        sums = pa.ListArray.from_arrays(ends, pa.array(total[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), sums], ["cluster", "n", "total"])

    parts = points.select("v", "apex").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    sums = F.array(*(F.sum(F.col("total")[i]) for i in range(centroids.shape[1])))
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), sums.alias("total")).collect():  # a row for each centroid at most
        out[r["cluster"]] = [s // r["n"] for s in r["total"]]
    return out


def assigned(points: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    of_centroids = simplex.project(centroids)
    key = points.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, (v, apex) in _blocks(batches, "v", "apex"):
            at, far, _ = nearest(v, apex, centroids, of_centroids)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    return points.mapInArrow(run, f"vec_id {key}, cluster int, distance bigint")


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, pivot_rounds: int = 2, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector.

    The centroids at the start and after each of the first rounds become pivots, pivot_rounds times:
    later centroids stay near their span, where the bounds are close.
    """
    spark, vectors = df.sparkSession, integer_vectors(df, key, vector, dims, scale)
    centroids = first_vectors(vectors, k, seed)
    facts_of = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(centroids):
        none = {c: F.lit(None).cast(t) for c, t in (("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"))}
        return vectors.select("vec_id").where(F.lit(False)).withColumns(none)
    simplex, points = Simplex(centroids), vectors
    for r in range(max(rounds, 1)):
        if r < max(pivot_rounds, 1):
            simplex.add(centroids)
            points = written(with_apexes(points, simplex))
        if r < rounds:
            centroids = moved(points, centroids, simplex)
    done = written(assigned(points, centroids, simplex))
    sums = {r["cluster"]: r["d"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # at most k
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(c, d, sum(sums.values()), sha[c]) for c, d in sums.items()], facts_of)
    return done.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
