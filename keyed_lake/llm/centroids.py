"""k-means in whole numbers, with a filter that looks at a few rotated coordinates first.

Components become integers, and so do centroids, so every sum, distance and tie is exact and a task that runs again
finds the same. The vectors are turned once into the axes of their principal components. The leading coordinates are
stored beside the vector, with the length of what the other coordinates hold (the residual norm). For a vector x and a
centroid c,

    |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2  <=  |x - c|^2

so a centroid whose bound exceeds the exact distance to another one is out. The rest are verified in integers. Rounding
of the rotated values is covered by a margin, so the filter decides how much is computed, never what comes out.

Defined results: vectors with another number of components, with a null, NaN or infinite one, or with one beyond
`LARGEST` (its squared distances would not fit a long) are left out. Of equal distances the smaller centroid wins. Equal
hashes (rows with the same key) are ordered by their components, null keys come last. With fewer vectors than `k` there are as
many centroids as vectors; an empty table gives an empty result. Rows that repeat count each. Only the key and the
vector column are read. A centroid table has `k` rows, which is all that is ever broadcast or collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, map_arrow, plus, written

DIMENSIONS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
LEADING = 16  # rotated coordinates that are stored
LARGEST = 1 << 17  # of a component before it is scaled: 64 squares of twice 2**27 stay below 2**63
_MARGIN = 1e-9  # of the squared sum of both lengths; rounding is below a thousandth of it


@dataclass(frozen=True)
class Rotation:
    """Orthonormal axes in columns, by falling variance."""

    axes: np.ndarray
    leading: int

    def turned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leading coordinates and the residual norm of every vector."""
        values = vectors.astype(np.float64) @ self.axes
        return values[:, : self.leading], np.sqrt((values[:, self.leading :] ** 2).sum(1))


def quantised(df: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, q: the vectors that are kept, in integers floor(scale * x)."""
    whole = (F.size(col(vector)) == dimensions) & F.forall(col(vector), lambda x: F.abs(x.cast("double")) <= LARGEST)
    q = F.transform(col(vector), lambda x: F.floor(x.cast("double") * float(scale)).cast("int"))
    return df.where(whole).select(col(key).alias("vec_id"), q.alias("q"))


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def principal_axes(vectors: DataFrame, dimensions: int, leading: int) -> Rotation:
    """The axes of all vectors. Every task sends one number per pair of components, whatever its rows."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((dimensions + 1, dimensions + 1))
        for batch in batches:
            if batch.num_rows:
                x = np.hstack([_matrix(batch, "q", dimensions).astype(np.float64), np.ones((batch.num_rows, 1))])
                sums += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())], ["at", "total"])

    rows = map_arrow(vectors.select("q"), moments, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    sums = np.zeros((dimensions + 1) ** 2)
    for row in rows.collect():  # (dimensions + 1)^2 rows
        sums[row["at"]] = row["total"]
    sums = sums.reshape(dimensions + 1, -1)
    n = max(sums[-1, -1], 1.0)
    mean = sums[-1, :-1] / n
    _, axes = np.linalg.eigh(sums[:-1, :-1] / n - np.outer(mean, mean))  # by rising variance
    return Rotation(np.ascontiguousarray(axes[:, ::-1]), min(leading, dimensions))


def rotated(vectors: DataFrame, rotation: Rotation) -> DataFrame:
    """Adds `lead` and `rest` to vec_id and q."""
    dimensions = len(rotation.axes)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotation.turned(_matrix(batch, "q", dimensions))
            leads = pa.ListArray.from_arrays(pa.array(np.arange(len(lead) + 1) * rotation.leading, pa.int32()), lead.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, leads, pa.array(rest)], ["vec_id", "q", "lead", "rest"])

    schema = plus(vectors.schema, ("lead", "array<double>"), ("rest", "double"))
    return map_arrow(vectors, turn, schema)


@dataclass(frozen=True)
class Centroids:
    """Integer centroids with their rotated form."""

    points: np.ndarray
    rotation: Rotation

    def nearest(self, q: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of every vector, its squared distance, and how many distances were computed."""
        leads, rests = self.rotation.turned(self.points)
        lengths = np.sqrt((lead**2).sum(1) + rest**2)[:, None] + np.sqrt((leads**2).sum(1) + rests**2)
        bound = ((lead[:, None, :] - leads) ** 2).sum(2) + (rest[:, None] - rests) ** 2 - _MARGIN * lengths**2
        first = bound.argmin(1)
        label, best, computed = first.copy(), self._distance(q, self.points[first]), len(q)
        for j, point in enumerate(self.points):
            at = np.flatnonzero((bound[:, j] <= best) & (first != j))
            exact = self._distance(q[at], point)
            closer = (exact < best[at]) | ((exact == best[at]) & (j < label[at]))
            label[at[closer]], best[at[closer]] = j, exact[closer]
            computed += len(at)
        return label, best, computed

    @staticmethod
    def _distance(q: np.ndarray, points: np.ndarray) -> np.ndarray:
        return ((q.astype(np.int64) - points) ** 2).sum(1)

    def assign(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors of a stored batch, their centroids and squared distances."""
        q = _matrix(batch, "q", self.points.shape[1])
        lead = _matrix(batch, "lead", self.rotation.leading)
        return q, *self.nearest(q, lead, batch.column("rest").to_numpy(zero_copy_only=False))[:2]


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The `k` vectors with the smallest hash of seed and key; every task offers its `k` smallest."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), col("vec_id").cast("string")), 256)
    rows = vectors.select(hashed.alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(k).collect()
    return np.array([r["q"] for r in rows], np.int64)


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """One round: every vector to its nearest centroid, every centroid to the floor of the mean of its vectors."""
    k, dimensions = centroids.points.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dimensions + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                q, label, _ = centroids.assign(batch)
                for j in np.unique(label):
                    sums[j, :-1] += q[label == j].sum(0, dtype=np.int64)
                    sums[j, -1] += (label == j).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())], ["at", "total"])

    rows = map_arrow(vectors.select("q", "lead", "rest"), totals, "at int, total long")
    points = [list(map(int, p)) for p in centroids.points]
    found = {r["at"]: int(r["total"]) for r in rows.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    for j in range(k):
        at = j * (dimensions + 1)
        if n := found.get(at + dimensions, 0):
            points[j] = [found[at + i] // n for i in range(dimensions)]
    return Centroids(np.array(points, np.int64), centroids.rotation)


def assigned(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """vec_id, cluster, distance (squared) of every vector."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, cluster, distance = centroids.assign(batch)
                columns = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    schema = T.StructType([vectors.schema["vec_id"]])
    return map_arrow(vectors, label, plus(schema, ("cluster", "int"), ("distance", "long")))


def cluster(
    df: DataFrame, key: str, vector: str, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
    scale: int = SCALE, seed: int = SEED, leading: int = LEADING,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every kept vector, and the final centroids.

    The vectors are stored once with their rotated form; every round reads that table and brings `k` sums back.
    """
    kept = quantised(df, key, vector, dimensions, scale)
    rotation = principal_axes(kept, dimensions, leading)
    vectors = written(rotated(kept, rotation), "rotated-vectors")
    state = Centroids(first_centroids(vectors, k, seed).reshape(-1, dimensions), rotation)
    if not len(state.points):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), state.points
    for _ in range(rounds):
        state = moved(vectors, state)
    return written(assigned(vectors, state), "clusters"), state.points


def cluster_report(df: DataFrame, key: str, vector: str, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    rows, points = cluster(df, key, vector, **options)
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    found = {r["cluster"]: int(r["total"]) for r in sums.collect()}  # a row per centroid
    facts = [
        (j, found.get(j, 0), sum(found.values()), hashlib.sha256(",".join(str(int(v)) for v in p).encode()).hexdigest())
        for j, p in enumerate(points)
    ]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return rows.join(F.broadcast(df.sparkSession.createDataFrame(facts, names)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
