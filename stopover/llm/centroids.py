"""Clusters around centroids by a tournament of bisectors, in whole numbers throughout.

Which of two centroids is nearer to a vector is the sign of a linear form: the
plane half-way between them has an integer normal and an integer threshold. These
are made once a round for all pairs of centroids; then k - 1 sign tests leave each
vector with its nearest centroid, zero favouring the smaller number. Only that
one's distance is worked out.

Sums of a round are made within tasks and added up by Spark, k vectors in all;
what is broadcast are k centroids. Vectors are read from their table each round
and never shuffled, so a hot group of equal vectors is as good as any other rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopover.llm.common import on_workers
from stopover.session import staged

# Sums travel in limbs of so many bits: a column of longs holds sums of any size exactly.
LIMB = 40
LARGEST = (1 << 63) - 1


def finite(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows that are whole vectors, and their components as doubles."""
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dims), False))
    values = column.take(pa.array(rows)).flatten().cast(pa.float64())
    vectors = values.to_numpy(zero_copy_only=False).reshape(-1, dims)
    good = np.isfinite(vectors).all(1)
    return rows[good], vectors[good]


def fits(dims: int, peak: int) -> bool:
    """Whether all sums below stay within 64 bits if no component exceeds ``peak``."""
    return 8 * dims * peak * peak < 1 << 62


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers or, where those may overflow, as Python's."""
    peak = float(np.abs(vectors).max(initial=0)) * scale
    if math.isfinite(peak) and fits(vectors.shape[1], math.ceil(peak)):
        return np.floor(vectors * scale).astype(np.int64)
    exact = [[int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in row]
             for row in vectors.tolist()]
    return np.array(exact, object).reshape(vectors.shape)


class Tournament:
    """Normals and thresholds of all pairs of ``centroids`` (lists of whole numbers)."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object)
        self.dims = self.centroids.shape[1]
        self.peak = max(abs(x) for row in centroids for x in row)
        norms = (self.centroids ** 2).sum(1)
        self.planes = {
            (i, j): (2 * (self.centroids[j] - self.centroids[i]), norms[j] - norms[i])
            for j in range(len(centroids)) for i in range(j)}
        self.narrow = fits(self.dims, self.peak)
        if self.narrow:
            self.centroids = self.centroids.astype(np.int64)
            self.planes = {pair: (normal.astype(np.int64), int(threshold))
                           for pair, (normal, threshold) in self.planes.items()}

    def winners(self, vectors: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each vector; of equally near ones the smallest."""
        if not self.narrow:
            vectors = vectors.astype(object)
        best = np.zeros(len(vectors), np.int64)
        for j in range(1, len(self.centroids)):
            before = best.copy()
            for i in range(j):
                rows = np.flatnonzero(before == i)
                if len(rows):
                    normal, threshold = self.planes[i, j]
                    ahead = np.asarray(vectors[rows] @ normal > threshold, bool)
                    best[rows[ahead]] = j
        return best

    def distances(self, vectors: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Squared distance to the centroid of the given number."""
        return ((vectors - self.centroids[best]) ** 2).sum(1)


def limbs(number: int) -> Iterator[tuple[int, int]]:
    """Number and value of the limbs of a whole number; all have its sign."""
    sign, rest, place = (-1 if number < 0 else 1), abs(number), 0
    while rest or not place:
        yield place, sign * (rest & ((1 << LIMB) - 1))
        rest >>= LIMB
        place += 1


def first_centroids(vectors: DataFrame, k: int, seed: int, dims: int, scale: int
                    ) -> list[list[int]]:
    """The k vectors with the smallest hash of seed and id; each task sends k at most."""

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[str, list[float]]] = []
        for batch in batches:
            rows, found = finite(batch.column(1), dims)
            ids = batch.column(0).take(pa.array(rows)).to_pylist()
            hashes = [hashlib.sha256(f"{seed}:{i or ''}".encode()).hexdigest() for i in ids]
            near = heapq.nsmallest(k, range(len(ids)), lambda r: (hashes[r], found[r].tolist()))
            kept = heapq.nsmallest(k, kept + [(hashes[r], found[r].tolist()) for r in near])
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in kept], pa.string()),
             pa.array([v for _, v in kept], pa.list_(pa.float64()))], ["hash", "vector"])

    chosen = vectors.mapInArrow(lowest, "hash string, vector array<double>").orderBy(
        "hash", "vector").limit(k).collect()
    found = np.array([row.vector for row in chosen], float).reshape(-1, dims)
    return [[int(x) for x in row] for row in integers(found, scale)]


def next_centroids(vectors: DataFrame, centroids: list[list[int]], dims: int, scale: int
                   ) -> list[list[int]]:
    """Floors of the means of all clusters; an empty one keeps its centroid."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        total: dict[tuple[int, int], int] = defaultdict(int)
        for batch in batches:
            numbers = integers(finite(batch.column(1), dims)[1], scale)
            best = tournament.winners(numbers)
            for cluster in np.unique(best).tolist():
                own = numbers[best == cluster]
                total[cluster, dims] += len(own)
                for place, value in enumerate(own.sum(0).tolist()):
                    total[cluster, place] += value
        rows = [(*key, *limb) for key, value in total.items() for limb in limbs(value)]
        columns = zip(*rows) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         ["cluster", "place", "limb", "value"])

    added = vectors.mapInArrow(
        sums, "cluster long, place long, limb long, value long",
    ).groupBy("cluster", "place", "limb").agg(F.sum("value").alias("value")).collect()
    total: dict[tuple[int, int], int] = defaultdict(int)
    for row in added:
        total[row.cluster, row.place] += row.value << (LIMB * row.limb)
    return [[total[c, place] // total[c, dims] for place in range(dims)]
            if total[c, dims] else centroid for c, centroid in enumerate(centroids)]


def clustered(vectors: DataFrame, id_column: str, vector_column: str, k: int, rounds: int,
              seed: int, dims: int, scale: int = 1024) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector.

    Only rows with exactly ``dims`` components, none null or not finite, are kept;
    other columns don't matter. Components become floor(scale * x). The first
    centroids are the k vectors with the smallest sha256 of ``seed:id`` (a null id
    is empty there; vectors with one id go by their components), fewer if there are
    fewer vectors. Repeated rows are vectors of their own. No vectors give no rows.
    A distance or sum of distances that no long holds is null.
    """
    spark = vectors.sparkSession
    on_workers(spark)
    keyed = vectors.select(F.col(id_column).cast("string").alias("key"),
                           F.col(vector_column).alias("vector"))
    centroids = first_centroids(keyed, k, seed, dims, scale)
    schema = f"vec_id {vectors.schema[id_column].dataType.simpleString()}, " \
             "cluster int, distance long"
    columns = ("cluster_inertia long, inertia long, centroid_sha256 string")
    if not centroids:
        return spark.createDataFrame([], f"{schema}, {columns}")
    for _ in range(rounds):
        centroids = next_centroids(keyed, centroids, dims, scale)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        for batch in batches:
            rows, found = finite(batch.column(1), dims)
            numbers = integers(found, scale)
            best = tournament.winners(numbers)
            distances = [d if d <= LARGEST else None
                         for d in tournament.distances(numbers, best).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(best.astype(np.int32)),
                 pa.array(distances, pa.int64())], ["vec_id", "cluster", "distance"])

    placed = staged(vectors.select(id_column, vector_column).mapInArrow(assigned, schema), "placed")
    sums = placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"),
        F.count_if(F.col("distance").isNull()).alias("over"))
    # One row per centroid, here and in the broadcast.
    found = {row.cluster: row for row in sums.collect()}

    def told(rows) -> int | None:
        total = sum(row.sum or 0 for row in rows)
        return int(total) if total <= LARGEST and not any(row.over for row in rows) else None

    told_rows = [
        (c, told([row]), told(found.values()),
         hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, row in found.items()]
    told_frame = spark.createDataFrame(told_rows, f"cluster int, {columns}")
    return placed.join(F.broadcast(told_frame), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
