"""Clustering by exact nearest centroids with the equal-average equal-variance search.

For vectors x and c of d components with sums S and deviations V = sqrt(d * sum of squares - S^2),

    d * |x - c|^2 >= (S_x - S_c)^2 + (V_x - V_c)^2.

Centroids are sorted by their sum, that is by their mean. A vector starts at its own mean and looks outward, at the nearer side first:
once the difference of sums alone exceeds the best distance, all that lie further out are excluded; a centroid whose difference of sums and
deviations together exceed it is passed over; the others get an exact distance in integers. Sums are compared as integers, deviations
with room for rounding, so the search always returns the nearest centroid, of equally near ones that of the smaller number.

Components are turned into integers once, ``floor(scale * x)``. Assigning, distances, component sums and the new centroids
``floor(sum / count)`` are exact. A round is one pass over the stored integers: each task sends one row per centroid and place.

Kept are vectors with exactly ``dims`` components, none null or non-finite; others, null vectors included, are left out. Repeated rows count
as often as they stand; vectors without an id are clustered but never start a centroid; where repeated ids tie for a start the smaller vector is
first. With fewer vectors than ``k`` there are as many centroids. Integers beyond 2^30 / dims would not leave exact 64-bit
distances and raise. Only ``vec_id`` and ``embedding`` are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import store

#: Vectors a task searches for at a time.
SLICE = 8192


class MeanOrder:
    """Centroids in the order of their means, with what the two inequalities need."""

    def __init__(self, centroids: np.ndarray):
        self.dims = centroids.shape[1]
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.points, self.sums = centroids[self.number], sums[self.number]
        self.spread = self._spread(self.points, self.sums)

    def _spread(self, points: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return np.sqrt((self.dims * (points * points).sum(axis=1) - sums * sums).astype(np.float64))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each point, and how many distances were worked out."""
        count, dims = len(self.sums), self.dims
        sums = points.sum(axis=1)
        spread = self._spread(points, sums)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        best = np.full(len(points), np.iinfo(np.int64).max // dims, dtype=np.int64)
        number = np.full(len(points), count, dtype=np.int64)
        far = np.iinfo(np.int64).max
        active, worked = np.arange(len(points)), 0
        while len(active):
            down, up = low[active], high[active]
            below = np.where(down >= 0, sums[active] - self.sums[np.maximum(down, 0)], far)
            above = np.where(up < count, self.sums[np.minimum(up, count - 1)] - sums[active], far)
            gap = np.minimum(below, above)
            # The nearer side exceeds the best distance, so does everything further out on both sides.
            near = gap < far
            near[near] = gap[near] ** 2 <= dims * best[active[near]]
            active, gap, take_low = active[near], gap[near], (below <= above)[near]
            if not len(active):
                break
            at = np.where(take_low, low[active], high[active])
            low[active] -= take_low
            high[active] += ~take_low
            off = np.abs(spread[active] - self.spread[at])
            off = np.maximum(off - 1e-9 * (spread[active] + self.spread[at]) - 1e-6, 0.0)
            bound = gap.astype(np.float64) ** 2 + off * off
            open_ = bound <= dims * best[active].astype(np.float64) * (1 + 1e-12)
            rows, at = active[open_], at[open_]
            apart = points[rows] - self.points[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            worked += len(rows)
            named = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (named < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], named[better]
        return number, best, worked


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, dims)


def _sum_up(centroids: np.ndarray):
    schema = pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Component sums, and at the last place the number of vectors, of each centroid in this task."""
        count, dims = centroids.shape
        order, totals = MeanOrder(centroids), np.zeros((count, dims + 1), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                points = _matrix(batch.column("point").slice(start, SLICE), dims)
                number = order.nearest(points)[0]
                np.add.at(totals[:, :dims], number, points)
                totals[:, dims] += np.bincount(number, minlength=count)
        used = np.flatnonzero(totals[:, dims])
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(used, dims + 1).astype(np.int32)), pa.array(np.tile(np.arange(dims + 1, dtype=np.int32), len(used))),
                    pa.array(totals[used].ravel()),
                ],
                schema=schema,
            )

    return run


def _assign(centroids: np.ndarray):
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                number, distance, _ = order.nearest(_matrix(part.column("point"), centroids.shape[1]))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], schema=schema)

    return run


def whole_points(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and the integers of the vectors that are kept."""
    sound = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).filter(
        (F.size("e") == dims) & F.forall("e", lambda x: F.abs(x) < float("inf"))
    )
    most = 2**30 // dims
    fits = F.forall("e", lambda x: F.abs(x * F.lit(float(scale))) < F.lit(float(most)))
    whole = F.transform("e", lambda x: F.floor(x * F.lit(float(scale))).cast("int"))
    return sound.select("vec_id", F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a scaled component reaches {most}"))).alias("point"))


def centroids_of(points: DataFrame, k: int, rounds: int, seed: str) -> np.ndarray:
    """The centroids after ``rounds`` rounds, one row each; ``points`` is a stored table."""
    turn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = points.filter("vec_id is not null").select(turn.alias("turn"), "point").orderBy("turn", "point").limit(k).collect()
    centroids = np.array([r["point"] for r in first], dtype=np.int64)
    for _ in range(rounds if len(first) else 0):
        sums = points.select("point").mapInArrow(_sum_up(centroids), "cluster int, place int, value long")
        sums = sums.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(28,0)")).alias("value"))
        dims = centroids.shape[1]
        # k * (dims + 1) numbers.
        found = {(r["cluster"], r["place"]): int(r["value"]) for r in sums.collect()}
        for cluster in {c for c, _ in found}:
            centroids[cluster] = [found[cluster, i] // found[cluster, dims] for i in range(dims)]
    return centroids


def clusters(vectors: DataFrame, dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: str = "1") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector kept of ``vectors`` (vec_id, embedding)."""
    points = store(whole_points(vectors, dims, scale), "eenns_points")
    centroids = centroids_of(points, k, rounds, seed)
    if not len(centroids):
        return points.select(
            "vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("cluster_inertia"),
            F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"),
        ).limit(0)
    found = store(points.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long"), "eenns_found")
    # k rows.
    apart = {r["cluster"]: r["distance"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("distance")).collect()}
    facts = [
        (i, apart[i], sum(apart.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
        if i in apart
    ]
    told = found.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
