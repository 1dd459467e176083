"""Exact k-means over whole-number vectors with Shallot's bounds.

Every vector remembers its nearest and second-nearest centroid, an upper bound of its distance to the first and a lower
bound of that to all others. Where the bounds cannot rule out a change, a search begins at the closer of the two and goes
through that centroid's neighbours in order of distance, in a ball that shrinks as nearer centroids are found. Bounds are
real numbers, held on the safe side; what remains is compared in integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylift.llm.shared import checkpointed
from staylift.llm.vectors import finite_rows

#: Components up to this keep squared distances of 64 of them within a long.
MOST = 1 << 27
#: Distances are rounded this much (relatively) to the safe side.
SLACK = 1e-12
STATE = "nearest INT, second INT, upper DOUBLE, lower DOUBLE"


class Centroids(NamedTuple):
    """Centroids, their mutual distances, and each one's others by distance."""

    points: np.ndarray
    apart: np.ndarray
    order: np.ndarray

    @staticmethod
    def of(points: np.ndarray) -> Centroids:
        apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2).astype(float))
        np.fill_diagonal(apart, -1.0)
        order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        return Centroids(points, apart, order)

    def half_gap(self) -> np.ndarray:
        """Half of each centroid's distance to the nearest other one."""
        if len(self.points) == 1:
            return np.array([np.inf])
        return self.apart[np.arange(len(self.points)), self.order[:, 0]] / 2 * (1 - SLACK)

    def moved_from(self, before: Centroids) -> np.ndarray:
        return np.sqrt(((self.points - before.points) ** 2).sum(axis=1).astype(float)) * (1 + SLACK)


class Bounded(NamedTuple):
    """What is remembered of each vector."""

    nearest: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    off = x - points
    return np.einsum("ij,ij->i", off, off)


def searched(x: np.ndarray, first: np.ndarray, second: np.ndarray, centroids: Centroids) -> Bounded:
    """The nearest two centroids of each vector, found around the closer of ``first`` and ``second``; ties: smaller number."""
    points = centroids.points
    if len(points) == 1:
        return Bounded(first, second, np.sqrt(squared(x, points[first]).astype(float)), np.full(len(x), np.inf))
    near, far = squared(x, points[first]), squared(x, points[second])
    swap = (far < near) | (far == near) & (second < first)
    start, best, other = np.where(swap, second, first), np.where(swap, second, first), np.where(swap, first, second)
    near, far = np.where(swap, far, near), np.where(swap, near, far)
    known = other.copy()
    reach = np.sqrt(near.astype(float))
    active = np.arange(len(x))
    for turn in range(len(points) - 1):
        candidate = centroids.order[start[active], turn]
        # A centroid outside the ball is farther than the second-nearest so far, and so are all after it.
        ball = (reach[active] + np.sqrt(far[active].astype(float))) * (1 + SLACK)
        inside = centroids.apart[start[active], candidate] <= ball
        active, candidate = active[inside], candidate[inside]
        if not len(active):
            break
        new = candidate != known[active]
        rows, candidate = active[new], candidate[new]
        d = squared(x[rows], points[candidate])
        wins = (d < near[rows]) | (d == near[rows]) & (candidate < best[rows])
        place = ~wins & (d < far[rows])
        w, p = rows[wins], rows[place]
        far[w], other[w] = near[w], best[w]
        near[w], best[w] = d[wins], candidate[wins]
        far[p], other[p] = d[place], candidate[place]
    return Bounded(best, other, np.sqrt(near.astype(float)) * (1 + SLACK), np.sqrt(far.astype(float)) * (1 - SLACK))


def reassigned(x: np.ndarray, old: Bounded, centroids: Centroids, moved: np.ndarray) -> Bounded:
    """Nearest centroids after these have ``moved``; only what the bounds leave open is searched."""
    nearest, second, upper, lower = (c.copy() for c in old)
    if len(moved) > 1:
        by_move = np.argsort(moved)
        most = np.where(nearest == by_move[-1], moved[by_move[-2]], moved[by_move[-1]])
        lower = (lower - most) - SLACK * (np.abs(lower) + most)
    upper = (upper + moved[nearest]) * (1 + SLACK)
    settled = np.maximum(lower, centroids.half_gap()[nearest])
    left = np.flatnonzero(upper >= settled)
    upper[left] = np.sqrt(squared(x[left], centroids.points[nearest[left]]).astype(float)) * (1 + SLACK)
    left = left[upper[left] >= settled[left]]
    if len(left):
        found = searched(x[left], nearest[left], second[left], centroids)
        for column, values in zip((nearest, second, upper, lower), found, strict=True):
            column[left] = values
    return Bounded(nearest, second, upper, lower)


# --- over all vectors ---------------------------------------------------------------------------------


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, dims), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and ``x``, the vector in whole units of 1/``scale`` (32-bit, little-endian), of every usable vector.

    Usable are vectors of ``dims`` components, none null, infinite or not a number. A component beyond 2**27 units is
    an error, since a squared distance might not fit a long.
    """

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, x = finite_rows(batch["embedding"], dims)
            if np.abs(x).max(initial=0) * scale > MOST:
                raise ValueError(f"a component is beyond {MOST} units")
            units = np.floor(scale * x).astype("<i4")
            keys = batch["vec_id"].take(pa.array(places))
            yield pa.RecordBatch.from_arrays([keys, pa.array([row.tobytes() for row in units], pa.binary())], ["vec_id", "x"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(packed, f"vec_id {kind}, x BINARY")


def starting_points(points: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The k vectors of smallest digest of ``<seed>:<vec_id>``; null ids come last, equal ones by content."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = points.select("x", drawn.alias("drawn")).orderBy(F.col("drawn").asc_nulls_last(), "x").limit(k)
    return _matrix(pa.array([bytes(r.x) for r in first.collect()], pa.binary()), dims)


def _with_state(rows: DataFrame, step: Callable[[pa.RecordBatch, np.ndarray], Bounded], dims: int) -> DataFrame:
    """Rows with what ``step`` remembers of them; it is given a batch and its vectors."""

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = step(batch, _matrix(batch["x"], dims))
            columns = [pa.array(state.nearest, pa.int32()), pa.array(state.second, pa.int32()), pa.array(state.upper), pa.array(state.lower)]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["x"], *columns], ["vec_id", "x", *Bounded._fields])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return checkpointed(rows.mapInArrow(judged, f"vec_id {kind}, x BINARY, {STATE}"))


def cluster_sums(state: DataFrame, k: int, dims: int) -> list[tuple[int, int, list[int]]]:
    """Cluster, count and component sums: a row per cluster and task, then one per cluster; at most ``k`` are collected."""

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            nearest = batch["nearest"].to_numpy(zero_copy_only=False)
            counts += np.bincount(nearest, minlength=k)
            np.add.at(sums, nearest, _matrix(batch["x"], dims))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    parts = state.select("nearest", "x").mapInArrow(summed, "cluster INT, n LONG, sums ARRAY<LONG>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dims)]).alias("sums"))
    return [(r.cluster, r.n, list(r.sums)) for r in totals.collect()]


def state_of(batch: pa.RecordBatch) -> Bounded:
    return Bounded(*[batch[name].to_numpy(zero_copy_only=False) for name in Bounded._fields])


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """Every usable vector of ``vectors`` (vec_id, embedding) with its cluster: vec_id, cluster, distance (squared),
    cluster_inertia, inertia, centroid_sha256.

    Components are floor(``scale`` * x). ``k`` vectors drawn by digest (all, if there are fewer) begin as centroids; each
    round assigns every vector to the nearest (ties: smaller number) and moves every centroid that has vectors to the
    floor of their mean; a last assignment follows. centroid_sha256 is the digest of the centroid's components as decimal
    integers between commas. See ``whole_vectors`` for which vectors count. Rows that repeat are vectors of their own, null
    ids are allowed, other columns are not read, and a table without usable vectors gives no rows.

    Centroids, at most ``k`` rows of ``dims`` numbers, are all that passes through the driver or is sent to tasks. The
    vectors lie in the shared folder and are rewritten with their bounds once a round; nothing of them is shuffled.
    """
    points = checkpointed(whole_vectors(vectors, dims, scale))
    start = starting_points(points, k, seed, dims)
    spark = vectors.sparkSession
    kind = points.schema["vec_id"].dataType.simpleString()
    if not len(start):
        return spark.createDataFrame([], f"vec_id {kind}, cluster INT, distance LONG, cluster_inertia LONG, inertia LONG, centroid_sha256 STRING")
    k, centroids = len(start), Centroids.of(start)

    def begun(_: pa.RecordBatch, x: np.ndarray) -> Bounded:
        zero = np.zeros(len(x), np.int64)
        return searched(x, zero, zero + min(1, k - 1), centroids)

    state = _with_state(points, begun, dims)
    for _ in range(rounds):
        moved_to = centroids.points.copy()
        for cluster, n, sums in cluster_sums(state, k, dims):
            moved_to[cluster] = [s // n for s in sums]
        before, centroids = centroids, Centroids.of(moved_to)

        def again(batch: pa.RecordBatch, x: np.ndarray, to=centroids, moved=centroids.moved_from(before)) -> Bounded:
            return reassigned(x, state_of(batch), to, moved)

        state = _with_state(state, again, dims)

    final = centroids.points

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = batch["nearest"].to_numpy(zero_copy_only=False)
            distance = squared(_matrix(batch["x"], dims), final[nearest])
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["nearest"], pa.array(distance)], ["vec_id", "cluster", "distance"])

    found = checkpointed(state.mapInArrow(measured, f"vec_id {kind}, cluster INT, distance LONG"))
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    # A row per cluster: no larger than k, so that it may be sent to every task.
    told = [(c, inertia[c], sum(inertia.values()), sha256(",".join(map(str, final[c].tolist())).encode()).hexdigest()) for c in inertia]
    clusters = spark.createDataFrame(told, "cluster INT, cluster_inertia LONG, inertia LONG, centroid_sha256 STRING")
    return found.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
