"""Clustering on whole numbers, exact at every step, by Shallot search.

A vector's component x is floor(``SCALE`` * x). Centroids start as the vectors of the smallest salted hash of their id. A round
assigns every vector to its nearest centroid (squared Euclidean distance, ties to the smaller number) and moves each centroid that
has vectors to the floor of their mean; the others stay. After the last round vectors are assigned once more.

Each vector carries its centroid, the second-nearest one, and two bounds: at most how far the first is, at least how far any
other. Centroids that move widen them. A vector whose upper bound stays below the lower one, or below half the
way from its centroid to the next, keeps its centroid without a look at any other. All others measure the two they remember, start at the closer one, and
go through that centroid's neighbours, sorted by distance, while these can lie no farther than the ball whose radius is the way
to the start and on to the second-best so far; each better one shrinks the ball. Bounds are floating-point numbers
with some slack, so they only rule out; what they leave is compared by integer squared distances.

Rounds are written tables, and a round reads the last one, so a lost executor repeats one part of one round. The driver holds
the centroids and their sums: ``clusters`` times (components + 1) numbers. Sums change by the vectors that moved, added up
within tasks first, so no cluster is ever one task's.

Vectors take part if they have exactly ``dimensions`` components, none null or non-finite. Those without an id do too, and come
last among the candidates for a start; of rows with one id the smaller vector comes first. Rows may repeat; each is returned. With
fewer vectors than clusters, each is a start. Equal starts are allowed: the smaller number takes the vectors and the other stays
empty. Components are held within +-2**27 (64 of them; less for more), so that a squared distance fits 64 bits. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from order_analytics.operators import staging

SCALE = 256
#: Relative slack of the bounds; rounding errors of a few rounds are below a millionth of it.
SLACK = 1e-9
FAR = np.int64(np.iinfo(np.int64).max)

STATE = "cluster int, second int, upper double, lower double, distance bigint, previous int"


def largest_component(dimensions: int) -> int:
    """So that the squared distance of two vectors stays below 2**62."""
    return 1 << ((62 - (dimensions - 1).bit_length()) // 2 - 1)


def whole_vectors(vectors: DataFrame, vector: str, dimensions: int) -> DataFrame:
    """(vec_id, vector) of the rows that take part, as integers."""
    most = float(largest_component(dimensions))
    values = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("vector")).filter(F.size("vector") == dimensions)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x * SCALE, F.lit(most)), F.lit(-most))).cast("int")

    return values.filter(finite).withColumn("vector", F.transform("vector", whole))


class Centroids(NamedTuple):
    """Centroids with, for each, all others by distance, itself first."""

    points: np.ndarray
    spacing: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, points: list[list[int]]) -> Centroids:
        held = np.array(points, np.int64)
        spacing = np.sqrt(np.stack([squared(held, point) for point in held]).astype(np.float64))
        apart = spacing.copy()
        np.fill_diagonal(apart, -1.0)  # equal centroids must not come before the centroid itself
        return cls(held, spacing, np.argsort(apart, axis=1, kind="stable"))

    def half_way(self) -> np.ndarray:
        """Half the distance from each centroid to the next."""
        if len(self.points) == 1:
            return np.full(1, np.inf)
        return self.spacing[np.arange(len(self.points)), self.order[:, 1]] / 2


def squared(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Integer squared distances, row by row."""
    apart = some - others
    return np.einsum("nd,nd->n", apart, apart)


def search(vectors: np.ndarray, first: np.ndarray, second: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, ...]:
    """(nearest, second-nearest, and the squared distance to each) of every vector, from the two it remembers."""
    best, other = first.copy(), second.copy()
    best_distance = squared(vectors, centroids.points[first])
    if len(centroids.points) == 1:
        return best, other, best_distance, np.full(len(vectors), FAR)
    other_distance = squared(vectors, centroids.points[second])
    closer = (other_distance < best_distance) | ((other_distance == best_distance) & (other < best))
    best, other = np.where(closer, other, best), np.where(closer, best, other)
    best_distance, other_distance = np.where(closer, other_distance, best_distance), np.where(closer, best_distance, other_distance)

    start, known = best.copy(), other.copy()
    way = np.sqrt(best_distance.astype(np.float64))
    open_rows = np.arange(len(vectors))
    for place in range(1, len(centroids.points)):
        candidate = centroids.order[start[open_rows], place]
        radius = way[open_rows] + np.sqrt(other_distance[open_rows].astype(np.float64))
        inside = centroids.spacing[start[open_rows], candidate] <= radius * (1 + SLACK)
        open_rows, candidate = open_rows[inside], candidate[inside]  # neighbours are sorted: whoever is out stays out
        if not len(open_rows):
            break
        fresh = candidate != known[open_rows]
        rows, candidate = open_rows[fresh], candidate[fresh]
        distance = squared(vectors[rows], centroids.points[candidate])
        wins = (distance < best_distance[rows]) | ((distance == best_distance[rows]) & (candidate < best[rows]))
        won, lost = rows[wins], ~wins & (distance < other_distance[rows])
        other[won], other_distance[won] = best[won], best_distance[won]
        best[won], best_distance[won] = candidate[wins], distance[wins]
        other[rows[lost]], other_distance[rows[lost]] = candidate[lost], distance[lost]
    return best, other, best_distance, other_distance


def assign(vectors: np.ndarray, state: dict[str, np.ndarray], centroids: Centroids, drift: np.ndarray) -> tuple[dict[str, np.ndarray], int]:
    """The state of the vectors after the centroids moved by ``drift``, and how many had to be searched."""
    cluster, second = state["cluster"].copy(), state["second"].copy()
    widest = np.argmax(drift)
    rest = np.full(len(drift), drift[widest])
    rest[widest] = np.delete(drift, widest).max(initial=0.0)
    upper = (state["upper"] + drift[cluster]) * (1 + SLACK)
    lower = state["lower"] - rest[cluster]
    lower -= SLACK * (np.abs(lower) + rest[cluster])
    half = centroids.half_way()[cluster] * (1 - SLACK)

    unsure = np.flatnonzero(upper >= np.maximum(lower, half))
    way = np.sqrt(squared(vectors[unsure], centroids.points[cluster[unsure]]).astype(np.float64)) * (1 + SLACK)
    upper[unsure] = way
    unsure = unsure[way >= np.maximum(lower, half)[unsure]]
    best, other, near, far = search(vectors[unsure], cluster[unsure], second[unsure], centroids)
    cluster[unsure], second[unsure] = best, other
    upper[unsure] = np.sqrt(near.astype(np.float64)) * (1 + SLACK)
    lower[unsure] = np.sqrt(far.astype(np.float64)) * (1 - SLACK)
    return {"cluster": cluster, "second": second, "upper": upper, "lower": lower, "previous": state["cluster"]}, len(unsure)


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dimensions).astype(np.int64)


def _assigned(held: DataFrame, centroids: Centroids, drift: np.ndarray | None, measured: bool, dimensions: int) -> DataFrame:
    """One assignment of all vectors; without ``drift`` the first one, where nothing is known of any vector."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, n = _matrix(batch, dimensions), batch.num_rows
            if drift is None:
                known = {"cluster": np.zeros(n, np.int32), "second": np.full(n, min(1, len(centroids.points) - 1), np.int32)}
                known |= {"upper": np.full(n, np.inf), "lower": np.zeros(n)}
                moves = np.zeros(len(centroids.points))
            else:
                known, moves = {name: batch.column(name).to_numpy() for name in ("cluster", "second", "upper", "lower")}, drift
            state, _ = assign(vectors, known, centroids, moves)
            if drift is None:
                state["previous"] = np.full(n, -1, np.int32)
            state["distance"] = squared(vectors, centroids.points[state["cluster"]]) if measured else np.zeros(n, np.int64)
            columns = {name: pa.array(state[name], kind) for name, kind in STATE_TYPES.items()}
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), *columns.values()], ["vec_id", "vector", *columns])

    kind = held.schema["vec_id"].dataType.simpleString()
    return held.mapInArrow(of_batches, f"vec_id {kind}, vector array<int>, {STATE}")


STATE_TYPES = {"cluster": pa.int32(), "second": pa.int32(), "upper": pa.float64(), "lower": pa.float64(), "distance": pa.int64(), "previous": pa.int32()}


def _moved(assigned: DataFrame, clusters: int, dimensions: int) -> list:
    """What the vectors that changed their centroid change in the sums: (cluster, component, total); the last component counts vectors."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((clusters, dimensions + 1), np.int64)
        for batch in batches:
            vectors = np.column_stack([_matrix(batch, dimensions), np.ones(batch.num_rows, np.int64)])
            np.add.at(totals, batch.column("cluster").to_numpy(), vectors)
            left = batch.column("previous").to_numpy()
            np.subtract.at(totals, left[left >= 0], vectors[left >= 0])
        cluster, component = np.nonzero(totals)
        columns = [pa.array(cluster, pa.int32()), pa.array(component, pa.int32()), pa.array(totals[cluster, component])]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "component", "total"])

    moved = assigned.filter("cluster <> previous").select("vector", "cluster", "previous")
    parts = moved.mapInArrow(of_batches, "cluster int, component int, total bigint")
    return parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()


def cluster(
    vectors: DataFrame, clusters: int, rounds: int, seed: str, vector: str = "embedding", dimensions: int = 64
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every vector that takes part.

    ``seed`` precedes the id where starts are drawn. ``centroid`` is the final one's list of integers.
    """
    spark = vectors.sparkSession
    held, path = staging.write_table(whole_vectors(vectors, vector, dimensions), "whole-vectors")
    drawn = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    starts = held.orderBy(drawn.asc_nulls_last(), "vector").limit(clusters).collect()
    kind = held.schema["vec_id"].dataType.simpleString()
    if not starts:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    points = [list(row["vector"]) for row in starts]
    sums = [[0] * (dimensions + 1) for _ in points]
    drift = None
    for number in range(rounds + 1):
        centroids = Centroids.of(points)
        assigned, following = staging.write_table(_assigned(held, centroids, drift, number == rounds, dimensions), "assigned")
        staging.drop_table(spark, path)
        held, path = assigned, following
        if number == rounds:
            break
        for row in _moved(assigned, len(points), dimensions):
            sums[row["cluster"]][row["component"]] += int(row["total"])
        points = [[total // count for total in totals] if count else point for point, (*totals, count) in zip(points, sums, strict=True)]
        drift = np.sqrt(squared(np.array(points, np.int64), centroids.points).astype(np.float64))

    within = {row["cluster"]: row["n"] for row in held.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    rows = [(number, within[number], sum(within.values()), points[number]) for number in within]
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return held.select("vec_id", "cluster", "distance").join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def centroid_digest(centroid: str = "centroid") -> Column:
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)


