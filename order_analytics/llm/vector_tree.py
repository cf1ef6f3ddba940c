"""Nearest neighbours by inner product through a hierarchical k-means tree.

The tree is fitted on the driver to a bounded sample (``SAMPLE`` vectors, those with the smallest hash of
their id) and splits nodes of more than ``LEAF_POINTS`` of them, so the number of leaves has a bound
whatever the input, and the visits of a query do too; every vector is indexed by walking down to the nearest
centroid at each level. A query walks best-bin-first: a priority queue holds open nodes by the inner
product of query and centroid, the best is opened next, and leaves are visited in the order they come up.
The number of leaves to visit is calibrated: for ``CALIBRATION`` queries the true neighbours are found against all rows, and
visits are widened until the wanted share of them lies in visited leaves.

A leaf is searched in blocks of ``BLOCK`` vectors, and its queries in lots of ``BLOCK``, so that a leaf with any share
of the rows or queries is spread over tasks. Scores are sums in double precision over each pair by itself, so that
equal vectors have equal scores; ties go to the smaller id.

Vectors that are null, zero, or hold null or non-finite components, take no part; nor do rows without id, nor those whose length is not the
most common one. Rows that repeat an id are candidates each; as a query an id counts once, with its
smallest vector. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from order_analytics.operators import staging

SAMPLE = 8_192
BRANCHES = 8
LEAF_POINTS = 128
CALIBRATION = 64
RECALL = 0.97
BLOCK = 2_048
#: Queries whose visits are listed at a time.
VISITORS = 16
ROUNDS = 8

FOUND = "query_id bigint, vec_id bigint, score double, leaf int"


def kmeans(points: np.ndarray, count: int, seed: int) -> np.ndarray:
    """The centroid number of each point after a few rounds from random points."""
    chosen = np.random.default_rng(seed).choice(len(points), count, replace=False)
    centres = points[chosen]
    for _ in range(ROUNDS):
        nearest = (points @ centres.T * 2 - (centres**2).sum(axis=1)).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=count)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return nearest


class Tree:
    """Node 0 is the root; ``children`` are empty at leaves, which are numbered by ``leaf``."""

    def __init__(self, sample: np.ndarray, leaf_points: int):
        self.centres, self.children, self.leaf = [sample.mean(axis=0)], [[]], [-1]
        self.leaves = 0
        open_nodes = [(0, sample)]
        while open_nodes:
            node, points = open_nodes.pop()
            parts = kmeans(points, BRANCHES, node) if len(points) > max(leaf_points, BRANCHES) else np.zeros(len(points), int)
            members = [points[parts == part] for part in np.unique(parts)]
            if len(members) == 1:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for part in members:
                self.children[node].append(len(self.centres))
                self.centres.append(part.mean(axis=0))
                self.children.append([])
                self.leaf.append(-1)
                open_nodes.append((len(self.centres) - 1, part))
        self.centres = np.array(self.centres)

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        leaves = np.zeros(len(vectors), np.int32)
        open_nodes = [(0, np.arange(len(vectors)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if self.leaf[node] >= 0:
                leaves[rows] = self.leaf[node]
            elif len(rows):
                centres = self.centres[self.children[node]]
                nearest = (vectors[rows] @ centres.T * 2 - (centres**2).sum(axis=1)).argmax(axis=1)
                open_nodes += [(child, rows[nearest == place]) for place, child in enumerate(self.children[node])]
        return leaves

    def visits(self, query: np.ndarray, count: int) -> list[int]:
        """The first ``count`` leaves, best bin first."""
        heap, found = [(0.0, 0)], []
        while heap and len(found) < count:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                found.append(self.leaf[node])
                continue
            children = self.children[node]
            for child, nearness in zip(children, (self.centres[children] @ query).tolist(), strict=True):
                heapq.heappush(heap, (-nearness, child))
        return found


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), values.alias("vector"))
    fit = rows.filter("vec_id is not null and vector is not null").filter(finite)
    fit = fit.filter(F.exists("vector", lambda x: x != 0))
    common = fit.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fit.filter(F.size("vector") == (common["n"] if common else 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _best(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of a block for each query, without the query's own."""
    block = block.sort_values("vec_id", kind="stable")
    ids, vectors = block["vec_id"].to_numpy(), _matrix(block["vector"])
    parts = []
    for first in range(0, len(queries), 256):
        some = queries.iloc[first : first + 256]
        own = some["query_id"].to_numpy()
        scores = np.einsum("qd,vd->qv", _matrix(some["vector"]), vectors)
        scores[own[:, None] == ids[None, :]] = -np.inf
        order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        found = np.take_along_axis(scores, order, axis=1)
        made = pd.DataFrame({"query_id": np.repeat(own, order.shape[1]), "vec_id": ids[order.ravel()], "score": found.ravel()})
        parts.append(made[made["score"] > -np.inf])
    out = pd.concat(parts)
    out["leaf"] = np.int32(block["leaf"].iloc[0])
    return out


def _search(visits: DataFrame, indexed: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score, leaf): the k best of each visited leaf's block for each query.

    ``visits`` has (query_id, vector, leaf). Numbers of rows and of visits by leaf are bounded by the
    number of leaves, so they go through the driver.
    """
    spark = visits.sparkSession
    rows = indexed.groupBy("leaf").agg(F.count("*").alias("rows"))
    asked = visits.groupBy("leaf").agg(F.count("*").alias("asked"))
    blocks = [
        (row["leaf"], -(-row["rows"] // BLOCK), -(-row["asked"] // BLOCK)) for row in rows.join(asked, "leaf").collect()
    ]
    shape = F.broadcast(spark.createDataFrame(blocks, "leaf int, blocks int, lots int"))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    held = indexed.join(shape, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    held = held.select("leaf", "block", every("lots").alias("lot"), "vec_id", "vector")
    wanted = visits.join(shape, "leaf").withColumn("lot", F.pmod(F.xxhash64("query_id"), "lots").cast("int"))
    wanted = wanted.select("leaf", every("blocks").alias("block"), "lot", "query_id", "vector")

    def search_block(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if block.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "leaf": []})
        return _best(queries, block, k)

    keys = ["leaf", "block", "lot"]
    return held.groupBy(keys).cogroup(wanted.groupBy(keys)).applyInPandas(search_block, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _calibrate(tree: Tree, queries: pd.DataFrame, truth: list, recall: float) -> int:
    """The least number of visits at which the wanted share of the true neighbours is in visited leaves."""
    reached = np.zeros(tree.leaves + 1, np.int64)
    rank = {
        query: {leaf: place for place, leaf in enumerate(tree.visits(vector, tree.leaves), 1)}
        for query, vector in zip(queries["query_id"], _matrix(queries["vector"]), strict=True)
    }
    for row in truth:
        reached[rank[row["query_id"]][row["leaf"]]] += 1
    share = np.cumsum(reached) / max(1, reached.sum())
    return max(1, int(np.searchsorted(share, recall)))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    vector: str = "embedding",
    recall: float = RECALL,
    sample: int = SAMPLE,
    leaf_points: int = LEAF_POINTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of ``queries``."""
    spark = vectors.sparkSession
    rows, _ = staging.write_table(usable(vectors, vector), "vectors")
    wanted = usable(queries, vector).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    wanted, _ = staging.write_table(wanted, "query-vectors")
    fitted = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    if fitted.empty:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    points = _matrix(fitted["vector"])
    tree = spark.sparkContext.broadcast(Tree(points, leaf_points))

    width = points.shape[1]

    def index_batches(batches):
        for batch in batches:
            vectors = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, width)
            yield batch.append_column("leaf", pa.array(tree.value.assign(vectors)))

    indexed, _ = staging.write_table(
        rows.mapInArrow(index_batches, "vec_id bigint, vector array<double>, leaf int"), "indexed"
    )

    def visit(count: int):
        def visit_batches(batches):
            for batch in batches:
                for first in range(0, batch.num_rows, VISITORS):
                    some = batch.slice(first, VISITORS)
                    queries = some.column("vector").flatten().to_numpy().reshape(some.num_rows, -1)
                    leaves = [tree.value.visits(query, count) for query in queries]
                    row = pa.array(np.repeat(np.arange(some.num_rows), [len(found) for found in leaves]))
                    columns = [some.column(name).take(row) for name in ("query_id", "vector")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(sum(leaves, []), pa.int32())], ["query_id", "vector", "leaf"])

        return lambda some: some.mapInArrow(visit_batches, "query_id bigint, vector array<double>, leaf int")

    tried = wanted.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).toPandas()
    if tried.empty:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    everywhere = visit(tree.value.leaves)(spark.createDataFrame(tried, "query_id bigint, vector array<double>"))
    truth = _top(_search(everywhere, indexed, k), k).select("query_id", "leaf").collect()
    count = _calibrate(tree.value, tried, truth, recall)
    visited, _ = staging.write_table(visit(count)(wanted), "visits")
    best = _top(_search(visited, indexed, k), k)
    return best.select("query_id", "rank", "vec_id", "score")
