"""Conflict-constrained best-fit packing of documents into bins (training sequences) of equal capacity.

Length is counted in words (or given by ``length``). A document longer than the capacity is cut into
pieces of the capacity and a rest; a document without words is one piece of length 0. Pieces conflict, so
must not share a bin, if they are of one duplicate cluster (``cluster`` column; by default equal texts; pieces of a document are
always of one cluster), or if the bin already holds ``per_source`` pieces of their source.

Each bin carries two bitmaps: the clusters it holds and, for each source, ``per_source`` places. Open
bins are ordered by residual capacity. A piece looks for the successor of its length in that order and goes on from
bin to bin until the first, hence tightest, compatible one; bins of one residual are tried from the
oldest. If there is none, it opens a bin. Pieces are taken by falling length, then cluster, then id.

Equal pieces of one cluster come one after the other, and none fits a bin that an earlier one passed or
took, so their search goes on from where the last one ended: a cluster of m copies costs m + bins steps.

Packing runs in lots that hold about ``LOT_LENGTH`` words, dealt by document; each lot is packed in one task and the
number of lots follows the input. Copies of a cluster spread over lots like any other rows. Pieces that more than ``MOST_ALIKE``
rows have alike (same doc_id or none, same cluster) are dealt by a number of their own. A bin lies in one lot.

Null text: no words. A null source is a source of its own, a null cluster conflicts with nothing, a null
doc_id is an id. Repeated rows are copies of each other. An empty table gives no bins. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from order_analytics.operators import staging

CAPACITY = 2_048
PER_SOURCE = 8
LOT_LENGTH = 1_000_000
#: Pieces of one id, number and cluster that are dealt to one lot.
MOST_ALIKE = 1_000

PACKED = "piece int, start bigint, length int, bin bigint, place int, offset int"


class Bins:
    """Open bins of one lot in order of residual capacity, with their bitmaps."""

    def __init__(self, capacity: int, per_source: int):
        self._capacity, self._per_source = capacity, per_source
        self._places = (1 << per_source) - 1
        self._by_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._filled = 0  # bit r: some bin has residual r
        self.clusters: list[int] = []
        self.sources: list[int] = []
        self.used: list[int] = []
        self.count: list[int] = []

    def _compatible(self, found: int, source: int, cluster: int) -> bool:
        if cluster >= 0 and self.clusters[found] >> cluster & 1:
            return False
        return self.sources[found] >> source * self._per_source & self._places != self._places

    def _open(self) -> int:
        for bitmap in (self.clusters, self.sources, self.used, self.count):
            bitmap.append(0)
        return len(self.used) - 1

    def successor(self, length: int, source: int, cluster: int, after: tuple[int, int]) -> int | None:
        """The first compatible bin from (residual, bin) ``after`` on with room for the length."""
        residual, least = max(after, (length, -1))
        while self._filled >> residual:
            ahead = self._filled >> residual
            step = (ahead & -ahead).bit_length() - 1
            if step:
                residual, least = residual + step, -1
            line = self._by_residual[residual]
            for place in range(bisect_left(line, least), len(line)):
                if self._compatible(line[place], source, cluster):
                    return line[place]
            residual, least = residual + 1, -1
        return None

    def put(self, length: int, source: int, cluster: int, after: tuple[int, int] = (0, -1)) -> tuple[int, int, int, int]:
        """Place a piece; its bin, its place and offset there, and the residual the bin had."""
        found = self.successor(length, source, cluster, after)
        if found is None:
            found, residual = self._open(), self._capacity
        else:
            residual = self._capacity - self.used[found]
            line = self._by_residual[residual]
            del line[bisect_left(line, found)]
            if not line:
                self._filled &= ~(1 << residual)
        offset, place = self.used[found], self.count[found]
        self.used[found] += length
        self.count[found] += 1
        if cluster >= 0:
            self.clusters[found] |= 1 << cluster
        held = self.sources[found] >> source * self._per_source & self._places
        self.sources[found] |= (held + 1) << source * self._per_source
        insort(self._by_residual[residual - length], found)
        self._filled |= 1 << (residual - length)
        return found, place, offset, residual


def pack_lot(lengths: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int, per_source: int) -> np.ndarray:
    """Rows of (bin, place, offset) for pieces in the order of packing; cluster -1 conflicts with nothing."""
    bins, out = Bins(capacity, per_source), np.zeros((len(lengths), 3), np.int64)
    last, after = None, (0, -1)
    for row, piece in enumerate(zip(lengths.tolist(), sources.tolist(), clusters.tolist(), strict=True)):
        if piece != last or piece[2] < 0:
            after = (0, -1)
        found, place, offset, residual = bins.put(*piece, after=after)
        last, after = piece, (residual, found)
        out[row] = found, place, offset
    return out


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def pieces_of(documents: DataFrame, capacity: int, length: Column, cluster: Column) -> DataFrame:
    """(doc_id, source, cluster, piece, start, length): the pieces of every row."""
    counted = documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        cluster.alias("cluster"),
        length.cast("bigint").alias("words"),
    )
    last = F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0))
    cut = counted.withColumn("piece", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    start = F.col("piece").cast("bigint") * capacity
    return cut.withColumn("start", start).withColumn("length", F.least(F.col("words") - F.col("start"), F.lit(capacity)).cast("int")).drop("words")


def pack(
    documents: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    length: Column | None = None,
    cluster: Column | None = None,
    lot_length: int = LOT_LENGTH,
    most_alike: int = MOST_ALIKE,
) -> DataFrame:
    """doc_id, source, cluster and, of each piece, its number, start and length, bin, place and offset."""
    text = F.col("text").cast("string")
    length = word_count(text) if length is None else length
    cluster = F.xxhash64(F.coalesce(text, F.lit(""))) if cluster is None else cluster.cast("bigint")
    dealt = F.xxhash64("doc_id", "piece", "cluster")
    # the tag is fixed by the write, so a repeated task deals alike
    tagged = pieces_of(documents, capacity, length, cluster).withColumns({"dealt": dealt, "tag": F.monotonically_increasing_id()})
    pieces, _ = staging.write_table(tagged, "pieces")
    # every piece weighs a little, so that very many empty ones make lots as well
    total = pieces.agg(F.sum(F.col("length") + F.lit(capacity // 64 + 1))).first()[0] or 0
    lots = max(1, -(-total // lot_length))
    alike = pieces.groupBy("dealt").agg(F.count("*").alias("alike")).filter(F.col("alike") > most_alike)
    salted = F.when(F.col("alike").isNotNull(), F.xxhash64("dealt", "tag")).otherwise(F.col("dealt"))
    pieces = pieces.join(alike, "dealt", "left").withColumn("lot", F.pmod(salted, F.lit(lots))).drop("dealt", "tag", "alike")

    def pack_group(key: tuple, rows: pa.Table) -> pa.Table:
        order = [("length", "descending"), *((name, "ascending") for name in ("cluster", "doc_id", "piece", "source"))]
        rows = rows.sort_by(order).drop_columns("lot")
        sources = rows.column("source").combine_chunks().dictionary_encode("encode").indices.to_numpy()
        clusters = rows.column("cluster").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        packed = pack_lot(rows.column("length").to_numpy(), sources, clusters, capacity, per_source)
        # bins of all lots are numbered without a clash
        rows = rows.append_column("bin", pa.array(packed[:, 0] * lots + key[0].as_py()))
        rows = rows.append_column("place", pa.array(packed[:, 1].astype(np.int32)))
        return rows.append_column("offset", pa.array(packed[:, 2].astype(np.int32)))

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, source string, cluster bigint, {PACKED}"
    return pieces.groupBy("lot").applyInArrow(pack_group, schema)
