"""Sharding by vector bin packing: bytes, words and rows are balanced jointly (law ``bytes``).

Texts that are equal form a group, and groups are what is placed:

* A group that takes at least ``1 / (PARCELS * FINE)`` of a shard in some measure is placed by itself, whole as long as it
  takes at most ``WHOLE`` of a shard.
* A larger one is dealt, by the hash of the doc_id, into pieces of ``1 / PARCELS`` of a shard that are placed one by one.
* All smaller ones share parcels by the hash of their text, ``PARCELS`` for each shard.

Hence the number of things to place is bounded by the shard count, whatever the input: ``PARCELS`` for each shard, ``3 * PARCELS * FINE`` groups and
as many pieces less ``FINE`` times. Only their sums reach the driver. There each, largest first, goes to the shard whose residual capacity has the
highest dot product with its vector (each measure as a share of a shard, and weighted). The plan goes back as a broadcast of that bounded table.

A slot is the rank of a row within its parcel plus the rows of the shard's earlier parcels; a group that is placed whole has several
parcels if need be, so no window is larger than about ``1 / PARCELS`` of a shard.

A null text has no bytes (size 16, CRC 0) and is equal to an empty one. A null doc_id is placed like any
other. Repeated rows get slots of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from order_analytics.operators import staging

#: Parcels of hashed small groups for each shard; larger groups are cut to about this share of a shard.
PARCELS = 256
#: Groups of at least this part of such a share are placed by themselves.
FINE = 4
#: Share of a shard up to which a group stays in one.
WHOLE = 1 / 32
#: Bytes that a row needs beside its text.
ROW_BYTES = 16

#: The measures, and what each counts in the dot product: bytes come first, as the law asks.
MEASURES = {"size": 64.0, "n_words": 1.0, "n_rows": 1.0}


def best_directions(vectors: np.ndarray, shards: int, weights: np.ndarray) -> np.ndarray:
    """The shard of each vector: largest first, to the highest weighted dot product with the residual capacity."""
    total = vectors.sum(axis=0, dtype=np.float64)
    shares = vectors / np.where(total > 0, total / shards, 1.0)
    residual = np.ones((shards, vectors.shape[1]))
    chosen = np.zeros(len(vectors), np.int64)
    for place in np.lexsort((np.arange(len(vectors)), -(shares @ weights))):
        shard = int(np.argmax(residual @ (shares[place] * weights)))
        residual[shard] -= shares[place]
        chosen[place] = shard
    return chosen


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, the text's digest and CRC, and the three measures of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        "doc_id",
        F.sha1(text.cast("binary")).alias("digest"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_words"),
        F.lit(1).cast("bigint").alias("n_rows"),
    )


def shard(documents: DataFrame, shards: int, parcels: int = PARCELS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    spark = documents.sparkSession
    # a number of its own for each row, fixed by the write: rows that are equal in all columns are dealt out like any others
    rows, _ = staging.write_table(measured(documents).withColumn("tag", F.monotonically_increasing_id()), "measured")
    sums = [F.sum(name).alias(name) for name in MEASURES]
    totals = rows.agg(*sums).first()
    part = {name: (totals[name] or 0) / (shards * parcels) for name in MEASURES}

    # at most shards * parcels * FINE groups can reach the least share in any one measure
    share = F.greatest(*(F.col(name) / F.lit(max(part[name], 1.0)) for name in MEASURES))
    groups = rows.groupBy("digest").agg(*sums).withColumn("share", share).filter(F.col("share") * FINE >= 1)
    pieces = F.least(F.ceil("share"), "n_rows").alias("pieces")
    found = groups.select("digest", pieces, (F.col("share") <= parcels * WHOLE).alias("whole")).orderBy("digest").toArrow()
    count = found["pieces"].to_numpy()
    first = shards * parcels + np.cumsum(count) - count
    listed = spark.createDataFrame(found.drop_columns("whole").append_column("first", pa.array(first, pa.int64())))
    # parcels of a group that stays in one shard are placed as the first of them
    unit = np.arange(shards * parcels + count.sum())
    unit[shards * parcels :] = np.where(np.repeat(found["whole"].to_numpy(), count), np.repeat(first, count), unit[shards * parcels :])

    hashed = F.pmod(F.xxhash64("digest"), F.lit(shards * parcels))
    dealt = F.col("first") + F.pmod(F.xxhash64("doc_id", "tag"), F.col("pieces"))
    placed = rows.join(F.broadcast(listed), "digest", "left").withColumn("parcel", F.coalesce(dealt, hashed))

    filled = placed.groupBy("parcel").agg(*sums).orderBy("parcel").toArrow()
    parcel, n_rows = filled["parcel"].to_numpy(), filled["n_rows"].to_numpy()
    _, unit = np.unique(unit[parcel], return_inverse=True)
    vectors = np.zeros((unit.max(initial=-1) + 1, len(MEASURES)))
    np.add.at(vectors, unit, np.stack([filled[name].to_numpy() for name in MEASURES], axis=1))
    target = best_directions(vectors, shards, np.array(list(MEASURES.values())))[unit]
    # rows of a shard's parcels before each
    by_shard = np.argsort(target, kind="stable")
    before = np.zeros(len(target), np.int64)
    before[by_shard] = np.cumsum(n_rows[by_shard]) - n_rows[by_shard]
    before -= np.concatenate([[0], np.cumsum(np.bincount(target, n_rows, shards).astype(np.int64))])[target]
    plan = pa.table({"parcel": parcel, "shard": pa.array(target, pa.int32()), "before": before})
    plan = spark.createDataFrame(plan)

    within = Window.partitionBy("parcel").orderBy("doc_id", "digest", "tag")
    ranked = placed.withColumn("rank", F.row_number().over(within) - 1)
    return ranked.join(F.broadcast(plan), "parcel").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("rank")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
