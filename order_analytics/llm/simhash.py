"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

Fingerprint: words are cut at white space after A-Z became a-z; each run of ``shingle`` words, joined by
one space, is hashed by XXH64 (seed 42); a bit of the fingerprint is 1 if it is 1 in over half of the
hashes, repeats included. A text with fewer words gives one hash of all of them; one without words has
the fingerprint zero and links like any other. Two fingerprints link if at most ``DISTANCE`` bits differ.

Candidates: the 64 bits are three segments of 23, 23 and 18 bits. At most two bits differ, so one segment
is equal, and any other segment differs in two bits at most, so it shares a Golay key. Three kinds of key,
each an equal segment and the Golay keys of its neighbour, therefore meet all links. Equal fingerprints are one
row before keys are made. Rows that share a key are joined by sorting on it, compared bit by bit, and
linked to the smallest fingerprint they are connected to, so a key of m rows gives fewer than m links.

A key of more than ``CROWDED`` fingerprints would make too many comparisons. Its fingerprints are joined by the values
halfway: each gives itself and its 64 neighbours at one bit; two that share a value differ in at most two
bits, and all that differ in at most two share one. That is exact too and has 65 rows for each.

``representatives`` keeps one row of each class: that with the smallest doc_id, rows without one last, then by a hash of the whole row. Rows
equal in all columns are one row. A different text under a repeated or missing doc_id has its own class, so it stays.

Null text: no words. Rows with a null doc_id take part and get a component, but never name one; a
component without any id has a null name. Rows may repeat; each is returned. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from order_analytics.llm import golay
from order_analytics.llm.batches import signed, steps
from order_analytics.llm.components import connected_components
from order_analytics.operators import staging

SEED = 42
DISTANCE = 2
CROWDED = 2_000

#: (shift and bits of the equal segment, shift of the segment that is hashed fuzzily); the third is padded.
SEGMENTS = ((0, 23, 23), (23, 23, 0), (46, 18, 0))

_words = re.compile(rb"[^ \t-\r]+").findall


def majority(hashes: list[int]) -> int:
    """The bits that are 1 in over half of the hashes."""
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    chosen = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(chosen, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of one text."""
    hashes = shingle_hashes(text, shingle)
    return majority(hashes) if hashes else 0


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    """The hash of each shingle of one text, in order."""
    words = _words(text.lower())  # of bytes: only A-Z change
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=False)]


def fingerprints(documents: DataFrame, shingle: int, row_hash: Column | None = None) -> DataFrame:
    """(doc_id, row_hash, print): the fingerprint as a signed 64-bit number; the hash is 0 if none is asked for."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in steps(batches, "text"):
            texts = rows.column("text").cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(text or b"", shingle) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("row_hash"), pa.array(signed(prints))], ["doc_id", "row_hash", "print"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    hashed = F.lit(0).cast("bigint") if row_hash is None else row_hash
    texts = documents.select("doc_id", hashed.alias("row_hash"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(of_batches, f"doc_id {kind}, row_hash bigint, print bigint")


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row of the fingerprint) for unsigned fingerprints, each key once for a row."""
    found = []
    for place, (shift, bits, other) in enumerate(SEGMENTS):
        equal = prints >> np.uint64(shift) & np.uint64((1 << bits) - 1)
        near = golay.keys((prints >> np.uint64(other) & np.uint64((1 << golay.LENGTH) - 1)).astype(np.uint32))
        keys = (equal[:, None] << np.uint64(golay.LENGTH) | near.astype(np.uint64)) << np.uint64(2) | np.uint64(place)
        fresh = np.ones(keys.shape, bool)
        fresh[:, 1:] = keys[:, 1:] != keys[:, :1]
        rows = np.broadcast_to(np.arange(len(prints))[:, None], keys.shape)
        found.append((keys[fresh], rows[fresh]))
    keys, rows = zip(*found, strict=True)
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(prints: DataFrame) -> DataFrame:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("print").to_numpy().view(np.uint64)
            keys, rows = fuzzy_keys(values)
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(signed(values[rows]))], ["key", "print"])

    return prints.select("print").mapInArrow(of_batches, "key bigint, print bigint")


def link_run(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected among the fingerprints of one key: each to its smallest."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= DISTANCE
    least = np.arange(len(prints))
    while True:
        following = np.where(near, least[None, :], len(prints)).min(axis=1)
        following = following[following]
        if (following == least).all():
            break
        least = following
    moved = np.flatnonzero(least != np.arange(len(prints)))
    return moved, least[moved]


def _linked(keyed: DataFrame) -> DataFrame:
    """Verified links of the fingerprints that share a key; the rows of a key stand together, sorted."""

    def link_pairs(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        close = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= DISTANCE]
        nodes, others = [prints[close + 1]], [prints[close]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            run = prints[start : start + size]
            moved, least = link_run(run)
            nodes.append(run[moved])
            others.append(run[least])
        return np.concatenate(nodes), np.concatenate(others)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            prints = np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
            done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last key may go on
            if done:
                yield _link_batch(*link_pairs(keys[:done], prints[:done]))
                keys, prints = keys[done:], prints[done:]
        if len(keys):
            yield _link_batch(*link_pairs(keys, prints))

    return keyed.repartition("key").sortWithinPartitions("key", "print").mapInArrow(of_batches, "node bigint, other bigint")


def _link_batch(nodes: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(signed(nodes)), pa.array(signed(others))], ["node", "other"])


def _linked_halfway(prints: DataFrame) -> DataFrame:
    """Links of fingerprints through the values at most one bit from both."""
    neighbours = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda bit: F.expr("print").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)))
    halfway = prints.select("print", F.explode(F.concat(F.array("print"), neighbours)).alias("value"))
    least = halfway.groupBy("value").agg(F.min("print").alias("other"), F.count("*").alias("n")).filter("n > 1")
    return halfway.join(least, "value").filter("print <> other").select(F.col("print").alias("node"), "other")


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (node, other) that connect all distinct fingerprints within the distance."""
    keyed = _keyed(prints)
    full = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > crowded).select("key")
    sparse = keyed.join(full, "key", "left_anti")
    dense = keyed.join(full, "key", "left_semi").select("print").distinct()
    return _linked(sparse).union(_linked_halfway(dense)).distinct()


def _rooted(distinct: DataFrame, crowded: int) -> DataFrame:
    """The distinct fingerprints with the root of their class."""
    roots = connected_components(links(distinct.select("print"), crowded))
    joined = distinct.join(roots, distinct["print"] == roots["node"], "left")
    return joined.select(*distinct.columns, F.coalesce("root", "print").alias("root"))


def components(documents: DataFrame, shingle: int = 3, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of every row."""
    printed, _ = staging.write_table(fingerprints(documents, shingle), "fingerprints")
    held = printed.groupBy("print").agg(F.min("doc_id").alias("least_id"))
    distinct, _ = staging.write_table(held, "distinct-fingerprints")
    rooted = _rooted(distinct, crowded)
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = rooted.join(named, "root").select("print", "component_id")
    return printed.join(by_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(documents: DataFrame, shingle: int = 3, crowded: int = CROWDED) -> DataFrame:
    """The first row of each class, with all its columns."""
    row_hash = F.xxhash64(*[F.col(name) for name in documents.columns])
    printed, _ = staging.write_table(fingerprints(documents, shingle, row_hash), "fingerprints")
    # the smallest id, an absent one last; then the row's hash; and how many rows of the class are these
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_hash")
    of_place = printed.groupBy("print", "doc_id", "row_hash").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(place.alias("place"), "copies")).alias("first")
    distinct, _ = staging.write_table(of_place.groupBy("print").agg(first), "distinct-fingerprints")
    chosen = _rooted(distinct, crowded).groupBy("root").agg(F.min("first").alias("first"))
    chosen, _ = staging.write_table(chosen.select("first.place.doc_id", "first.place.row_hash", "first.copies"), "representatives")
    wanted = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("row_hash").alias("chosen_hash"), "copies")
    hashed = documents.select(F.struct(*documents.columns).alias("row"), "doc_id", row_hash.alias("row_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("row_hash") == F.col("chosen_hash"))
    found = hashed.join(wanted, same).select("row.*", "copies")
    # a row that stands several times is rare here, and its copies fall together ahead of the shuffle
    single, several = found.filter("copies = 1"), found.filter("copies > 1")
    return single.select(documents.columns).unionByName(several.select(documents.columns).dropDuplicates())
