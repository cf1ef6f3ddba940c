"""Passages that repeat across a corpus, found without comparing texts pair by pair.

A text is a sequence of units (bytes or words). A window is ``length`` consecutive units. The anchor of a window is
the ``seed``-unit string in it with the smallest hash (the leftmost of equals). Equal windows have equal
anchors at equal places, so they meet by the anchor's hash, and only about two in ``length - seed + 2`` positions are anchors.

1. ``anchors``: windows that follow each other and have one anchor are a run; a row says where the anchor is, how
   far the run reaches to both sides (its context), and has hashes of the anchor and of the context.
2. ``shared_anchors``: runs whose anchor occurs once only are dropped.
3. ``contexts``: equal contexts become one row with their first place; a later copy is covered as a whole. Sums come
   before the shuffle, so a context with very many copies is a row for each task.
4. Contexts that share an anchor but differ are compared in groups (``compared``) by the caller's method. A
   group of more than ``MOST_CONTEXTS`` is split by a longer shared string: windows whose anchor is among the first
   or the second half of the possible places share more units right or left of it. Halving ends at single windows, which
   are grouped by sum. Nothing is left out.
5. ``spans``: the units of each text that are covered.

A document is known by its id and the hash of its text. Rows without id are not compared with others.
Rows that share an id are not earlier than each other; fully equal rows get equal results, and their spans are listed once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from order_analytics.llm.batches import SubstringHash, Texts, binary_column, mix, signed, steps, texts_of, words_of
from order_analytics.operators import staging

#: Contexts of one group that are compared with each other at most.
MOST_CONTEXTS = 500
#: Bytes of text whose windows are hashed in one step: some fifteen numbers of 8 bytes for each are held at a time.
STEP_TEXT_BYTES = 1 << 20
#: Bytes of contexts that are compared in one step; the suffix array holds some 300 bytes for each token of them.
STEP_CONTEXT_BYTES = 1 << 19
#: A staged table has so many files for each core, or one for so many of the session's shuffle partitions if that is more. Local file
#: systems start processes for each file that an executor creates, and for a moment such a child counts with all its executor's memory.
FILES_PER_CORE, PARTITIONS_PER_FILE = 3, 8

#: A position takes 30 bits beside the 34 highest bits of a hash.
PLACE_BITS = 30
PLACE = np.uint64((1 << PLACE_BITS) - 1)

CONTEXT_NAMES = ["key", "low", "high", "anchor", "context", "doc_id", "place", "before", "after", "body"]
CONTEXT = "key bigint, low int, high int, anchor bigint, context bigint, doc_id bigint, place bigint, before int, after int, body binary"


class Passage(NamedTuple):
    """What counts as a repeat: windows of ``length`` bytes or words, with anchors of ``seed``."""

    unit: str
    length: int
    seed: int

    @property
    def reach(self) -> int:
        """Units by which a window goes beyond its anchor, on both sides together."""
        return self.length - self.seed


class Sequence(NamedTuple):
    """Texts as units, with the byte range of each."""

    symbols: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def sequence_of(texts: Texts, unit: str) -> Sequence:
    if unit == "byte":
        places = np.arange(len(texts.data) + 1)
        return Sequence(texts.data, texts.bounds, places[:-1], places[1:])
    words = words_of(texts)
    return Sequence(words.hashes, words.bounds, words.starts, words.ends)


class Runs(NamedTuple):
    """Runs of windows with one anchor: text, anchor's unit, first window, end of the last, hashes.

    ``again``: the text holds the same context earlier.
    """

    owner: np.ndarray
    place: np.ndarray
    first: np.ndarray
    end: np.ndarray
    anchor: np.ndarray
    context: np.ndarray
    again: np.ndarray


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: back from the block's end, on from the next one's start."""
    count = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], onward[width - 1 : width - 1 + count])


def runs_of(symbols: np.ndarray, bounds: np.ndarray, passage: Passage) -> Runs:
    """All windows of each text as runs."""
    count = len(symbols) - passage.length + 1
    if count <= 0:
        return Runs(*(np.zeros(0, kind) for kind in (*[np.int64] * 4, *[np.uint64] * 2, bool)))
    substring = SubstringHash(symbols)
    seeds = substring.windows(passage.seed)
    ranked = (seeds & ~PLACE) | np.arange(len(seeds), dtype=np.uint64)
    place = (_least_in_windows(ranked, passage.reach + 1) & PLACE).astype(np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = owner[:count] == owner[passage.length - 1 :]
    moved = place[1:] != place[:-1]
    opens, closes = whole.copy(), whole.copy()
    opens[1:] &= moved | ~whole[:-1] | (owner[1:count] != owner[: count - 1])
    closes[:-1] &= moved | ~whole[1:] | (owner[1:count] != owner[: count - 1])
    first, end = np.flatnonzero(opens), np.flatnonzero(closes) + passage.length
    place, owner = place[first], owner[first]
    anchor = seeds[place]
    context = mix(substring(first, end) + mix((place - first).astype(np.uint64) + anchor))
    again = np.ones(len(first), bool)
    again[np.unique(mix(context + owner.astype(np.uint64)), return_index=True)[1]] = False
    return Runs(owner, place, first, end, anchor, context, again)


def keyed(documents: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """carried columns as ``row``; doc_id (null: after all others), hash of the text, text (null: empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    last = F.lit(2**63 - 1)
    return documents.select(
        F.struct(*carried).alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), last).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


def anchors(rows: DataFrame, passage: Passage, by_document: bool) -> DataFrame:
    """(anchor, context, doc_id, text_hash, at) of each context of a text; ``at`` packs place and reach.

    Where an earlier start in the same document is enough, contexts that their text repeats are left out.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, texts in steps(batches, "text", STEP_TEXT_BYTES):
            sequence = sequence_of(texts, passage.unit)
            runs = runs_of(sequence.symbols, sequence.bounds, passage)
            fresh = ~runs.again | by_document
            owner, place = runs.owner[fresh], runs.place[fresh]
            before = place - runs.first[fresh]
            after = runs.end[fresh] - place - passage.seed
            at = (place - sequence.bounds[owner]) << 16 | before << 8 | after
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(runs.anchor[fresh])),
                    pa.array(signed(runs.context[fresh])),
                    some.column("doc_id").take(pa.array(owner)),
                    some.column("text_hash").take(pa.array(owner)),
                    pa.array(at),
                ],
                ["anchor", "context", "doc_id", "text_hash", "at"],
            )

    schema = "anchor bigint, context bigint, doc_id bigint, text_hash bigint, at bigint"
    return rows.select("doc_id", "text_hash", "text").mapInArrow(of_batches, schema)


def _places(at: str) -> list:
    return [
        F.shiftright(at, 16).alias("place"),
        F.shiftright(at, 8).bitwiseAND(255).cast("int").alias("before"),
        F.col(at).bitwiseAND(255).cast("int").alias("after"),
    ]


def shared_anchors(found: DataFrame, written: list[str]) -> DataFrame:
    """The rows whose anchor another row has.

    The anchors are written before the join: with no grouping next to it, both sides of the join are plain
    shuffles, and adaptive execution can split an anchor that very many rows have.
    """
    several = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    return found.join(_kept(several, "shared-anchors", written), "anchor")


def contexts(held: DataFrame) -> DataFrame:
    """(anchor, context, first): each different context and where it stands first."""
    return held.groupBy("anchor", "context").agg(F.min(F.struct("doc_id", "at", "text_hash")).alias("first"))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task without those that repeat the id and text of an earlier one."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        names = zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), strict=True)
        fresh = [name not in seen and not seen.add(name) for name in names]
        yield batch if all(fresh) else batch.filter(pa.array(fresh, pa.bool_()))


def bodies(rows: DataFrame, found: DataFrame, passage: Passage, written: list[str]) -> DataFrame:
    """The contexts that share an anchor with another, as ``CONTEXT`` rows with their units' bytes."""
    wanted = shared_anchors(found, written).select("anchor", "context", "first.*")
    wanted = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "context", *_places("at"))).alias("wanted"))
    texts = rows.select("doc_id", "text_hash", "text").join(wanted, ["doc_id", "text_hash"])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, texts in steps(_once(batches), "text", STEP_TEXT_BYTES):
            sequence = sequence_of(texts, passage.unit)
            lists = some.column("wanted")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            fields = dict(zip(["anchor", "context", "place", "before", "after"], lists.flatten().flatten(), strict=True))
            at = fields["place"].to_numpy() + sequence.bounds[owner]
            first = sequence.starts[at - fields["before"].to_numpy()]
            end = sequence.ends[at + passage.seed + fields["after"].to_numpy() - 1]
            sizes = end - first
            ends = np.concatenate([[0], np.cumsum(sizes)])
            taken = np.arange(ends[-1]) + np.repeat(first - ends[:-1], sizes)
            zeros = pa.array(np.zeros(len(owner), np.int32))
            reach = pa.array(np.full(len(owner), passage.reach, np.int32))
            ids = some.column("doc_id").take(pa.array(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    fields["anchor"],
                    zeros,
                    reach,
                    fields["anchor"],
                    fields["context"],
                    ids,
                    fields["place"],
                    fields["before"],
                    fields["after"],
                    binary_column(texts.data[taken], ends),
                ],
                CONTEXT_NAMES,
            )

    return texts.mapInArrow(of_batches, CONTEXT)


class Contexts(NamedTuple):
    """Contexts to compare: rows with one key hold one shared string, and their windows start ``o`` units
    before the anchor, ``low <= o <= high``."""

    key: np.ndarray
    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    context: np.ndarray
    doc_id: np.ndarray
    place: np.ndarray
    before: np.ndarray
    after: np.ndarray
    texts: Texts

    def sequence(self, unit: str) -> Sequence:
        return sequence_of(self.texts, unit)

    def least(self, reach: int) -> np.ndarray:
        """The first window of each row: its ``o`` counted down from ``greatest``."""
        return np.maximum(self.low, reach - self.after)

    def greatest(self) -> np.ndarray:
        return np.minimum(self.high, self.before)


def _contexts_of(batch: pa.RecordBatch) -> Contexts:
    return Contexts(*(batch.column(name).to_numpy() for name in CONTEXT_NAMES[:-1]), texts_of(batch.column("body")))


def _halves(large: DataFrame, passage: Passage) -> DataFrame:
    """Rows of groups too large, once for each half of their windows that they have windows in."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _contexts_of(batch)
            sequence = rows.sequence(passage.unit)
            substring = SubstringHash(sequence.symbols)
            middle = (rows.low + rows.high) // 2
            for low, high in ((rows.low, middle), (middle + 1, rows.high)):
                some = np.flatnonzero(np.maximum(low, passage.reach - rows.after) <= np.minimum(high, rows.before))
                at = sequence.bounds[some] + rows.before[some]
                shared = substring(at - low[some], at + passage.length - high[some])
                key = mix(shared + mix(signed_back(rows.anchor[some]) + (low[some] * 256 + high[some]).astype(np.uint64)))
                kept = batch.take(pa.array(some))
                columns = [pa.array(signed(key)), pa.array(low[some]), pa.array(high[some]), *kept.columns[3:]]
                yield pa.RecordBatch.from_arrays(columns, CONTEXT_NAMES)

    return large.mapInArrow(of_batches, CONTEXT)


def signed_back(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.uint64)


Method = Callable[[Contexts, Passage], tuple[np.ndarray, np.ndarray]]


def _covered_ranges(rows: Contexts, row: np.ndarray, start: np.ndarray, passage: Passage) -> pa.RecordBatch:
    """Windows (row, units from the anchor back) as ranges of units counted from the anchor."""
    width = 2 * passage.reach + passage.seed + 1
    change = np.zeros(len(rows.key) * width + 1, np.int32)
    at = row * width + passage.reach - start
    np.add.at(change, at, 1)
    np.add.at(change, at + passage.length, -1)
    inside = np.concatenate([[False], np.cumsum(change[:-1]) > 0])
    first, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    if len(end) < len(first):
        end = np.append(end, len(inside) - 1)
    row = first // width
    shift = row * width + passage.reach
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.anchor[row]), pa.array(rows.context[row]), pa.array(first - shift), pa.array(end - shift)],
        ["anchor", "context", "start", "end"],
    )


RANGE = "anchor bigint, context bigint, start bigint, end bigint"


def _compared(small: DataFrame, passage: Passage, method: Method) -> DataFrame:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            keys = table.column("key").to_numpy()
            done = len(keys) if last else int(np.flatnonzero(keys != keys[-1]).max(initial=-1)) + 1
            held[:] = [table.slice(done)]
            if done:
                rows = _contexts_of(table.slice(0, done))
                yield _covered_ranges(rows, *method(rows, passage), passage)

        for batch in batches:
            for some, texts in steps([batch], "body", STEP_CONTEXT_BYTES):
                held.append(some)
                size += len(texts.data)
                if size >= STEP_CONTEXT_BYTES:
                    yield from settle(last=False)
                    size = held[0].column("body").nbytes
        if held:
            yield from settle(last=True)

    return small.repartition("key").sortWithinPartitions("key").mapInArrow(of_batches, RANGE)


def _compared_single(windows: DataFrame, passage: Passage, by_document: bool) -> DataFrame:
    """Groups of one window each: all rows but those at the first place are covered."""
    order = F.struct("doc_id") if by_document else F.struct("doc_id", "place")
    first = windows.groupBy("key").agg(F.min(order).alias("first"))
    later = windows.join(first, "key").filter(order > F.col("first"))
    start = -F.col("low").cast("bigint")
    return later.select("anchor", "context", start.alias("start"), (start + passage.length).alias("end"))


def compared(contexts_found: DataFrame, passage: Passage, method: Method, by_document: bool, most: int, written: list[str]) -> DataFrame:
    """``RANGE`` rows: what of a context an earlier different context holds, counted from the anchor."""
    pending, ranges = contexts_found, []
    while True:
        full = _kept(pending.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > most), "large-groups", written)
        if full.isEmpty():
            ranges.append(_compared(pending, passage, method))
            break
        ranges.append(_compared(pending.join(full, "key", "left_anti"), passage, method))
        halves = _kept(_halves(pending.join(full, "key", "left_semi"), passage), "halves", written)
        ranges.append(_compared_single(halves.filter("low = high"), passage, by_document))
        pending = halves.filter("low < high")
    found = ranges[0]
    for more in ranges[1:]:
        found = found.unionByName(more)
    return found


def few_files(table: DataFrame) -> DataFrame:
    """The table in fewer partitions than its shuffles have; their number still grows with the session's shuffle partitions."""
    spark = table.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table.coalesce(max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, shuffled // PARTITIONS_PER_FILE))


def _kept(table: DataFrame, label: str, written: list[str]) -> DataFrame:
    """The table once written; the shuffles that made it can go, and its path is noted.

    A task writes several shuffle partitions, one after the other. Tasks get equal numbers of them, and each part of a partition
    that was split counts as one, so a key that very many rows have still goes to several tasks.
    """
    staged, path = staging.write_table(few_files(table), label)
    written.append(path)
    staging.forget_shuffles(table.sparkSession)
    return staged


def spans(rows: DataFrame, passage: Passage, method: Method, by_document: bool, most: int = MOST_CONTEXTS) -> DataFrame:
    """(doc_id, text_hash, spans): covered units of each document that has any, as (start, end) in no order.

    ``by_document``: only documents with a smaller id are earlier; else an earlier start in the same
    document is as well, and the caller adds contexts that a text itself repeats.
    """
    spark, written = rows.sparkSession, []
    held = _kept(shared_anchors(anchors(rows, passage, by_document), written), "repeated-anchors", [])
    found = _kept(contexts(held), "contexts", written)
    bodies_found = _kept(bodies(rows, found, passage, written), "context-bodies", written)
    ranges = compared(bodies_found, passage, method, by_document, most, written)
    ranges = ranges.groupBy("anchor", "context").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    known = found.select("anchor", "context", F.col("first.doc_id").alias("first_id")).join(ranges, ["anchor", "context"], "left")
    known = _kept(known, "known-contexts", [])
    for path in written:
        staging.drop_table(spark, path)
    staging.forget_shuffles(spark)
    joined = held.join(known, ["anchor", "context"]).filter("doc_id > first_id or ranges is not null")
    joined = joined.select("doc_id", "text_hash", "first_id", "ranges", *_places("at"))
    whole = F.struct((F.col("place") - F.col("before")).alias("start"), (F.col("place") + passage.seed + F.col("after")).alias("end"))
    parts = F.transform("ranges", lambda x: F.struct((x["start"] + F.col("place")).alias("start"), (x["end"] + F.col("place")).alias("end")))
    covered = joined.withColumn("span", F.explode(F.when(F.col("doc_id") > F.col("first_id"), F.array(whole)).otherwise(parts)))
    return covered.groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans"))


def covered_units(bounds: np.ndarray, lists: pa.ListArray, more: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Whether each unit of a run of texts is covered, from lists of spans by text; ``more`` adds ranges of units."""
    change = np.zeros(bounds[-1] + 1, np.int64)
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    start, end = (field.to_numpy() for field in lists.flatten().flatten())
    np.add.at(change, start + bounds[owner], 1)
    np.add.at(change, end + bounds[owner], -1)
    if more is not None:
        np.add.at(change, more[0], 1)
        np.add.at(change, more[1], -1)
    return np.cumsum(change[:-1]) > 0


def with_spans(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, ["doc_id", "text_hash"], "left")
