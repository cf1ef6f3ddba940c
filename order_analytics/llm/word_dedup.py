"""Removal of repeated word sequences by prefix-partitioned suffix trees.

Words are runs of bytes other than white space. A window is ``length`` consecutive words of one document. Every
word is removed that is in a window which also starts in a document with a smaller doc_id; windows are
judged on the input.

Suffixes are taken at anchors (see ``repeats``), so the anchor's words are the prefix that partitions them.
Groups that do not fit get longer prefixes, until they do. In a group the suffixes behind the prefix are sorted and make a suffix
tree (``suffix_tree``). Its deep internal nodes are the strings that repeat and go no further to the right. A window that starts
o words before the anchor needs a node that is ``length - o`` words deep behind it: each suffix climbs from its leaf to the highest such node, one step at most
when o grows by one. Of the suffixes below that node, those with the same o words before the anchor hold the same window, so the words
left of the prefix make the repeat maximal on that side. A suffix that is still at its leaf repeats nothing.

A null text has no words. A null doc_id comes after all others; rows that share one are not earlier than each other. Texts of
fewer words than a window are left as they are. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from order_analytics.llm import repeats
from order_analytics.llm.batches import MULTIPLIER, binary_column, mix, steps, words_of
from order_analytics.llm.suffix_tree import suffix_tree

LENGTH = 50
SEED = 25


def _beside(symbols: np.ndarray, from_place: np.ndarray, step: int, counts: np.ndarray, reach: int) -> np.ndarray:
    """Words right (step 1) or left (step -1) of a place, a row for each; after ``counts`` unlike any."""
    places = from_place[:, None] + step * np.arange(reach)
    there = np.arange(reach) < counts[:, None]
    filler = mix(np.arange(places.size, dtype=np.uint64).reshape(places.shape) + np.uint64(step + 2))
    return np.where(there, symbols[np.where(there, places, 0)], filler)


def earlier_windows(rows: repeats.Contexts, passage: repeats.Passage) -> tuple[np.ndarray, np.ndarray]:
    """(row, o) of the windows that a document with a smaller id holds."""
    sequence = rows.sequence("word")
    anchor = sequence.bounds[:-1] + rows.before
    group = np.cumsum(np.concatenate([[True], rows.key[1:] != rows.key[:-1]]))
    right = _beside(sequence.symbols, anchor + passage.seed, 1, rows.after, passage.reach)
    order = np.lexsort((*right.T[::-1], group))
    right, group = right[order], group[order]
    differs = right[1:] != right[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), passage.reach)
    shared = np.concatenate([[-1], np.where(group[1:] == group[:-1], shared, -1)])
    tree = suffix_tree(shared, passage.reach)
    node = np.arange(tree.leaves)

    left = _beside(sequence.symbols, anchor - 1, -1, rows.before, passage.reach)[order]
    rolled = np.zeros(len(order), np.uint64)
    age = np.unique(rows.doc_id, return_inverse=True)[1][order]
    least, greatest = rows.least(passage.reach)[order], rows.greatest()[order]
    found_row, found_start = [], []
    for start in range(passage.reach + 1):
        if start:
            rolled = mix(rolled * np.uint64(MULTIPLIER) + left[:, start - 1])
        node = tree.climb(node, passage.reach - start)
        some = np.flatnonzero((start >= least) & (start <= greatest) & (node > tree.leaves))
        if not len(some):
            continue
        _, place = np.unique(mix(node[some].astype(np.uint64) + rolled[some]), return_inverse=True)
        oldest = np.full(place.max() + 1, len(order))
        np.minimum.at(oldest, place, age[some])
        later = order[some[age[some] > oldest[place]]]
        found_row.append(later)
        found_start.append(np.full(len(later), start))
    return np.concatenate([*found_row, np.zeros(0, int)]), np.concatenate([*found_start, np.zeros(0, int)])


def remove(
    documents: DataFrame,
    carried: tuple[str, ...] = ("doc_id",),
    length: int = LENGTH,
    seed: int = SEED,
    most: int = repeats.MOST_CONTEXTS,
) -> DataFrame:
    """``row`` (the carried columns), n_words, n_removed and ``kept``: the words left, joined by spaces."""
    passage = repeats.Passage("word", length, seed)
    rows = repeats.keyed(documents, carried)
    found = repeats.spans(rows, passage, earlier_windows, by_document=True, most=most)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, texts in steps(batches, "text"):
            words = words_of(texts)
            gone = repeats.covered_units(words.bounds, some.column("spans"))
            starts, ends, owner = words.starts[~gone], words.ends[~gone], words.owner()[~gone]
            left = np.concatenate([[0], np.cumsum(~gone)])[words.bounds]
            # each kept word with a space after it, but for the last of a text
            final = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
            sizes = ends - starts + ~final
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            taken = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes)
            spaced = np.append(texts.data, np.uint8(0x20))[np.minimum(taken, len(texts.data))]
            spaced[(bounds[1:] - 1)[~final]] = 0x20
            kept = binary_column(spaced, bounds[left])
            counts = [pa.array(x.astype(np.int64)) for x in (np.diff(words.bounds), np.diff(words.bounds) - np.diff(left))]
            yield pa.RecordBatch.from_arrays([some.column("row"), *counts, kept], ["row", "n_words", "n_removed", "kept"])

    schema = T.StructType([rows.schema["row"]]).add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept", T.BinaryType())
    return repeats.with_spans(rows, found).select("row", "text", "spans").mapInArrow(of_batches, schema)
