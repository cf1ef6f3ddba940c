"""Removal of repeated byte strings by suffix arrays.

Texts are UTF-8 bytes. Every byte is removed that a string of ``length`` bytes covers which also starts
earlier: in a document with a smaller doc_id, or before in the same document. Strings never cross documents,
and are judged on the input, not on what is left.

Candidates meet by anchors (see ``repeats``). Contexts that share an anchor and differ are ordered by a
suffix array that is built by linear grouping (see ``lyndon_suffixes``). Its symbols are tokens: words
with the byte after them, and the anchor, the same in all contexts of a group, as one; suffixes that start at a token are sorted. A
window that starts within a token equals another one if the rest of their tokens is equal and the suffixes
behind have enough bytes in common, which their common prefixes with their neighbours in the order tell.

A null text is empty. A null doc_id comes after all others. Rows that share a doc_id: see ``repeats``.
Texts shorter than ``length`` are left as they are. An empty table gives no rows. Other columns are carried if named, else ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from order_analytics.llm import repeats
from order_analytics.llm.batches import IS_SEPARATOR, SubstringHash, binary_column, mix, steps
from order_analytics.llm.lyndon_suffixes import suffix_array

LENGTH = 100
SEED = 40


def _tokens(rows: repeats.Contexts, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the tokens of all contexts and the context of each: cut after white space, and at both
    ends of the anchor, never within it."""
    data, bounds = rows.texts
    cut = np.zeros(len(data) + 1, bool)
    cut[1:] = IS_SEPARATOR[data]
    anchor = bounds[:-1] + rows.before
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, anchor + 1, 1)
    np.add.at(inside, anchor + seed, -1)
    cut &= np.cumsum(inside) == 0
    cut[anchor], cut[anchor + seed], cut[bounds[:-1]], cut[-1] = True, True, True, False
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(bounds, starts, "right") - 1


def _symbols(rows: repeats.Contexts, starts: np.ndarray, owner: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ranks of all contexts, each ended by a symbol of its own; and the place of each token there."""
    data, bounds = rows.texts
    ends = np.append(starts[1:], len(data))
    raw = data.tobytes()
    tokens = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    ranks = {token: rank for rank, token in enumerate(sorted(set(tokens)))}
    values = np.fromiter(map(ranks.__getitem__, tokens), np.int64, len(tokens))
    contexts = len(rows.key)
    # the last context ends with the smallest symbol
    places = np.arange(len(tokens)) + owner
    symbols = np.empty(len(tokens) + contexts, np.int64)
    symbols[places] = values + contexts
    closing = np.ones(len(symbols), bool)
    closing[places] = False
    symbols[closing] = (np.arange(contexts) + 1) % contexts
    return symbols, places


def _common_bytes(data: np.ndarray, first: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it, up to ``most``."""
    padded = np.concatenate([data, np.zeros(most, np.uint8)])
    common = np.zeros(len(first), np.int64)
    for low in range(1, len(first), 20_000):
        some = np.arange(low, min(low + 20_000, len(first)))
        ours = padded[first[some][:, None] + np.arange(most)]
        theirs = padded[first[some - 1][:, None] + np.arange(most)]
        differs = ours != theirs
        common[some] = np.where(differs.any(axis=1), differs.argmax(axis=1), most)
    limit = np.minimum(size, np.append(0, size[:-1]))
    return np.minimum(common, limit)


def earlier_windows(rows: repeats.Contexts, passage: repeats.Passage) -> tuple[np.ndarray, np.ndarray]:
    """(row, o) of the windows that an earlier context of the group holds."""
    data, bounds = rows.texts
    starts, owner = _tokens(rows, passage.seed)
    symbols, places = _symbols(rows, starts, owner, passage.seed)
    token_of = np.full(len(symbols), -1)
    token_of[places] = np.arange(len(places))
    order = token_of[suffix_array(symbols)]
    order = order[order >= 0]
    # A window belongs to the first token that starts after its first byte, or to the anchor: that much can be told from
    # its own bytes. Suffixes behind the anchor have done their part in the sorting.
    anchor = (bounds[:-1] + rows.before)[owner[order]]
    order = order[(starts[order] == anchor) | (starts[order] < anchor) & (starts[order] > bounds[owner[order]])]
    group = np.cumsum(np.concatenate([[True], rows.key[1:] != rows.key[:-1]]))
    back = bounds[owner[order]] + rows.before[owner[order]] - starts[order]
    order = order[np.lexsort((back, group[owner[order]]))]  # stable: suffixes keep their order

    first, row = starts[order], owner[order]
    back = bounds[row] + rows.before[row] - first
    common = _common_bytes(data, first, bounds[row + 1] - first, passage.length)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (group[row[1:]] != group[row[:-1]]) | (back[1:] != back[:-1])
    earlier = np.maximum(np.append(0, starts[:-1])[order], bounds[row])  # the token before starts here
    room = first - earlier
    age = np.unique(np.stack([rows.doc_id, rows.place]), axis=1, return_inverse=True)[1].ravel()
    least, greatest = rows.least(passage.reach), rows.greatest()
    substring = SubstringHash(data)
    found_row, found_start = [], []
    for ahead in range(int(room.max(initial=0)) + 1):
        node = np.cumsum(fresh | (common < passage.length - ahead))
        windows = back + ahead
        near = room >= ahead if ahead else back == 0
        some = np.flatnonzero(near & (windows >= least[row]) & (windows <= greatest[row]))
        if not len(some):
            continue
        key = mix(node[some].astype(np.uint64) + substring(first[some] - ahead, first[some]))
        _, place = np.unique(key, return_inverse=True)
        oldest = np.full(place.max() + 1, len(age))
        np.minimum.at(oldest, place, age[row[some]])
        later = some[age[row[some]] > oldest[place]]
        found_row.append(row[later])
        found_start.append(windows[later])
    return np.concatenate([*found_row, np.zeros(0, int)]), np.concatenate([*found_start, np.zeros(0, int)])


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Only characters all of whose bytes are gone."""
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(leads):
        return gone
    whole = np.logical_and.reduceat(gone, leads)
    return np.repeat(whole, np.diff(np.append(leads, len(data))))


def remove(
    documents: DataFrame,
    carried: tuple[str, ...] = ("doc_id",),
    length: int = LENGTH,
    seed: int = SEED,
    whole_characters: bool = False,
    most: int = repeats.MOST_CONTEXTS,
) -> DataFrame:
    """``row`` (the carried columns), n_bytes, n_removed, n_spans and ``kept``, the bytes that are left.

    ``whole_characters`` keeps a character unless all its bytes are covered, so that the rest is text.
    """
    passage = repeats.Passage("byte", length, seed)
    rows = repeats.keyed(documents, carried)
    found = repeats.spans(rows, passage, earlier_windows, by_document=False, most=most)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, texts in steps(batches, "text"):
            runs = repeats.runs_of(texts.data, texts.bounds, passage)
            own = runs.first[runs.again], runs.end[runs.again]
            gone = repeats.covered_units(texts.bounds, some.column("spans"), own)
            if whole_characters:
                gone = _whole_characters(texts.data, gone)
            left = np.concatenate([[0], np.cumsum(~gone)])[texts.bounds]
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            edges = texts.bounds[:-1][np.diff(texts.bounds) > 0]
            opens[edges] = gone[edges]
            opened = np.concatenate([[0], np.cumsum(opens)])[texts.bounds]
            sizes = np.diff(texts.bounds)
            counts = [pa.array(x.astype(np.int64)) for x in (sizes, sizes - np.diff(left), np.diff(opened))]
            kept = binary_column(texts.data[~gone], left)
            yield pa.RecordBatch.from_arrays([some.column("row"), *counts, kept], ["row", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = T.StructType([rows.schema["row"]])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, T.LongType())
    joined = repeats.with_spans(rows, found).select("row", "text", "spans")
    return joined.mapInArrow(of_batches, schema.add("kept", T.BinaryType()))
