"""Quality rules on repetition: characters inside repeated word n-grams and repeated lines.

Words are maximal runs of bytes other than white space; a character is a code point. An n-gram of a text
is repeated if the text holds it at least twice; a word is covered for n if a repeated n-gram holds it.
All occurrences count, the first as well. A line counts as repeated if it holds a word and equals an
earlier line of its text, to the byte.

The verdict: a text is kept if it passes the base rule (at least ``least_words`` words, and at most
``repeat_percent`` % of its words in repeated 5-grams) and if, for every n of ``coverage_percent``, the
characters covered for n are at most that share of all word characters, and those in repeated lines at
most ``line_percent`` % of them.

A null text has no words and fails the base rule, as do an empty one and one of white space. Rows may repeat; each
is judged by itself, so ties do not arise. Other columns are carried if named, else ignored. An empty table gives no rows. Very
long texts are worked on whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from order_analytics.llm.batches import MULTIPLIER, SubstringHash, Texts, Words, mix, steps, words_of

BASE_WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
#: Share of word characters that repeated n-grams of each length may cover.
COVERAGE_PERCENT = {5: 20, 7: 18, 10: 15}
LINE_PERCENT = 20

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[place] > 1


def covered_words(words: Words, owner: np.ndarray, length: int) -> np.ndarray:
    """Whether a repeated n-gram of the word's own text holds it, by a rolling hash over word hashes."""
    count = len(words.hashes) - length + 1
    if count <= 0:
        return np.zeros(len(words.hashes), bool)
    rolling = np.zeros(count, np.uint64)
    for place in range(length):
        rolling = rolling * np.uint64(MULTIPLIER) + words.hashes[place : place + count]
    starts = np.flatnonzero(owner[:count] == owner[length - 1 :])
    found = starts[repeated(mix(mix(rolling[starts]) + owner[starts].astype(np.uint64)))]
    change = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(change, found, 1)
    np.add.at(change, found + length, -1)
    return np.cumsum(change[:-1]) > 0


def repeated_lines(texts: Texts, words: Words, substring: SubstringHash) -> tuple[np.ndarray, np.ndarray]:
    """For each repeated line, its text, and the range of its words: (text, first, last) as columns."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    starts = np.sort(np.concatenate([texts.bounds[:-1], breaks + 1]))
    owner = np.searchsorted(texts.bounds, starts, "right") - 1
    # a line break at the end of a text leaves an empty line there; it belongs to that text, not to the next
    ends = np.sort(np.concatenate([breaks, texts.bounds[1:]]))
    first, last = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    some = last > first
    starts, ends, owner, first, last = (x[some] for x in (starts, ends, owner, first, last))
    keys = mix(substring(starts, ends) + mix(owner.astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return owner[again], np.stack([first[again], last[again]])


def _sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def measure(texts: Texts, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The counts of each text, ``dup_chars_<n>`` for each n-gram length and ``dup_line_chars``."""
    substring = SubstringHash(texts.data)
    words = words_of(texts, substring)
    owner = words.owner()
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    chars = points[words.ends] - points[words.starts]
    line_owner, line_words = repeated_lines(texts, words, substring)
    char_sums = np.concatenate([[0], np.cumsum(chars)])
    in_lines = char_sums[line_words[1]] - char_sums[line_words[0]]
    count = len(texts.bounds) - 1
    return {
        "n_words": np.diff(words.bounds),
        "word_chars": _sum_by(chars, words.bounds),
        "n_symbols": _sum_by(IS_SYMBOL[texts.data], texts.bounds),
        "n_dup_lines": np.bincount(line_owner, minlength=count),
        "n_repeat_words": _sum_by(covered_words(words, owner, BASE_WINDOW), words.bounds),
        **{f"dup_chars_{n}": _sum_by(chars * covered_words(words, owner, n), words.bounds) for n in lengths},
        "dup_line_chars": np.bincount(line_owner, weights=in_lines, minlength=count).astype(np.int64),
    }


def judge(
    documents: DataFrame,
    carried: tuple[str, ...] = ("doc_id",),
    least_words: int = LEAST_WORDS,
    repeat_percent: int = REPEAT_PERCENT,
    coverage_percent: dict[int, int] | None = None,
    line_percent: int = LINE_PERCENT,
) -> DataFrame:
    """``row`` (the carried columns), the counts, ``base_failed`` and ``kept`` of every row."""
    coverage = COVERAGE_PERCENT if coverage_percent is None else coverage_percent
    lengths = tuple(coverage)

    def measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in steps(batches, "text"):
            found = measure(texts, lengths)
            columns = [rows.column("row"), *(pa.array(values, pa.int64()) for values in found.values())]
            yield pa.RecordBatch.from_arrays(columns, ["row", *found])

    names = [*COUNTS, *(f"dup_chars_{n}" for n in lengths), "dup_line_chars"]
    rows = documents.select(F.struct(*carried).alias("row"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *(T.StructField(name, T.LongType()) for name in names)])
    counted = rows.mapInArrow(measure_batches, schema)
    base_failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    passed = 100 * F.col("dup_line_chars") <= line_percent * F.col("word_chars")
    for n, percent in coverage.items():
        passed &= 100 * F.col(f"dup_chars_{n}") <= percent * F.col("word_chars")
    return counted.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & passed)
