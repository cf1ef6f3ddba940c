"""Stupid-backoff scores of documents under counts of the whole corpus.

Every document is scored by the n-grams of all other documents: its own counts are taken off first. The
score of word w after the words u is c(uw) / c(u) if the others hold uw; else ``BACKOFF`` times the score of w after u without its first
word. A word without context scores c(w) / N if the others hold it, else ``BACKOFF`` / N. N counts words. The context is the ``order - 1`` words before, fewer at
the start of a text. A document's score is the sum of the logarithms; ``mean_log`` is per word.

The plan is relational: documents are cut into n-grams, equal n-grams of a lot of documents are one row with their
number, count tables are partitioned by the hash of the n-gram and summed, and each row gets back
its table's count by a join on that hash; scores are then summed by document. Rows of one lot and one
partition travel together as packed arrays, since a row of its own for each n-gram would cost several times its
size. A very common n-gram is one entry of each lot, so no partition grows with it.

Lots hold about ``LOT_BYTES`` of text, tables about ``TABLE_BYTES`` of text's n-grams; both numbers follow the input.

N-grams are known by 64-bit hashes. A null text has no words and the score 0; its mean is null. Repeated rows are
documents each; where rows of equal id and text would fill a good part of a lot, they travel as one with its number of copies, and each gets its
score by a join. A null doc_id is an id. An empty table gives no rows. Other columns are ignored. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from order_analytics.llm.batches import MULTIPLIER, mix, steps, words_of
from order_analytics.operators import staging

BACKOFF = 0.4
ORDER = 2
LOT_BYTES = 10 << 20
TABLE_BYTES = 8 << 20


class Grams:
    """The n-grams of a lot of documents by their order: words, pairs of words, and so on."""

    def __init__(self, texts: pa.ChunkedArray, copies: np.ndarray, order: int):
        hashes, sizes = [], []
        for batch in pa.table({"text": texts}).to_batches():
            for _, some in steps([batch], "text"):
                words = words_of(some)
                hashes.append(words.hashes)
                sizes.append(np.diff(words.bounds))
        words = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.sizes = np.concatenate([np.zeros(0, np.int64), *sizes])
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        weights = copies[self.owner] if (copies > 1).any() else None
        filled = self.sizes[self.sizes > 0]
        firsts = np.cumsum(filled) - filled
        #: words that end an n-gram, and the n-grams
        self.ends: dict[int, np.ndarray] = {1: np.arange(len(words))}
        self.by_order: dict[int, np.ndarray] = {1: words}
        short = np.zeros(len(words), bool)  # fewer words before them than the n-gram needs
        for size in range(2, order + 1):
            short[firsts[filled > size - 2] + size - 2] = True
            self.ends[size] = np.flatnonzero(~short)
            self.by_order[size] = mix(self.by_order[size - 1][self.lead(size)] * np.uint64(MULTIPLIER) + words[self.ends[size]])
        self.places: dict[int, np.ndarray] = {}
        self.distinct: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, grams in self.by_order.items():
            found, self.places[size], counts = np.unique(grams, return_inverse=True, return_counts=True)
            if weights is not None:
                counts = np.zeros(len(found), np.int64)
                np.add.at(counts, self.places[size], weights[self.ends[size]])
            self.distinct[size] = found, counts

    def lead(self, size: int) -> np.ndarray:
        """For each n-gram, the place of the one without its last word among those one word shorter."""
        if size == 2:
            return self.ends[2] - 1
        return np.searchsorted(self.ends[size - 1], self.ends[size] - 1)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All distinct n-grams of the lot and their counts, in a fixed order."""
        grams, counts = zip(*self.distinct.values(), strict=True)
        return np.concatenate(grams), np.concatenate(counts)

    def own(self, size: int) -> np.ndarray:
        """For each n-gram, how often its own document holds it."""
        keys = mix(self.by_order[size] + mix(self.owner[self.ends[size]].astype(np.uint64)))
        _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
        return counts[place]

    def others(self, totals: np.ndarray) -> dict[int, np.ndarray]:
        """For each n-gram, its count in all other documents, from the totals of ``table``."""
        cuts = np.cumsum([0, *(len(found) for found, _ in self.distinct.values())])
        split = {size: totals[a:b] for size, a, b in zip(self.distinct, cuts, cuts[1:], strict=False)}
        return {size: split[size][self.places[size]] - self.own(size) for size in self.distinct}


def parts_of(grams: np.ndarray, parts: int) -> np.ndarray:
    return (mix(grams) % np.uint64(parts)).astype(np.int64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in four bytes each, or in eight where one needs more."""
    return counts.astype("<u4" if counts.max(initial=0) < 2**32 else "<u8").tobytes()


def _wide(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // max(1, size)}").astype(np.int64) if size else np.zeros(0, np.int64)


def log_scores(grams: Grams, totals: np.ndarray, corpus_words: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and sum of logarithms of each document of a lot."""
    others = grams.others(totals)
    sizes = grams.sizes
    rest = np.maximum(corpus_words - sizes, 1)[grams.owner]
    scores = np.where(others[1] > 0, others[1] / rest, backoff / rest)
    for size in range(2, max(others) + 1):
        ends, held, lead = grams.ends[size], others[size], others[size - 1][grams.lead(size)]
        scores[ends] = np.where(held > 0, held / np.maximum(lead, 1), backoff * scores[ends])
    return sizes, np.bincount(grams.owner, weights=np.log(scores), minlength=len(sizes))


def _alike_once(texts: DataFrame, crowds: DataFrame) -> DataFrame:
    """Rows of ``crowds`` as one for each id and text, the others as they are; ``copies`` says how many."""
    rest = texts.join(crowds, "row_hash", "left_anti").withColumns({"copies": F.lit(1).cast("bigint"), "alike": F.lit(False)})
    once = texts.join(crowds, "row_hash", "left_semi").groupBy("doc_id", "text", "row_hash").agg(F.count("*").alias("copies"))
    return rest.unionByName(once.withColumn("alike", F.lit(True)))


def score(
    documents: DataFrame, backoff: float = BACKOFF, lot_bytes: int = LOT_BYTES, table_bytes: int = TABLE_BYTES, order: int = ORDER
) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = documents.select("doc_id", text.alias("text")).withColumn("row_hash", F.xxhash64("doc_id", "text"))
    # a row weighs a little beside its text, so that very many short rows make lots as well
    weight, words = F.octet_length("text") + 64, F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    total, corpus_words = (value or 0 for value in texts.agg(F.sum(weight), F.sum(words)).first())
    lots, parts = max(1, -(-total // lot_bytes)), max(1, -(-total // table_bytes))
    # neither many rows with one id nor many with one text make a lot large; rows equal in both are dealt as one
    alike = texts.groupBy("row_hash").agg(F.sum(weight).alias("weight"), F.count("*").alias("n"))
    crowds, _ = staging.write_table(alike.filter((F.col("n") > 1) & (F.col("weight") > lot_bytes // 4)).select("row_hash"), "alike")
    crowded = not crowds.isEmpty()
    single = texts.withColumns({"copies": F.lit(1).cast("bigint"), "alike": F.lit(False)})
    dealt = (_alike_once(texts, crowds) if crowded else single).withColumn("lot", F.pmod("row_hash", F.lit(lots)))

    def count_lot(key: tuple, rows: pa.Table) -> pa.Table:
        grams, counts = Grams(rows.column("text"), rows.column("copies").to_numpy(), order).table()
        part = parts_of(grams, parts)
        by_part = np.argsort(part, kind="stable")
        grams, counts, part = grams[by_part], counts[by_part].astype("<i8"), part[by_part]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
        ranges = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=False))
        return pa.table(
            {
                "part": part[cuts],
                "lot": np.full(len(cuts), key[0].as_py()),
                "grams": pa.array([grams[a:b].tobytes() for a, b in ranges], pa.binary()),
                "counts": pa.array([_narrow(counts[a:b]) for a, b in ranges], pa.binary()),
            }
        )

    def total_part(key: tuple, rows: pa.Table) -> pa.Table:
        lists = [np.frombuffer(packed, np.uint64) for packed in rows.column("grams").to_pylist()]
        counts = [_wide(packed, len(grams)) for packed, grams in zip(rows.column("counts").to_pylist(), lists, strict=True)]
        _, place = np.unique(np.concatenate(lists), return_inverse=True)
        sums = np.zeros(place.max() + 1, np.int64)
        np.add.at(sums, place, np.concatenate(counts))
        totals = np.split(sums[place], np.cumsum([len(grams) for grams in lists])[:-1])
        packed = pa.array([_narrow(part) for part in totals], pa.binary())
        sizes = pa.array([len(part) for part in totals], pa.int64())
        return pa.table({"part": rows.column("part"), "lot": rows.column("lot"), "size": sizes, "counts": packed})

    def score_lot(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(rows.column("text"), rows.column("copies").to_numpy(), order)
        answers = answers.sort_by("part")
        by_part = np.argsort(parts_of(grams.table()[0], parts), kind="stable")
        totals = np.zeros(len(by_part), np.int64)
        found = zip(answers.column("counts").to_pylist(), answers.column("size").to_pylist(), strict=True)
        totals[by_part] = np.concatenate([np.zeros(0, np.int64), *(_wide(packed, size) for packed, size in found)])
        sizes, logs = log_scores(grams, totals, corpus_words, backoff)
        named = {name: rows.column(name) for name in ("doc_id", "row_hash", "alike")}
        return pa.table({**named, "n_words": pa.array(sizes, pa.int64()), "log_score": logs})

    kind = documents.schema["doc_id"].dataType.simpleString()
    packed = dealt.groupBy("lot").applyInArrow(count_lot, "part bigint, lot bigint, grams binary, counts binary")
    answered = packed.groupBy("part").applyInArrow(total_part, "part bigint, lot bigint, size bigint, counts binary")
    # written, so that the n-grams' shuffle is over when documents travel to their lots again
    answered, _ = staging.write_table(answered, "totals")
    del packed
    staging.forget_shuffles(documents.sparkSession)
    scored = dealt.groupBy("lot").cogroup(answered.groupBy("lot")).applyInArrow(
        score_lot, f"doc_id {kind}, row_hash bigint, alike boolean, n_words bigint, log_score double"
    )
    if crowded:
        scored, _ = staging.write_table(scored, "scores")
        once = scored.filter("alike").drop("doc_id")
        scored = scored.filter("not alike").unionByName(texts.select("doc_id", "row_hash").join(once, "row_hash"))
    mean = F.col("log_score") / F.nullif(F.col("n_words"), F.lit(0))
    return scored.select("doc_id", "n_words", "log_score", mean.alias("mean_log"))
