"""Encoding, language model, repetition rules and the two kinds of deduplication, against plain versions."""

from __future__ import annotations

import base64
import math
import random
import struct
from collections import Counter

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SMALL

from order_analytics.llm import backoff_lm, byte_bpe, byte_dedup, repeats, repetition, word_dedup
from order_analytics.llm.lyndon_suffixes import suffix_array
from order_analytics.llm.suffix_tree import suffix_tree

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
#: Names that the operators use for columns of their own.
CLASHING = "doc_id bigint, text string, source string, row string, n_words string, kept string, spans string, lot string, ids string"


@pytest.fixture(scope="module")
def documents(spark):
    return [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture
def table(spark):
    """(doc_id, text) rows with columns that clash."""
    return lambda rows: spark.createDataFrame([(*row, "s", *"abcdef") for row in rows], CLASHING)


@pytest.fixture(scope="module")
def library():
    tokens = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={token: rank for rank, token in enumerate(tokens)}, special_tokens={})


ODD = [None, "", " ", "\n\n", "a", "a" * 3000, "  x  y\t\tz   .", "it's we'LL 123four \U0001f600\U0001f600 ١é", "<|endoftext|>", "\x00\x1c\x7f"]


def test_encoding_equals_the_library(table, documents, library):
    rows = documents + [(10_000 + k, text) for k, text in enumerate(ODD)] + [(None, "no id"), (7, "again"), (7, "again")]
    encoded = byte_bpe.encode(table(rows), RANKS, PATTERN)
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"]), bytes(r["decoded"]), r["n_tokens"]) for r in byte_bpe.decode(encoded, RANKS).collect())
    expected = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id is None, doc_id or 0, struct.pack(f"<{len(ids)}I", *ids), (text or "").encode(), len(ids)))
    assert found == sorted(expected)
    assert byte_bpe.decode(byte_bpe.encode(table([]), RANKS, PATTERN), RANKS).count() == 0


def test_every_character_is_split_and_merged_alike(library):
    tokens = byte_bpe.read_ranks(RANKS)
    encoder = byte_bpe._Encoder(byte_bpe.serialise_model(tokens), tokens, PATTERN)
    points = [p for p in [*range(0x3000), *range(0x3000, 0x110000, 97)] if not 0xD800 <= p < 0xE000]
    texts = [f"'s a{chr(p)} b{chr(p)}{chr(p)}  1{chr(p)} " for p in points]
    for text, packed in zip(texts, encoder(texts), strict=True):
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode_ordinary(text)


def test_pieces_stand_at_their_ranks():
    import sentencepiece

    tokens = byte_bpe.read_ranks(RANKS)
    model = sentencepiece.SentencePieceProcessor(model_proto=byte_bpe.serialise_model(tokens))
    assert model.vocab_size() == len(tokens) + 1 and model.unk_id() == len(tokens)
    assert [model.id_to_piece(rank) for rank in (0, 300, 50_000)] == [byte_bpe.byte_map(tokens[rank]) for rank in (0, 300, 50_000)]
    with open(RANKS, "rb") as lines:
        assert base64.b64decode(lines.readline().split()[0]) == tokens[0]


def backoff(rows, order=2):
    found = [plain.words(text) for _, text in rows]

    def grams(text):
        return Counter(tuple(text[end - size : end]) for size in range(1, order + 1) for end in range(size, len(text) + 1))

    counts = Counter()
    for text in found:
        counts.update(grams(text))
    out = []
    for (doc_id, _), text in zip(rows, found, strict=True):
        others, own = max(sum(map(len, found)) - len(text), 1), grams(text)

        def logarithm(gram, others=others, own=own):
            held = counts[gram] - own[gram]
            if len(gram) == 1:
                return math.log((held or backoff_lm.BACKOFF) / others)
            if held:
                return math.log(held / (counts[gram[:-1]] - own[gram[:-1]]))
            return math.log(backoff_lm.BACKOFF) + logarithm(gram[1:])

        total = sum(logarithm(tuple(text[max(0, end - order) : end])) for end in range(1, len(text) + 1))
        out.append((doc_id, len(text), float(total)))
    return out


def same_scores(found, expected):
    key = lambda row: (row[0] is None, row[0] or 0, row[1], row[2])
    for ours, theirs in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert ours[:2] == theirs[:2] and ours[2] == pytest.approx(theirs[2], rel=1e-9)
        assert ours[3] == (pytest.approx(theirs[2] / theirs[1], rel=1e-9) if theirs[1] else None)


@pytest.mark.parametrize(("lot_bytes", "order"), [(1 << 22, 2), (20_000, 2), (40_000, 3), (1 << 22, 4)])
def test_backoff_scores(table, documents, lot_bytes, order):
    rows = documents[:: 1 if order == 2 else 4] + [(10_000 + k, text) for k, text in enumerate(ODD)]
    rows += [(None, "no id is an id"), (5, "twice a row"), (5, "twice a row"), (20_000, "one"), (20_001, "twice a"), (20_002, "a twice a row a")]
    found = backoff_lm.score(table(rows), lot_bytes=lot_bytes, table_bytes=lot_bytes, order=order).collect()
    same_scores(found, backoff(rows, order))
    if order == 2:
        assert backoff_lm.score(table([])).count() == 0


def test_backoff_scores_of_very_many_equal_rows(table, documents):
    rows = documents[:40] + [(None, "a row that comes again")] * 3_000 + [(5, "twice a row")] * 2 + [(None, None)] * 500
    found = backoff_lm.score(table(rows), lot_bytes=20_000, table_bytes=20_000).collect()
    same_scores(found, backoff(rows))


def test_repetition_measures(table, documents):
    lines = "one two three\nfour\none two three\n\n \néé four\nfour\n"
    rows = documents + [(10_000 + k, text) for k, text in enumerate([*ODD, lines, lines * 50, "w " * 9, "a b c d e f g h i j k", "x y z " * 40])]
    rows += [(None, "no id"), (5, "twice"), (5, "twice")]
    judged = repetition.judge(table(rows))
    found = [({name: row[name] for name in judged.columns if name != "row"}, row["row"]["doc_id"]) for row in judged.collect()]
    expected = [(plain.repetition(text, repetition.COVERAGE_PERCENT), doc_id) for doc_id, text in rows]
    assert sorted(map(str, found)) == sorted(str(({name: row[name] for name in judged.columns if name != "row"}, i)) for row, i in expected)
    assert repetition.judge(table([])).count() == 0


def test_suffix_array_equals_sorting():
    draw = np.random.default_rng(5)
    for _ in range(1500):
        symbols = np.append(draw.integers(1, draw.integers(2, 6), draw.integers(0, 50)), 0)
        suffixes = symbols.tolist()
        assert suffix_array(symbols).tolist() == sorted(range(len(suffixes)), key=lambda place: suffixes[place:])
    assert suffix_array(np.zeros(0, int)).tolist() == []


def test_suffix_tree_equals_common_prefixes():
    draw = random.Random(4)
    for letters, count in ((1, 6), (2, 40), (3, 60), (9, 30), (2, 1)):
        strings = sorted("".join(draw.choice("abcdefghi"[:letters]) for _ in range(7)) for _ in range(count))
        common = lambda one, other: next((k for k in range(7) if one[k] != other[k]), 7)
        shared = [-1, *(common(one, other) for one, other in zip(strings, strings[1:], strict=False))]
        if count > 10:
            shared[5] = -1  # two groups
        tree = suffix_tree(np.array(shared), 7)
        node = np.arange(count)
        for depth in range(7, -1, -1):
            node = tree.climb(node, depth)
            for one in range(count):
                below = {other for other in range(count) if node[other] == node[one]}
                near = {other for other in range(count) if min([*shared[min(one, other) + 1 : max(one, other) + 1], 7]) >= depth}
                assert below == near and (len(near) > 1) == bool(node[one] > tree.leaves)
    assert suffix_tree(np.zeros(0, int), 7).parent.tolist() == [0]


def similar_texts(seed: int, count: int, size: int) -> list[str]:
    """Texts that share passages: cut, edited and repeated pieces of a few sources."""
    draw = random.Random(seed)
    syllables = ["ba", "é", "to", "x", "ri", "中"]
    word = lambda: "".join(draw.choices(syllables, k=draw.randint(1, 4)))
    sources = [[word() for _ in range(size)] for _ in range(4)]
    texts = []
    for _ in range(count):
        parts: list[str] = []
        for _ in range(draw.randint(1, 4)):
            source = draw.choice(sources)
            low = draw.randrange(size)
            part = source[low : low + draw.randint(1, size)]
            if draw.random() < 0.5:
                part = [word() if draw.random() < 0.04 else kept for kept in part]
            parts += part
        texts.append(draw.choice([" ", "\n"]).join(parts))
    return texts


def dedup_rows(seed: int) -> list[tuple]:
    texts = similar_texts(seed, 60, 40)
    texts += [texts[3], texts[3], texts[5] + " " + texts[5], "a" * 400, "b" + "a" * 300, "ab" * 200, "", None, " " * 200, "short"]
    ids = list(range(len(texts)))
    random.Random(seed).shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize(("seed", "most", "length", "anchor"), [(1, 500, 40, 16), (2, 3, 40, 16), (3, 1, 30, 20), (4, 2, 25, 10)])
def test_byte_dedup(table, seed, most, length, anchor):
    """Small groups force the splitting down to single windows."""
    rows = dedup_rows(seed)
    found = byte_dedup.remove(table(rows), length=length, seed=anchor, most=most).collect()
    ours = {row["row"]["doc_id"]: (row["n_bytes"], row["n_removed"], row["n_spans"], bytes(row["kept"])) for row in found}
    assert ours == plain.byte_dedup(rows, length)


@pytest.mark.parametrize(("seed", "most", "length", "anchor"), [(1, 500, 8, 4), (2, 3, 8, 4), (3, 1, 6, 3), (4, 2, 10, 5)])
def test_word_dedup(table, seed, most, length, anchor):
    rows = dedup_rows(seed)
    found = word_dedup.remove(table(rows), length=length, seed=anchor, most=most).collect()
    assert {row["row"]["doc_id"]: (row["n_words"], row["n_removed"], bytes(row["kept"])) for row in found} == plain.word_dedup(rows, length)


def test_dedup_without_id_repeated_rows_and_nothing(table):
    text = " ".join(f"w{k}" for k in range(120))
    rows = [(1, text), (1, text), (None, text), (None, None), (2, text + " end"), (3, None)]
    cut = sorted((str(r["row"]["doc_id"]), r["n_removed"]) for r in byte_dedup.remove(table(rows)).collect())
    size = len(text)
    assert cut == [("1", 0), ("1", 0), ("2", size), ("3", 0), ("None", 0), ("None", size)]
    cut = sorted((str(r["row"]["doc_id"]), r["n_removed"]) for r in word_dedup.remove(table(rows)).collect())
    assert cut == [("1", 0), ("1", 0), ("2", 120), ("3", 0), ("None", 0), ("None", 120)]
    assert byte_dedup.remove(table([])).count() == word_dedup.remove(table([])).count() == 0


def test_copies_without_id_list_their_spans_once(table):
    """What a text's spans and contexts take does not grow with its copies."""
    text = " ".join(f"w{k}" for k in range(400))
    sizes = []
    for copies in (2, 200):
        rows = repeats.keyed(table([(1, text[:700]), (2, text[500:] + " end")] + [(None, text)] * copies), ("doc_id",))
        found = repeats.spans(rows, repeats.Passage("byte", 100, 40), byte_dedup.earlier_windows, by_document=False).collect()
        sizes.append({row["doc_id"]: len(row["spans"]) for row in found})
        held = repeats.anchors(rows, repeats.Passage("byte", 100, 40), by_document=False)
        bodies = repeats.bodies(rows.coalesce(1), repeats.contexts(held), repeats.Passage("byte", 100, 40), [])
        assert bodies.groupBy("anchor", "context").count().filter("count > 8").isEmpty()
    assert sizes[0] == sizes[1] and sizes[0][2**63 - 1]
    rows = [(1, text), *[(None, text)] * 300]
    assert {r["n_removed"] for r in byte_dedup.remove(table(rows)).collect() if r["row"]["doc_id"] is None} == {len(text)}


def test_staged_tables_have_few_files(spark, table, monkeypatch):
    words = [f"w{number}" for number in range(4000)]
    rows = [(doc_id, " ".join(words[40 * (doc_id % 60) : 40 * (doc_id % 60) + 120])) for doc_id in range(180)]
    held, write = [], repeats.staging.write_table

    def noted(*args):
        staged, path = write(*args)
        held.append(len(staged.inputFiles()))
        return staged, path

    monkeypatch.setattr(repeats.staging, "write_table", noted)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = {row["row"]["doc_id"]: (row["n_words"], row["n_removed"], bytes(row["kept"])) for row in word_dedup.remove(table(rows)).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found == plain.word_dedup(rows, word_dedup.LENGTH)
    assert max(held) <= repeats.FILES_PER_CORE * spark.sparkContext.defaultParallelism


def test_whole_characters_leave_text(table):
    one, two = "é" * 120, "a" + "é" * 120
    found = byte_dedup.remove(table([(1, one), (2, two)]), whole_characters=True).collect()
    kept = {row["row"]["doc_id"]: bytes(row["kept"]).decode() for row in found}
    assert kept[2] == "a" and set(kept[1]) <= {"é"}


def test_steps_cut_by_size():
    from order_analytics.llm.batches import steps

    batch = pa.RecordBatch.from_pydict({"n": list(range(6)), "text": ["aa", None, "", "bbbbbbbb", "c", "d"]})
    assert [rows.column("n").to_pylist() for rows, _ in steps([batch], "text", 3)] == [[0, 1, 2], [3], [4, 5]]
