"""Byte-level BPE through a sentencepiece model that is written straight from a rank file.

Every byte is mapped to one character (U+0100 plus the byte), so that a token of any bytes is a piece of
valid text. The piece of rank r has the score -r: merging the pair with the best score is then merging
the pair with the lowest rank. Nothing is normalised. The piece of rank r stands at place r, hence piece
ids are token ids; the piece for unknown text comes last and is never met, as all bytes are pieces.

Texts are split by the pattern first; each pre-token is encoded by itself. A pre-token that is in the
vocabulary as a whole is that token.

A null text is an empty one and has no tokens. Rows may repeat. Other columns are ignored, so their names
cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from order_analytics.llm.batches import binary_column, steps

#: Remembered pre-tokens of one worker; the memory is emptied when it is full.
REMEMBERED = 400_000

#: Fields of the public sentencepiece model message.
PIECE, PIECE_TEXT, PIECE_SCORE, PIECE_KIND, KIND_UNKNOWN = 1, 1, 2, 3, 2
TRAINER, MODEL_KIND, KIND_BPE, VOCABULARY_SIZE, UNKNOWN_ID = 2, 3, 2, 4, 40
NORMALIZER, NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 3, 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 token and rank in each line) in order of rank."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    return [token for _, token in ranked]


def byte_map(data: bytes) -> str:
    """Bytes as characters from U+0100 on."""
    return (np.frombuffer(data, np.uint8).astype("<u2") + 256).tobytes().decode("utf-16-le")


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    return bytes([*out, number])


def _number(field: int, number: int) -> bytes:
    return _varint(field << 3) + _varint(number)


def _nested(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def _score(field: int, score: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", score)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece r is token r."""
    pieces = [
        _nested(PIECE, _nested(PIECE_TEXT, byte_map(token).encode()) + _score(PIECE_SCORE, -rank))
        for rank, token in enumerate(tokens)
    ]
    unknown = _nested(PIECE, _nested(PIECE_TEXT, b"<unk>") + _number(PIECE_KIND, KIND_UNKNOWN))
    trainer = _number(MODEL_KIND, KIND_BPE) + _number(VOCABULARY_SIZE, len(tokens) + 1) + _number(UNKNOWN_ID, len(tokens))
    plain = _nested(NAME, b"identity") + _number(DUMMY_PREFIX, 0) + _number(EXTRA_SPACES, 0) + _number(ESCAPE_SPACES, 0)
    return b"".join([*pieces, unknown, _nested(TRAINER, trainer), _nested(NORMALIZER, plain)])


@functools.lru_cache(maxsize=1)
def _classes() -> dict[str, str]:
    """Members of the pattern's character classes within the basic plane, as the regex library has them."""
    plane = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x10000))))

    def members(name: str) -> str:
        found = [ord(c) for c in regex.findall(name, plane)]
        cuts = [i for i in range(1, len(found)) if found[i] != found[i - 1] + 1]
        runs = zip([0, *cuts], [*cuts, len(found)], strict=True)
        return "".join(f"\\u{found[a]:04x}-\\u{found[b - 1]:04x}" for a, b in runs)

    return {name: members(name) for name in (r"\p{L}", r"\p{N}", r"\s")}


@functools.lru_cache(maxsize=4)
def splitter(pattern: str):
    """A function from a text to its pre-tokens.

    The standard library's engine is the faster one. It has no property classes, so they are written out;
    texts beyond the basic plane go to the regex library.
    """
    exact = regex.compile(pattern).findall
    written = pattern.replace(r"\S", "[^" + _classes()[r"\s"] + "]")
    in_set = re.sub(r"\[[^\]]*\]", lambda found: _expand(found[0]), written)
    outside = re.sub(r"(\\p\{[LN]\}|\\s)", lambda found: "[" + _classes()[found[0]] + "]", in_set)
    fast = re.compile(outside).findall
    beyond = re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: exact(text) if not text.isascii() and beyond(text) else fast(text)


def _expand(characters: str) -> str:
    for name, members in _classes().items():
        characters = characters.replace(name, members)
    return characters


class _Encoder:
    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._known = {token: struct.pack("<I", rank) for rank, token in enumerate(tokens)}
        self._split = splitter(pattern)
        self._packed: dict[str, bytes] = {}

    def _learn(self, unseen: list[str]) -> None:
        encoded = [text.encode() for text in unseen]
        rest = []
        for text, data in zip(unseen, encoded, strict=True):
            whole = self._known.get(data)
            if whole is None:
                rest.append(text)
            else:
                self._packed[text] = whole
        # 0xFF is in no UTF-8 text, so it can part the pre-tokens while all are mapped at once
        mapped = byte_map(b"\xff".join(text.encode() for text in rest)).split(byte_map(b"\xff")) if rest else []
        for text, ids in zip(rest, self._model.encode(mapped, num_threads=1), strict=True):
            self._packed[text] = struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        parts = [self._split(text) for text in texts]
        met = set().union(*parts)
        unseen = met.difference(self._packed)
        if len(self._packed) + len(unseen) > REMEMBERED:
            self._packed.clear()
            unseen = met
        self._learn(list(unseen))
        return [b"".join(map(self._packed.__getitem__, found)) for found in parts]


def encode(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers, one after the other."""
    tokens = read_ranks(ranks_path)
    shared = documents.sparkSession.sparkContext.broadcast((serialise_model(tokens), tokens))

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(*shared.value, pattern)
        for rows, _ in steps(batches, "text"):
            ids = encoder([text or "" for text in rows.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        encode_batches, f"doc_id {_kind(documents, 'doc_id')}, n_tokens bigint, ids binary"
    )


def decode(encoded: DataFrame, ranks_path: str, keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The columns of ``keep`` and ``decoded``, the bytes that ``ids`` stand for. Null ids are none."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        lengths = np.array([len(token) for token in tokens], np.int64)
        places = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        for rows, packed in steps(batches, "ids"):
            ids = np.frombuffer(packed.data.tobytes(), "<u4")
            sizes = lengths[ids]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            # each byte: the place of its token's first byte, plus how far into the token it is
            taken = np.arange(ends[-1]) + np.repeat(places[ids] - ends[:-1], sizes)
            decoded = binary_column(flat[taken], ends[packed.bounds // 4])
            yield pa.RecordBatch.from_arrays([*map(rows.column, keep), decoded], [*keep, "decoded"])

    kinds = ", ".join(f"`{name}` {_kind(encoded, name)}" for name in keep)
    return encoded.select(*keep).mapInArrow(decode_batches, f"{kinds}, decoded binary")


def _kind(frame: DataFrame, name: str) -> str:
    return frame.schema[name].dataType.simpleString()
