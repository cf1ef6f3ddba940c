"""Secrets in texts: keywords first, regular expressions only where one stands, checksums where the format has one.

An Aho-Corasick automaton over the lower-cased bytes of many texts at once finds every keyword; a kind's expression is then tried at its keywords
alone, anchored, from left to right, and a match hides the keywords inside it, as in a search of the whole text. A match that fails its kind's
further conditions is dropped, but hides them too. Runs of hexadecimal digits have no keyword: any run of ``LEAST_HEX`` covers a place
whose number is a multiple of that, so only these places are looked at, and grown both ways where a digit stands there.

Kinds, in order:

- ``assign``: a word for a secret, a colon or an equals sign, and a value of at least 8 characters
- ``access``: access key ids, 16 characters or more
- ``hex``: runs of at least 32 lower-case hexadecimal digits
- ``forge``, ``package``: tokens of code forges and of a package registry; the last six of their 36 characters are the CRC-32 of the
  others in base 62, which must hold

``spans`` has each find as kind, start and end in code points, by start, then by the order of kinds. Finds of different kinds may overlap.

A null text is an empty one and has no finds. Rows may repeat; each is judged by itself, so ties do not arise. Very long texts are worked
on whole. An empty table gives no rows. Other columns are carried if named, else ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from order_analytics.llm.batches import Texts, steps

LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

#: The digits of base 62 in the checksums of tokens, and how many there are.
BASE_62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CHECKSUM_DIGITS = 6

HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))


def token_checksum(random_part: bytes) -> bytes:
    """The CRC-32 of a token's random part as six digits of base 62."""
    value, digits = zlib.crc32(random_part), ""
    for _ in range(CHECKSUM_DIGITS):
        value, digit = divmod(value, 62)
        digits = BASE_62[digit] + digits
    return digits.encode()


def token_holds(match: re.Match) -> bool:
    body = match[1]
    return token_checksum(body[:-CHECKSUM_DIGITS]) == body[-CHECKSUM_DIGITS:]


class Kind(NamedTuple):
    """A kind of secret: its keywords in lower case, its expression and what else must hold."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    holds: Callable[[re.Match], bool]


#: Of ``hex`` no keyword is known, see ``hex_runs``.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE),
        lambda match: len(match[2]) >= LEAST_VALUE,
    ),
    Kind("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda match: len(match[0]) >= LEAST_ACCESS),
    Kind("hex", (), re.compile(rb"[0-9a-f]+"), lambda match: len(match[0]) >= LEAST_HEX),
    Kind("forge", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(rb"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"), token_holds),
    Kind("package", ("npm_",), re.compile(rb"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"), token_holds),
)
NAMES = tuple(kind.name for kind in KINDS)


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """All keywords; each gives its length and the number of its kind."""
    words = ahocorasick.Automaton()
    for number, kind in enumerate(KINDS):
        for keyword in kind.keywords:
            words.add_word(keyword, (len(keyword), number))
    words.make_automaton()
    return words


def keyword_hits(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(start, kind) of every keyword, by start; one that reaches into the next text is none, as its expression ends with its text."""
    lowered = texts.data.tobytes().lower().decode("latin-1")  # one character a byte
    hits = [(last + 1 - length, kind) for last, (length, kind) in automaton().iter(lowered)]
    found = np.array(sorted(hits), np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def hex_runs(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of at least ``LEAST_HEX`` digits; no run crosses texts."""
    data, edges = texts.data, texts.bounds
    digit = np.concatenate([HEX[data], np.zeros(LEAST_HEX, bool)])  # what lies before the first byte, too, is none
    probes = np.arange(0, len(data), LEAST_HEX)
    half = LEAST_HEX // 2
    before, after = [digit[probes - way] for way in (1, half // 2, half)], [digit[probes + way] for way in (1, half // 2, half - 1)]
    # a run that covers a probe holds the half before it or the half after it; three places of each settle most probes
    probes = probes[digit[probes] & (np.logical_and.reduce(before) | np.logical_and.reduce(after))]
    starts, ends, past = [], [], 0
    for probe in probes.tolist():
        if probe < past:
            continue
        text = int(np.searchsorted(edges, probe, "right")) - 1
        low, high = int(edges[text]), int(edges[text + 1])
        start = _grown(data, probe, low, -1)
        end = _grown(data, probe, high, 1)
        past = end
        if end - start >= LEAST_HEX:
            starts.append(start)
            ends.append(end)
    return np.array(starts, np.int64), np.array(ends, np.int64)


def _grown(data: np.ndarray, place: int, limit: int, way: int) -> int:
    """How far digits go on from a place: the run's start, or the place after its end."""
    width = LEAST_HEX
    while True:
        if way > 0:
            other = np.flatnonzero(~HEX[data[place : min(place + width, limit)]])
            if len(other):
                return place + int(other[0])
            if place + width >= limit:
                return limit
        else:
            other = np.flatnonzero(~HEX[data[max(place + 1 - width, limit) : place + 1]][::-1])
            if len(other):
                return place + 1 - int(other[0])
            if place + 1 - width <= limit:
                return limit
        width *= 4


def finds(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, kind, start, end) of every secret, by text, start and kind; places are bytes of all texts together."""
    places, kinds = keyword_hits(texts)
    owners = np.searchsorted(texts.bounds, places, "right") - 1
    data = texts.data.tobytes()
    ends = texts.bounds[owners + 1]
    past = [0] * len(KINDS)
    rows = []
    for place, number, owner, end in zip(places.tolist(), kinds.tolist(), owners.tolist(), ends.tolist(), strict=True):
        if place < past[number]:
            continue
        kind = KINDS[number]
        match = kind.pattern.match(data, place, end)
        if match is None:
            continue
        past[number] = match.end()
        if kind.holds(match):
            rows.append((owner, number, *match.span()))
    starts, ends = hex_runs(texts)
    owners = np.searchsorted(texts.bounds, starts, "right") - 1
    runs = np.stack([owners, np.full(len(owners), NAMES.index("hex")), starts, ends], axis=1)
    found = np.concatenate([np.array(rows, np.int64).reshape(-1, 4), runs])
    found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2], found[:, 3]


def scan(documents: DataFrame, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns) and ``finds``, an array of (kind, start, end), of every row."""
    find = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in steps(batches, "text"):
            owners, kinds, starts, ends = finds(texts)
            points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
            ahead = points[texts.bounds[owners]]
            columns = [pa.array(NAMES).take(pa.array(kinds)), pa.array(points[starts] - ahead), pa.array(points[ends] - ahead)]
            held = pa.StructArray.from_arrays(columns, ["kind", "start", "end"])
            bounds = np.searchsorted(owners, np.arange(rows.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.ListArray.from_arrays(pa.array(bounds), held)], ["row", "finds"])

    rows = documents.select(F.struct(*carried).alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan_batches, T.StructType([rows.schema["row"], T.StructField("finds", T.ArrayType(find))]))
