"""Plain versions of the operators: slow, short, without Spark."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter

WORD = re.compile(rb"[^ \t-\r]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def byte_dedup(rows, length):
    """rows of (doc_id, text), distinct ids -> {doc_id: (n_bytes, n_removed, n_spans, kept)}"""
    first = {}
    for doc_id, text in sorted(rows, key=lambda row: row[0]):
        data = (text or "").encode()
        for start in range(len(data) - length + 1):
            first.setdefault(data[start : start + length], (doc_id, start))
    out = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - length + 1):
            if first[data[start : start + length]] < (doc_id, start):
                gone[start : start + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(byte for byte, cut in zip(data, gone, strict=True) if not cut)
        out[doc_id] = (len(data), sum(gone), runs, kept)
    return out


def word_dedup(rows, length):
    first = {}
    for doc_id, text in sorted(rows, key=lambda row: row[0]):
        found = words(text)
        for start in range(len(found) - length + 1):
            first.setdefault(tuple(found[start : start + length]), doc_id)
    out = {}
    for doc_id, text in rows:
        found = words(text)
        gone = [False] * len(found)
        for start in range(len(found) - length + 1):
            if first[tuple(found[start : start + length])] < doc_id:
                gone[start : start + length] = [True] * length
        kept = b" ".join(word for word, cut in zip(found, gone, strict=True) if not cut)
        out[doc_id] = (len(found), sum(gone), kept)
    return out


def covered(found: list, n: int) -> list[bool]:
    counts = Counter(tuple(found[k : k + n]) for k in range(len(found) - n + 1))
    inside = [False] * len(found)
    for k in range(len(found) - n + 1):
        if counts[tuple(found[k : k + n])] > 1:
            inside[k : k + n] = [True] * n
    return inside


def repetition(text: str | None, coverage: dict[int, int], line_percent: int = 20) -> dict:
    found = [word.decode() for word in words(text)]
    base = sum(covered(found, 5))
    chars = sum(map(len, found))
    seen, lines, line_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        inside = [word.decode() for word in words(line)]
        if inside and line in seen:
            lines, line_chars = lines + 1, line_chars + sum(map(len, inside))
        seen.add(line)
    dup = {n: sum(len(word) for word, cut in zip(found, covered(found, n), strict=True) if cut) for n in coverage}
    failed = len(found) < 10 or 100 * base > 20 * len(found)
    passed = all(100 * dup[n] <= percent * chars for n, percent in coverage.items()) and 100 * line_chars <= line_percent * chars
    return {
        "n_words": len(found),
        "word_chars": chars,
        "n_symbols": sum((text or "").count(symbol) for symbol in "#*$%&|<>"),
        "n_dup_lines": lines,
        "n_repeat_words": base,
        **{f"dup_chars_{n}": count for n, count in dup.items()},
        "dup_line_chars": line_chars,
        "base_failed": failed,
        "kept": not failed and passed,
    }


class Classes:
    """Union-find; the name of a class is its smallest member."""

    def __init__(self, members):
        self.parent = {member: member for member in members}

    def find(self, member):
        while self.parent[member] != member:
            member = self.parent[member]
        return member

    def join(self, one, other):
        one, other = sorted((self.find(one), self.find(other)))
        self.parent[other] = one


def near_classes(rows, print_of, bits=2) -> dict:
    """Classes of fingerprints at most so many bits apart: print -> the class's smallest one."""
    prints = sorted({print_of(row) for row in rows})
    classes = Classes(prints)
    for place, one in enumerate(prints):
        for other in prints[:place]:
            if (one ^ other).bit_count() <= bits:
                classes.join(one, other)
    return {value: classes.find(value) for value in prints}


def best_fit(pieces, capacity: int, per_source: int) -> list[int]:
    """Bin numbers of (length, source, cluster) pieces in their order, by looking at all bins."""
    bins, out = [], []
    for length, source, cluster in pieces:
        fits = [
            (capacity - sum(held[0] for held in content), number)
            for number, content in enumerate(bins)
            if capacity - sum(held[0] for held in content) >= length
            and all(held[2] != cluster or cluster < 0 for held in content)
            and sum(held[1] == source for held in content) < per_source
        ]
        if fits:
            number = min(fits)[1]
        else:
            number = len(bins)
            bins.append([])
        bins[number].append((length, source, cluster))
        out.append(number)
    return out


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def digest(text: str) -> str:
    return sha256(text.encode())


def _tree(nodes: list[str], fan: int = 8) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[k : k + fan])) for k in range(0, len(below), fan)])
    return levels


def _path(levels: list[list[str]], place: int, fan: int = 8) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        first = place // fan * fan
        out.append(("".join(level[first:place]), "".join(level[place + 1 : first + fan])))
        place //= fan
    return out


def merkle_leaf(row) -> str:
    return digest("".join("-" if value is None else f"{len(str(value).encode())}:{value}" for value in row))


def manifest(rows, claim):
    """rows of (doc_id, source, lang, n_chars, text) -> the manifest; ``claim`` gives the leaf that a row is held to."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for held in groups.values():
        held.sort(key=lambda row: (row[0] is not None, row[0] or 0, merkle_leaf(row)))
    trees = [_tree([merkle_leaf(row) for row in groups[lang]]) for lang in order]
    top = _tree([levels[-1][0] for levels in trees])
    out = []
    for number, lang in enumerate(order):
        for place, row in enumerate(groups[lang]):
            path = _path(trees[number], place) + _path(top, number)
            node = claim(row)
            for left, right in path:
                node = digest(left + node + right)
            proof = digest("".join(left + right for left, right in path))
            out.append((row[0], merkle_leaf(row), trees[number][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def clustering(rows, clusters: int, rounds: int, seed: str, dimensions: int):
    """rows of (vec_id, vector) -> (vec_id, cluster, distance, cluster_inertia, inertia, centroid), by looking at all centroids."""
    fit = [(i, v) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    held = [(i, [math.floor(256 * x) for x in v]) for i, v in fit]
    if not held:
        return []
    centroids = [v for _, v in sorted(held, key=lambda r: (r[0] is None, "" if r[0] is None else digest(f"{seed}{r[0]}"), r[1]))[:clusters]]

    def assigned():
        ways = [[sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centroids] for _, v in held]
        return [min(range(len(centroids)), key=lambda k, way=way: (way[k], k)) for way in ways], [min(way) for way in ways]

    for _ in range(rounds):
        chosen, _ = assigned()
        for number in range(len(centroids)):
            members = [v for (_, v), k in zip(held, chosen, strict=True) if k == number]
            if members:
                centroids[number] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    chosen, ways = assigned()
    within = Counter()
    for number, way in zip(chosen, ways, strict=True):
        within[number] += way
    return [(i, k, way, within[k], sum(ways), centroids[k]) for (i, _), k, way in zip(held, chosen, ways, strict=True)]


def secret_finds(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) by searches of the whole text."""
    text, out = text or "", []
    assign = r"(?ai)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    for kind, prefix in ((3, "gh[pousr]_"), (4, "npm_")):
        for m in re.finditer(prefix + r"([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])", text):
            value, digits = zlib.crc32(m[1].encode()), ""
            while len(digits) < 6:
                value, digit = divmod(value, 62)
                digits = (string.digits + string.ascii_uppercase + string.ascii_lowercase)[digit] + digits
            out += [(m.start(), kind, m.end())] if digits == m[2] else []
    return sorted(out)
