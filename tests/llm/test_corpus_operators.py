"""Near-duplicates, packing, archives, sharding and neighbours, against plain versions."""

from __future__ import annotations

import base64
import hashlib
import inspect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_text_operators import similar_texts

from order_analytics.llm import golay, packing, sharding, simhash, vector_tree, warc
from order_analytics.llm.components import connected_components

DOCUMENT = "doc_id bigint, text string, source string, node string, print string, key string, parcel string, length string"


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(*row, "s", *"abcde") for row in rows], DOCUMENT)


def test_golay_code():
    words = golay.codewords()
    weights = np.bincount(np.bitwise_count(words), minlength=24)
    assert weights.tolist() == [1, 0, 0, 0, 0, 0, 0, 253, 506, 0, 0, 1288, 1288, 0, 0, 506, 253, 0, 0, 0, 0, 0, 0, 1]
    some = np.random.default_rng(1).integers(0, 1 << 23, 300).astype(np.uint32)
    keys = golay.keys(some)
    assert not golay.syndrome(keys.ravel()).any()
    for one in range(23):
        for other in range(23):
            near = golay.keys(some ^ np.uint32(1 << one) ^ np.uint32(1 << other if one != other else 0))
            assert (keys[:, :, None] == near[:, None, :]).any(axis=(1, 2)).all()


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)]
    links += [(None, 5), (7, None), (9, 9), (2000, 1999), (1999, 2000)]
    classes = plain.Classes({node for link in links for node in link if node is not None})
    for one, other in links:
        if one is not None and other is not None:
            classes.join(one, other)
    found = {row["node"]: row["root"] for row in connected_components(spark.createDataFrame(links, "node bigint, other bigint")).collect()}
    assert found == {node: classes.find(node) for node in classes.parent if classes.find(node) != node}
    assert connected_components(spark.createDataFrame([], "node bigint, other bigint")).count() == 0


def simhash_rows():
    texts = similar_texts(7, 40, 60)
    rows = list(enumerate(texts))
    draw = random.Random(9)
    long = [f"w{draw.randrange(400)}" for _ in range(900)]
    for k in range(60):  # a crowd: one text with an edit each
        edited = list(long)
        edited[draw.randrange(900)] = f"v{k}"
        rows.append((100 + k, " ".join(edited)))
    return rows + [(300, None), (301, ""), (302, " \n"), (303, "A b"), (304, "a B"), (305, texts[0]), (306, "x" * 50_000), (306, "x" * 50_000)]


@pytest.mark.parametrize("crowded", [2_000, 3])
def test_simhash_components(table, crowded):
    rows = simhash_rows()
    prints = {doc_id: simhash.fingerprint((text or "").encode(), 3) for doc_id, text in rows}
    classes = plain.Classes(prints)
    for one in prints:
        for other in prints:
            if (prints[one] ^ prints[other]).bit_count() <= 2:
                classes.join(one, other)
    found = simhash.components(table(rows), crowded=crowded).collect()
    assert len(found) == len(rows)
    assert {tuple(row) for row in found} == {(i, f"{prints[i]:016x}", classes.find(i)) for i in prints}
    assert len({classes.find(100 + k) for k in range(60)}) < 60


def test_fingerprint_is_the_majority_of_hashes():
    import xxhash

    text = b"One two  THREE\tfour two three four"
    words = [b"one", b"two", b"three", b"four", b"two", b"three", b"four"]
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(5)]
    assert simhash.fingerprint(text, 3) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 5)
    assert simhash.fingerprint(b"One", 3) == xxhash.xxh64_intdigest(b"one", 42) and simhash.fingerprint(b" ", 3) == 0


def test_simhash_odd_rows(table):
    found = simhash.components(table([(None, "a b c d"), (None, "z"), (4, "a b c d"), (2, "a b c d")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in found) == [("2", "2"), ("4", "2"), ("None", "2"), ("None", "None")]
    assert simhash.components(table([])).count() == simhash.representatives(table([])).count() == 0


def test_representatives(table):
    rows = simhash_rows() + [(None, None), (None, "z y x w"), (None, "z y x w"), (400, "Z y x w"), (2, "another text under this id"), (None, "alone here now")]
    rows += [(None, "many copies of this")] * 3_000 + [(500, "copies with an id")] * 3_000
    print_of = lambda row: simhash.fingerprint((row[1] or "").encode(), 3)
    classes = plain.near_classes(rows, print_of)
    first = {}
    for row in rows:
        first.setdefault(classes[print_of(row)], []).append((row[0] is None, row[0] or 0, row))
    expected = [min(held, key=lambda place: place[:2])[2] for held in first.values()]
    for crowded in (2_000, 3):
        kept = simhash.representatives(table(rows), crowded=crowded)
        assert kept.columns == table(rows).columns
        found = kept.select("doc_id", "text").collect()
        assert sorted(str(row["doc_id"]) for row in found) == sorted(str(row[0]) for row in expected)
        assert len({classes[print_of(row)] for row in found}) == len(found) == len(first)
    assert sum(row["text"] == "many copies of this" for row in found) == 1 and (2, "another text under this id") in [tuple(row) for row in found]


def test_packing_is_best_fit(spark):
    draw = random.Random(11)
    pieces = [(draw.randint(0, 60), draw.randrange(4), draw.randrange(30) if draw.random() < 0.9 else -1) for _ in range(400)]
    pieces = sorted(pieces, key=lambda piece: (-piece[0], piece[2]))
    pieces += [(5, 1, 77)] * 40
    lengths, sources, clusters = (np.array(column) for column in zip(*pieces, strict=True))
    packed = packing.pack_lot(lengths, sources, clusters, 64, 3)
    assert packed[:, 0].tolist() == plain.best_fit(pieces, 64, 3)


def test_packing_keeps_everything_apart(table):
    rows = [(k, "w " * (k % 70)) for k in range(300)] + [(1000 + k, "same text here") for k in range(50)]
    rows += [(None, "no id"), (None, None), (5, ""), (5, ""), (7, "long " * 1000)]
    for lot in (1_000_000, 500):
        found = [row.asDict() for row in packing.pack(table(rows), capacity=64, per_source=4, lot_length=lot).collect()]
        assert Counter(row["doc_id"] for row in found) == Counter({i: 0 for i, _ in rows} | Counter(
            {i: n for i, n in Counter(i for i, text in rows for _ in range(max(1, -(-len(plain.words(text)) // 64)))).items()}))
        assert sum(row["length"] for row in found) == sum(len(plain.words(text)) for _, text in rows)
        bins = defaultdict(list)
        for row in found:
            bins[row["bin"]].append(row)
        for held in bins.values():
            held.sort(key=lambda row: row["place"])
            assert [row["place"] for row in held] == list(range(len(held))) and len(held) <= 4
            assert [row["offset"] for row in held] == np.cumsum([0, *(row["length"] for row in held[:-1])]).tolist()
            assert sum(row["length"] for row in held) <= 64
            assert len({row["cluster"] for row in held}) == len(held)
    assert packing.pack(table([])).count() == 0


def test_packing_deals_equal_rows_over_the_lots(table):
    rows = [(None, "word " * 20)] * 3_000 + [(7, "other " * 20)] * 3_000 + [(k, "w " * 20) for k in range(500)]
    found = packing.pack(table(rows), capacity=64, lot_length=14_300, most_alike=100).collect()
    assert Counter(row["doc_id"] for row in found) == Counter(i for i, _ in rows)
    lots = Counter(row["bin"] % 10 for row in found)
    assert len(lots) == 10 and max(lots.values()) < 800
    bins = Counter((row["bin"], row["cluster"]) for row in found)
    assert max(bins.values()) == 1


PAGE = "page_id bigint, url string, html string, digest string, record string"


def warc_rows():
    rows = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 300_000)]
    rows += [(6, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"), (7, "u", "\r\n\r\n"), (8, "u", "\x00\x1a")]
    rows += [(None, "u", "alone"), (None, "u", "<p>é</p>"), (9, "u", "twice"), (9, "u", "twice")]
    return rows + [(100 + k, f"h{k}", "hot") for k in range(500)]


@pytest.mark.parametrize(("least", "bits"), [(0, warc.FILTER_BITS), (5, warc.FILTER_BITS), (0, 8)])
def test_archives(spark, tmp_path, monkeypatch, least, bits):
    """With eight bits the filters hold nearly everything, so the exact join decides."""
    rows = warc_rows()
    path = str(tmp_path / "archives")
    monkeypatch.setattr(warc, "BITMAP_BITS", min(warc.BITMAP_BITS, bits))
    warc.write_archives(spark.createDataFrame([(*row, "d", "r") for row in rows], PAGE), path, least_bytes=least, filter_bits=bits)
    found = warc.read_archives(spark, path).collect()
    largest = {}
    for page, _, html in rows:
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", page), page)
    times = Counter(html or "" for _, _, html in rows)
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        original = largest.get(html or "")
        again = len(data) >= least and times[html or ""] > 1 and original is not None and page != original
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((str(page), len(data), digest, "revisit" if again else "response", original if again else None))
    assert sorted(map(str, expected)) == sorted(str((str(r[0]), *r[1:5])) for r in found)
    assert all(row["intact"] in (True, None) for row in found)


def test_filters_have_no_false_negatives(spark):
    rows = spark.range(0, 60_000).select(F.col("id").alias("page_id"), F.md5(F.col("id").cast("string")).alias("digest"))
    some = rows.filter("page_id % 3 = 0")
    for bits in (1 << 28, 1 << 15):
        tested = warc.Filter(some, 1, bits).test(rows, "hit").groupBy(F.expr("page_id % 3 = 0").alias("inside"), "hit").count()
        counts = {(row["inside"], row["hit"]): row["count"] for row in tested.collect()}
        assert counts[True, True] == 20_000 and (True, False) not in counts
        assert counts.get((False, True), 0) < (1_500 if bits > 1 << 15 else 40_001)


def test_payloads_are_not_shuffled_and_large_records_have_files_of_their_own(spark, tmp_path):
    import gzip
    from pathlib import Path

    rows = [(k, f"http://a/{k}", "same payload" if k % 3 == 0 else f"page {k} " * 10) for k in range(300)]
    rows += [(1000 + k, "u", chr(97 + k) * (1 << 22)) for k in range(2)] + [(2000 + k, "u", chr(97 + k) * 300_000) for k in range(3)]
    path = tmp_path / "archives"
    warc.write_archives(spark.createDataFrame([(*row, "d", "r") for row in rows], PAGE), str(path))
    files = [list(warc.parse_archive(file.read_bytes())) for file in path.glob("*.gz")]
    assert sum(map(len, files)) == len(rows)
    for file in files:
        if any(record["payload_bytes"] >= 1 << 22 for record in file):
            assert len(file) == 1
    text = b"".join(gzip.decompress(Path(file).read_bytes()) for file in path.glob("*.gz")).decode()
    assert text.count("same payload") == 1
    assert text.count("WARC-Refers-To-Target-URI: http://a/297\r\n") == text.count("WARC-Refers-To-Date: ") == 99


def test_damaged_archives_are_named(spark, tmp_path):
    import gzip
    from pathlib import Path

    path = str(tmp_path / "archives")
    rows = [(k, "u", f"<p>{k}</p>" * 50, "d", "r") for k in range(40)]
    warc.write_archives(spark.createDataFrame(rows, PAGE).coalesce(1), path)
    (file,) = Path(path).glob("*.gz")
    packed = file.read_bytes()
    plain_text = gzip.decompress(packed)
    assert len(list(warc.parse_archive(packed))) == 40
    damages = [packed[: len(packed) // 2], gzip.compress(plain_text[:-3]), gzip.compress(plain_text[:-60]), gzip.compress(plain_text.replace(b"Content-Length: ", b"Content-Length: 1", 1))]
    for damaged in damages:
        with pytest.raises((ValueError, EOFError)):
            list(warc.parse_archive(damaged))
    other = tmp_path / "other"
    other.mkdir()
    (other / "cut.gz").write_bytes(damages[0])
    with pytest.raises(Exception, match="cut.gz: the archive ends early"):
        warc.read_records(spark, str(other)).collect()
    changed = tmp_path / "changed"
    changed.mkdir()
    (changed / "one.gz").write_bytes(gzip.compress(plain_text.replace(b"<p>7</p>", b"<p>8</p>", 1)))
    assert [row["page_id"] for row in warc.read_archives(spark, str(changed)).filter("not intact").collect()] == [7]


def test_no_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGE), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_sharding(spark, table):
    draw = random.Random(2)
    rows = [(k, "ab " * draw.randint(0, 60)) for k in range(2000)] + [(5000 + k, "copy of a text") for k in range(1200)]
    rows += [(None, "x"), (None, None), (3, "twice"), (3, "twice"), (9, "long " * 2000)]
    found = sharding.shard(table(rows), shards=10).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    by_shard = defaultdict(list)
    for row in found:
        by_shard[row["shard"]].append(row)
    assert set(by_shard) == set(range(10))
    for held in by_shard.values():
        assert sorted(row["slot"] for row in held) == list(range(len(held)))
    sizes = [sum(row["size"] for row in held) for held in by_shard.values()]
    assert max(sizes) < 1.03 * min(sizes)
    counts = [len(held) for held in by_shard.values()]
    assert max(counts) < 1.1 * min(counts)
    assert {(row["law"], row["grown_shard"]) for row in found} == {("bytes", None)}
    assert sharding.shard(table([]), shards=3).count() == 0


def test_sharding_of_equal_rows_without_an_id(spark):
    rows = spark.range(60_000).selectExpr("CAST(NULL AS bigint) AS doc_id", "'one text for all of these rows' AS text", "'s' AS source")
    rows = rows.unionAll(spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'s' AS source"))
    found = sharding.shard(rows, shards=10).groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max("slot").alias("last")).collect()
    assert sum(row["n"] for row in found) == 80_000 and all(row["last"] == row["n"] - 1 for row in found)
    assert max(row["size"] for row in found) < 1.02 * min(row["size"] for row in found)
    assert max(row["n"] for row in found) < 1.05 * min(row["n"] for row in found)


def test_groups_stay_in_a_shard_while_they_fit(spark, table):
    groups = [(f"text {k} " * 12, 1 + k % 7) for k in range(1_500)]  # each 0.3 percent of a shard at most
    rows = [(k * 10 + n, text) for k, (text, copies) in enumerate(groups) for n in range(copies)] + [(90_000 + k, "hot " * 30) for k in range(3_000)]
    found = sharding.shard(table(rows), shards=4)
    spread = {row["text_crc32"]: row["shards"] for row in found.groupBy("text_crc32").agg(F.countDistinct("shard").alias("shards")).collect()}
    assert spread.pop(zlib.crc32(b"hot " * 30)) == 4 and set(spread.values()) == {1}
    sizes = [row["size"] for row in found.groupBy("shard").agg(F.sum("size").alias("size")).collect()]
    assert max(sizes) < 1.01 * min(sizes)


def test_directions_take_the_highest_dot_product():
    draw = np.random.default_rng(4)
    vectors = draw.integers(1, 50, (60, 3)).astype(float)
    weights = np.array([3.0, 1.0, 2.0])
    chosen = sharding.best_directions(vectors, 5, weights)
    shares = vectors / (vectors.sum(axis=0) / 5)
    residual = [np.ones(3) for _ in range(5)]
    for place in sorted(range(60), key=lambda k: (-(shares[k] @ weights), k)):
        best = max(range(5), key=lambda shard: (residual[shard] @ (shares[place] * weights), -shard))
        assert chosen[place] == best
        residual[best] = residual[best] - shares[place]


VECTOR = "vec_id bigint, embedding array<float>, leaf string, score string"


def exact(rows, queries, k):
    out = {}
    matrix = np.array([vector for _, vector in rows], np.float64)
    for query, vector in queries:
        scores = (matrix * np.asarray(vector, np.float64)).sum(axis=1)
        out[query] = sorted((-score, i) for score, (i, _) in zip(scores.tolist(), rows, strict=True) if i != query)[:k]
    return out


def test_neighbours_with_ties_and_unusable_rows(spark):
    draw = np.random.default_rng(6)
    rows = [(k, draw.normal(size=8).astype(np.float32).tolist()) for k in range(3000)]
    rows += [(3000 + k, rows[0][1]) for k in range(1500)]  # one vector holds a third of the rows
    bad = [(9000, None), (9001, [0.0] * 8), (9002, [1.0] * 7), (9003, [float("nan")] * 8), (9004, [float("inf")] * 8), (9005, [None] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame([(*row, "l", "s") for row in rows + bad], VECTOR)
    found = vector_tree.nearest(table, table.filter("vec_id % 20 = 0"), 20, leaf_points=100).collect()
    truth = exact(rows, [row for row in rows if row[0] % 20 == 0], 20)
    ours = defaultdict(list)
    for row in sorted(found, key=lambda row: (row["query_id"], row["rank"])):
        ours[row["query_id"]].append((-row["score"], row["vec_id"]))
    assert set(ours) == set(truth)
    hits = 0
    for query, near in truth.items():
        assert [row for row in ours[query]] == sorted(ours[query]) and len(ours[query]) == 20
        hits += len({i for _, i in near} & {i for _, i in ours[query]})
    assert hits >= 0.9 * 20 * len(truth)
    same = [query for query in truth if query >= 3000]
    assert [i for _, i in ours[same[0]]] == [i for _, i in truth[same[0]]]


def test_few_neighbours(spark):
    table = spark.createDataFrame([(k, [1.0, float(k)], "l", "s") for k in range(5)], VECTOR)
    found = vector_tree.nearest(table, table, 20).collect()
    assert Counter(row["query_id"] for row in found) == {k: 4 for k in range(5)}
    assert vector_tree.nearest(table.filter("false"), table.filter("false"), 20).count() == 0
    assert vector_tree.nearest(table, table.filter("false"), 20).count() == 0
    assert table.filter(F.col("vec_id") < 1).count() == 1


def test_visits_are_calibrated_to_the_stated_recall():
    assert vector_tree.RECALL == 0.97 == inspect.signature(vector_tree.nearest).parameters["recall"].default
