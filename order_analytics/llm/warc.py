"""WARC archives without repeated payloads.

``write_archives`` makes one WARC/1.1 record of each page. Of the pages whose payloads are equal, that with the largest
page_id is the original and gets a response record with the payload. The others get a revisit record: fresh headers that name
the digest and the original's record, address and date, and the HTTP header, but no payload. Payloads under ``least_bytes`` are always responses.

Only headers (page_id, url, size, digest) are shuffled by digest; payloads go from the scan to the writer. A scanned page learns what it is from
a filter: bitmaps of the hashes of all revisits, broadcast, at most ``FILTER_BITS``. A page that misses the filter is a response. Headers tell
which other pages hit it by chance, and a second filter of those tells them from revisits, but for the few that hit both:
they alone are shuffled and joined to the headers, so the outcome is exact. When revisits outgrow the filters, more pages take that join.

Records are text: each row of the output is header and block, and the line separator is the blank lines
that end a record. The text sink writes and commits them in tasks, gzipped, wherever the path points. A file holds at most about 1 GiB of records
(or a single one), so that it can be read in one piece; records of very different sizes go to different files.

``read_archives`` parses the files by the lengths in the headers, whatever the payloads hold, recomputes the digest of each response, and joins
revisit records to their originals by record id. A file that ends early or whose lengths do not meet the ends of its records is an error
that names the file; a payload that differs from its digest is not ``intact``.

A null html is an empty payload. A null url is left out of the header; white space and control
characters in it are escaped. A page without page_id is a revisit if another page with the payload has
one, else a response. Rows that repeat an original are responses as well. An empty table gives no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from order_analytics.operators import staging

DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: (bytes of payload and address from which on, records of one archive file at most)
FILE_CLASSES = ((0, 4_000), (1 << 18, 250), (1 << 22, 1))
#: Bits of a filter: so many for each key, and at most so many.
BITS_PER_KEY, FILTER_BITS = 64, 1 << 28
#: Spark's bitmaps hold so many bits.
BITMAP_BITS = 1 << 15
ROWS_PER_BATCH = 2_000

CRLF = "\r\n"
END_OF_RECORD = CRLF + CRLF
RECORD = "page_id bigint, record_id string, record_type string, payload_digest string, payload_bytes bigint, intact boolean, refers_to_id string"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base32: each five hexadecimal digits are four base-32 digits."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, place, 5), 16, 32), 4, "0") for place in range(1, 41, 5)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def _record_id(page_id: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), digest).cast("binary"))
    parts = [F.substring(name, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def payloads_of(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes and digest of each page."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7F]", "%20").alias("url"),
        html.alias("payload"),
        F.octet_length(html).alias("payload_bytes"),
        base32_sha1(html.cast("binary")).alias("digest"),
    )


def revisits_of(heads: DataFrame, least_bytes: int) -> DataFrame:
    """The headers of pages that revisit another, with ``original``, the (page_id, url) of that one."""
    shared = heads.filter(F.col("payload_bytes") >= least_bytes)
    originals = shared.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("original"), F.count("*").alias("n"))
    originals = originals.filter("n > 1 and original.page_id is not null").drop("n")
    return shared.join(originals, "digest").filter(~F.col("page_id").eqNullSafe(F.col("original.page_id")))


class Filter:
    """Bitmaps of the hashes of (digest, page_id): a key that is not in them is none of the rows'."""

    def __init__(self, rows: DataFrame, seed: int, most_bits: int):
        self._seed = seed
        self._bits = max(BITMAP_BITS, min(most_bits, 1 << (BITS_PER_KEY * max(1, rows.count()) - 1).bit_length()))
        places = rows.select(self._place().alias("place")).select(self._bitmap(), self._bit().alias("bit"))
        # dealt before they are summed: a task's bitmaps would be larger than its places
        self._bitmaps = places.repartition("bitmap").groupBy("bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(F.lit(self._seed), "digest", "page_id"), F.lit(self._bits))

    def _bitmap(self) -> Column:
        return F.shiftright("place", 15).alias("bitmap")

    def _bit(self) -> Column:
        return F.col("place").bitwiseAND(F.lit(BITMAP_BITS - 1))

    def test(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows with a boolean column ``name``: whether the filter may hold their key."""
        placed = rows.withColumn("place", self._place()).withColumn("bitmap", self._bitmap())
        held = placed.join(F.broadcast(self._bitmaps), "bitmap", "left")
        byte = F.conv(F.hex(F.substring("bits", F.shiftright(self._bit(), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        mask = F.element_at(F.array(*(F.lit(1 << bit) for bit in range(8))), (F.col("place") % 8 + 1).cast("int"))
        found = F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))
        return held.withColumn(name, found).drop("place", "bitmap", "bits")


def _same_key(one: DataFrame, other: DataFrame) -> Column:
    return (one["digest"] == other["digest"]) & one["page_id"].eqNullSafe(other["page_id"])


def _record(date: str) -> Column:
    """Header and block of a row; ``original`` is null and ``payload`` given for a response."""
    revisit = F.col("original").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END_OF_RECORD),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    original_id = F.when(revisit, _record_id(F.col("original.page_id"), F.col("digest")))
    profile = F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", profile),
        _line("WARC-Refers-To", original_id),
        _line("WARC-Refers-To-Target-URI", F.col("original.url")),
        _line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    return F.concat(header, block)


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", filter_bits: int = FILTER_BITS
) -> None:
    """Write the records of all pages as gzipped archives to a new folder."""
    spark = pages.sparkSession
    payloads, written = payloads_of(pages), []

    def kept(table: DataFrame, label: str) -> DataFrame:
        staged, place = staging.write_table(table, label)
        written.append(place)
        return staged

    heads = kept(payloads.drop("payload"), "warc-heads")
    revisits = kept(revisits_of(heads, least_bytes), "warc-revisits")
    first = Filter(revisits, 1, filter_bits)
    hits = first.test(heads, "hit").filter("hit").drop("hit")
    mistaken = kept(hits.join(revisits, _same_key(hits, revisits), "left_anti"), "warc-mistaken")
    second = Filter(mistaken, 2, filter_bits)

    tested = first.test(payloads, "hit")
    doubtful = second.test(tested.filter("hit").drop("hit"), "mistaken").filter("mistaken").drop("mistaken")
    cleared = doubtful.join(mistaken, _same_key(doubtful, mistaken), "left_semi")
    none = F.lit(None).cast(revisits.schema["original"].dataType).alias("original")
    responses = tested.filter("not hit").drop("hit").unionByName(cleared).select("*", none)
    rows = responses.unionByName(revisits.withColumn("payload", F.lit(None).cast("string")))

    size = F.col("payload_bytes") + F.coalesce(F.octet_length("url"), F.lit(0))
    starts = [start for start, _ in FILE_CLASSES]
    file_class = sum((size >= F.lit(start)).cast("int") for start in starts[1:]) + F.lit(0)
    present = {row["class"] for row in heads.select(file_class.alias("class")).distinct().collect()}
    for number in sorted(present) or [0]:
        some = rows if len(present) <= 1 else rows.filter(file_class == number)
        writer = some.select(_record(date).alias("record")).write.mode("errorifexists" if number == min(present, default=0) else "append")
        writer = writer.option("lineSep", END_OF_RECORD).option("maxRecordsPerFile", FILE_CLASSES[number][1])
        writer.option("compression", "gzip").text(path)
    for place in written:
        staging.drop_table(spark, place)


class _Unzipped(io.RawIOBase):
    """A gzipped file in memory, unpacked as it is read."""

    def __init__(self, packed: bytes):
        self._rest, self._unpack = packed, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while True:
            if self._unpack.eof:
                self._rest = self._unpack.unused_data
                if not self._rest:
                    return 0
                self._unpack = zlib.decompressobj(31)
            out = self._unpack.decompress(self._rest, len(target))
            self._rest = self._unpack.unconsumed_tail or (b"" if not self._unpack.eof else self._rest)
            if out:
                target[: len(out)] = out
                return len(out)
            if not self._rest and not self._unpack.eof:
                raise ValueError("the archive ends early")


def _header(source: io.BufferedReader) -> dict[str, str] | None:
    """The fields of a header up to its blank line; the first line is under ''. None at the end."""
    first = source.readline()
    if not first:
        return None
    fields = {"": first.decode().strip()}
    while (line := source.readline().decode().rstrip(CRLF)):
        name, _, value = line.partition(": ")
        fields[name.lower()] = value
    return fields


def parse_archive(packed: bytes) -> Iterator[dict]:
    """The records of one archive file as rows of ``RECORD``."""
    source = io.BufferedReader(_Unzipped(packed), 1 << 16)
    while (fields := _header(source)) is not None:
        if not fields[""].startswith("WARC/"):
            raise ValueError("not at the start of a record")
        block = source.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]) or source.read(len(END_OF_RECORD)) != END_OF_RECORD.encode():
            raise ValueError(f"record {fields.get('warc-record-id')} does not end where its length says")
        inner = io.BufferedReader(io.BytesIO(block))
        http = _header(inner) or {}
        payload = inner.read()
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        response = fields["warc-type"] == "response"
        yield {
            "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
            "record_id": fields["warc-record-id"],
            "record_type": fields["warc-type"],
            "payload_digest": digest,
            "payload_bytes": len(payload) if response else int(http["content-length"]),
            "intact": base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest if response else None,
            "refers_to_id": fields.get("warc-refers-to"),
        }


def _named(name: str, found: Iterator[dict]) -> Iterator[dict]:
    """The records of a file; what is wrong with it is said with its name."""
    try:
        yield from found
    except (ValueError, KeyError, zlib.error) as wrong:
        raise ValueError(f"{name}: {wrong}") from wrong


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder; ``intact`` says whether a response has its digest."""
    names = ["page_id", "record_id", "record_type", "payload_digest", "payload_bytes", "intact", "refers_to_id"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for name, packed in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for record in _named(name, parse_archive(packed.as_py())):
                    held.append(record)
                    if len(held) == ROWS_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
        yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse_batches, RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of every record."""
    found = read_records(spark, path)
    responses = found.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id"))
    targets = responses.agg(F.max("page_id").alias("refers_to"))
    return found.join(targets, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )
