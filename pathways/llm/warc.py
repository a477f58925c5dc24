"""WARC archives: written whole, made seekable record by record, read back by offset.

``write_archives`` puts a record for each page into monolithic gzip files: one
stream a file, as a crawler with plain compression leaves them. Of pages with equal
payloads one is a response and the others are revisits that refer to it.

``normalise`` inflates each such file once, from front to back, finds the records by
their Content-Length, and rewrites every record as a gzip member of its own, with a
sidecar index of file, record, offset and length. The new files lie in
``archive=<name>/kind=warc``, their index in ``archive=<name>/kind=index``.

``read_records`` reads the members at the offsets of the index.

Files are written and read by Spark only, so they may lie in any store it knows and a
lost executor leaves no half of one. Its text format ends each row with a separator:
between the records of a monolithic file that is the blank line of the WARC format;
after a member it is NUL, the last byte of the member itself (the high byte of its
size). Where a record has 16 MiB or more and ends otherwise, an empty member follows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathways.functions.skew import join_unique
from pathways.session import remove, scratch_path

from .common import ship, stage

GAP = "\r\n\r\n"
# Fixed values of the WARC 1.1 and base32 formats.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EXTENDED_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

DATE = "2024-01-01T00:00:00Z"
LEAST_BYTES = 0
# A new archive begins beyond this, so that one fits a task when it is read.
MOST_BYTES = 32 << 20


def base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: 15 of them are 12 digits of base 32."""
    pieces = [F.lpad(F.conv(F.substring(sha1_hex, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*pieces), EXTENDED_HEX, BASE32)


def _records(pages: DataFrame, least_bytes: int, date: str) -> DataFrame:
    """One column, ``value``: the records without the blank line after them."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).alias("size"), base32(F.sha1(html.cast("binary"))).alias("digest"))
    # Payloads met more than once, from digests and ids only; written first, so that its size is
    # known and a small one is sent to the tasks instead of dealing the pages out.
    each = rows.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("page_id").isNull(), F.col("page_id"))).alias("first")
    shared = each.groupBy("digest").agg(first, F.sum("n").alias("n"), F.max("n").alias("copies")).where("n > 1")
    shared = stage(shared.select("digest", F.col("first.page_id").alias("first_id"), "copies"), "shared")
    rows = join_unique(rows, shared, ["digest"])
    rows = rows.withColumn("shared", F.col("copies").isNotNull() & (F.col("size") >= least_bytes))
    later = F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.withColumn("html", F.when(~later, F.col("html")))
    if shared.where("copies > 1").take(1):
        # Rows that repeat a page_id with the same payload are told apart by their urls' order.
        same = Window.partitionBy("page_id", "digest").orderBy(F.col("url").asc_nulls_last())
        repeated = rows.where("copies > 1").withColumn("copy", F.row_number().over(same))
        rows = rows.where("copies is null or copies = 1").withColumn("copy", F.lit(1)).unionByName(repeated)
    else:
        rows = rows.withColumn("copy", F.lit(1))
    revisit = F.col("shared") & (F.col("html").isNull() | (F.col("copy") > 1))
    one_line = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    urn = lambda c, copy: F.concat(F.lit("<urn:page:"), number(c), F.lit(":"), F.col("digest"), F.lit(":"), copy, F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(GAP))
    body = F.when(revisit, head).otherwise(F.concat(head, "html"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id", F.col("copy").cast("string"))),
        F.concat(F.lit("WARC-Date: "), F.lit(date)),
        F.concat(F.lit("WARC-Target-URI: "), one_line),  # concat_ws leaves out a null line
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("first_id", F.lit("1")))),
        F.when(revisit, F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("body")),
    ]
    return rows.withColumn("body", body).select(F.concat(F.concat_ws("\r\n", *lines), F.lit(GAP), "body").alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str = DATE) -> None:
    """A record for each row of ``pages`` (page_id, url, html) in monolithic gzip files.

    Of rows with equal payloads of at least ``least_bytes`` bytes that with the smallest
    page_id is a response (null last; where rows repeat that page_id, the one with the
    first url), the others are revisits. Null html is an empty payload; without a url the
    record has no target; line ends in a url are percent-encoded.
    """
    _records(pages, least_bytes, date).write.option("compression", "gzip").option("lineSep", GAP).text(path)


def header_fields(header: bytes) -> dict[bytes, bytes]:
    """Fields by their lower-case names."""
    pairs = (line.partition(b":") for line in header.split(b"\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class Stream:
    """Records of one file from its bytes, given as the pieces between blank lines."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.header, self.wanted = b"", 0

    def feed(self, piece: bytes) -> Iterator[tuple[bytes, bytes]]:
        """The records (header, block) that this piece completes."""
        gap = GAP.encode()
        self.held += piece
        self.held += gap
        while self.held:
            if not self.wanted:
                if self.held[:2] == gap[:2]:  # further blank lines between records
                    del self.held[:2]
                    continue
                self.header = bytes(self.held[: self.held.index(gap)])
                if not self.header.startswith(b"WARC/"):
                    raise ValueError(f"no record begins with {self.header[:40]!r}")
                size = int(header_fields(self.header)[b"content-length"])
                self.wanted = len(self.header) + len(gap) + size + len(gap)
            if len(self.held) < self.wanted:
                return
            if self.held[self.wanted - len(gap) : self.wanted] != gap:
                raise ValueError("a record is longer than its Content-Length")
            block = bytes(self.held[len(self.header) + len(gap) : self.wanted - len(gap)])
            del self.held[: self.wanted]
            self.wanted = 0
            yield self.header, block


def member(header: bytes, block: bytes) -> bytes:
    """A record as a gzip member that ends with NUL."""
    made = b""
    while not made.endswith(b"\0"):  # the second time round: an empty member
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        made += packer.compress(header + GAP.encode() + block + GAP.encode() if not made else b"") + packer.flush()
    return made


def normalise(spark: SparkSession, source: str, target: str, most_bytes: int = MOST_BYTES) -> None:
    """Rewrite the monolithic archives under ``source`` as archives of single members.

    A file is one stream in one task, piece by piece; its records go, in their order,
    to archives of some ``most_bytes`` compressed bytes. An index entry has six fields
    parted by tabs: archive, number of the record, offset, length, type, record id. A
    file that ends within a record, or has anything but records, is an error.
    """
    ship(spark)
    pieces = spark.read.option("lineSep", GAP).text(source)
    pieces = pieces.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, stream, part, number, offset, entries = None, Stream(), 0, 0, 0, []

        def archive() -> str:
            name = path.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt").removesuffix(".warc")
            return f"{name}-{hashlib.sha1(path.encode()).hexdigest()[:8]}-{part:05d}"

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.string(), pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["archive", "kind", "number", "value"])

        def index() -> Iterator[pa.RecordBatch]:
            if entries:
                yield batch_of(entries)
                entries.clear()

        def closed() -> None:
            if stream.wanted:
                raise ValueError(f"{path} ends within a record")

        for batch in batches:
            rows, held = [], 0
            for at, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                if at != path:
                    closed()
                    yield from index()
                    path, stream, part, number, offset = at, Stream(), 0, 0, 0
                for header, block in stream.feed(piece.as_py()):
                    if offset >= most_bytes:
                        yield from index()
                        part, number, offset = part + 1, 0, 0
                    made, fields = member(header, block), header_fields(header)
                    rows.append((archive(), "warc", number, made[:-1]))
                    told = [archive().encode(), b"%d" % number, b"%d" % offset, b"%d" % len(made), fields[b"warc-type"], fields[b"warc-record-id"]]
                    entries.append((archive(), "index", number, b"\t".join(told)))
                    number, offset, held = number + 1, offset + len(made), held + len(made)
                    if held > 1 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)
        closed()
        yield from index()

    made = pieces.mapInArrow(rewrite, "archive string, kind string, number long, value binary")
    made = made.sortWithinPartitions("archive", "kind", "number").select("archive", "kind", F.col("value").cast("string"))
    made.write.partitionBy("archive", "kind").option("lineSep", "\0").text(target)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """archive, number, offset, length, record_type, record_id: the sidecar entries of normalised archives."""
    lines = spark.read.option("lineSep", "\0").schema("value string").text(f"{path}/archive=*/kind=index")
    f = F.split("value", "\t")
    return lines.select(
        f[0].alias("archive"), f[1].cast("long").alias("number"), f[2].cast("long").alias("offset"), f[3].cast("long").alias("length"),
        f[4].alias("record_type"), f[5].alias("record_id"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, refers_to, url, payload_bytes, payload_digest, payload of normalised archives.

    Each member is read at its offset. A revisit has the size and digest of the payload
    it refers to and a null payload. A payload that differs from its digest is an error.
    """
    ship(spark)
    index = read_index(spark, path).groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places"))
    files = spark.read.format("binaryFile").load(f"{path}/archive=*/kind=warc")
    archive = F.regexp_extract("path", "archive=([^/]+)/kind=", 1)
    files = files.select(F.url_decode(archive).alias("archive"), "content")
    placed = files.join(index, "archive").select("content", "places.offset", "places.length")
    names = ["record_id", "record_type", "refers_to", "url", "payload_bytes", "payload_digest", "payload"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                content = memoryview(batch.column(0)[row].as_buffer())
                rows, held = [], 0
                for offset, length in zip(batch.column(1)[row].as_py(), batch.column(2)[row].as_py()):
                    record = zlib.decompressobj(31).decompress(content[offset : offset + length])
                    header, _, block = record.partition(GAP.encode())
                    fields = header_fields(header)
                    http, _, payload = block[: int(fields[b"content-length"])].partition(GAP.encode())
                    digest = fields[b"warc-payload-digest"].removeprefix(b"sha1:")
                    size = int(header_fields(http)[b"content-length"])
                    kind = fields[b"warc-type"].decode()
                    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()) != digest):
                        raise ValueError(f"payload of {fields[b'warc-record-id']!r} is damaged")
                    text = [v.decode() if v is not None else None for v in (fields.get(b"warc-refers-to"), fields.get(b"warc-target-uri"))]
                    rows.append((fields[b"warc-record-id"].decode(), kind, *text, size, digest.decode(), payload if kind == "response" else None))
                    held += len(payload)
                    if held > 1 << 22 or len(rows) >= 5_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    schema = "record_id string, record_type string, refers_to string, url string, payload_bytes long, payload_digest string, payload binary"
    return placed.mapInArrow(read, schema)


def page_of(record_id: Column | str) -> Column:
    """page_id in a record id; null for the id of a page without one."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+):", 1).try_cast("long")


def archived_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Write ``pages``, normalise the archives and read them back: one row per row of ``pages``.

    page_id, payload_bytes, payload_digest, record_type, refers_to, as the archives have
    them. The rules of ``write_archives`` hold; other columns than page_id, url and html
    are not read; an empty table gives no rows. The normalised archives stay in the
    scratch folder, the monolithic ones go once they are rewritten.
    """
    spark = pages.sparkSession
    whole, single = scratch_path(spark, "archives"), scratch_path(spark, "members")
    write_archives(pages, whole, least_bytes)
    normalise(spark, whole, single, most_bytes)
    remove(spark, whole)
    if not spark.read.format("binaryFile").load(single).select("path").take(1):
        empty = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        return spark.createDataFrame([], empty)
    found = read_records(spark, single)
    return found.select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to")
    )
