"""WARC archives compressed record by record with an embedded dictionary.

An archive is a file of Zstandard frames: first a skippable frame (magic
0x184D2A5D) that holds the dictionary, built from pieces drawn from all of the
archive's records, then one frame per record, each readable alone with that
dictionary. A file that grows beyond SEGMENT_BYTES goes on with a new dictionary
frame for its further records. Where Zstandard's trainer finds nothing in common
(too few or too uniform records), the pieces themselves are the dictionary. Tasks
write through Spark's text writer, whose commit protocol survives lost
executors and whose paths may be in any store: its line separator is an empty
skippable frame, so the whole file is a valid Zstandard stream.

Records: ``response`` (HTTP head and payload) or ``revisit`` (HTTP head only)
when a record with the same payload and a smaller page_id exists; both carry
the SHA-1 of the full payload.

Defined cases: a null html is an empty payload; a null url has no target URI;
control characters of a url are percent-encoded; rows with equal page_id and
payload are all responses if that page_id is the smallest; a null page_id is
larger than any other; an empty table writes no archive and reads no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

DICTIONARY_MAGIC = 0x184D2A5D
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)  # an empty skippable frame; ASCII only
ARCHIVE_BYTES = 16 << 20   # payload bytes that an archive holds on average
SEGMENT_BYTES = 32 << 20   # records that one dictionary serves and a task holds, about
TRAIN_BYTES = 8 << 20      # bytes of the pieces that a dictionary is trained on
PIECE_BYTES = 16 << 10     # longest piece
DICTIONARY_BYTES = 56 << 10
LEVEL = 3
MIN_REVISIT_BYTES = 0      # payloads under this size are always responses
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
_FORBIDDEN = re.compile(r"[\x00-\x20\x7f]")


def _field(name: str, value) -> str:
    return "" if value is None else f"{name}: {value}\r\n"


def record(page_id, url, payload: bytes, sha1: bytes, refers_to, kind: str, date: str = NO_DATE) -> bytes:
    """One WARC/1.1 record."""
    digest = base64.b32encode(sha1).decode()
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + b"\r\n\r\n")
    if kind == "response":
        block += payload
    uri = None if url is None else _FORBIDDEN.sub(lambda m: f"%{ord(m[0]):02X}", url)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {uri} {digest}")
    head = ("WARC/1.1\r\n" + _field("WARC-Type", kind) + _field("WARC-Record-ID", f"<urn:uuid:{name}>")
            + _field("WARC-Target-URI", uri) + _field("WARC-Date", date)
            + _field("WARC-Payload-Digest", f"sha1:{digest}")
            + _field("WARC-Profile", PROFILE if kind == "revisit" else None)
            + _field("X-Page-ID", page_id) + _field("X-Refers-To-Page-ID", refers_to)
            + _field("Content-Type", "application/http;msgtype=response")
            + _field("Content-Length", len(block)) + "\r\n")
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Header fields (lower-case names) of a record, with its ``payload`` (of a
    response; else None) and ``http_length`` (length of the full payload)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    block = rest[:int(out["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    found = re.search(rb"\r\ncontent-length: (\d+)", http, re.I)
    out["http_length"] = int(found[1]) if found else None
    out["payload"] = payload if out["warc-type"] == "response" else None
    return out


def training_pieces(records: list[bytes]) -> list[bytes]:
    """Pieces of all records, evenly spread, of at most about TRAIN_BYTES."""
    total = sum(map(len, records))
    size = min(PIECE_BYTES, max(total // 64, 64))
    pieces = [r[i:i + size] for r in records for i in range(0, len(r), size)]
    return pieces[::max(-(-total // TRAIN_BYTES), 1)]


def train(records: list[bytes]):
    """A dictionary from an archive's records."""
    import zstandard

    pieces = training_pieces(records)
    size = min(DICTIONARY_BYTES, max(sum(map(len, pieces)) // 8, 1024))
    try:
        return zstandard.train_dictionary(size, pieces, k=200, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(pieces)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def frames(records):
    """The archive's frames: dictionary frame, then a frame per record."""
    import zstandard

    def segment(held):
        dictionary = train(held)
        raw = dictionary.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, dict_data=dictionary)
        for r in held:
            yield compressor.compress(r)

    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r)
        if size >= SEGMENT_BYTES:
            yield from segment(held)
            held, size = [], 0
    if held:
        yield from segment(held)


def read_archive(content: bytes):
    """The records of an archive."""
    import zstandard

    view, at, decompressor = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC and size:
                dictionary = zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size]))
                decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            chunk = view[at:at + (1 << 14)]
            parts.append(frame.decompress(chunk))
            at += len(chunk) - len(frame.unused_data)
        yield b"".join(parts)


def decided(scratch: Scratch, pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, sha1, kind, refers_to, part) of each page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    # the part of the input tells repeated rows apart, in every run alike
    base = pages.select("page_id", "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("sha1"),
                        F.spark_partition_id().alias("part"))
    first = (base.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).groupBy(F.col("sha1").alias("d_sha1"))
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # written: the planner knows its size, and a hot payload's rows can be split in the join
    first = scratch.keep(first, "repeated-payloads")
    again = F.col("d_sha1").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (
        F.octet_length("payload") >= MIN_REVISIT_BYTES)
    return base.join(first, F.col("sha1") == F.col("d_sha1"), "left").select(
        "page_id", "url", "payload", "sha1", F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("first_id")).cast("long").alias("refers_to"), "part")


def write_archives(scratch: Scratch, pages: DataFrame, path: str) -> None:
    """Archives of about ARCHIVE_BYTES payload bytes under ``path``."""
    def run(batches):
        def records():
            for b in batches:
                for page_id, url, payload, sha1, kind, refers_to in zip(*b.columns, strict=True):
                    payload = payload.as_py()
                    url = url.as_py()
                    yield record(page_id.as_py(), None if url is None else url.decode("utf-8", "replace"),
                                 payload, sha1.as_py(), refers_to.as_py(), kind.as_py())

        batch, size = [], 0
        for f in frames(records()):
            batch.append(f)
            size += len(f)
            if size >= 4 << 20:
                yield pa.record_batch([pa.array(batch, pa.binary())], names=["frame"])
                batch, size = [], 0
        if batch:
            yield pa.record_batch([pa.array(batch, pa.binary())], names=["frame"])

    rows = decided(scratch, pages).withColumn("url", F.col("url").cast("binary"))
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    dealt = rows.repartition(max(1, round(total / ARCHIVE_BYTES)), F.xxhash64("page_id", "sha1", "part")).drop("part")
    (dealt.mapInArrow(run, "frame binary").select(F.col("frame").cast("string"))
     .write.option("lineSep", SEPARATOR.decode("ascii")).text(path))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, kind, payload, payload_bytes, payload_digest, refers_to)
    per record; the payload and its digest are those read, not those declared.
    Without ``payloads`` they are checked but not returned (null)."""
    def run(batches):
        for b in batches:
            for content in b.column(0):
                rows = []
                for raw in read_archive(content.as_py()):
                    r = parse_record(raw)
                    declared = r["warc-payload-digest"].removeprefix("sha1:")
                    if r["payload"] is not None:
                        digest = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                        if digest != declared or len(r["payload"]) != r["http_length"]:
                            raise ValueError(f"record {r['warc-record-id']} is damaged")
                    ids = [int(r[k]) if k in r else None for k in ("x-page-id", "x-refers-to-page-id")]
                    rows.append((ids[0], r.get("warc-target-uri"), r["warc-type"], r["payload"] if payloads else None, r["http_length"],
                                 declared, ids[1]))
                columns = list(zip(*rows, strict=True)) or [()] * 7
                kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                      names=["page_id", "url", "kind", "payload", "payload_bytes",
                                             "payload_digest", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "page_id long, url string, kind string, payload binary, payload_bytes long, "
                                 "payload_digest string, refers_to long")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), read
    back from archives of all pages."""
    with Scratch(spark, "warc") as scratch:
        path = scratch.path("archives")
        scratch.temporary(path)
        write_archives(scratch, pages, path)
        out = read_archives(spark, path, payloads=False).select(
            "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")
        return scratch.keep(out, "result", result=True)
