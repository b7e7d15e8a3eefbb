"""Converter from the legacy ARC archive format to WARC, with a writer and a reader for either.

An ARC file begins with a version block whose first line names the version.  Record header lines differ by version:

* version 1: URL, IP, date, content type, length;
* version 2: URL, IP, date, content type, result code, checksum, location, offset, file name, length.

The declared length says where a record ends.  The converter reads the records a file holds, asks Spark which payloads
are equal (same SHA-1 and size), and writes a WARC record for each: identifiers derived from file name and offset, dates
rewritten, block and payload digests computed.  Of equal payloads of at least ``LEAST_REVISIT`` bytes, the one with the largest
page_id (then last file and offset) is the response and the others become revisits without a payload.

Files are compressed record by record, so any record can be read by its offset, and a task holds one record at a time.  Only
metadata is shuffled.  Null payloads are empty; null URLs are written as ``about:blank``; null page_ids count as the smallest.
An empty table gives archives without records.  A payload, however long, is held whole by the task that has its record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged
from .files import one_per_task, opened, shared_folder

LEAST_REVISIT = 1000
FETCHED = "20200101000000"
READ_BYTES = 1 << 18
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122


class ArcRecord(NamedTuple):
    offset: int
    url: str
    date: str
    mime: str
    headers: bytes
    payload: bytes


def squeezed(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(stream, offset: int = 0) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the compressed members of a file, from ``offset`` on."""
    stream.seek(offset)
    rest = b""
    while rest or (rest := stream.read(READ_BYTES)):
        unpacker, parts, taken = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not rest and not (rest := stream.read(READ_BYTES)):
                raise ValueError(f"the record at {offset} is cut off")
            parts.append(unpacker.decompress(rest))
            taken += len(rest) - len(unpacker.unused_data)
            rest = unpacker.unused_data
        yield offset, b"".join(parts)
        offset += taken


def split_http(block: bytes) -> tuple[bytes, bytes]:
    head, gap, body = block.partition(b"\r\n\r\n")
    return head + gap, body


def header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode() if found else None


# ---- ARC -------------------------------------------------------------------------------

def arc_header(version: int, url: str, date: str, mime: str, length: int, name: str, offset: int, checksum: str = "-",
               code: int = 200) -> bytes:
    fields = [url, "0.0.0.0", date, mime]
    if version == 2:
        fields += [str(code), checksum, "-", str(offset), name]
    return (" ".join([*fields, str(length)]) + "\n").encode()


def version_block(version: int, name: str, date: str = FETCHED) -> bytes:
    body = f"{version} 0 tidemart\n{ARC_FIELDS[version]}\n".encode()
    return arc_header(version, f"filedesc://{name}", date, "text/plain", len(body), name, 0) + body + b"\n"


def arc_url(url: str | None) -> str:
    """Header fields are separated by spaces, so white space and control characters are escaped."""
    return re.sub(r"[\x00-\x20\x7f\x85\xa0]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "about:blank"


def arc_block(page_id: int | None, payload: bytes) -> bytes:
    page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{page}\r\n".encode() + payload


def arc_version(content: bytes) -> int:
    """The version a version block names, checked against its field line."""
    line, _, body = content.partition(b"\n")
    if not line.startswith(b"filedesc://"):
        raise ValueError("an ARC file begins with a version block")
    declared = body.split(b"\n", 2)
    version = int(declared[0].split()[0])
    if version not in ARC_FIELDS:
        raise ValueError(f"unknown ARC version {version}")
    if declared[1].decode() != ARC_FIELDS[version]:
        raise ValueError("the field line does not fit the version")
    return version


def parse_arc(content: bytes, version: int, offset: int) -> ArcRecord:
    line, _, body = content.partition(b"\n")
    fields = line.decode().rsplit(" ", 4 if version == 1 else 9)
    if len(fields) != len(ARC_FIELDS[version].split()):
        raise ValueError(f"the header line at {offset} does not fit version {version}")
    length = int(fields[-1])
    if length > len(body):
        raise ValueError(f"the record at {offset} declares {length} bytes and has {len(body)}")
    head, payload = split_http(body[:length])
    return ArcRecord(offset, fields[0], fields[2], fields[3], head, payload)


def arc_records(stream) -> Iterator[ArcRecord]:
    version = 0
    for offset, content in members(stream):
        if not version:
            version = arc_version(content)
        else:
            yield parse_arc(content, version, offset)


def write_arcs(spark: SparkSession, pages: DataFrame) -> list[str]:
    """ARC files of the pages, one per task, versions 1 and 2 in turn; their URIs."""
    small_batches(spark)
    folder = shared_folder(spark, "arc")
    store, root = opened(folder)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"part-{part:06d}-{uuid.uuid4().hex}.arc.gz"
        store, path = opened(f"{folder}/{name}")
        with store.open_output_stream(path, compression=None) as out:
            offset = out.write(squeezed(version_block(version, name)))
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
                for page_id, url, html in zip(*columns, strict=True):
                    block = arc_block(page_id, (html or "").encode())
                    head = arc_header(version, arc_url(url), FETCHED, "text/html", len(block), name, offset)
                    offset += out.write(squeezed(head + block + b"\n"))
        yield pa.RecordBatch.from_pydict({"uri": [f"{folder}/{name}"]})

    rows = pages.select("page_id", "url", "html").mapInArrow(write, "uri string").collect()  # one row a file
    return [r.uri for r in rows]


# ---- WARC ------------------------------------------------------------------------------

def record_id(arc: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{arc.rpartition('/')[2]}#{offset}')}>"


def warc_date(date: str) -> str:
    """ARC dates have up to 14 digits; what is missing becomes the earliest moment."""
    d = date + "00000101000000"[len(date):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def sha1_base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def converted(record: ArcRecord, arc: str, refers_to_id: str | None, refers_to: int | None) -> bytes:
    """The WARC record of an ARC record: a response, or a revisit of the record ``refers_to_id``."""
    revisit = refers_to_id is not None
    block = record.headers if revisit else record.headers + record.payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(arc, record.offset)),
        ("WARC-Date", warc_date(record.date)), ("WARC-Target-URI", record.url),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Block-Digest", sha1_base32(block)),
        ("WARC-Payload-Digest", sha1_base32(record.payload)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", refers_to_id), ("X-Refers-To-Page-Id", "" if refers_to is None else str(refers_to)),
        ]
    return warc_record(fields, block)


def catalog(spark: SparkSession, arcs: list[str]) -> DataFrame:
    """(arc, place, page_id, payload_bytes, payload_digest) of every ARC record, parsed from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri in (u for b in batches for u in b.column("uri").to_pylist()):
            store, path = opened(uri)
            with store.open_input_file(path) as stream:
                rows = [
                    (uri, r.offset, int(page) if (page := header(r.headers, "X-Page-Id")) else None, len(r.payload),
                     hashlib.sha1(r.payload).hexdigest()) for r in arc_records(stream)
                ]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["arc", "place", "page_id", "payload_bytes", "payload_digest"])

    return one_per_task(spark, [(a,) for a in arcs], "uri string").mapInArrow(
        run, "arc string, place bigint, page_id bigint, payload_bytes bigint, payload_digest string")


def convert(spark: SparkSession, arcs: list[str], least_revisit: int = LEAST_REVISIT) -> list[str]:
    """Writes the WARC files of ARC files; their URIs."""
    records = staged(spark, catalog(spark, arcs), "arc-catalog")
    same = ("payload_digest", "payload_bytes")
    winners = (
        records.where(F.col("payload_bytes") >= least_revisit).groupBy(*same)
        .agg(F.max(F.struct("page_id", "arc", "place")).alias("response"), F.count("*").alias("copies"))
        .where("copies > 1").select(*same, "response")
    )
    response = F.col("response")
    revisits = ~((F.col("arc") == response["arc"]) & (F.col("place") == response["place"]))
    decided = staged(spark, records.join(winners, list(same), "left").select(
        "arc", "place", F.when(revisits, response).alias("response")), "arc-decided")
    folder = shared_folder(spark, "warc")
    store, root = opened(folder)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        store, path = opened(f"{folder}/{name}")
        arc = None
        with store.open_output_stream(path, compression=None) as out:
            info = b"software: tidemart\r\nformat: WARC File Format 1.1\r\n"
            out.write(squeezed(warc_record([
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, 0)), ("WARC-Date", warc_date(FETCHED)),
                ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
            ], info)))
            for batch in batches:
                for row in batch.to_pylist():  # in order of file and offset
                    if row["arc"] != arc:
                        arc = row["arc"]
                        source, at = opened(arc)
                        stream = source.open_input_file(at)
                        version = arc_version(next(members(stream))[1])
                        reader = members(stream, row["place"])  # a range of a file has its records in a row
                    offset, content = next(reader)
                    if offset != row["place"]:
                        raise ValueError(f"{arc} has no record at {row['place']}")
                    to = row["response"]
                    out.write(squeezed(converted(
                        parse_arc(content, version, offset), arc, to and record_id(to["arc"], to["place"]), to and to["page_id"])))
        yield pa.RecordBatch.from_pydict({"uri": [f"{folder}/{name}"]})

    # As many tasks as files: the rows are small, what they name is not.
    dealt = decided.repartitionByRange(max(1, len(arcs)), "arc", "place").sortWithinPartitions("arc", "place")
    return [r.uri for r in dealt.mapInArrow(write, "uri string").collect()]  # one row a file


def read_warcs(spark: SparkSession, warcs: list[str]) -> DataFrame:
    """One row per response or revisit record, as read from the files.

    record_id, url, date, page_id, payload_bytes, payload_digest (hexadecimal), record_type, refers_to.  A response's
    digest is computed from its payload and must equal the declared one.
    """
    kinds = [
        ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]

    def row(content: bytes) -> tuple | None:
        head, _, rest = content.partition(b"\r\n\r\n")
        kind = header(head, "WARC-Type")
        if kind not in ("response", "revisit"):
            return None
        http, payload = split_http(rest[:int(header(head, "Content-Length"))])
        digest = base64.b32decode(header(head, "WARC-Payload-Digest").removeprefix("sha1:")).hex()
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"digest of {header(head, 'WARC-Record-ID')} does not fit its payload")
        size = len(payload) if kind == "response" else int(header(http, "Content-Length"))
        page, to = header(http, "X-Page-Id"), header(head, "X-Refers-To-Page-Id")
        return (header(head, "WARC-Record-ID"), header(head, "WARC-Target-URI"), header(head, "WARC-Date"),
                int(page) if page else None, size, digest, kind, int(to) if to else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri in (u for b in batches for u in b.column("uri").to_pylist()):
            store, path = opened(uri)
            with store.open_input_file(path) as stream:
                rows = [r for _, content in members(stream) if (r := row(content))]
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])

    return one_per_task(spark, [(w,) for w in warcs], "uri string").mapInArrow(run, (
        "record_id string, url string, date string, page_id bigint, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint"))
