"""Legacy archives to WARC.

``write_arc`` stores pages as ARC files, ``arc_to_warc`` converts ARC files to WARC files, and
``read_warc`` reads WARC files. An ARC file starts with a version block that says how the header
line of its records is laid out: version 1 has five fields (url, address, date, type, length), version 2
ten (with status, checksum, location, offset and file name). The converter takes the fields by the
version and the content by its declared length, so blank lines or header-like lines inside a page
do no harm, and synthesises what WARC asks for: a record identifier (a UUID of the page and its
payload digest, so a repeated conversion gives the same), an ISO timestamp, the record type, and
payload and block digests. Of records with equal payloads the one with the largest page id becomes
the response, the others revisits that refer to it and hold no payload.

Files are written by Spark's text writer, one record per row, its line separator being what ends a
record; so commits, retries and remote folders are Spark's business. Files hold at most
``FILE_RECORDS`` records. Files are read whole, one at a time, and unpacked as a stream.

Defined results: a null html is the empty payload, a null url the address ``unknown:``; blanks and control
characters in a url are percent-encoded. A page without an id never becomes the record that others
refer to while there is one with an id; rows that repeat an id and payload share a record identifier
and type. Records that are cut off raise an error.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.session import store_once

FILE_RECORDS = 2000
CAPTURED = "20240101000000"  # pages carry no date of their own
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:marquee:arc")
FAST = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# The two header layouts of ARC files.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length",
    ),
}
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= size or weight > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


# Writing ARC


def arc_version_block(version: int, name: str) -> bytes:
    layout = f"{version} 0 marquee\n{' '.join(FIELDS[version])}\n"
    fields = ["filedesc://" + name, "0.0.0.0", CAPTURED, "text/plain"]
    fields += ["200", "-", "-", "0", name] if version == 2 else []
    return f"{' '.join(fields)} {len(layout)}\n{layout}".encode()


def arc_record(version: int, name: str, page_id: int | None, url: str | None, html: str | None) -> bytes:
    # "\r\n" ends the lines of the response header that the crawler stored in front of the page.
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    content = f"{head}\r\n{html or ''}".encode()
    address = _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url or "unknown:")
    fields = [address, "0.0.0.0", CAPTURED, "text/html"]
    fields += ["200", "-", "-", "0", name] if version == 2 else []
    return f"{' '.join(fields)} {len(content)}\n".encode() + content


def write_arc(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> None:
    """One file per FILE_RECORDS rows and partition; files of odd partitions have version 2."""
    schema = pa.schema([("value", pa.binary())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version = 1 + part % 2

        def rows() -> Iterator[tuple[bytes]]:
            n = 0
            for batch in batches:
                for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    name = f"pages-{part:05d}-{n // FILE_RECORDS:05d}.arc.gz"
                    if n % FILE_RECORDS == 0:
                        yield (arc_version_block(version, name),)
                    yield (arc_record(version, name, page_id, url, html),)
                    n += 1

        yield from _batches(rows(), schema)

    chosen = pages.select(F.col(id_column).cast("long"), F.col(url_column), F.col(html_column))
    # The version block is a row as well, so a file has one row more than records.
    written = chosen.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    written.write.options(lineSep="\n", maxRecordsPerFile=FILE_RECORDS + 1, **FAST).text(folder)


# Reading


class Stream:
    """The unpacked bytes of a gzip or plain file, read by line and by length."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        self.gzip = data[:2] == b"\x1f\x8b"
        self.at = 0
        self.unpacked = io.BytesIO(data) if not self.gzip else None
        self.opened = zlib.decompressobj(31) if self.gzip else None
        self.held, self.pos = b"", 0

    def _more(self) -> bool:
        if not self.gzip:
            piece = self.unpacked.read(1 << 20)
        else:
            piece = b""
            while not piece and self.at < len(self.data):
                packed = self.data[self.at : self.at + (1 << 18)]
                piece = self.opened.decompress(packed)
                self.at += len(packed) - len(self.opened.unused_data)
                if self.opened.eof:
                    self.opened = zlib.decompressobj(31)  # a file may hold several members
        self.held, self.pos = self.held[self.pos :] + piece, 0
        return bool(piece)

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.held.find(b"\n", self.pos)) < 0:
            if not self._more():
                line, self.pos = self.held[self.pos :], len(self.held)
                return line or None
        line, self.pos = self.held[self.pos : end], end + 1
        return line.rstrip(b"\r")

    def take(self, size: int) -> bytes:
        while len(self.held) - self.pos < size and self._more():
            pass
        if len(self.held) - self.pos < size:
            raise ValueError(f"a record is cut off: {size} bytes declared, {len(self.held) - self.pos} left")
        taken = self.held[self.pos : self.pos + size]
        self.pos += size
        return taken


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record of an ARC file, without the version block."""
    stream, version = Stream(data), 1
    while (line := stream.line()) is not None:
        if not line:
            continue  # what parts two records
        text = line.decode("utf-8", "replace")
        if text.startswith("filedesc://"):
            block = stream.take(int(text.rsplit(" ", 1)[1]))
            version = int(block.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"no such ARC version: {version}")
            continue
        names = FIELDS[version]
        values = text.rsplit(" ", len(names) - 1)  # from the right: old crawlers left blanks in addresses
        if len(values) != len(names):
            raise ValueError(f"a header line of version {version} has {len(values)} fields")
        fields = dict(zip(names, values))
        yield fields, stream.take(int(fields["Archive-length"]))


def _page_of(content: bytes) -> tuple[int | None, bytes, bytes]:
    """Page id, response header and payload of a stored response."""
    head, _, payload = content.partition(b"\r\n\r\n")
    found = re.search(rb"(?mi)^X-Page-Id: (-?\d+)\r?$", head)
    return (int(found.group(1)) if found else None), head + b"\r\n\r\n", payload


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def arc_heads(spark: SparkSession, folder: str) -> DataFrame:
    """(path, place, page_id, digest) of each record."""
    schema = pa.schema([("path", pa.string()), ("place", pa.int32()), ("page_id", pa.int64()), ("digest", pa.string())])

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for path, content in zip(batch.column(0), batch.column(1)):
                    for place, (_, record) in enumerate(arc_records(content.as_py())):
                        page_id, _, payload = _page_of(record)
                        yield path.as_py(), place, page_id, base32_sha1(payload)

        yield from _batches(rows(), schema, 4096)

    return _files(spark, folder).mapInArrow(heads, "path string, place int, page_id long, digest string")


# Converting


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the blank lines that end it, which the writer adds."""
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    return f"WARC/1.1\r\n{''.join(f'{k}: {v}\r\n' for k, v in head)}\r\n".encode() + block


def _timestamp(date: str) -> str:
    """ISO 8601 of an ARC date, of which version 1 files may hold the first 8 or 12 digits only."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def converted(fields: dict[str, str], content: bytes, original: int | None) -> bytes:
    """The WARC record of one ARC record; a revisit if the page id of an original is given."""
    page_id, head, payload = _page_of(content)
    digest = base32_sha1(payload)
    named = [
        ("WARC-Record-ID", record_id(page_id, digest) if original is None else f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'revisit/{page_id}/{digest}')}>"),
        ("WARC-Date", _timestamp(fields["Archive-date"])),
        ("WARC-Target-URI", fields["URL"]),
        ("WARC-IP-Address", fields["IP-address"]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if original is None:
        return warc_record("response", named, head + payload)
    named += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(original, digest)),
    ]
    return warc_record("revisit", named, head)


def arc_to_warc(spark: SparkSession, arc_folder: str, warc_folder: str) -> None:
    """Convert all ARC files of a folder."""
    heads = store_once(arc_heads(spark, arc_folder), "arc-heads")
    originals = heads.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1")
    again = heads.join(originals, "digest").where("original IS NOT NULL AND (page_id IS NULL OR page_id < original)")
    # At most FILE_RECORDS entries per file, for files written here.
    per_file = again.groupBy("path").agg(F.collect_list(F.struct("place", "original")).alias("again"))
    schema = pa.schema([("value", pa.binary())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[bytes]]:
            n = 0
            for batch in batches:
                for content, listed in zip(batch.column("content"), batch.column("again")):
                    original = {x["place"]: x["original"] for x in listed.as_py() or []}
                    for place, (fields, record) in enumerate(arc_records(content.as_py())):
                        if n % FILE_RECORDS == 0:
                            yield (_warcinfo(n),)
                        yield (converted(fields, record, original.get(place)),)
                        n += 1

        yield from _batches(rows(), schema)

    joined = _files(spark, arc_folder).join(per_file, "path", "left").select("content", "again")
    written = joined.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    written.write.options(lineSep="\r\n\r\n", maxRecordsPerFile=FILE_RECORDS + 1, **FAST).text(warc_folder)


def _warcinfo(n: int) -> bytes:
    block = b"software: marquee\r\nformat: WARC file version 1.1\r\n"
    name = uuid.uuid5(NAMESPACE, f"info/{n}")
    fields = [("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", _timestamp(CAPTURED)), ("Content-Type", "application/warc-fields")]
    return warc_record("warcinfo", fields, block)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in small letters) and block of each record of a WARC file."""
    stream = Stream(data)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while line := stream.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.lower()] = value.strip()
        yield fields, stream.take(int(fields["content-length"]))


WARC_COLUMNS = "record_id string, type string, date string, uri string, page_id long, digest string, refers_to string, bytes long"


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row per response and revisit of the folder's WARC files, with the payload if asked for.

    Digest and bytes of a response are those of the payload as read; a digest that differs from
    the declared one raises an error. A revisit has the declared digest and no bytes.
    """
    columns = WARC_COLUMNS + (", payload binary" if payloads else "")
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (c.split() for c in columns.split(", "))])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for content in batch.column("content"):
                    for f, block in warc_records(content.as_py()):
                        if f["warc-type"] not in ("response", "revisit"):
                            continue
                        page_id, _, payload = _page_of(block)
                        digest = f["warc-payload-digest"].removeprefix("sha1:")
                        whole = f["warc-type"] == "response"
                        if whole and base32_sha1(payload) != digest:
                            raise ValueError(f"the payload of {f['warc-record-id']} does not have its digest")
                        row = (
                            f["warc-record-id"], f["warc-type"], f["warc-date"], f["warc-target-uri"], page_id, digest,
                            f.get("warc-refers-to"), len(payload) if whole else None,
                        )
                        yield (*row, payload if whole else None) if payloads else row

        yield from _batches(rows(), schema)

    return _files(spark, folder).select("content").mapInArrow(parsed, columns)


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits looked up in their responses."""
    records = store_once(records, "warc-records")
    responses = records.where("type = 'response'")
    revisits = records.where("type = 'revisit'").select("page_id", "digest", "refers_to")
    # Repeated rows may share a record identifier.
    known = responses.groupBy("record_id").agg(F.first("page_id").alias("original"), F.first("bytes").alias("payload_bytes"))
    found = revisits.join(known, revisits.refers_to == known.record_id, "left")
    own = responses.select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    return own.unionByName(
        found.select(
            "page_id",
            "payload_bytes",
            F.col("digest").alias("payload_digest"),
            F.lit("revisit").alias("record_type"),
            F.col("original").alias("refers_to"),
        )
    )
