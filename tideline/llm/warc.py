"""WARC records in ZIP packages: written by tasks, read back by ranges without extraction."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import save, slices, text_of

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Texts below this many bytes are never written as revisits.
LEAST_BYTES = 100
# Compressed bytes that one reading task item covers.
SLICE = 8 << 20
_EOCD, _ZIP64_LOCATOR, _ZIP64_EOCD, _CENTRAL, _LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there.

    Tasks reach the folder through pyarrow, so it must be one that pyarrow opens: a shared mount,
    HDFS, S3 or GCS.
    """
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", uri):
        uri = re.sub("^file:/+", "file:///", uri)
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


# -- the package


@dataclass(frozen=True)
class Member:
    """A stored or compressed file in the package; ``header`` is where its local header begins."""

    name: str
    method: int
    size: int
    packed: int
    header: int


def _directory_place(file, length: int) -> tuple[int, int]:
    """Offset and size of the central directory, from the end records (ZIP64 where it is needed)."""
    tail = min(length, 22 + 0xFFFF + 20)
    file.seek(length - tail)
    end = file.read(tail)
    at = end.rfind(_EOCD)
    while at >= 0:  # a comment may hold the signature: the record must end where the file does
        if at + 22 <= len(end) and at + 22 + struct.unpack_from("<H", end, at + 20)[0] == len(end):
            break
        at = end.rfind(_EOCD, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    entries, size, offset = struct.unpack_from("<HII", end, at + 10)
    if at >= 20 and end[at - 20 : at - 16] == _ZIP64_LOCATOR and (
        entries == 0xFFFF or size == 0xFFFFFFFF or offset == 0xFFFFFFFF
    ):
        (place,) = struct.unpack_from("<Q", end, at - 12)
        file.seek(place)
        record = file.read(56)
        if record[:4] != _ZIP64_EOCD:
            raise ValueError("no ZIP64 end of central directory")
        size, offset = struct.unpack_from("<QQ", record, 40)
    return offset, size


def members(file, length: int) -> list[Member]:
    """The package's members from its central directory, ZIP64 fields included. Nothing else is read."""
    offset, size = _directory_place(file, length)
    file.seek(offset)
    directory, at, found = file.read(size), 0, []
    while at + 46 <= len(directory) and directory[at : at + 4] == _CENTRAL:
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name]
        extra, end = at + 46 + n_name, at + 46 + n_name + n_extra
        while extra + 4 <= end:
            kind, n = struct.unpack_from("<HH", directory, extra)
            if kind == 1:  # the 64-bit values of the fields above that are all ones, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", directory, extra + 4))
                if full == 0xFFFFFFFF:
                    full = wide.pop(0)
                if packed == 0xFFFFFFFF:
                    packed = wide.pop(0)
                if header == 0xFFFFFFFF:
                    header = wide.pop(0)
            extra += 4 + n
        found.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, full, packed, header))
        at = end + n_comment
    return found


def data_offset(file, member: Member) -> int:
    """Where a stored member's bytes begin: behind its local header, whose own lengths count."""
    if member.method:
        raise ValueError(f"{member.name} is compressed: it can't be read by ranges")
    file.seek(member.header)
    local = file.read(30)
    if local[:4] != _LOCAL:
        raise ValueError(f"no local header for {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n_name + n_extra


# -- records


def _header_value(value: str) -> str:
    """Header lines end at CR LF, so these and NUL are percent-encoded (not reversed on reading)."""
    return re.sub(r"[\r\n\0]", lambda m: f"%{ord(m[0]):02X}", value)


def record_id(run: str, digest: str, key: str | None) -> str:
    """The id of the record of a page in one run: known to the revisits of a payload without looking it up."""
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(run), f'{digest}/{key}')}>"


def record_bytes(
    key: str | None, uri: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool,
    run: str = str(uuid.NAMESPACE_URL), date: str = "1970-01-01T00:00:00Z",
) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit has the HTTP head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    # Only the first record of a payload is referred to, and only pages with an id can be first.
    own = record_id(run, digest, key) if key is not None and not revisit else f"<urn:uuid:{uuid.uuid4()}>"
    lines += [f"WARC-Record-ID: {own}", f"WARC-Date: {date}"]
    if key is not None:
        lines.append(f"WARC-Page-ID: {_header_value(key)}")
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_header_value(uri)}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines.append(f"WARC-Profile: {_PROFILE}")
        if refers_to is not None:
            lines.append(f"WARC-Refers-To: {record_id(run, digest, refers_to)}")
            lines.append(f"WARC-Refers-To-Page-ID: {_header_value(refers_to)}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def sort_key(uri: str | None) -> str:
    """The key of an index line: the host's labels from the last one on, then the path, in lower case."""
    if uri is None:
        return "-"
    host, slash, path = _header_value(uri).partition("://")[2].partition("/")
    return f"{','.join(host.split(':')[0].split('.')[::-1])}){slash}{path}".lower().replace(" ", "%20")


def index_line(uri: str | None, date: str, digest: str, offset: int, length: int, revisit: bool) -> str:
    """A CDXJ line: sort key, 14-digit timestamp, JSON."""
    entry = {
        "url": uri, "mime": "warc/revisit" if revisit else "text/html", "status": "200", "digest": f"sha256:{digest}",
        "length": length, "offset": offset, "filename": ARCHIVE.rpartition("/")[2],
    }
    return f"{sort_key(uri)} {re.sub('[^0-9]', '', date)} {json.dumps(entry)}"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(data: bytes) -> tuple:
    """(page id, uri, type, refers to, payload bytes, digest, payload or None, record id, referred record) of one gzip member.

    The payload of an HTTP response or request is what follows its head, that of other records the whole block.
    It is hashed: a SHA-256 digest or a length of ours that differs is an error. A revisit has no payload of its own;
    its size and digest are those its headers give, null where they give none.
    """
    text = gzip.decompress(data)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    kind, stated = fields["warc-type"], fields.get("warc-payload-digest", "")
    http = fields.get("content-type", "").startswith("application/http")
    http_head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    size = _fields(http_head).get("content-length")
    stated = stated.removeprefix("sha256:") if stated.startswith("sha256:") else None
    if kind == "revisit":
        size, digest, payload = None if size is None else int(size), stated, None
    else:
        digest = hashlib.sha256(payload).hexdigest()
        if stated not in (None, digest) or ("warc-page-id" in fields and size is not None and int(size) != len(payload)):
            raise ValueError(f"payload of record {fields.get('warc-record-id')} differs from its headers")
        size = len(payload)
    return (
        fields.get("warc-page-id"), fields.get("warc-target-uri"), kind, fields.get("warc-refers-to-page-id"),
        size, digest, payload, fields.get("warc-record-id"), fields.get("warc-refers-to"),
    )


# -- writing


def _with_first(pages: DataFrame) -> DataFrame:
    """(id, url, payload) with the payload's digest and, for copies, the id that they revisit."""
    rows = pages.withColumn("digest", F.sha2("payload", 256))
    slim = rows.where(F.octet_length("payload") >= LEAST_BYTES).groupBy("digest")
    first = slim.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    # Payloads and repeated digests meet as plain scans: AQE splits a hot digest.
    first = save(first, "warc-first")
    return rows.join(first, "digest", "left")


def write_packages(
    pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One WARC record per row, in ZIP packages below ``folder``; returns (path, length, records).

    Each task streams its records into one package: the WARC file and its index are stored
    members, so both can be read by ranges. Files have random names and count only if the returned
    rows, written as a table, name them: a lost or repeated attempt leaves a file nobody reads.

    Of equal payloads of ``LEAST_BYTES`` or more the row with the smallest id is a response, the
    others revisit it. Shorter ones are all responses; a null payload is empty. Rows that share the
    smallest id are all responses (and of one record id). A null id is never the smallest; where a group has no other,
    all its rows are responses. The records' date is that of the call.
    """
    base, run = folder.rstrip("/"), str(uuid.uuid4())
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(base)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        index, at = [], 0
        with store.open_output_stream(f"{root}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
            with package.open(ARCHIVE, "w", force_zip64=True) as archive:
                for batch in slices(batches):
                    columns = [batch.column(c).to_pylist() for c in ("id", "url", "digest", "first")]
                    for key, uri, digest, first, value in zip(*columns, batch.column("payload")):
                        revisit = first is not None and key != first
                        record = record_bytes(key, uri, value.as_py(), digest, first, revisit, run, date)
                        archive.write(record)
                        index.append(index_line(uri, date, digest, at, len(record), revisit))
                        at += len(record)
            with package.open(INDEX, "w", force_zip64=True) as listing:
                for line in sorted(index):
                    listing.write(line.encode() + b"\n")
            package.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}))
        length = store.get_file_info(f"{root}/{name}").size
        yield pa.RecordBatch.from_pydict({"path": [f"{base}/{name}"], "length": [length], "records": [len(index)]})

    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        text_of(html).cast("binary").alias("payload"),
    )
    ready = _with_first(rows).select(
        F.col("id").cast("string").alias("id"), "url", "payload", "digest", F.col("first").cast("string").alias("first")
    )
    return save(ready.mapInArrow(write, "path string, length bigint, records bigint"), "warc-packages")


# -- reading


def package_paths(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the packages below a folder, listed by Spark; no content is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.wacz").load(folder)
    return listed.select("path", "length")


def _index_lines(file, index: Member) -> Iterator[bytes]:
    """The lines of an index member, stored plainly or as gzip, read block by block."""
    file.seek(data_offset(file, index))
    unpack = zlib.decompressobj(zlib.MAX_WBITS | 16) if index.name.endswith(".gz") else None
    left, rest = index.size, b""
    while left:
        block = file.read(min(left, 1 << 20))
        left -= len(block)
        more = b""
        while unpack is not None and block:  # gzip members may follow each other
            more += unpack.decompress(block)
            block = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(zlib.MAX_WBITS | 16)
        *lines, rest = (rest + (more if unpack is not None else block)).split(b"\n")
        yield from lines
    yield rest


def record_places(file, length: int) -> dict[str, list[tuple[int, int]]]:
    """Of each archive of a package the (offset, length) of its records, in order, by its indexes.

    Indexes are the members below ``indexes/``: CDXJ lines (or JSON alone), whose ``filename`` names the
    archive below ``archive/``. Records that several indexes list count once.
    """
    found, by_name = {}, {m.name: m for m in members(file, length)}
    for name, member in by_name.items():
        if not re.fullmatch(r"indexes/.*\.(cdxj?|json)(\.gz)?", name):
            continue
        for line in _index_lines(file, member):
            at = line.find(b"{")
            if at < 0:
                continue  # an empty line or a header
            entry = json.loads(line[at:])
            archive = f"archive/{entry['filename']}"
            if archive not in by_name:
                raise ValueError(f"{name} names {archive}, which is not in the package")
            found.setdefault(archive, set()).add((int(entry["offset"]), int(entry["length"])))
    return {archive: sorted(places) for archive, places in found.items()}


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From packages to spans of adjacent records of about ``SLICE`` bytes, with the record lengths in them."""
    names = ["path", "start", "lengths"]
    types = [pa.string(), pa.int64(), pa.list_(pa.int64())]
    for batch in batches:
        for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, place = open_store(path)
            with store.open_input_file(place) as file:
                by_name = {m.name: m for m in members(file, length)}
                for archive, places in sorted(record_places(file, length).items()):
                    base, found = data_offset(file, by_name[archive]), []
                    for offset, size in places:
                        if not found or offset != end or end + size - begin > SLICE:
                            begin = offset
                            found.append((path, base + offset, []))
                        found[-1][2].append(size)
                        end = offset + size
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)


_RECORD = [
    ("id", "string"), ("url", "string"), ("record_type", "string"), ("refers_to", "string"), ("payload_bytes", "bigint"),
    ("payload_digest", "string"), ("payload", "binary"), ("record_id", "string"), ("refers_to_record", "string"),
]


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [name for name, _ in _RECORD]
    types = [pa.int64() if sql == "bigint" else pa.binary() if sql == "binary" else pa.string() for _, sql in _RECORD]
    for batch in batches:
        for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
            store, place = open_store(path)
            out, size = [], 0
            with store.open_input_file(place) as file:
                file.seek(start)
                for length in lengths:
                    out.append(parse_record(file.read(length)))
                    size += out[-1][4] or 0
                    if size > SLICE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def read_packages(packages: DataFrame, parts: int | None = None) -> DataFrame:
    """All records of the packages (path, length): id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for a revisit), record_id, refers_to_record.

    First the directories and indexes are read, by ranges; then spans of records of about
    ``SLICE`` bytes are dealt out, so a large package is read by many tasks. Packages may hold any number of
    archives and indexes, of any name, also from other writers: ``id`` and ``refers_to`` are those of our own
    pages, null for others. Archives must be stored, not compressed, in the package, and their records gzip
    members. Digests that are given as SHA-256 are verified. No packages, no rows.
    """
    spark = packages.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = packages.select("path", "length").repartition(parts)
    spans = listed.mapInArrow(_slices, "path string, start bigint, lengths array<bigint>").repartition(parts)
    return spans.mapInArrow(_records, ", ".join(f"{name} {sql}" for name, sql in _RECORD))
