"""WARC packages: round trips, directories and ranges."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import struct
import zipfile
from collections import Counter

import pytest

from tideline.llm import warc
from tideline.session import scratch_path

PAGES = "page_id long, url string, html string, extra int"
LONG = "<p>" + "x" * 200


def test_round_trip(spark):
    rows = [
        (3, "http://a/", LONG, 1), (1, "http://b/", LONG, 2), (2, "http://c/\r\nX: y", LONG, 3), (4, None, "short", 4), (5, "u", "short", 5),
        (6, "u", None, 6), (None, "u", LONG, 7), (7, "é", "ü" * 100_000, 8), (None, "v", LONG + "!", 9), (None, "v", LONG + "!", 10),
        (8, "w", "a\r\n\r\nb" * 50, 11), (1, "http://b/", LONG, 12),
    ]
    folder = scratch_path(spark, "warc")
    packages = warc.write_packages(spark.createDataFrame(rows, PAGES).repartition(3), folder)
    got = Counter()
    for r in warc.read_packages(packages).collect():
        got[(r.id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)] += 1
        assert r.payload is None or hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    want = Counter()
    for key, _, html, _ in rows:
        data = (html or "").encode()
        first = min((k for k, _, h, _ in rows if h == html and k is not None), default=None)
        revisit = len(data) >= 100 and first is not None and key != first
        name = None if key is None else str(key)
        want[(name, "revisit" if revisit else "response", str(first) if revisit else None, len(data), hashlib.sha256(data).hexdigest())] += 1
    assert got == want
    listed = {(r.path.replace("file:", "").lstrip("/"), r.length) for r in warc.package_paths(spark, folder).collect()}
    assert {(r.path.replace("file:", "").lstrip("/"), r.length) for r in packages.collect()} <= listed
    urls = {r.url for r in warc.read_packages(warc.package_paths(spark, folder)).collect()}
    assert {"http://c/%0D%0AX: y", "é", None} <= urls


def test_nothing_written_nothing_read(spark):
    packages = warc.write_packages(spark.createDataFrame([], PAGES), scratch_path(spark, "warc"))
    assert warc.read_packages(packages).count() == 0
    assert warc.read_packages(packages.limit(0)).count() == 0


def test_slices_split_a_package(spark, monkeypatch):
    folder = scratch_path(spark, "warc")
    rows = [(i, "u", f"{i} " * 500, 0) for i in range(100)]
    packages = warc.write_packages(spark.createDataFrame(rows, PAGES).coalesce(1), folder)
    import pyarrow as pa

    (row,) = packages.collect()
    batch = pa.RecordBatch.from_pydict({"path": [row.path], "length": [row.length]})
    monkeypatch.setattr(warc, "SLICE", 2000)
    spans = [s for b in warc._slices(iter([batch])) for s in b.to_pylist()]
    assert len(spans) > 3 and sum(len(s["lengths"]) for s in spans) == 100


def package(**extra):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        with z.open("a/one", "w", force_zip64=extra.get("zip64", False)) as f:
            f.write(b"first")
        z.writestr(zipfile.ZipInfo("a/two"), b"packed" * 100, compress_type=zipfile.ZIP_DEFLATED)
        z.writestr("ü", b"third")
        z.comment = extra.get("comment", b"")
    return out.getvalue()


@pytest.mark.parametrize("extra", [{}, {"zip64": True}, {"comment": b"PK\x05\x06" + b"c" * 60_000}])
def test_members(extra):
    data = package(**extra)
    file = io.BytesIO(data)
    found = {m.name: m for m in warc.members(file, len(data))}
    assert list(found) == ["a/one", "a/two", "ü"]
    for name, content in (("a/one", b"first"), ("ü", b"third")):
        at = warc.data_offset(file, found[name])
        assert data[at : at + found[name].size] == content
    with pytest.raises(ValueError):
        warc.data_offset(file, found["a/two"])


def test_zip64_directory():
    """Every field at its limit: sizes, offset and the directory's place come from ZIP64 records."""
    name, content = b"big", b"stored bytes"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, 20)
    local += name + struct.pack("<2H2Q", 1, 16, len(content), len(content))
    body = b"prefix" + local + content
    central = struct.pack(
        "<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, 28 + 8, 0, 0, 0, 0, 0xFFFFFFFF
    )
    central += name + struct.pack("<2HI", 0x7777, 4, 9) + struct.pack("<2H3Q", 1, 24, len(content), len(content), 6)
    place = len(body)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), place)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, place + len(central), 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = body + central + end64 + locator + end
    (member,) = warc.members(io.BytesIO(data), len(data))
    assert (member.name, member.size, member.header) == ("big", len(content), 6)
    at = warc.data_offset(io.BytesIO(data), member)
    assert data[at : at + member.size] == content


def test_damage_is_an_error():
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(b"no package" * 10), 100)
    import gzip

    good = warc.record_bytes("1", "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False)
    assert warc.parse_record(good)[6] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(gzip.compress(gzip.decompress(good).replace(b"payload\r\n", b"pAyload\r\n")))


def test_records_are_as_the_standards_say(spark):
    """Mandatory headers, a sorted index with key and timestamp, revisits that name the record they revisit."""
    folder = scratch_path(spark, "warc")
    rows = [(i, f"https://www.Example.org:80/{p}", h, 0) for i, (p, h) in enumerate([("b", LONG), ("a?x=1 2", LONG), ("c", "other " * 50)])]
    packages = warc.write_packages(spark.createDataFrame(rows, PAGES).coalesce(1), folder)
    (row,) = packages.collect()
    with zipfile.ZipFile(row.path.removeprefix("file:")) as package:
        lines = package.read(warc.INDEX).decode().splitlines()
        data = package.read(warc.ARCHIVE)
    assert lines == sorted(lines) and [line.split(" ")[0] for line in lines] == ["org,example,www)/a?x=1%202", "org,example,www)/b", "org,example,www)/c"]
    for line in lines:
        _, stamp, entry = line.split(" ", 2)
        entry = json.loads(entry)
        assert re.fullmatch(r"\d{14}", stamp) and set(entry) == {"url", "mime", "status", "digest", "length", "offset", "filename"}
        head = gzip.decompress(data[entry["offset"] : entry["offset"] + entry["length"]]).split(b"\r\n\r\n")[0].decode()
        fields = dict(h.split(": ", 1) for h in head.split("\r\n")[1:])
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
    read = {r.id: r for r in warc.read_packages(packages).collect()}
    assert read["1"].record_type == "revisit" and read["1"].refers_to_record == read["0"].record_id
    assert len({r.record_id for r in read.values()}) == 3


def test_packages_of_other_writers(spark, tmp_path):
    """Two archives, two indexes of other names, one of them gzip; records that are not ours."""

    def record(kind, block, content="application/http; msgtype=response", **more):
        head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:x>", "WARC-Date: 2020-01-01T00:00:00Z", f"Content-Type: {content}"]
        head += [f"{k.replace('_', '-')}: {v}" for k, v in more.items()] + [f"Content-Length: {len(block)}"]
        return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    info = record("warcinfo", b"software: x\r\n", "application/warc-fields")
    one = record("response", http + b"one", WARC_Target_URI="http://a/", WARC_Payload_Digest="sha1:ABC")
    two = record("response", http + b"two", WARC_Target_URI="http://b/")
    again = record("revisit", http, WARC_Target_URI="http://c/", WARC_Refers_To="<urn:uuid:x>")
    first = f'com,a)/ 2020 {{"offset": "{len(info)}", "length": "{len(one)}", "filename": "rec-0001.warc.gz"}}\n'
    first += f'{{"offset": 0, "length": {len(info)}, "filename": "rec-0001.warc.gz"}}'
    second = f'!meta 0\ncom,b)/ 2020 {{"offset": 0, "length": {len(two)}, "filename": "more/rec.warc.gz"}}\n'
    third = f'com,c)/ 2020 {{"offset": {len(two) + 5}, "length": {len(again)}, "filename": "more/rec.warc.gz"}}\n'
    with zipfile.ZipFile(tmp_path / "foreign.wacz", "w") as package:
        package.writestr("archive/rec-0001.warc.gz", info + one)
        package.writestr("archive/more/rec.warc.gz", two + b"?????" + again)
        package.writestr("indexes/a.cdxj", first)
        package.writestr("indexes/b.cdx.gz", gzip.compress(second.encode()) + gzip.compress(third.encode()))
        package.writestr("pages/pages.jsonl", "{}")
    got = warc.read_packages(warc.package_paths(spark, str(tmp_path))).collect()
    found = {(r.url, r.record_type, None if r.payload is None else bytes(r.payload), r.id) for r in got}
    assert found == {
        (None, "warcinfo", b"software: x\r\n", None), ("http://a/", "response", b"one", None),
        ("http://b/", "response", b"two", None), ("http://c/", "revisit", None, None),
    }
    assert {r.payload_digest for r in got if r.url == "http://a/"} == {hashlib.sha256(b"one").hexdigest()}
    with zipfile.ZipFile(tmp_path / "foreign.wacz", "a") as package:
        package.writestr("indexes/c.cdxj", '{"offset": 0, "length": 1, "filename": "gone.warc.gz"}')
    with pytest.raises(Exception, match="gone.warc.gz"):
        warc.read_packages(warc.package_paths(spark, str(tmp_path))).collect()
