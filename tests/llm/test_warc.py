import base64
import gzip
import hashlib
import struct
import zipfile

import pytest

from broadsheet.llm.warc import DATA, INDEX, central_directory, member_range, parse_record, read_packages, record, write_packages


class Bytes:
    """A file in memory."""

    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


PAGES = "page_id long, url string, html string, digest string, revisit string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    best = {}
    for i, _, html in rows:
        if i is not None:
            best[html or ""] = max(i, best.get(html or "", i))
    out = []
    for i, _, html in rows:
        to = best.get(html or "")
        revisit = to is not None and i != to
        out.append((i, len((html or "").encode()), digest(html), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_write_and_read(spark, tmp_path):
    rows = [(1, "http://a.example/x y\r\nEvil: 1", "<p>é</p>"), (2, None, None), (3, "http://[bad/", ""), (4, "u", "<p>é</p>"), (5, "u", "\r\n\r\n"), (6, "u", "x" * 3_000_000)]
    rows += [(7, "u", "same"), (7, "u", "same"), (None, "u", "same"), (None, "u", "only without id"), (8, "u", "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
    manifest = write_packages(pages, str(tmp_path / "w"), package_bytes=2000)
    assert manifest.count() >= 2
    got = read_packages(manifest, range_bytes=100).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[6].payload == b"x" * 3_000_000 and by_id[5].payload == b"\r\n\r\n" and by_id[2].payload is None
    assert by_id[1].url == "http://a.example/x%20y%0D%0AEvil:%201" and by_id[2].url is None
    assert write_packages(pages.limit(0), str(tmp_path / "e")).collect() == []
    assert read_packages(write_packages(pages.limit(0), str(tmp_path / "e"))).collect() == []
    # below the limit all are responses
    few = read_packages(write_packages(pages, str(tmp_path / "m"), min_revisit_bytes=1000)).collect()
    assert {r.record_type for r in few} == {"response"}


def test_package_is_a_plain_zip(spark, tmp_path):
    manifest = write_packages(spark.createDataFrame([(i, f"http://h{i}.example/", f"page {i}", "", "") for i in range(9)], PAGES), str(tmp_path / "w"))
    path = manifest.first().package
    with zipfile.ZipFile(path) as z:
        assert z.namelist() == [DATA, INDEX] and z.testzip() is None
        assert gzip.decompress(z.read(DATA)).count(b"WARC/1.1\r\n") == manifest.first().n_records
    with open(path, "rb") as f:
        file = Bytes(f.read())
    members = central_directory(file)
    at, size = member_range(file, members, DATA)
    assert gzip.decompress(file.data[at : at + size]).startswith(b"WARC/1.1")
    damaged = Bytes(file.data[:-30])
    with pytest.raises(ValueError):
        central_directory(damaged)


def test_zip64_directory():
    # one stored member whose sizes and offset stand in the ZIP64 extra field, and a ZIP64 end record
    local = struct.pack("<4sHHHHHLLLHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 5, 5, 1, 0) + b"a" + b"hello"
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = struct.pack("<4sHHHHHHLLLHHHHHLL", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + b"a" + extra
    at = len(local)
    end64 = struct.pack("<4sQHHLLQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sLQL", b"PK\x06\x07", 0, at + len(entry), 1)
    end = struct.pack("<4sHHHHLLH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    file = Bytes(local + entry + end64 + locator + end)
    members = central_directory(file)
    assert members == {"a": (0, 5)}
    assert file.read_at(*reversed(member_range(file, members, "a"))) == b"hello"


def test_damaged_record():
    data = record(1, "u", b"payload", None, False)
    assert parse_record(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        parse_record(data.replace(b"payload\r\n", b"paXload\r\n"))
