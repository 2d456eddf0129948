"""Web archives in ZIP packages: written by the tasks, and read by ranges without extraction.

A package is a ZIP file of stored members: ``archive/data.warc.gz`` with one gzip member per WARC record, and ``indexes/index.cdxj``
with one line per record. The reader takes a package apart from its end: end record, ZIP64 locator and record, central
directory, the local header of a member, then only the byte ranges that the index names. Files are opened through
``pyarrow.fs``, so the folder may be in any store that it reaches.

Tasks write packages of about ``PACKAGE_BYTES`` under names of their own and report them in a manifest table; only what a committed
task reported is read, so a repeated or lost task leaves at most a file nobody knows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, work_dir

PACKAGE_BYTES = 64 << 20
#: Records are read in ranges of about so many bytes.
RANGE_BYTES = 1 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "package string, n_records long, n_bytes long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _open_in(path: str):
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _header(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str | None) -> int | None:
    found = re.search(r"urn:x-page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the response's headers, and so the payload's length, but no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", "WARC-Date: 2024-01-01T00:00:00Z"]
    lines += [f"WARC-Target-URI: {_header(url)}"] if url is not None else []
    lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one WARC record; the digest of a payload that is there must be the one declared."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http + b"\r\n")[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = headers["WARC-Type"] == "response"
    if whole and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return {
        "page_id": _page_of(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"), "record_type": headers["WARC-Type"],
        "refers_to": _page_of(headers.get("WARC-Refers-To")), "payload_digest": digest, "payload_bytes": size, "payload": payload if whole else None,
    }


class _Package:
    """One package being written."""

    def __init__(self, folder: str):
        self.path = f"{folder}/package-{uuid.uuid4().hex}.wacz"
        store, name = fs.FileSystem.from_uri(self.path)
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.file = store.open_output_stream(name)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines, self.at = [], 0

    def add(self, page_id: int | None, url: str | None, member: bytes) -> None:
        self.data.write(member)
        host = ",".join(reversed((urlsplit(url or "").netloc if "[" not in (url or "") else "").split(".")))
        self.lines.append(f"{_header(host) or '-'} 20240101000000 " + json.dumps({"offset": self.at, "length": len(member), "filename": "data.warc.gz", "page": page_id}))
        self.at += len(member)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(sorted(self.lines)) + "\n")
        self.zip.close()
        self.file.close()
        return self.path, len(self.lines), self.at


def _writer(folder: str, package_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit"))):
                package = package or _Package(folder)
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), revisit.as_py())
                package.add(page_id.as_py(), url.as_py(), gzip.compress(data, 1, mtime=0))
                if package.at >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["package", "n_records", "n_bytes"])

    return write


def write_packages(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id long, url, html) and returns the manifest: package, n_records, n_bytes.

    Of records with equal payloads of at least ``min_revisit_bytes`` bytes the one with the largest page_id is a response
    and the others are revisits of it. A null html is an empty payload. Rows that repeat a page_id and its payload are treated alike; a row without
    page_id is never the response another one refers to, and a response if all its equals have none. Other columns are ignored; an empty table
    gives no package.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    # decide on ids and digests; pages move once, and only to meet what was decided
    slim = materialize(rows.filter(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "digest"))
    groups = slim.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    revisits = slim.join(groups, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
    revisits = revisits.withColumnsRenamed({"page_id": "r_page_id", "digest": "r_digest"})
    decided = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_page_id")) & (F.col("digest") == F.col("r_digest")), "left")
    out = decided.select("page_id", "url", "payload", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    return materialize(out.mapInArrow(_writer(folder, package_bytes), MANIFEST))


def central_directory(file) -> dict[str, tuple[int, int]]:
    """Name to (offset of the local header, size) of all members of an open ZIP file; they must be stored."""
    size = file.size()
    tail = file.read_at(min(size, 65_557), max(0, size - 65_557))
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HLL", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        (at,) = struct.unpack_from("<Q", tail, end - 12)
        count, length, offset = struct.unpack_from("<QQQ", file.read_at(56, at), 32)
    directory, at, members = file.read_at(length, offset), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, packed, whole = *struct.unpack_from("<H", directory, at + 10), *struct.unpack_from("<LL", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        (local,) = struct.unpack_from("<L", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra, i = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while i + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, i)
            if kind == 1:  # ZIP64: only the fields that did not fit, in this order
                wide, k = list(struct.unpack_from(f"<{n // 8}Q", extra, i + 4)), 0
                if whole == 0xFFFFFFFF:
                    whole, k = wide[k], k + 1
                if packed == 0xFFFFFFFF:
                    packed, k = wide[k], k + 1
                if local == 0xFFFFFFFF:
                    local = wide[k]
            i += 4 + n
        if method:
            raise ValueError(f"member {name} is compressed")
        members[name] = (local, whole)
        at += 46 + n_name + n_extra + n_comment
    return members


def member_range(file, members: dict[str, tuple[int, int]], name: str) -> tuple[int, int]:
    """Where a stored member's bytes are: (offset, size)."""
    local, size = members[name]
    n_name, n_extra = struct.unpack_from("<HH", file.read_at(30, local), 26)
    return local + 30 + n_name + n_extra, size


def _list_ranges(range_bytes: int):
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("package").to_pylist():
                with _open_in(path) as file:
                    members = central_directory(file)
                    base, _ = member_range(file, members, DATA)
                    index = file.read_at(*reversed(member_range(file, members, INDEX))).decode()
                entries = sorted((e["offset"], e["length"]) for e in (json.loads(line.split(" ", 2)[2]) for line in index.splitlines() if line))
                out, start = [], 0
                for i in range(1, len(entries) + 1):
                    if i == len(entries) or entries[i][0] - entries[start][0] >= range_bytes:
                        out.append((path, base + entries[start][0], [e[1] for e in entries[start:i]]))
                        start = i
                if out:
                    path_, offset, lengths = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(path_), pa.array(offset, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))], names=["package", "offset", "lengths"])

    return ranges


def _read_ranges(with_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset, lengths in zip(*(batch.column(c).to_pylist() for c in ("package", "offset", "lengths"))):
                with _open_in(path) as file:
                    data = file.read_at(sum(lengths), offset)
                rows, at = [], 0
                for n in lengths:
                    rows.append(parse_record(zlib.decompress(data[at : at + n], 31)))
                    at += n
                if not with_payload:
                    for row in rows:
                        row["payload"] = None
                yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_packages(manifest: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the packages named by ``manifest`` (package): page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload.

    A revisit has no payload of its own. A damaged package or record fails the job.
    """
    ranges = materialize(manifest.select("package").repartition(max(1, manifest.count())).mapInArrow(_list_ranges(range_bytes), "package string, offset long, lengths array<long>"))
    dealt = ranges.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInArrow(_read_ranges(with_payload), RECORD)


def op1_zip_warc(spark: SparkSession, sf: str) -> DataFrame:
    """All pages written to packages and read back."""
    folder = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = write_packages(spark.read.parquet(f"{sf}/pages.parquet"), folder)
    return read_packages(manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP1_SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS best FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda k: substr('{_LETTERS}', CAST(1 + ((CAST('0x' || substr(p.h || '0', CAST(5 * k // 4 + 1 AS BIGINT), 3) AS INTEGER) >> CAST(7 - 5 * k % 4 AS INTEGER)) & 31) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to, url
FROM p JOIN g ON p.h = g.h
"""
