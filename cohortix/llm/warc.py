"""WARC records in ZIP packages: writer and reader.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, one gzip member
a record, ``indexes/index.cdxj``, a line a record with its offset and length, and ``datapackage.json``.
The reader takes byte ranges of a package: the end records, plain and ZIP64, the central directory,
the members' local headers, the index, and then each record by itself. Nothing is extracted.

Packages lie in the shared folder. A task writes a package of its own name and Spark keeps the names
of those tasks that ended well, so a task that runs twice leaves an unread file at worst.

Defined results: a null or empty payload is a record of no bytes. Rows of one payload revisit the one
with the largest id. Rows that repeat that id and payload are responses too. Null ids come before all others. Extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_dir, small, texts_of

DATE = "2000-01-01T00:00:00Z"
#: Tasks that read packages, at most; a task reads one package after another.
READERS = 20_000
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"


def _fs(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address if "://" in address else address.replace("file:/", "file:///", 1))


def visible(url: str | None) -> str:
    """The URL with all but visible ASCII characters percent-encoded, so that it breaks no line."""
    return quote(url or "", safe="".join(map(chr, range(0x21, 0x7F))))


def name_of(page_id) -> str:
    """A record's name. Ids are percent-encoded, a null id has none."""
    return "urn:cohortix:page:" + ("" if page_id is None else "=" + quote(str(page_id), safe=""))


def id_of(name: str) -> str | None:
    end = name.strip("<>").rpartition(":")[2]
    return unquote(end[1:]) if end else None


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing ----------------------------------------------------------------------------------


def record(kind: str, record_id: str, url: str, payload: bytes, payload_digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record, uncompressed. A revisit carries no payload but its digest and target."""
    uri = visible(url) or "urn:none"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gz(data: bytes, level: int = 4) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Package:
    """A package being written: members are stored one after another, the index comes last."""

    def __init__(self, address: str):
        self.address = address
        fs, path = _fs(address)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, raw: bytes, fields: dict) -> None:
        data = gz(raw)
        self.member.write(data)
        self.lines.append(f"{fields['urlkey']} 20000101000000 " + json.dumps({k: v for k, v in fields.items() if k != "urlkey"} | {"offset": self.size, "length": len(data), "filename": DATA}))
        self.size += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(sorted(self.lines)) + "\n")
        self.zip.writestr(zipfile.ZipInfo(PACKAGE), json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [{"path": DATA}, {"path": INDEX}]}))
        self.zip.close()
        self.out.close()


def write_packages(rows: DataFrame, folder: str, roll: int = 64 << 20) -> DataFrame:
    """Write (page_id, url, payload, digest, main, is_main) and return (package, records).

    ``digest`` is the payload's SHA-1 in hex; ``main`` the id of its response, which has ``is_main``.
    A package is closed at ``roll`` bytes, so neither a package nor its index outgrows a task.
    """

    def go(it):
        made, pack, n = [], None, 0
        for b in it:
            cols = b.to_pydict()
            for i, u, t, d, m, first in zip(cols["page_id"], cols["url"], texts_of(b.column("payload")), cols["digest"], cols["main"], cols["is_main"], strict=True):
                if pack is None:
                    pack, n = Package(f"{folder}/{uuid.uuid4().hex}.wacz"), 0
                kind = "response" if first else "revisit"
                raw = record(kind, name_of(i), u, t, base64.b32encode(bytes.fromhex(d)).decode(), None if first else name_of(m))
                pack.add(raw, {"urlkey": visible(u) or "-", "id": i, "payload_bytes": len(t)})
                n += 1
                if pack.size >= roll:
                    pack.close()
                    made.append((pack.address, n))
                    pack = None
        if pack is not None:
            pack.close()
            made.append((pack.address, n))
        yield pa.RecordBatch.from_pydict({"package": [a for a, _ in made], "records": pa.array([n for _, n in made], pa.int64())}, schema=pa.schema([("package", pa.string()), ("records", pa.int64())]))

    return rows.mapInArrow(go, "package string, records long")


# ---- reading ----------------------------------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    size: int  # as it lies in the file
    header: int  # offset of the local header


class ZipRanges:
    """A ZIP file behind ``read(offset, length)``: members are located, never extracted."""

    def __init__(self, size: int, read):
        self.size, self.read = size, read
        self.members = {m.name: m for m in self._central()}

    def _central(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 65_557)  # the end record and the longest comment
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] > len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        count, length, offset = struct.unpack_from("<HII", tail, at + 10)
        where = tail_at + at - 20
        if where >= 0 and (loc := self.read(where, 20))[:4] == b"PK\x06\x07":
            end = self.read(struct.unpack_from("<Q", loc, 8)[0], 56)
            if end[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, length, offset = struct.unpack_from("<QQQ", end, 32)
        data, p = self.read(offset, length), 0
        for _ in range(count):
            if data[p : p + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, p + 8)
            packed, full, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", data, p + 20)
            header = struct.unpack_from("<I", data, p + 42)[0]
            name = data[p + 46 : p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra, e = data[p + 46 + n_name : p + 46 + n_name + n_extra], 0
            while e + 4 <= len(extra):
                tag, n = struct.unpack_from("<HH", extra, e)
                if tag == 1:  # values that did not fit, in this order
                    q = e + 4
                    got = []
                    for v in (full, packed, header):
                        if v == 0xFFFFFFFF:
                            got.append(struct.unpack_from("<Q", extra, q)[0])
                            q += 8
                        else:
                            got.append(v)
                    full, packed, header = got
                e += 4 + n
            yield Member(name, method, packed, header)
            p += 46 + n_name + n_extra + n_note

    def start(self, name: str) -> int:
        """Where a stored member's bytes begin, from its local header."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed, so its bytes can't be read by range")
        head = self.read(m.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))

    def range(self, name: str, offset: int, length: int) -> bytes:
        if offset < 0 or offset + length > self.members[name].size:
            raise ValueError("range outside the member")
        return self.read(self.start(name) + offset, length)

    def whole(self, name: str) -> bytes:
        return self.range(name, 0, self.members[name].size)


def open_package(address: str) -> tuple[ZipRanges, io.IOBase]:
    fs, path = _fs(address)
    f = fs.open_input_file(path)
    return ZipRanges(f.size(), lambda at, n: f.read_at(n, at)), f


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record; digests and length are verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record length is wrong")
    if (said := fields.get("warc-block-digest")) and said != f"sha1:{digest(block)}":
        raise ValueError("block digest is wrong")
    return fields, block


def records(address: str, near: int = 4 << 20) -> Iterator[tuple[dict, dict[str, str], bytes]]:
    """(index entry, header fields, block) of every record that a package's index lists.

    Records are read in the order of their offsets; neighbours share a range of up to ``near`` bytes.
    """
    z, f = open_package(address)
    with f:
        entries = sorted((json.loads(line.split(" ", 2)[2]) for line in z.whole(INDEX).decode().split("\n") if line), key=lambda e: (e["filename"], e["offset"]))
        at, held, name = 0, b"", None
        for e in entries:
            if e["filename"] != name or e["offset"] + e["length"] > at + len(held):
                name, at = e["filename"], e["offset"]
                held = z.range(name, at, max(e["length"], min(near, z.members[name].size - at)))
            data = held[e["offset"] - at : e["offset"] - at + e["length"]]
            yield e, *parse_record(zlib.decompress(data, 31))


def read_packages(packages: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records of ``packages``.

    A response's payload is digested again; what its header says must agree.
    """
    number = id_type != "string"
    schema = pa.schema([("page_id", pa.int64() if number else pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64() if number else pa.string())])

    def ident(v: str | None):
        v = v and id_of(v)
        return int(v) if number and v is not None else v

    def go(it):
        for b in it:
            for address in b.column(0).to_pylist():
                held: list[tuple] = []
                for e, fields, block in records(address):
                    said = fields["warc-payload-digest"].removeprefix("sha1:")
                    payload = block.partition(b"\r\n\r\n")[2]
                    if fields["warc-type"] == "response" and (digest(payload) != said or len(payload) != e["payload_bytes"]):
                        raise ValueError("payload digest is wrong")
                    held.append((ident(fields["warc-record-id"]), e["payload_bytes"], said, fields["warc-type"], ident(fields.get("warc-refers-to"))))
                    if len(held) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    kind = "string" if not number else "bigint"
    return packages.select("package").mapInArrow(go, f"page_id {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}")


def archive_and_read(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Write a record for every row, read all packages back and return what they say.

    Of equal payloads of at least ``least`` bytes the row with the largest id is the response and the
    others revisit it; smaller ones are all responses. The digest decides equality.
    """
    where = shared_dir(pages.sparkSession)
    own = dict(pages.dtypes)[page_id]
    kind = "bigint" if own in ("tinyint", "smallint", "int", "bigint") else "string"
    said = (lambda c: F.hex(c)) if own == "binary" else (lambda c: F.col(c).cast(kind))
    rows = pages.select(F.col(page_id).alias("own_id"), F.col(url).cast("string").alias("url"), F.coalesce(payload, F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    # Payloads that occur once need no other row. The others' responses are a row a payload; while
    # those are few, pages are written where they are read and no payload is shuffled. Ids are compared
    # in their own type and written as text unless they are whole numbers.
    top = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("own_id").alias("main"), F.count("*").alias("n")).where("n > 1")
    top = cut(top.select("digest", "main"), where)
    found = rows.join(small(top, top.count()), "digest", "left")
    is_main = F.col("main").isNull() | F.coalesce(F.col("own_id") == F.col("main"), F.lit(False))
    found = found.select(said("own_id").alias("page_id"), "url", "payload", "digest", said("main").alias("main"), is_main.alias("is_main"))
    packages = cut(write_packages(found, f"{where}/packages"), where)
    read = read_packages(packages.repartition(min(max(1, packages.count()), READERS)), kind)
    return read.withColumns({c: F.unhex(c) if own == "binary" else F.col(c).cast(own) for c in ("page_id", "refers_to")})
