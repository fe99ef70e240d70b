"""WARC records in ZIP-packaged archives: a writer, and a reader that unpacks nothing.

An archive is a ZIP file with three stored members: the records, gzipped one
by one; an index with the place of each record; a short description. The
reader fetches the end of the file, follows the ZIP64 locator if there is one,
parses the central directory, finds the stored members, and reads the index
and then single records by byte ranges.

Records with equal payloads of at least ``SMALLEST`` bytes are stored once:
that with the smallest page_id is the response, and the others are revisits
that name it. Payload digests meet in a table of counts; frequent payloads are
joined by broadcast, so one page copied many times is no hot key.

Archives are written below the session's shared folder by its file system;
each has a name of its own, and only those named in the stored manifest of
finished tasks are read, so a lost or repeated task leaves no trace in the
result.

Null html is an empty payload, a null url is left out of the record. A row
without page_id is never named by others: it is a revisit if a payload equal
to its own has a page_id, else a response. Rows that share the smallest
page_id and the payload are responses all. Empty tables give no archive and
an empty result. Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.llm.common import lookup, slices, stored
from eta_spark.session import new_run_dir

SMALLEST = 100
#: Bytes of compressed records after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
RECORDS, INDEX, ABOUT = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
DATE = "2024-01-01T00:00:00Z"
_URL_SAFE = "%/:=&?~#+!$,;'@()*[]"


def decide(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload_digest and refers_to, the page_id whose record is revisited."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    digest = F.sha2(F.col("html").cast("binary"), 256)
    brief = stored(rows.select("page_id", digest.alias("payload_digest"), F.octet_length("html").alias("size")), "payloads")
    equal = brief.where(F.col("size") >= SMALLEST).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    equal = stored(equal.where("copies > 1 AND first IS NOT NULL"), "equal")
    copies = lookup(brief, equal, "payload_digest", "copies").where("NOT page_id <=> first")
    revisits = copies.select(F.coalesce("page_id", F.lit(-1)).alias("key"), F.col("page_id").isNull().alias("nameless"), "payload_digest", F.col("first").alias("refers_to"))
    keyed = rows.withColumns({"key": F.coalesce("page_id", F.lit(-1)), "nameless": F.col("page_id").isNull(), "payload_digest": digest})
    return keyed.join(revisits.distinct(), ["key", "nameless", "payload_digest"], "left").select("page_id", "url", "html", "payload_digest", "refers_to")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the response's headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}"] if url else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers of a record, the HTTP headers and the payload of its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def write_archives(decided: DataFrame, folder: str) -> DataFrame:
    """Writes the records; returns the stored manifest: archive, records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        data, index = io.BytesIO(), []

        def close() -> Iterator[pa.RecordBatch]:
            if not index:
                return
            made, name = io.BytesIO(), f"{root}/{uuid.uuid4().hex}.wacz"
            with zipfile.ZipFile(made, "w", zipfile.ZIP_STORED) as archive:
                about = json.dumps({"profile": "data-package", "resources": [{"path": RECORDS}, {"path": INDEX}]})
                for member, content in ((RECORDS, data.getvalue()), (INDEX, "".join(index).encode()), (ABOUT, about.encode())):
                    with archive.open(zipfile.ZipInfo(member), "w", force_zip64=True) as out:
                        out.write(content)
            system.create_dir(root, recursive=True)
            with system.open_output_stream(name) as out:
                out.write(made.getbuffer())
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([len(index)], pa.int64())})
            data.seek(0)
            data.truncate()
            index.clear()

        for batch in slices(batches):
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packed = gzip.compress(record(page_id, url, html.encode(), digest, refers_to), 6, mtime=0)
                place = {"offset": data.tell(), "length": len(packed), "digest": digest}
                index.append(f"{'-' if page_id is None else page_id} {json.dumps(place)}\n")
                data.write(packed)
                if data.tell() >= ARCHIVE_BYTES:
                    yield from close()
        yield from close()

    return stored(decided.mapInArrow(run, "archive string, records long"), "manifest")


class Member(NamedTuple):
    name: str
    offset: int  # of its local header
    size: int


Read = Callable[[int, int], bytes]
_END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def directory(read: Read, size: int) -> list[Member]:
    """The stored members of a ZIP file, from its central directory; read(offset, length) fetches a range."""
    tail_at = max(0, size - 22 - 65535 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    # The comment behind the record may hold the signature by chance: its length tells.
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == _LOCATOR:
        (end64,) = struct.unpack_from("<Q", tail, at - 12)
        record64 = read(end64, 56)
        if record64[:4] != _END64:
            raise ValueError("no ZIP64 end of a directory")
        entries, length, start = struct.unpack_from("<QQQ", record64, 32)
    data, members, at = read(start, length), [], 0
    for _ in range(entries):
        if data[at : at + 4] != _ENTRY:
            raise ValueError("broken ZIP directory")
        method, packed, plain, n_name, n_extra, n_comment = (*struct.unpack_from("<H", data, at + 10), *struct.unpack_from("<IIHHH", data, at + 20))
        (offset,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n_name].decode()
        extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:  # ZIP64 holds, in this order, the values that did not fit
            tag, n = struct.unpack_from("<HH", extra)
            if tag == 1:
                wide = list(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + n :]
        if method == 0 and packed == plain:
            members.append(Member(name, offset, plain))
        at += 46 + n_name + n_extra + n_comment
    return members


def content_start(read: Read, member: Member) -> int:
    """Where a stored member's bytes begin."""
    head = read(member.offset, 30)
    if head[:4] != _LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.offset + 30 + sum(struct.unpack_from("<HH", head, 26))


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """archive, offset, length of each record, from the archives' own directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(name) as file:
                    read = lambda offset, length, file=file: file.read_at(length, offset)
                    members = {m.name: m for m in directory(read, file.size())}
                    index = members[INDEX]
                    lines = read(content_start(read, index), index.size).decode().splitlines()
                    start = content_start(read, members[RECORDS])
                places = [json.loads(line.partition(" ")[2]) for line in lines]
                columns = {
                    "archive": [name] * len(places),
                    "offset": pa.array([start + p["offset"] for p in places], pa.int64()),
                    "length": pa.array([p["length"] for p in places], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return manifest.select("archive").mapInArrow(run, "archive string, offset long, length long")


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records by range reads; a response's digest is computed from its payload and must equal the header's."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][: 6 + with_payload]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def row(packed: bytes) -> tuple:
        headers, http, payload = parse(gzip.decompress(packed))
        kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
        length = next(int(v) for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")) if k.lower() == b"content-length")
        if kind == "response":
            if (found := hashlib.sha256(payload).hexdigest()) != digest or len(payload) != length:
                raise ValueError(f"payload of {headers['warc-record-id']} is {found}, not {digest}")
        refers_to = page(headers.get("warc-refers-to")) if kind == "revisit" else None
        return page(headers["warc-record-id"]), headers.get("warc-target-uri"), length, digest, kind, refers_to, payload if kind == "response" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in slices(batches):
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    if file:
                        file.close()
                    name, file = archive, system.open_input_file(archive)
                rows.append(row(file.read_at(length, offset)))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: len(names)], names)
        if file:
            file.close()

    return index.mapInArrow(run, schema)


def archive_folder(df: DataFrame) -> str:
    """A new folder below the shared one, as an address that names its file system."""
    folder = new_run_dir(df.sparkSession, "archives")
    return folder if "://" in folder or not folder.startswith("file:") else "file://" + folder.removeprefix("file:")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes all pages to archives and reads them back."""
    folder = archive_folder(pages)
    manifest = write_archives(decide(pages), folder)
    return read_records(read_index(manifest, folder), folder)


SQL = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM payloads),
named AS (SELECT *, CASE WHEN payload_bytes >= {SMALLEST} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM digests)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM named
"""
