"""WARC records inside ZIP archives, read by ranges.

An archive holds stored (uncompressed) members: ``data.warc.gz`` with one gzip member per record, and ``index.cdx``
with a line per record. The reader takes the end of the file, the ZIP64 records if there are any, and the central
directory; then the index; then each record by its own range. Nothing is extracted.

Files are opened through Arrow's file systems by URI, so the folder may be local to a shared mount, HDFS or an
object store. A task writes under a fresh name and reports it with its result: archives of attempts that failed
are never named and never read.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scaling import scratch_path
from .common import stored, table

DATA, INDEX = "data.warc.gz", "index.cdx"
#: Payloads from this size on are written once; bytes of an archive before the next begins.
REVISIT_FROM, ARCHIVE_BYTES = 100, 512 << 20
#: Records and bytes of one range read (one record may be longer); bytes of records for a task that reads.
RANGE_RECORDS, RANGE_BYTES, TASK_BYTES = 128, 4 << 20, 2 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _files(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:/", "file:///", 1))


# --- records ----------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:x-nopage:{uuid.uuid4()}>"


def page_of(identifier: str | None) -> int | None:
    return int(identifier[12:-1]) if identifier and identifier.startswith("<urn:x-page:") else None


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    body = _HTTP + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def read_record(packed: bytes) -> dict:
    """Headers and payload of one gzip member; payload is None for a revisit."""
    raw = gzip.decompress(packed)
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    payload = None if headers["WARC-Type"] == "revisit" else block.partition(b"\r\n\r\n")[2]
    if payload is not None and f"sha256:{hashlib.sha256(payload).hexdigest()}" != headers["WARC-Payload-Digest"]:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    return headers | {"payload": payload}


# --- writing ----------------------------------------------------------------

class _Archive:
    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.zip"
        files, path = _files(self.uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data, self.lines, self.at = self.zip.open(DATA, "w", force_zip64=True), [], 0

    def add(self, name: str, kind: str, record: bytes) -> None:
        packed = gzip.compress(record, 4, mtime=0)
        self.data.write(packed)
        self.lines.append(f"{name} {kind} {self.at} {len(packed)}\n")
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for k in range(0, len(self.lines), 10_000):
                index.write("".join(self.lines[k:k + 10_000]).encode())
        self.zip.close()
        self.out.close()
        return self.uri, len(self.lines), self.at


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, n_bytes, record_type, refers_to).

    Of equal payloads of at least ``REVISIT_FROM`` bytes the smallest page_id is the response; rows that share it
    are all responses, and payloads of rows without page_id only are too.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.unhex(F.sha2("html", 256)), "n_bytes": F.octet_length("html").cast("long")})
    # stored, so that the join has two plain shuffles, of which the rows of a hot payload can be split
    firsts = stored(rows.filter(F.col("n_bytes") >= REVISIT_FROM).groupBy("digest", "n_bytes")
                    .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1 and first is not null").drop("n"), "first-payloads")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return (rows.join(firsts, ["digest", "n_bytes"], "left").withColumns({
        "record_type": F.when(again, "revisit").otherwise("response"), "refers_to": F.when(again, F.col("first"))})
        .drop("first"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html); gives the stored list (archive, records, bytes)."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        done = lambda a: pa.RecordBatch.from_pylist([dict(zip(("archive", "records", "bytes"), a.close(), strict=True))])
        for batch in batches:
            for row in batch.to_pylist():
                archive = archive or _Archive(folder)
                revisit = row["record_type"] == "revisit"
                archive.add(record_id(row["page_id"]), row["record_type"], warc_record(
                    row["page_id"], row["url"], row["html"].encode(), row["digest"].hex(), row["refers_to"], revisit))
                if archive.at >= ARCHIVE_BYTES:
                    yield done(archive)
                    archive = None
        if archive is not None:
            yield done(archive)

    return stored(with_revisits(pages).mapInArrow(write, "archive string, records long, bytes long"), "archives")


# --- reading ----------------------------------------------------------------

def _zip64(extra: bytes, wanted: list[tuple[str, int, int]]) -> dict[str, int]:
    """Values of a directory entry; those at their largest are taken from the ZIP64 extra field, in order."""
    wide, at = b"", 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = extra[at + 4:at + 4 + size]
        at += 4 + size
    values, at = {}, 0
    for name, value, top in wanted:
        if value == top:
            value = struct.unpack_from("<Q", wide, at)[0]
            at += 8
        values[name] = value
    return values


def central_directory(file, size: int) -> dict[str, tuple[int, int]]:
    """{member: (offset of its bytes, length)} of the stored members of an archive.

    ``file`` needs ``read_at(length, offset)``. A compressed or encrypted member raises, as it has no ranges.
    """
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # the comment after the end record may hold the same bytes: its length must reach the end of the file
    while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end + 3)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    entries, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":
        wide_at = struct.unpack_from("<Q", tail, end - 12)[0]
        entries, length, offset = struct.unpack_from("<QQQ", file.read_at(56, wide_at), 32)
    directory, at, members = file.read_at(length, offset), 0, {}
    for _ in range(entries):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        top = 0xFFFFFFFF
        v = _zip64(extra, [("plain", plain, top), ("packed", packed, top), ("local", local, top)])
        if method != 0 or flags & 1:
            raise ValueError(f"{name} is not stored plainly")
        n_name2, n_extra2 = struct.unpack_from("<HH", file.read_at(30, v["local"]), 26)
        members[name] = (v["local"] + 30 + n_name2 + n_extra2, v["plain"])
        at += 46 + n_name + n_extra + n_comment
    return members


def _index_lines(file, start: int, length: int, block: int = 4 << 20) -> Iterator[str]:
    rest = b""
    for at in range(0, length, block):
        *lines, rest = (rest + file.read_at(min(block, length - at), start + at)).split(b"\n")
        yield from (x.decode() for x in lines)


def record_ranges(archives: DataFrame) -> DataFrame:
    """(archive, start, length, sizes): runs of neighbouring records, from the directories and indexes."""
    schema = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                        ("sizes", pa.list_(pa.int64()))])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                files, path = _files(uri)
                with files.open_input_file(path) as file:
                    members = central_directory(file, file.size())
                    if DATA not in members:
                        continue
                    base, rows, first, sizes = members[DATA][0], [], 0, []
                    for line in _index_lines(file, *members[INDEX]):
                        at, size = map(int, line.split(" ")[2:4])
                        if sizes and (len(sizes) == RANGE_RECORDS or sum(sizes) + size > RANGE_BYTES):
                            rows.append((uri, first, sum(sizes), sizes))
                            sizes = []
                        first = first if sizes else base + at
                        sizes.append(size)
                    if sizes:
                        rows.append((uri, first, sum(sizes), sizes))
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type)
                                                      for i, f in enumerate(schema)], schema=schema)

    # an explicit number, as adaptive execution joins the partitions of such a small list otherwise
    spread = archives.select("archive").repartition(max(1, archives.count()), "archive")
    return spread.mapInArrow(ranges, "archive string, start long, length long, sizes array<long>")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of all records.

    Every run of records is one range read; runs are dealt over as many tasks as the archives' bytes ask for. The
    payload of a revisit is null.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                files, path = _files(run["archive"])
                with files.open_input_file(path) as file:
                    data = file.read_at(run["length"], run["start"])
                rows, at = [], 0
                for size in run["sizes"]:
                    r = read_record(data[at:at + size])
                    at += size
                    n = int(r["X-Payload-Length"]) if r["payload"] is None else len(r["payload"])
                    rows.append((page_of(r["WARC-Record-ID"]), r.get("WARC-Target-URI"),
                                 r["payload"] if payloads else None, n,
                                 r["WARC-Payload-Digest"].removeprefix("sha256:"), r["WARC-Type"],
                                 page_of(r.get("WARC-Refers-To"))))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type)
                                                  for i, f in enumerate(schema)], schema=schema)

    size = archives.agg(F.sum("bytes")).first()[0] or 0
    runs = record_ranges(archives).repartition(max(1, -(-size // TASK_BYTES)), "archive", "start")
    return runs.mapInArrow(read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long")


def op9_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written and read back."""
    folder = scratch_path(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return (read_archives(archives, payloads=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR least IS NULL OR least IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 100 OR least IS NULL OR least IS NOT DISTINCT FROM page_id THEN NULL ELSE least END AS refers_to
FROM f
"""
