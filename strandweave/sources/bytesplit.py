"""Byte-range readers for text formats whose records span lines.

``numbered_lines`` gives every line its split, row and byte offset;
``fastq_records`` groups four lines to a record. Both divide a file at fixed
byte distances and move each border to the next line or record start, so a file
of any size is read by many tasks. Compressed files are one split.
"""

import gzip

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 64 << 20
BATCH = 8192


class ByteRange(InputPartition):
    def __init__(self, path, split, start, end):
        self.path, self.split, self.start, self.end = path, split, start, end


def _filesystem(path):
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _files(path):
    system, inner = _filesystem(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    prefix = path[:len(path) - len(inner)] if path.endswith(inner) else ""
    found = system.get_file_info(fs.FileSelector(inner))
    return sorted((prefix + f.path, f.size) for f in found
                  if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))


def _open(path):
    system, inner = _filesystem(path)
    if path.endswith(".gz"):
        return gzip.open(system.open_input_stream(inner, compression=None), "rb")
    return pa.PythonFile(system.open_input_file(inner), mode="r")


def _lines(handle, start, size=1 << 20):
    """(offset, line without its end) from the first line beginning at or after ``start``."""
    at = start
    if start:
        handle.seek(start - 1)
        at = start - 1
    rest, skip = b"", bool(start)
    while True:
        data = handle.read(size)
        if not data:
            break
        parts = (rest + data).split(b"\n")
        rest = parts.pop()
        for part in parts:
            if not skip:
                yield at, part
            skip = False
            at += len(part) + 1
    if rest and not skip:
        yield at, rest


def _text(raw):
    return raw.rstrip(b"\r").decode("utf-8", "replace")


class _RangeReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.leading = options.get("leading")
        self.counts = options.get("counts") == "true"

    def partitions(self):
        parts = []
        for path, size in _files(self.path):
            step = size if self.leading or path.endswith(".gz") else self.bytes
            for start in range(0, max(size, 1), max(step, 1)):
                end = None if start + step >= size else start + step
                parts.append(ByteRange(path, len(parts), start, end))
        return parts or [ByteRange(None, 0, 0, 0)]


class LineReader(_RangeReader):
    SCHEMA = "path string, split int, row bigint, offset bigint, line string"

    def read(self, part):
        schema = pa.schema([("path", pa.string()), ("split", pa.int32()), ("row", pa.int64()),
                            ("offset", pa.int64()), ("line", pa.string())])
        if part.path is None:
            return
        rows, n = [], 0
        with _open(part.path) as handle:
            for offset, raw in _lines(handle, part.start):
                if part.end is not None and offset >= part.end:
                    break
                line = _text(raw)
                if self.leading and not line.startswith(self.leading):
                    break
                rows.append((n, offset, line))
                n += 1
                if len(rows) == BATCH:
                    yield self._batch(schema, part, rows)
                    rows = []
        if rows:
            yield self._batch(schema, part, rows)

    @staticmethod
    def _batch(schema, part, rows):
        n = len(rows)
        row, offset, line = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([part.path] * n), pa.array([part.split] * n, pa.int32()), pa.array(row, pa.int64()),
             pa.array(offset, pa.int64()), pa.array(line, pa.string())], schema=schema)


class FastqReader(_RangeReader):
    SCHEMA = "split int, row bigint, header string, seq string, qual string"

    def _records(self, part):
        with _open(part.path) as handle:
            window, aligned = [], part.start == 0
            for item in _lines(handle, part.start):
                window.append(item)
                if len(window) < 4:
                    continue
                (offset, head), (_, seq), (_, plus), (_, qual) = window
                # a header is the only line starting '@' whose second next starts '+'
                whole = head[:1] == b"@" and plus[:1] == b"+" and len(seq.rstrip(b"\r")) == len(qual.rstrip(b"\r"))
                if not whole:
                    if aligned:
                        raise ValueError(f"broken record at byte {offset} of {part.path}")
                    window.pop(0)
                    if part.end is not None and offset >= part.end + (1 << 20):
                        return
                    continue
                aligned = True
                if part.end is not None and offset >= part.end:
                    return
                yield _text(head)[1:], _text(seq), _text(qual)
                window = []
            if aligned and any(raw.strip() for _, raw in window):
                raise ValueError(f"incomplete record at the end of {part.path}")

    def read(self, part):
        if part.path is None:
            return
        if self.counts:
            n = sum(1 for _ in self._records(part))
            yield self._batch(part.split, n, [("", "", "")])
            return
        rows, n = [], 0
        for record in self._records(part):
            rows.append(record)
            if len(rows) == BATCH:
                yield self._batch(part.split, n, rows)
                n += len(rows)
                rows = []
        if rows:
            yield self._batch(part.split, n, rows)

    @staticmethod
    def _batch(split, first, rows):
        head, seq, qual = zip(*rows)
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([split] * n, pa.int32()), pa.array(range(first, first + n), pa.int64()),
             pa.array(head), pa.array(seq), pa.array(qual)],
            names=["split", "row", "header", "seq", "qual"])


class NumberedLines(DataSource):
    @classmethod
    def name(cls):
        return "numbered_lines"

    def schema(self):
        return LineReader.SCHEMA

    def reader(self, schema):
        return LineReader(self.options)


class FastqRecords(DataSource):
    @classmethod
    def name(cls):
        return "fastq_records"

    def schema(self):
        return FastqReader.SCHEMA

    def reader(self, schema):
        return FastqReader(self.options)


def register(spark):
    spark.dataSource.register(NumberedLines)
    spark.dataSource.register(FastqRecords)
