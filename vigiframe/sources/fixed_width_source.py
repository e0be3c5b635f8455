"""Splittable reader for large fixed-width record files (DBF-style header).

This Python Data Source plans one partition per range of records: the driver reads only the 12-byte
header of each file, every task seeks to its range and hands the raw records
to Spark as Arrow batches. Field cutting and typing stay Spark expressions
(``decode_records``), so Python only moves bytes.

Files are opened through ``pyarrow.fs``: local paths and URIs whose scheme the
pyarrow build supports (e.g. ``s3://``, ``hdfs://``), with random-access reads,
so every executor reads its own byte range of the shared storage.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vigiframe.sources.files import Field, decode_records

DEFAULT_RECORDS_PER_PARTITION = 2_000_000
BATCH_RECORDS = 200_000
# Bytes of a batch: its offsets are 32-bit.
BATCH_BYTES = 64 << 20


class RecordRange(InputPartition):
    def __init__(self, path: str, start: int, end: int, header_len: int, record_len: int):
        super().__init__(None)
        self.path, self.start, self.end = path, start, end
        self.header_len, self.record_len = header_len, record_len


def _filesystem(uri: str):
    """(filesystem, path) for a local path or a URI with a scheme."""
    from pyarrow import fs
    if uri.startswith("file:/") and "://" not in uri:       # as Hadoop writes local URIs
        uri = uri.removeprefix("file:")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


def _uri(original: str, path: str) -> str:
    """Re-attach the scheme and authority of ``original`` to a listed ``path``
    (absolute paths as HDFS and local files list them, bucket/key as object stores do)."""
    if "://" not in original:
        return path
    scheme, rest = original.split("://", 1)
    authority = rest.split("/", 1)[0]
    if path.startswith("/"):
        return f"{scheme}://{authority}{path}"
    if authority and path.startswith(authority + "/"):
        return f"{scheme}://{path}"
    return f"{scheme}://{authority}/{path}"


def list_files(pattern: str) -> list[str]:
    """Files of a path, folder or glob (last path component only), as URIs."""
    from pyarrow import fs
    filesystem, path = _filesystem(pattern)
    if any(ch in path for ch in "*?["):
        parent, pat = posixpath.dirname(path), posixpath.basename(path)
        infos = filesystem.get_file_info(fs.FileSelector(parent))
        found = [i.path for i in infos if i.type == fs.FileType.File and fnmatch.fnmatch(posixpath.basename(i.path), pat)]
    else:
        info = filesystem.get_file_info(path)
        if info.type == fs.FileType.Directory:
            found = [i.path for i in filesystem.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.File]
        else:
            found = [path]
    return sorted(_uri(pattern, f) for f in found)


def _read_at(uri: str, offset: int, size: int) -> bytes:
    filesystem, path = _filesystem(uri)
    with filesystem.open_input_file(path) as fh:
        fh.seek(offset)
        return fh.read(size)


def header_counts(uri: str) -> tuple[int, int, int, int]:
    """(declared records, header length, record length, whole records present)."""
    filesystem, path = _filesystem(uri)
    with filesystem.open_input_file(path) as fh:
        head = fh.read(12)
        size = fh.size()
    n, = struct.unpack("<I", head[4:8])
    hlen, rlen = struct.unpack("<HH", head[8:12])
    whole = max(0, (size - hlen) // rlen)
    return n, hlen, rlen, min(n, whole)


def header_size_counts(uri: str) -> tuple[int, int]:
    """(declared records, whole records that the file's size has room for)."""
    filesystem, path = _filesystem(uri)
    with filesystem.open_input_file(path) as fh:
        head, size = fh.read(12), fh.size()
    n, hlen, rlen = struct.unpack("<IHH", head[4:12])
    return n, max(0, (size - hlen) // rlen)


def read_dbf_fields(path: str) -> list[Field]:
    """Field list from a DBF-style header: 32-byte descriptors after the 32-byte file
    header, up to the 0x0D terminator (name: 11 bytes NUL-padded, type at byte 11,
    length at 16, decimals at 17). Only the header bytes are read, on the driver."""
    head = _read_at(path, 0, 32)
    hlen, = struct.unpack("<H", head[8:10])
    desc = _read_at(path, 32, hlen - 32)
    fields = []
    for i in range(0, len(desc), 32):
        d = desc[i:i + 32]
        if not d or d[0] == 0x0D or len(d) < 32:
            break
        name = d[:11].split(b"\x00", 1)[0].decode("latin-1").strip().lower()
        fields.append(Field(name, d[16], chr(d[11]), d[17]))
    return fields


class FixedWidthReader(DataSourceReader):
    def __init__(self, options: dict):
        pattern = options.get("path")
        if not pattern:
            raise ValueError("option 'path' is required")
        # several paths or globs may be given, one per line
        self.files = sorted({f for p in pattern.splitlines() if p.strip() for f in list_files(p.strip())})
        self.step = int(options.get("recordsPerPartition", DEFAULT_RECORDS_PER_PARTITION))

    def partitions(self):
        parts = []
        for path in self.files:
            _, hlen, rlen, whole = header_counts(path)
            for start in range(0, whole, self.step):
                parts.append(RecordRange(path, start, min(whole, start + self.step), hlen, rlen))
        return parts

    def read(self, partition: RecordRange):
        import numpy as np
        import pyarrow as pa
        if not isinstance(partition, RecordRange):      # no records at all: Spark plans one empty partition
            return
        rlen = partition.record_len
        filesystem, path = _filesystem(partition.path)
        with filesystem.open_input_file(path) as fh:
            pos = partition.start
            fh.seek(partition.header_len + pos * rlen)
            while pos < partition.end:
                n = min(BATCH_RECORDS, max(1, BATCH_BYTES // rlen), partition.end - pos)
                buf = fh.read(n * rlen)
                n = len(buf) // rlen
                if n == 0:
                    break
                offsets = np.arange(0, (n + 1) * rlen, rlen, dtype=np.int32)
                recs = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()),
                                                              pa.py_buffer(buf[:n * rlen])])
                nos = pa.array(np.arange(pos, pos + n, dtype=np.int64))
                paths = pa.array([partition.path] * n, pa.string())
                yield pa.RecordBatch.from_arrays([paths, nos, recs], names=["path", "record_no", "rec"])
                pos += n


class FixedWidthDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fixedwidth"

    def schema(self) -> str:
        return "path string, record_no long, rec binary"

    def reader(self, schema) -> FixedWidthReader:
        return FixedWidthReader(self.options)


def read_fixed_width_split(spark: SparkSession, path: str | list[str], fields: list[Field],
                           records_per_partition: int = DEFAULT_RECORDS_PER_PARTITION) -> DataFrame:
    """Decoded live records, one task per record range. ``path`` is a
    path, folder, glob or URI, or a list of them."""
    spark.dataSource.register(FixedWidthDataSource)
    if not isinstance(path, str):
        path = "\n".join(path)
    raw = (spark.read.format("fixedwidth").option("path", path)
           .option("recordsPerPartition", records_per_partition).load())
    return decode_records(raw, "rec", fields, ["path", "record_no"])
