"""SHA-256 of whole files as a Python Data Source: one task per file, read in blocks, so a file may have any size.

Files are opened through ``pyarrow.fs`` (local paths and the URIs its build knows), like ``sources.fixed_width_source``.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vigiframe.sources.fixed_width_source import _filesystem, _uri

BLOCK_BYTES = 4 << 20


class WholeFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(None)
        self.path = path


def files_below(root: str, glob: str) -> list[str]:
    """Files below a folder (or the file itself) whose names match, as URIs; hidden folders and files are left out."""
    from pyarrow import fs
    filesystem, path = _filesystem(root)
    info = filesystem.get_file_info(path)
    if info.type == fs.FileType.File:
        return [_uri(root, path)]
    found = filesystem.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    wanted = []
    for i in found:
        parts = posixpath.relpath(i.path, path).split("/")
        if i.type == fs.FileType.File and fnmatch.fnmatch(parts[-1], glob) and not any(p.startswith(("_", ".")) for p in parts if "=" not in p):
            wanted.append(_uri(root, i.path))
    return sorted(wanted)


def digest_blocks(stream, block: int = BLOCK_BYTES) -> tuple[int, str]:
    """(bytes, SHA-256) of a stream, holding one block at a time."""
    digest, size = hashlib.sha256(), 0
    while data := stream.read(block):
        digest.update(data)
        size += len(data)
    return size, digest.hexdigest()


class FileHashReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.glob = options["path"], options.get("glob", "*")

    def partitions(self):
        return [WholeFile(f) for f in files_below(self.root, self.glob)]

    def read(self, partition):
        if not isinstance(partition, WholeFile):        # no files: Spark plans one empty partition
            return
        filesystem, path = _filesystem(partition.path)
        with filesystem.open_input_stream(path) as stream:
            size, sha256 = digest_blocks(stream)
        yield partition.path, size, sha256


class FileHashDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filehashes"

    def schema(self) -> str:
        return "path string, length long, sha256 string"

    def reader(self, schema) -> FileHashReader:
        return FileHashReader(self.options)
