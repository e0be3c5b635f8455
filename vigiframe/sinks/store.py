"""Small shared documents (manifests, the registry, table pointers) on the file system that Spark itself uses.

A document at ``<folder>/<name>.json`` is a row of numbered revisions in ``<folder>/_<name>/``. A writer adds revision
n + 1 to the n it has read; a revision appears whole and only once, so of two writers one is told that it came too
late, reads again and repeats its change on the newer text. Readers take the highest revision and never wait. The file
``<name>.json`` is a copy for people and other programs, replaced after each change; the library reads the revisions.

Everything goes through Hadoop's file system API, so a path that only Spark can open works. The file system must keep
a rename from replacing an existing file (HDFS does); on a local folder, where rename replaces, a hard link is used.
"""

from __future__ import annotations

import json
import posixpath
import random
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Digits of a revision's file name, and tries of a change before it gives up.
REVISION_DIGITS = 12
TRIES = 50


class ConflictError(RuntimeError):
    """Other writers were first in every try."""


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def _configuration(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _path(spark: SparkSession, path: str):
    """(file system, qualified path)."""
    p = _hadoop(spark).Path(path)
    fs = p.getFileSystem(_configuration(spark))
    return fs, fs.makeQualified(p)


def _java_error(error) -> str:
    return error.java_exception.getClass().getSimpleName()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark reports it for files."""
    return _path(spark, path)[1].toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder (none where there is no folder)."""
    fs, p = _path(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to a place where there is none yet."""
    fs, to = _path(spark, target)
    fs.mkdirs(to.getParent())
    _rename(spark, _path(spark, source)[1], to, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_beside(spark: SparkSession, path: str, text: str):
    """The text in a file of its own, hidden from Spark, in the folder of ``path``."""
    fs, target = _path(spark, path)
    beside = _hadoop(spark).Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return fs, beside, target


def _rename(spark: SparkSession, source, target, replace: bool) -> None:
    options = getattr(_hadoop(spark), "Options$Rename")
    choice = spark.sparkContext._gateway.new_array(options, 1)
    choice[0] = options.OVERWRITE if replace else options.NONE
    _hadoop(spark).FileContext.getFileContext(source.toUri(), _configuration(spark)).rename(source, target, choice)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that is not there yet; False if it is there. It appears whole or not at all."""
    from py4j.protocol import Py4JJavaError
    fs, beside, target = _write_beside(spark, path, text)
    try:
        if fs.getScheme() == "file":
            files, paths = spark._jvm.java.nio.file.Files, spark._jvm.java.nio.file.Paths
            files.createLink(paths.get(target.toUri()), paths.get(beside.toUri()))
        else:
            _rename(spark, beside, target, False)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in _java_error(error):
            return False
        raise
    finally:
        if fs.exists(beside):
            fs.delete(beside, False)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a whole file in place of the one that may be there."""
    _, beside, target = _write_beside(spark, path, text)
    _rename(spark, beside, target, True)


class Document:
    """A JSON document that several writers may change."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        folder, name = posixpath.split(path)
        self.folder = posixpath.join(folder, f"_{name.removesuffix('.json')}")

    def revision(self) -> int:
        found = [int(n.removesuffix(".json")) for n in names(self.spark, self.folder) if n.endswith(".json") and n.removesuffix(".json").isdigit()]
        return max(found, default=0)

    def _file(self, revision: int) -> str:
        return posixpath.join(self.folder, f"{revision:0{REVISION_DIGITS}d}.json")

    def read(self, revision: int | None = None) -> dict | None:
        """The newest text, or that of one revision; None where there is none.

        A plain file without revisions (written by another program) counts as revision 0.
        """
        at = self.revision() if revision is None else revision
        text = read_text(self.spark, self._file(at) if at else self.path)
        return json.loads(text) if text is not None else None

    def update(self, change: Callable[[dict | None], dict | None]) -> dict | None:
        """Write ``change(newest text)`` as the next revision and return it; where the change gives None, nothing is
        written. The change is made again on the newer text when another writer was first."""
        for attempt in range(TRIES):
            at = self.revision()
            old = self.read(at)
            new = change(old)
            if new is None:
                return old
            text = json.dumps(new, ensure_ascii=False, indent=2, sort_keys=True)
            if write_new(self.spark, self._file(at + 1), text):
                self._copy(at + 1, text)
                return new
            time.sleep(random.uniform(0, 0.01 * (attempt + 1)))
        raise ConflictError(f"{self.path} was changed by others {TRIES} times in a row")

    def _copy(self, revision: int, text: str) -> None:
        """Renew the copy; a writer that finds a newer revision leaves the copy to that one's writer."""
        if self.revision() == revision:
            replace_text(self.spark, self.path, text)
