"""Token ids in binary files of patched frame-of-reference blocks.

A block holds up to 128 ids of the token stream: its minimum is subtracted, the differences are packed at the
smallest width that fits at least ``FIT_PERCENT`` of them (a wider one where that makes the block smaller), and the
few that don't fit are listed as exceptions (place and high bits). Little-endian throughout:

file  = magic "PFOR2\\0\\0\\0", blocks, index, footer
block = u32 minimum, u8 width, u8 exceptions, u16 ids, packed low bits (u32 words), exceptions' places (u8 each), high bits (u32 each)
index = u64 offset of every block; i64 id of every document (0 for null), u64 ids before it in the file, of every document
footer= u64 offset of the index, u64 blocks, u64 documents, u64 ids, u64 documents with a null id, magic

Documents are in ascending order of id over all files and inside each, null ids first; a document may start inside a
block. Writing and reading hold a file's index as plain numbers: 16 bytes a document and 8 a block.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigiframe.llm.common import map_batches, staged
from vigiframe.llm.ordering import range_count, range_number, range_starts, text_order
from vigiframe.session import ensure_checkpoint_dir

MAGIC = b"PFOR2\0\0\0"
BLOCK = 128
FIT_PERCENT = 90
END_ID = 1
FOOTER = 48
KNOWN_WORDS = 400_000      # parts of words kept per Python worker, and as many of those before
FLUSH_BLOCKS = 512
_HEADER = np.dtype([("minimum", "<u4"), ("width", "u1"), ("exceptions", "u1"), ("ids", "<u2")])


def packed_size(n: int, width: int) -> int:
    return (n * width + 31) // 32 * 4


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Low ``width`` bits of each row's values, one after the other, padded to 32-bit words: a row of bytes each."""
    rows, n = values.shape
    bits = np.unpackbits(np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(rows, n, 4), axis=2, bitorder="little")[:, :, :width]
    raw = np.packbits(bits.reshape(rows, n * width), axis=1, bitorder="little")
    return np.pad(raw, ((0, 0), (0, packed_size(n, width) - raw.shape[1])))


def _unpack(raw: np.ndarray, width: int, n: int) -> np.ndarray:
    """The ``n`` values of each row of packed bytes."""
    rows = len(raw)
    bits = np.zeros((rows, n, 32), np.uint8)
    bits[:, :, :width] = np.unpackbits(raw, axis=1, bitorder="little")[:, :n * width].reshape(rows, n, width)
    return np.packbits(bits, axis=2, bitorder="little").view("<u4").reshape(rows, n)


def block_widths(widths: np.ndarray) -> np.ndarray:
    """Packing width of each block from the bits of its values (blocks x ids).

    The least width that fits ``FIT_PERCENT`` of the values, or a wider one if that makes the block smaller: its
    packed words and five bytes per value that doesn't fit.
    """
    rows, n = widths.shape
    counts = np.bincount((np.arange(rows)[:, None] * 33 + widths).ravel(), minlength=33 * rows).reshape(rows, 33)
    beyond = n - np.cumsum(counts, axis=1)
    size = np.array([packed_size(n, w) for w in range(33)]) + 5 * beyond
    return np.argmin(np.where(beyond <= n - -(-n * FIT_PERCENT // 100), size, 1 << 30), axis=1)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of equal length from a table of unsigned 32-bit ids (blocks x ids, 1 to ``BLOCK`` ids each)."""
    ids = ids.astype(np.int64)
    least = ids.min(axis=1)
    low = ids - least[:, None]
    chosen = block_widths(np.frexp(low.astype(np.float64))[1])  # bits of each value: exact below 2 ** 53
    over = low >> chosen[:, None]
    place, column = np.nonzero(over)
    high, cuts = over[place, column].astype("<u4"), np.searchsorted(place, np.arange(len(ids) + 1))
    header = np.zeros(len(ids), _HEADER)
    header["minimum"], header["width"], header["exceptions"], header["ids"] = least, chosen, np.diff(cuts), ids.shape[1]
    out = [b""] * len(ids)
    for width in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == width)
        packed = _pack(low[rows], width)
        for r, raw in zip(rows.tolist(), packed, strict=True):
            a, b = cuts[r], cuts[r + 1]
            out[r] = header[r].tobytes() + raw.tobytes() + column[a:b].astype(np.uint8).tobytes() + high[a:b].tobytes()
    return out


def decode_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at the given places, one block after the other."""
    buf = np.frombuffer(raw, np.uint8)
    size = _HEADER.itemsize
    head = buf[starts[:, None] + np.arange(size)].reshape(-1).view(_HEADER)
    begin = np.concatenate([[0], np.cumsum(head["ids"], dtype=np.int64)])
    out = np.zeros(begin[-1], np.int64)
    kinds = head["ids"].astype(np.int64) * 64 + head["width"]
    for kind in np.unique(kinds).tolist():
        n, width = divmod(kind, 64)
        rows = np.flatnonzero(kinds == kind)
        if width:
            packed = buf[starts[rows][:, None] + np.arange(size, size + packed_size(n, width))]
            out[begin[rows][:, None] + np.arange(n)] = _unpack(packed, width, n)
    for r in np.flatnonzero(head["exceptions"]).tolist():
        n, width, count = int(head["ids"][r]), int(head["width"][r]), int(head["exceptions"][r])
        at = int(starts[r]) + size + packed_size(n, width)
        out[begin[r] + buf[at:at + count].astype(np.int64)] |= np.frombuffer(raw, "<u4", count, at + count).astype(np.int64) << width
    return (out + np.repeat(head["minimum"].astype(np.int64), head["ids"])).astype("<u4")


class Tokenizer:
    """The library's tokenizer with a bounded table of words met before.

    The tokenizer lower-cases, normalises and splits at white space and between letters, digits and marks before it
    merges, so a text's ids are those of its parts in order. Texts of ASCII and Latin-1 letters are cut into these
    parts here and only parts not met before go to the library's merges; other white-space-free runs, and texts with the
    tokenizer's special strings, go to it as they are.
    """

    _PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
    _PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")

    def __init__(self, path: str, known: int = KNOWN_WORDS):
        from tokenizers import Tokenizer as Library
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library, self.most, self.known, self.older = Library.from_file(path), known, {}, {}
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def _runs(self, text: str) -> list[str]:
        if self._PLAIN.fullmatch(text):
            return self._PARTS.findall(text.lower())
        out = []
        for run in re.split(r"[\t-\r ]+", text):
            out += self._PARTS.findall(run.lower()) if self._PLAIN.fullmatch(run) else [run] if run else []
        return out

    def _part(self, part: str) -> bytes:
        """Ids of a part that needs no normalising and splitting any more: straight from the library's merges."""
        symbols = part if part.isascii() else self.bytes.pre_tokenize_str(part)[0][0]
        return array("I", [t.id for t in self.library.model.tokenize(symbols)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian u32) of each text, without special tokens."""
        if len(self.known) > self.most:     # what isn't met again while the table fills once more is forgotten
            self.known, self.older = {}, self.known
        whole = [any(s in t for s in self.special) for t in texts]
        runs = [[] if w else self._runs(t) for t, w in zip(texts, whole, strict=True)]
        unseen = {r for own in runs for r in own if r not in self.known}
        fresh = []
        for r in unseen:
            if r in self.older:
                self.known[r] = self.older[r]
            else:
                fresh.append(r)
        for r in fresh:
            self.known[r] = self._part(r) if self._PLAIN.fullmatch(r) else np.array(self.library.encode(r, add_special_tokens=False).ids, "<u4").tobytes()
        known = self.known
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if w else b"".join([known[r] for r in own])
                for t, w, own in zip(texts, whole, runs, strict=True)]


_tokenizers: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The worker's tokenizer of that file."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


class Writer:
    """Streams documents into one file, those with a null id first; ids wait until ``FLUSH_BLOCKS`` blocks are full, the index until the end."""

    def __init__(self, out):
        self.out, self.size, self.rest, self.waiting = out, 0, [], 0
        self.blocks, self.docs, self.starts, self.ids, self.nulls = array("q"), array("q"), array("q"), 0, 0
        self._write(MAGIC)

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.size += len(raw)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if doc_id is None and self.nulls < len(self.docs):
            raise ValueError("null ids come before all others")
        self.nulls += doc_id is None
        self.docs.append(doc_id or 0)
        self.starts.append(self.ids)
        self.ids += len(ids) // 4
        self.rest.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= FLUSH_BLOCKS * BLOCK:
            self._flush()

    def _flush(self) -> None:
        """Write the full blocks of what waits."""
        ids = np.frombuffer(b"".join(self.rest), "<u4")
        full = len(ids) // BLOCK * BLOCK
        for at in range(0, full, FLUSH_BLOCKS * BLOCK):
            self._blocks(ids[at:min(full, at + FLUSH_BLOCKS * BLOCK)].reshape(-1, BLOCK))
        self.rest, self.waiting = [ids[full:].tobytes()], len(ids) - full

    def _blocks(self, ids: np.ndarray) -> None:
        for raw in encode_blocks(ids):
            self.blocks.append(self.size)
            self._write(raw)

    def close(self) -> None:
        self._flush()
        if self.waiting:
            self._blocks(np.frombuffer(self.rest[0], "<u4").reshape(1, -1))
        index = self.size
        for numbers in (self.blocks, self.docs, self.starts):
            self._write(np.asarray(numbers, "<i8").tobytes())
        self._write(np.array([index, len(self.blocks), len(self.docs), self.ids, self.nulls], "<u8").tobytes() + MAGIC)


class Reader:
    """Reads documents of one file through its index."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - FOOTER)
        footer = source.read(FOOTER)
        if footer[-len(MAGIC):] != MAGIC:
            raise ValueError("not a token file, or cut off")
        self.index, blocks, docs, self.ids, self.nulls = np.frombuffer(footer, "<u8", 5).astype(int).tolist()
        source.seek(self.index)
        raw = source.read(8 * blocks + 16 * docs)
        self.blocks = np.append(np.frombuffer(raw, "<u8", blocks).astype(np.int64), self.index)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 * blocks)
        self.starts = np.append(np.frombuffer(raw, "<u8", docs, 8 * (blocks + docs)).astype(np.int64), self.ids)

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` (included) to ``last`` (excluded) of the file."""
        if last <= first:
            return np.zeros(0, "<u4")
        a, b = first // BLOCK, (last - 1) // BLOCK + 1
        self.source.seek(int(self.blocks[a]))
        raw = self.source.read(int(self.blocks[b] - self.blocks[a]))
        return decode_blocks(raw, self.blocks[a:b] - self.blocks[a])[first - a * BLOCK:last - a * BLOCK]


def write_token_files(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Tokenise every text and write the files; returns the manifest ``(place, file, docs, ids, start)``.

    One file per range of (id, text hash), so a frequent id spreads over files. A file's name is new for every attempt of its task and only files of attempts that
    Spark commits get into the manifest, so lost or repeated tasks do no harm. Null texts count as empty (one end
    id), null ids come first, repeated ids follow each other in the order of their texts' hashes. An empty table makes no
    file. ``start`` counts the ids of all files before.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    starts = range_starts(rows.select("doc_id"), "doc_id", range_count(spark))
    placed = rows.withColumn("order", text_order())
    placed = placed.withColumn("place", range_number(F.col("doc_id"), F.col("order"), starts)).repartitionById(max(1, len(starts)), F.col("place"))
    placed = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "order", "text").select("doc_id", "text", "place")

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        out = writer = name = None
        place = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                place, name = batch.column(2)[0].as_py(), f"part-{batch.column(2)[0].as_py():05d}-{uuid.uuid4().hex}.pfor"
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}")
                writer = Writer(out)
            ids = tokenizer(path).encode(batch.column(1).to_pylist())
            for doc_id, own in zip(batch.column(0).to_pylist(), ids, strict=True):
                writer.add(doc_id, own + END_ID.to_bytes(4, "little"))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([name]), pa.array([len(writer.docs)], pa.int64()),
                                              pa.array([writer.ids], pa.int64()), pa.array([writer.size], pa.int64())], names=["place", "file", "docs", "ids", "bytes"])

    manifest = staged(map_batches(placed, run, "place int, file string, docs bigint, ids bigint, bytes bigint"))
    # One row per file: at most as many as there are ranges.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files of a manifest, one task per file."""
    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, size, before in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                with store.open_input_file(f"{base}/{name}") as source:
                    reader = Reader(source, size)
                    for at in range(0, len(reader.doc_ids), 256):
                        stop = min(at + 256, len(reader.doc_ids))
                        first, last = int(reader.starts[at]), int(reader.starts[stop])
                        cuts = reader.starts[at:stop + 1]
                        crcs, ids, have = [], None, None
                        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                            if have is None or b > have[1]:  # about a megabyte of ids at a time, or one document
                                end = int(cuts[max(np.searchsorted(cuts, a + (1 << 18), "right") - 1, np.searchsorted(cuts, b))])
                                have = (a, min(max(end, b), last))
                                ids = reader.read(*have)
                            crcs.append(zlib.crc32(ids[a - have[0]:b - have[0]].tobytes()))
                        numbers = reader.doc_ids[at:stop]
                        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64(), mask=np.arange(at, stop) < reader.nulls), pa.array(cuts[:-1] + before, pa.int64()),
                                                          pa.array(np.diff(cuts), pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("file", "bytes", "start", "place")
    spread = files.repartitionById(range_count(files.sparkSession), F.col("place") % range_count(files.sparkSession)).select("file", "bytes", "start")
    return map_batches(spread, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files in the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base if re.match('[a-z0-9]+:', base) else 'file://' + os.path.abspath(base)}/tokens-{uuid.uuid4().hex}"


def digest(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every row of ``docs(doc_id, text)``, read back from its files."""
    folder = token_folder(docs.sparkSession)
    return read_token_files(write_token_files(docs, path, folder), folder)
