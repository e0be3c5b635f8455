"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The vocabulary file gives the pieces. The highest-scoring segmentation of a text (white space written as the marker
U+2581, one marker in front) is found by dynamic programming; characters that no piece covers fall back to byte
pieces. The trie is a double array (base, check, value) over UTF-8 bytes, so a step is two array reads and many
segments advance together. No piece has a marker behind another character or a line break, so the best path of a
text is made of the best paths between these places: segments are encoded once and kept by a bounded table.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiframe.llm.common import map_batches, safe_names

MARKER = "▁"
RANK_OFFSET = 2.7           # Zipf-Mandelbrot offset of the log scores
UNKNOWN_PENALTY = 10.0      # below the lowest score, for a character without a piece
KNOWN_SEGMENTS = 250_000    # segments kept per Python worker
LONG_SEGMENT = 192          # bytes; longer segments are encoded one by one


@dataclass
class Vocabulary:
    """Pieces as bytes, log scores, byte piece ids by byte, and the double array of the pieces."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    splits: bool
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(base, check, value)`` of a trie: state s goes by byte c to t = base[s] + c if check[t] = s; value[t] is
    the word that ends in t, or -1. State 0 is the root."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, number in words.items():
        at = 0
        for c in word:
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
                ends.append(-1)
            at = children[at][c]
        ends[at] = number
    size = len(children) * 4 + 4096
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    used = bytearray(size)
    used[0], single, many = 1, 1, 1
    queue = [(0, 0)]
    for node, state in queue:
        keys = sorted(children[node])
        if not keys:
            continue
        if len(keys) == 1:  # fills the gaps
            single = used.index(0, single)
            b = single - keys[0]
            if b < 1:
                b = used.index(0, keys[0] + 1) - keys[0]
        else:               # moves on: a place is tried by few nodes with several children
            b, tried = many, 0
            while any(used[b + c] for c in keys):
                b, tried = b + 1, tried + 1
            if tried > 64:
                many = b - 32
        base[state] = b
        for c in keys:
            used[b + c] = 1
            check[b + c], value[b + c] = state, ends[children[node][c]]
            queue.append((children[node][c], b + c))
    return base, check, value


def load_vocabulary(path: str) -> Vocabulary:
    """Vocabulary of a SentencePiece model file. Its scores are merge ranks; a piece of rank r has the log score
    -ln(r + offset) less the logarithm of the sum of all 1 / (r + offset)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, words, byte_ids = [], {}, np.zeros(256, np.int64)
    ranks = np.full(model.get_piece_size(), np.nan)
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            pieces.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            pieces.append(b"")
        else:
            pieces.append(name.encode())
            words[pieces[-1]] = i
            ranks[i] = len(words)
    scores = -np.log(ranks + RANK_OFFSET) - np.log(np.nansum(1 / (ranks + RANK_OFFSET)))
    mark = MARKER.encode()
    splits = all(b"\n" not in w and mark not in re.sub(b"^(" + mark + b")+", b"", w) for w in words)
    return Vocabulary(pieces, np.nan_to_num(scores), byte_ids, float(np.nanmin(scores)) - UNKNOWN_PENALTY, splits, *double_array(words))


def _char_length(first: np.ndarray) -> np.ndarray:
    return np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))


def best_paths(v: Vocabulary, segments: list[bytes]) -> list[bytes]:
    """Piece ids (little-endian int32) of the best segmentation of each segment, all advanced together.

    Of equally good paths the one whose last piece starts first wins.
    """
    order = sorted(range(len(segments)), key=lambda i: -len(segments[i]))
    lengths = np.array([len(segments[i]) for i in order], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    buf = np.frombuffer(b"\0".join(segments[i] for i in order) + b"\0" * 8, np.uint8).astype(np.int64)
    best = np.full(len(buf) + 8, -np.inf)
    best[starts] = 0.0
    origin, piece = np.zeros(len(best), np.int64), np.full(len(best), -2, np.int64)
    ends = starts + lengths
    for offset in range(int(lengths.max(initial=0))):
        active = int(np.searchsorted(-lengths, -offset, "left"))
        p = starts[:active] + offset
        reach = best[p] > -np.inf
        p, end = p[reach], ends[:active][reach]
        score = best[p]
        width = _char_length(buf[p])
        single = np.zeros(len(p), bool)
        who, state, q = np.arange(len(p)), np.zeros(len(p), np.int64), p.copy()
        while len(who):
            to = v.base[state] + buf[q]
            ok = (v.check[to] == state) & (q < end[who])
            who, state, q = who[ok], to[ok], q[ok] + 1
            number = v.value[state]
            word = number >= 0
            w, at, ids = who[word], q[word], number[word]
            single[w[at - p[w] == width[w]]] = True
            new = score[w] + v.scores[ids]
            better = new > best[at]
            at, w = at[better], w[better]
            best[at], origin[at], piece[at] = new[better], p[w], ids[better]
        lone = ~single
        at = np.minimum(p[lone] + width[lone], end[lone])
        new = score[lone] + v.unknown
        better = new > best[at]
        at = at[better]
        best[at], origin[at], piece[at] = new[better], p[lone][better], -1
    # Walk back from all ends together; a step gives one piece (or the bytes of one character) per segment.
    out: list[list[bytes]] = [[] for _ in segments]
    cur, who = ends.copy(), np.arange(len(order))
    steps = []
    while len(who):
        going = cur > starts[who]
        who, cur = who[going], cur[going]
        steps.append((who, piece[cur], origin[cur], cur))
        cur = origin[cur]
    for who, ids, begin, stop in reversed(steps):
        for i, k, a, b in zip(who.tolist(), ids.tolist(), begin.tolist(), stop.tolist(), strict=True):
            out[i].append(k.to_bytes(4, "little") if k >= 0 else v.byte_ids[buf[a:b]].astype("<i4").tobytes())
    found = [b""] * len(segments)
    for i, parts in zip(order, out, strict=True):
        found[i] = b"".join(parts)
    return found


def best_path(v: Vocabulary, segment: bytes) -> bytes:
    """``best_paths`` of one segment, step by step: for long ones."""
    n = len(segment)
    best, back = [float("-inf")] * (n + 1), [(0, -1)] * (n + 1)
    best[0] = 0.0
    base, check, value = v.base, v.check, v.value
    for p in range(n):
        if best[p] == float("-inf"):
            continue
        first = segment[p]
        width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        state, q, single = 0, p, False
        while q < n:
            to = int(base[state]) + segment[q]
            if check[to] != state:
                break
            state, q = to, q + 1
            k = int(value[state])
            if k >= 0:
                single = single or q - p == width
                new = best[p] + float(v.scores[k])
                if new > best[q]:
                    best[q], back[q] = new, (p, k)
        if not single and best[p] + v.unknown > best[q := min(p + width, n)]:
            best[q], back[q] = best[p] + v.unknown, (p, -1)
    parts, at = [], n
    while at:
        begin, k = back[at]
        parts.append(k.to_bytes(4, "little") if k >= 0 else v.byte_ids[list(segment[begin:at])].astype("<i4").tobytes())
        at = begin
    return b"".join(reversed(parts))


_SEGMENT = re.compile(f"{MARKER}+[^{MARKER}\n]*|[^{MARKER}\n]+|\n")


class Encoder:
    """Encodes whole texts; segments met before come from a bounded table."""

    def __init__(self, vocabulary: Vocabulary, known: int = KNOWN_SEGMENTS):
        self.v, self.most, self.known = vocabulary, known, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian int32) of each text; an empty text has none."""
        if len(self.known) > self.most:
            self.known = {}
        marked = [MARKER + t.replace(" ", MARKER) if t else "" for t in texts]
        segments = [_SEGMENT.findall(t) if self.v.splits else [t] if t else [] for t in marked]
        fresh = list({s for own in segments for s in own if s not in self.known})
        raw = [s.encode("utf-8", "replace") for s in fresh]
        short = [i for i, r in enumerate(raw) if len(r) <= LONG_SEGMENT]
        for at in range(0, len(short), 20_000):
            part = short[at:at + 20_000]
            self.known.update(zip((fresh[i] for i in part), best_paths(self.v, [raw[i] for i in part]), strict=True))
        single = {fresh[i]: best_path(self.v, r) for i, r in enumerate(raw) if len(r) > LONG_SEGMENT}
        look = _Both(self.known, single) if single else self.known
        return [b"".join([look[s] for s in own]) for own in segments]

    def decode(self, ids: bytes) -> str:
        """Text of ids: pieces joined, byte pieces as bytes (invalid ones replaced), markers as spaces, without the first."""
        pieces = self.v.pieces
        text = b"".join([pieces[i] for i in np.frombuffer(ids, "<i4").tolist()]).decode("utf-8", "replace").replace(MARKER, " ")
        return text[1:] if text[:1] == " " else text


class _Both(dict):
    """Looks in the first table, then in the second."""

    def __init__(self, first: dict, second: dict):
        super().__init__(second)
        self.first = first

    def __missing__(self, key):
        return self.first[key]


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker and vocabulary broadcast: workers serve many tasks."""
    if shared.id not in _encoders:
        _encoders.clear()
        _encoders[shared.id] = Encoder(shared.value)
    return _encoders[shared.id]


class _Shared:
    """A broadcast vocabulary and the number that names it."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        self.broadcast = spark.sparkContext.broadcast(vocabulary)
        self.id = self.broadcast._jbroadcast.id() if hasattr(self.broadcast, "_jbroadcast") else id(vocabulary)

    @property
    def value(self) -> Vocabulary:
        return self.broadcast.value


def _list_column(ids: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with the text column replaced by ``piece_ids`` (array of int), in last place.

    Null texts count as empty ones and have no ids. The vocabulary at ``path`` is read by the driver and broadcast:
    its size does not depend on the data.
    """
    shared = _Shared(docs.sparkSession, load_vocabulary(path))
    rest = [c for c in docs.columns if c != text]

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _list_column(encoder.encode(texts))], names=[*rest, "piece_ids"])

    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("piece_ids", T.ArrayType(T.IntegerType()))])
    return map_batches(docs.select(*rest, text), run, schema)


def decode(rows: DataFrame, path: str, ids: str = "piece_ids") -> DataFrame:
    """``rows`` plus ``decoded``: the text of each row's ids (null for null)."""
    shared = _Shared(rows.sparkSession, load_vocabulary(path))
    names = [*rows.columns, "decoded"]
    at = names.index(ids)

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = [None if x is None else encoder.decode(np.array(x, "<i4").tobytes()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return map_batches(rows, run, T.StructType(rows.schema.fields + [T.StructField("decoded", T.StringType())]))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_pieces, n_byte_pieces, ids_crc32, decoded_crc32, round_trip)`` per row of ``docs(doc_id, text)``.

    Encodes and decodes every whole text; ``round_trip`` tells whether the decoded text is the text (a marker in
    the text decodes as a space). A null text counts as empty: no pieces, and it comes back as empty.
    """
    shared = _Shared(docs.sparkSession, load_vocabulary(path))

    def run(batches):
        encoder = _encoder(shared)
        is_byte = np.zeros(len(encoder.v.pieces), bool)
        is_byte[encoder.v.byte_ids] = True
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for t, ids in zip(texts, encoder.encode(texts), strict=True):
                back = encoder.decode(ids)
                rows.append((len(ids) // 4, int(is_byte[np.frombuffer(ids, "<i4")].sum()), zlib.crc32(ids),
                             zlib.crc32(back.encode("utf-8", "replace")), back == t.replace(MARKER, " ")))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                                             names=["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_crc32", "round_trip"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, n_pieces bigint, n_byte_pieces bigint, ids_crc32 bigint, decoded_crc32 bigint, round_trip boolean")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` but the text, plus ``piece_ids`` and ``n_pieces`` (names that clash get the new values)."""
    keep = [c for c in docs.columns if c not in ("piece_ids", "n_pieces")]
    safe, names = safe_names(docs.select(*keep))
    out = encode(safe, path, names["text"])
    return out.select(*[F.col(names[c]).alias(c) for c in keep if c != "text"], "piece_ids", F.size("piece_ids").cast("bigint").alias("n_pieces"))
