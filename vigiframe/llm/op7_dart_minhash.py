"""Near-duplicate classes by DartMinHash signatures, banded joining and exact verification.

A text is the weighted set of its five-word shingles, a shingle seen c times weighing 1 + ln c. Darts are thrown
into the plane (weight x rank) over every shingle by hashing: in each unit slab of weight the ranks of the darts
are the arrival times of a Poisson process and the weight positions are uniform, all fixed by the shingle alone.
A dart hits the text if its weight position lies below the shingle's weight. Every dart belongs to one of ``k``
coordinates; the earliest hit of each coordinate is the signature, and two texts share a coordinate with
probability equal to their weighted Jaccard similarity. Only darts up to rank t / |w| are looked at, t = k ln k + 2k,
so the work is one hash per shingle plus about t darts a text; a text with an empty coordinate doubles its rank.
Links are defined on plain sets, and a passage that one text repeats lowers the weighted similarity far below the
plain one; so a text with a repeated shingle has a second signature with all weights 1, and the bands of both.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.common import by_characters, map_batches, safe_names, staged, text_key
from vigiframe.llm.components import connected_components
from vigiframe.llm.shingles import SHINGLE_WORDS, jaccard, mix, shingle_sets

BANDS = 20
ROWS = 4
SIMILARITY = 0.8
PROBES = 4              # further members of a bucket's leading class that the texts outside it are compared with
# Rows of either side of a tile, and shingles of its queries, which are in memory at once (8 bytes each).
TILE_ROWS = 256
TILE_SHINGLES = 1 << 20


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def dart_signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """Signatures (texts x k, unsigned 64 bit dart names) of weighted sets; an empty set has all zeros."""
    out = np.zeros((len(sets), k), np.uint64)
    best = np.full((len(sets), k), np.inf)
    todo = [i for i, (e, _) in enumerate(sets) if len(e)]
    t = k * math.log(max(k, 2)) + 2 * k
    while todo:
        item = np.concatenate([sets[i][0] for i in todo])
        weight = 1.0 + np.log(np.concatenate([sets[i][1] for i in todo]))
        doc = np.repeat(np.array(todo), [len(sets[i][0]) for i in todo])
        total = np.bincount(doc, weight, len(sets))
        reach = np.zeros(len(sets))
        reach[todo] = t / total[todo]
        found = [[], [], []]
        slab = 0
        live = np.arange(len(item))
        while len(live):
            seed = mix(item[live] ^ mix(np.full(1, slab + 1, np.uint64)))
            who, rank, arrival = live, np.zeros(len(live)), 0
            while len(who):
                name = mix(seed + np.uint64((2 * arrival + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
                rank = rank - np.log(_uniform(name))
                near = rank <= reach[doc[who]]
                who, rank, seed, name = who[near], rank[near], seed[near], name[near]
                mark = mix(name ^ np.uint64(0xD6E8FEB86659FD93))
                hit = slab + _uniform(mark) < weight[who]
                for kept, values in zip(found, (doc[who[hit]], rank[hit], mark[hit]), strict=True):
                    kept.append(values)
                arrival += 1
            slab += 1
            live = live[weight[live] > slab]
        d, rank, mark = (np.concatenate(x) for x in found)
        cell = d * k + (mix(mark) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((mark, rank, cell))
        cell, rank, mark = cell[order], rank[order], mark[order]
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, int)
        best.flat[cell[first]], out.flat[cell[first]] = rank[first], mark[first]
        todo = [i for i in todo if np.isinf(best[i]).any()]
        t *= 2
    return out


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(key, n, bands)`` per row of ``docs(key, text)``: number of distinct shingles and the distinct band hashes.

    A text without a repeated shingle has one hash per band, as its weights are all 1. Any other text has one per band
    of the weighted signature and one per band of the plain one, in the same name space, so plain meets plain.
    """
    salts = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    names = mix(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32))

    def band_hashes(sets):
        sig = dart_signatures(sets, bands * rows).reshape(len(sets), bands, rows)
        return mix((sig * salts).sum(axis=2, dtype=np.uint64) ^ names)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts, hashes = [], []
            for part in by_characters(texts):
                sets = shingle_sets(texts[part], words)
                h = list(band_hashes(sets))
                again = [i for i, (_, c) in enumerate(sets) if (c > 1).any()]
                plain = band_hashes([(sets[i][0], np.ones(len(sets[i][0]), np.int64)) for i in again])
                for i, x in zip(again, plain, strict=True):
                    h[i] = np.unique(np.concatenate([h[i], x]))
                counts += [len(e) for e, _ in sets]
                hashes += [x.view(np.int64) if len(e) else None for x, (e, _) in zip(h, sets, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int32()), pa.array(hashes, pa.list_(pa.int64()))],
                                             names=["key", "n", "bands"])

    return map_batches(docs, run, "key binary, n int, bands array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, words: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose whole texts' shingle sets have at least the Jaccard similarity."""
    def run(batches):
        last, mine = None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            keep = []
            for part in by_characters(right):
                for i, (other, _) in zip(range(part.start, part.stop), shingle_sets(right[part], words), strict=True):
                    if a[i] != last:
                        last, mine = a[i], shingle_sets([left[i]], words)[0][0]
                    if jaccard(mine, other) >= similarity:
                        keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.binary()), pa.array([b[i] for i in keep], pa.binary())],
                                             names=["a", "b"])

    with_b = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    return map_batches(both.select("a", "b", "text_a", "text_b"), run, "a binary, b binary")


def near_duplicate_links(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = SHINGLE_WORDS,
                         similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """``(rows, roots)``: ``rows(doc_id, key)`` of all documents and ``roots(node, root)`` of linked texts.

    Exact copies collapse into one text first. The texts of a bucket (equal band hash) are compared with the
    bucket's centre, the member that shares most buckets with others. Members that this leaves in another
    class than most of their bucket are then compared with every member outside their own class, so every pair
    that shares a bucket is either in one class or has been compared: links are lost only where no band agrees. Every
    text has the bands of its plain set, so at a set similarity of 0.8 that is at most (1 - 0.8^4)^20, about 3 in
    100,000, however often either text repeats a passage.
    """
    keyed = docs.select("doc_id", "text", text_key().alias("key"))
    signed = staged(signatures(keyed.select("key", "text").where("text is not null"), bands, rows, words))
    one = signed.where("bands is not null").groupBy("key").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    cells = one.select(F.explode("bands").alias("hash"), "key", "n")
    shared = cells.groupBy("hash").agg(F.count("*").alias("members")).where("members > 1")
    cells = staged(cells.join(shared, "hash"))
    degree = cells.groupBy("key").agg(F.sum("members").alias("degree"))
    ranked = cells.join(degree, "key")
    centre = ranked.groupBy("hash").agg(F.max(F.struct("degree", "key", "n")).alias("c")).select("hash", F.col("c.key").alias("a"), F.col("c.n").alias("n_a"))
    alike = F.least("n", "n_a") >= F.greatest("n", "n_a") * F.lit(similarity)
    stars = staged(cells.join(centre, "hash").where((F.col("key") != F.col("a")) & alike).select("a", F.col("key").alias("b")).distinct())
    wanted = cells.select("key").distinct()
    # Copies collapse before the shuffle, not after the join.
    texts = staged(keyed.select("key", "text").dropDuplicates(["key"]).join(wanted, "key", "left_semi"))
    links = staged(verified(stars, texts, words, similarity))
    roots = connected_components(links)

    # A few other members of the leading class of each open bucket settle most of what one centre left open ...
    members = open_members(cells, roots)
    leading = [F.min(F.when(F.col("root") == F.col("top"), F.struct(F.xxhash64("key", F.lit(i)), F.col("key").alias("a"), F.col("n").alias("n_a")))) for i in range(PROBES)]
    probes = members.groupBy("hash").agg(F.array_distinct(F.array(*leading)).alias("probes"))
    tries = members.where("root <> top").join(probes, "hash").select("key", "n", F.explode("probes").alias("p")).select("p.a", F.col("p.n_a"), "key", "n")
    tries = tries.where(alike).select("a", F.col("key").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    probed = staged(verified(tries, texts, words, similarity))
    # ... and the rest is compared with all members of its buckets, in blocks. For these, a class that a probe has
    # linked counts as part of the other one; a link seen so or not is only compared once more.
    more = staged(linked_in_blocks(open_members(cells, merged(roots, probed)), texts, words, similarity))
    new = probed.unionByName(more)
    if not new.isEmpty():
        roots = connected_components(links.unionByName(new))
    return keyed.select("doc_id", "key"), roots


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` with every class that a link ``(a, b)`` joins to another one put under that one's root, one step far.

    ``a`` is in the class that stays. Texts without a class are classes of their own.
    """
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    moves = ends.select(F.coalesce("root_a", "a").alias("into"), F.coalesce("root_b", "b").alias("root")).where("into <> root")
    moves = moves.groupBy("root").agg(F.min("into").alias("into"))
    nodes = roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct().join(roots, "node", "left_anti"))
    return staged(nodes.join(moves, "root", "left").select("node", F.coalesce("into", "root").alias("root")))


def open_members(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """``(hash, key, n, root, top)`` of the buckets whose texts are in several classes; top is the largest one."""
    member = cells.join(roots.withColumnRenamed("node", "key"), "key", "left").select("hash", "key", "n", F.coalesce("root", "key").alias("root"))
    sizes = member.groupBy("hash", "root").agg(F.count("*").alias("m"))
    most = sizes.groupBy("hash").agg(F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("classes")).where("classes > 1")
    return staged(member.join(most.select("hash", F.col("top.root").alias("top")), "hash"))


class ShingleIndex:
    """Shingles of several sets in one sorted array, with the set each comes from."""

    def __init__(self, sets: list[np.ndarray]):
        joined = np.concatenate(sets)
        order = np.argsort(joined, kind="stable")
        self.count, self.shingles = len(sets), joined[order]
        self.owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]

    def shared(self, own: np.ndarray) -> np.ndarray:
        """How many shingles each set shares with ``own`` (distinct ones)."""
        low = np.searchsorted(self.shingles, own, "left")
        runs = np.searchsorted(self.shingles, own, "right") - low
        shift = np.repeat(low - (np.cumsum(runs) - runs), runs)
        return np.bincount(self.owner[shift + np.arange(len(shift))], minlength=self.count)


def linked_in_blocks(members: DataFrame, texts: DataFrame, words: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``(a, b)``: links between each text outside its bucket's leading class and the bucket's texts of other classes.

    A bucket is a grid of tiles: its texts outside are queries, dealt into blocks, and all its members are dealt into
    pieces. The queries of a tile form one index of shingles, and the tile's members pass by it one after the other, so
    no pair becomes a row unless it is a link that joins two classes (one per query, class and piece). A query and a
    member meet in one tile, and no tile grows with its bucket.
    """
    queries = members.where("root <> top")
    blocks = queries.groupBy("hash").agg(F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int").alias("blocks"))
    pieces = members.groupBy("hash").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("pieces"))
    grid = blocks.join(pieces, "hash")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = queries.join(grid, "hash").select("hash", F.expr("pmod(xxhash64(key), blocks)").cast("int").alias("block"), each("pieces").alias("piece"),
                                              F.lit(0).alias("turn"), "key", "root")
    passing = members.join(grid, "hash").select("hash", each("blocks").alias("block"), F.expr("pmod(xxhash64(key, 1), pieces)").cast("int").alias("piece"),
                                                F.lit(1).alias("turn"), "key", "root")
    stream = asked.unionByName(passing).join(texts, "key").select("hash", "block", "piece", "turn", "key", "root", "text")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = stream.repartition(parts, "hash", "block", "piece").sortWithinPartitions("hash", "block", "piece", "turn", "key")

    def run(batches):
        tile, keys, roots, sets, index, told = None, [], [], [], None, set()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            mine = []
            for part in by_characters(columns[6]):
                mine += [e for e, _ in shingle_sets(columns[6][part], words)]
            found = []
            for h, block, piece, turn, key, root, own in zip(*columns[:6], mine, strict=True):
                if (h, block, piece) != tile:
                    tile, keys, roots, sets, index, told = (h, block, piece), [], [], [], None, set()
                if turn == 0:
                    keys.append(key)
                    roots.append(root)
                    sets.append(own)
                    continue
                if not sets or not len(own):
                    continue
                if index is None:
                    index, sizes = ShingleIndex(sets), np.array([len(x) for x in sets])
                both = index.shared(own)
                for i in np.flatnonzero((both > 0) & (both >= similarity * (sizes + len(own) - both))).tolist():
                    if roots[i] != root and (keys[i], root) not in told:
                        told.add((keys[i], root))
                        found.append((min(key, keys[i]), max(key, keys[i])))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"])

    return map_batches(stream, run, "a binary, b binary")


def near_duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, key, class_id, class_size, is_lead)`` for every row of ``docs``.

    Classes are the components of the relation "five-word shingle sets at least 0.8 alike" plus equal texts; the
    class id is the least document id in the class, the lead the text that has it (of several, the one with the
    least key), ``class_size`` counts rows, repeated ones included. A null text, or a row without an id, is in no
    class: its class id is its own id (null without an id), its size 1, and it leads itself. Equal texts without a
    word are copies of each other and near to nothing else. Other columns of ``docs`` are not looked at.
    """
    rows, roots = near_duplicate_links(docs.select("doc_id", "text"), **options)
    tagged = rows.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    tagged = staged(tagged.select("doc_id", "key", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "key")).alias("root")))
    least = tagged.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("lead"), F.count("*").alias("class_size"))
    # Written first: between the sum and the join there is then a shuffle of its own, and a hot class's rows may be split.
    found = tagged.join(staged(least.where("class_size > 1")), "root", "left")
    is_lead = F.coalesce((F.col("doc_id") == F.col("lead.doc_id")) & (F.col("key") == F.col("lead.key")), F.lit(True))
    return found.select("doc_id", "key", F.coalesce("lead.doc_id", "doc_id").alias("class_id"),
                        F.coalesce("class_size", F.lit(1)).alias("class_size"), is_lead.alias("is_lead"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: one row of each class's lead stays, and every row that is in no class.

    Rows with a null text or id always stay. All columns are kept as they are.
    """
    classes = near_duplicate_classes(docs, **options).where("class_size > 1")
    verdict = classes.groupBy("doc_id", "key").agg(F.max("is_lead").alias("lead"), F.count("*").alias("copies"))
    safe, names = safe_names(docs)
    doc_id = names["doc_id"]
    held = safe.withColumn("key", text_key(names["text"])).withColumnRenamed(doc_id, "doc_id").join(verdict, ["doc_id", "key"], "left")
    single = held.where(F.col("lead").isNull() | (F.col("lead") & (F.col("copies") == 1)))
    again = held.where(F.col("lead") & (F.col("copies") > 1)).dropDuplicates(["doc_id", "key"])
    kept = single.unionByName(again).withColumnRenamed("doc_id", doc_id)
    return kept.select(*safe.columns).toDF(*docs.columns)
