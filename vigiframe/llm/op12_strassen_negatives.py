"""Hard negatives by exact integer products of anchors and candidates.

Two passes over a grid of tiles (anchors of a block, candidates of a shard). The first multiplies the anchors of each
label with the candidates of that label and keeps, per anchor, a heap of its first positives; heaps of an anchor's
tiles merge into its positives. The second multiplies again, and each positive keeps a heap of the first rows of other
labels whose score lies in its window; these merge likewise. A heap holds ``KEEP`` rows, so what a tile gives is bounded
by its anchors and merging loses nothing.

Products are Strassen's: seven products of half-size blocks and eighteen additions of int64 blocks, blocks padded with
zeros to even sizes, down to ``LEAF``. Integers wrap around modulo 2^64 in sums and products alike, so a result that
fits an int64 is exact whatever its intermediate sums were, and rows too large for that fail the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigiframe.llm.vectors import finite, first_by_score, in_tiles, matrices

KEEP = 5
# Least size of a side that is still halved.
LEAF = 16
# Rows of a product of one step inside a tile; bounds the score matrix.
STEP_ROWS = 256
SCALE = 256.0
# With squared lengths below 2^56 every score times 100 fits a long (Cauchy-Schwarz).
MOST_SQUARED = float(1 << 56)


def _even(a: np.ndarray) -> np.ndarray:
    return np.pad(a, ((0, a.shape[0] % 2), (0, a.shape[1] % 2))) if a.shape[0] % 2 or a.shape[1] % 2 else a


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices."""
    if min(a.shape[0], a.shape[1], b.shape[1]) <= LEAF:
        return a @ b
    rows, columns = a.shape[0], b.shape[1]
    a, b = _even(a), _even(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


def integers(vectors: np.ndarray) -> np.ndarray:
    """Components as floor(256 x); fails where a score could not be held exactly."""
    scaled = np.floor(SCALE * vectors)
    with np.errstate(over="ignore"):
        if len(scaled) and not ((scaled * scaled).sum(axis=1) < MOST_SQUARED).all():
            raise ValueError("a vector is too large: floor(256 x) has a squared length of 2^56 or more")
    return scaled.astype(np.int64)


class _Out:
    """Columns of long integers, filled block by block."""

    def __init__(self, names: list[str]):
        self.names, self.parts = names, [[] for _ in names]

    def add(self, n: int, *values) -> None:
        for part, v in zip(self.parts, values):
            part.append(np.full(n, v, np.int64) if np.ndim(v) == 0 else np.asarray(v, np.int64))

    def table(self) -> pa.Table:
        return pa.table([pa.array(np.concatenate(p) if p else np.empty(0, np.int64)) for p in self.parts], names=self.names)


POSITIVE = "anchor_id bigint, anchor_key bigint, label bigint, positive_id bigint, positive_score bigint"
NEGATIVE = "anchor_id bigint, anchor_key bigint, label bigint, place bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def positives_of_tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    """Each anchor's first rows of its label in one shard."""
    out = _Out(_names(POSITIVE))
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    anchor_ids, keys, anchor_labels = (anchors[c].to_numpy() for c in ("vec_id", "anchor_key", "label"))
    shard = {m.shape[1]: (at, integers(m)) for at, m in matrices(rows["vector"])}
    for at, vectors in matrices(anchors["vector"]):
        places, candidates = shard.get(vectors.shape[1], (np.empty(0, np.int64), np.empty((0, vectors.shape[1]), np.int64)))
        for label in np.unique(anchor_labels[at]):
            mine = np.flatnonzero(anchor_labels[at] == label)
            same = np.flatnonzero(labels[places] == label)
            if not len(same):
                continue
            there, theirs = ids[places[same]], np.ascontiguousarray(candidates[same].T)
            for start in range(0, len(mine), STEP_ROWS):
                part = mine[start:start + STEP_ROWS]
                for i, score in zip(at[part], strassen(integers(vectors[part]), theirs)):
                    others = np.flatnonzero(there != anchor_ids[i])
                    first = others[first_by_score(score[others], there[others], KEEP)]
                    out.add(len(first), anchor_ids[i], keys[i], label, there[first], score[first])
    return out.table()


def negatives_of_tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    """For each anchor and positive, the first rows of other labels in one shard that lie in the positive's window."""
    out = _Out(_names(NEGATIVE))
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    anchor_ids, keys, anchor_labels = (anchors[c].to_numpy() for c in ("vec_id", "anchor_key", "label"))
    positives = anchors["positives"].to_pylist()
    shard = {m.shape[1]: (at, integers(m)) for at, m in matrices(rows["vector"])}
    for at, vectors in matrices(anchors["vector"]):
        if vectors.shape[1] not in shard:
            continue
        places, candidates = shard[vectors.shape[1]]
        candidates, there, theirs = np.ascontiguousarray(candidates.T), ids[places], labels[places]
        for start in range(0, len(at), STEP_ROWS):
            part = slice(start, start + STEP_ROWS)
            for i, score in zip(at[part], strassen(integers(vectors[part]), candidates)):
                other = theirs != anchor_labels[i]
                for p in positives[i]:
                    least, most = 80 * p["positive_score"], 100 * p["positive_score"]
                    inside = np.flatnonzero(other & (100 * score >= least) & (100 * score <= most))
                    first = inside[first_by_score(score[inside], there[inside], KEEP)]
                    out.add(len(first), anchor_ids[i], keys[i], anchor_labels[i], p["place"], p["positive_id"], p["positive_score"], there[first], score[first])
    return out.table()


def oracle_sql() -> str:
    """The whole result in DuckDB SQL: all products of anchors and rows, and window functions."""
    return f"""
WITH r AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT DISTINCT vec_id AS anchor_id, label AS anchor_label, v AS anchor FROM r WHERE vec_id % 100 = 0),
s AS (
  SELECT a.*, r.vec_id, r.label, CAST(list_dot_product(anchor, v) AS BIGINT) AS score
  FROM a JOIN r ON len(anchor) = len(v) AND anchor_id <> vec_id),
p AS (
  SELECT anchor_id, anchor_label, anchor, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id, anchor_label, anchor ORDER BY score DESC, vec_id) AS place
  FROM s WHERE label = anchor_label QUALIFY place <= {KEEP}),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, anchor_label, anchor, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id, anchor_label, anchor)
  WHERE label <> anchor_label AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {KEEP}"""


def mine(df: DataFrame, every: int = 100, shift_every: int = 7, labels: int = 10, id_column: str = "vec_id", vector: str = "embedding",
         label: str = "label") -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``.

    ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score``, ``negative_score``: for each
    anchor and each of its first five positives the first five rows of another label with
    80 positive_score <= 100 negative_score <= 100 positive_score. Where an id is divisible by ``shift_every`` the label
    becomes (label + 1) % ``labels`` first. Rows without an id or label, and vectors that are null or hold null or
    non-finite components take no part; vectors of other lengths than the anchor's have no score. A row with the
    anchor's id is no positive of it; repeated other rows each count; ties go to the smaller id. Anchors that repeat id,
    label and vector count once; anchors that share only the id are mined each. An empty table, an anchor without
    positives and an empty window give no rows. Other columns are not looked at.
    """
    rows = df.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").cast("bigint").alias("label"),
                     F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector")))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("anchor_key", F.xxhash64("vector")).dropDuplicates(["vec_id", "label", "anchor_key"])
    found = in_tiles(rows, anchors, positives_of_tile, POSITIVE, F.struct("vec_id", "vector"), F.col("vec_id"))
    order = Window.partitionBy("anchor_id", "anchor_key", "label").orderBy(F.desc("positive_score"), "positive_id")
    merged = found.withColumn("place", F.row_number().over(order).cast("bigint")).where(F.col("place") <= KEEP)
    # At most KEEP rows an anchor.
    held = merged.groupBy(F.col("anchor_id").alias("vec_id"), "anchor_key", "label").agg(
        F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))
    second = anchors.join(held, ["vec_id", "anchor_key", "label"])
    windows = in_tiles(rows, second, negatives_of_tile, NEGATIVE, F.struct("vec_id", "vector"), F.col("vec_id"))
    order = Window.partitionBy("anchor_id", "anchor_key", "label", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = windows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= KEEP)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
