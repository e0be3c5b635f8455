"""Approximate nearest neighbours by collision counting over query-centred windows.

Every vector is scaled to length 1 and projected on ``PROJECTIONS`` random directions; a shard keeps each projection
as a sorted array. A query opens a window around its own projection in every array. Windows grow level by level
(virtual rehashing: radius times ``GROWTH``), and only what a window newly covers is counted, so a vector's count is
the number of arrays in which it fell into the window. A vector whose count reaches the threshold is verified: its
cosine is computed in double precision on the original vectors. A query stops as soon as its fifth best verified
vector lies within the level's radius.

A vector at distance s falls into one window of radius R with probability 2 Phi(w R / 2 s) - 1. The threshold lies
``SLACK`` standard deviations below the expected count at s = R, so a vector at least as near as the one that stops
the search is missed by it in about 2 % of cases; nothing else is cut: there is no limit on candidates, and windows
that cover an array verify all that is left. Recall against brute force is tested; the index covers every row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigiframe.llm.vectors import finite, first_by_score, in_tiles, matrices

NEIGHBOURS = 5
PROJECTIONS = 32
# Width of the window at radius 1. A larger width tells near from far better but counts more.
WIDTH = 2.719
FIRST_RADIUS, GROWTH = 0.125, 1.2
SLACK = 2.0
SEED = 20_011
HIT = "query_id bigint, query_key bigint, vec_id bigint, score double"


def threshold(projections: int = PROJECTIONS, width: float = WIDTH, slack: float = SLACK) -> int:
    """Least collisions that make a vector a candidate."""
    p = math.erf(width / 2 / math.sqrt(2))
    return max(1, math.floor(projections * p - slack * math.sqrt(projections * p * (1 - p))))


def directions(dims: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Random directions, the same in every task."""
    return np.random.default_rng([SEED, dims]).standard_normal((dims, projections))


class SortedProjections:
    """One shard: its vectors, and their projections as sorted arrays."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        # Scaling by powers of two changes no digit of a cosine and keeps squares of huge components finite.
        self.vectors, self.ids = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None]), ids
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.lines = directions(vectors.shape[1])
        places = (self.vectors / self.norms[:, None]) @ self.lines
        order = np.argsort(places, axis=0, kind="stable")
        # The sorted arrays lie one behind the other, further apart in value than any window reaches (a projection is
        # at most its direction's length, so half a window of over twice that covers an array), and one search serves all.
        self.apart = 8 * np.sqrt((self.lines * self.lines).sum(axis=0).max()) * np.arange(self.lines.shape[1])
        self.sorted = (np.take_along_axis(places, order, axis=0) + self.apart).T.ravel()
        self.order = order.T.astype(np.int32).ravel()

    def search(self, query: np.ndarray, own: int, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` nearest found, nearest first; ``own`` is the id that is left out."""
        size, lists = len(self.ids), self.lines.shape[1]
        query = np.ldexp(query, -int(np.frexp(np.abs(query).max())[1]))
        norm = np.sqrt((query * query).sum())
        centre = (query / norm) @ self.lines + self.apart
        low = np.searchsorted(self.sorted, centre)
        high, counts, least = low, np.zeros(size, np.int64), threshold(lists)
        done = self.ids == own
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        radius = FIRST_RADIUS
        while not done.all():
            half = WIDTH * radius / 2
            left, right = np.searchsorted(self.sorted, centre - half, "left"), np.searchsorted(self.sorted, centre + half, "right")
            starts, lengths = np.concatenate([left, high]), np.concatenate([low - left, right - high])
            total = int(lengths.sum())
            if total:
                shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
                counts += np.bincount(self.order[shift + np.arange(total)], minlength=size)
                low, high = left, right
                found = np.flatnonzero((counts >= least) & ~done)
                if len(found):
                    done[found] = True
                    # A sum along each row: equal vectors get equal scores wherever they stand.
                    score = (self.vectors[found] * query).sum(axis=1) / (self.norms[found] * norm)
                    best_ids, best = np.concatenate([best_ids, self.ids[found]]), np.concatenate([best, score])
                    first = first_by_score(best, best_ids, k)
                    best_ids, best = best_ids[first], best[first]
            if len(best) == k and math.sqrt(max(0.0, 2 - 2 * best[-1])) <= radius:
                break
            radius *= GROWTH
        return best_ids, best


def search_tile(rows: pa.Table, queries: pa.Table) -> pa.Table:
    """The nearest rows of one shard for each query of one block."""
    ids = rows["vec_id"].to_numpy()
    by_length = {m.shape[1]: (at, m) for at, m in matrices(rows["vector"])}
    query_ids, keys = queries["vec_id"].to_numpy(), queries["query_key"].to_numpy()
    out: list[list] = [[], [], [], []]
    for at, vectors in matrices(queries["vector"]):
        if vectors.shape[1] not in by_length:
            continue
        places, shard = by_length[vectors.shape[1]]
        index = SortedProjections(shard, ids[places])
        for i, query in zip(at, vectors):
            found, score = index.search(query, query_ids[i])
            out[0].append(np.full(len(found), query_ids[i]))
            out[1].append(np.full(len(found), keys[i]))
            out[2].append(found)
            out[3].append(score)
    kinds = [np.int64, np.int64, np.int64, np.float64]
    return pa.table([pa.array(np.concatenate(c).astype(t) if c else np.empty(0, t)) for c, t in zip(out, kinds)],
                    names=["query_id", "query_key", "vec_id", "score"])


def nearest(df: DataFrame, every: int = 50, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For rows whose id is divisible by ``every``: the five nearest other rows by cosine that the search finds.

    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``. Rows without an id, and vectors that are null, empty, zero or
    hold null or non-finite components take no part. Only vectors of the same length have a cosine. A row with the
    query's id is never its neighbour; repeated other rows each count; ties go to the smaller id. Rows that repeat a
    query's id and vector ask once; rows that share only the id ask each, under the same ``query_id``. Other columns
    are not looked at; an empty table gives no rows.
    """
    rows = df.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    queries = rows.where(F.col("vec_id") % every == 0).withColumn("query_key", F.xxhash64("vector")).dropDuplicates(["vec_id", "query_key"])
    hits = in_tiles(rows, queries, search_tile, HIT, F.struct("vec_id", "vector"), F.col("vec_id"))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEIGHBOURS)
    return ranked.select("query_id", "rank", "vec_id", "score")
