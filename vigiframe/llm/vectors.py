"""Vector rows for the operators on embeddings: which rows take part, Arrow lists as matrices, grids of tiles."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one tile's candidate side, and pairs of rows that one tile compares at most on average. A tile's two sides
# are in memory at once; with 64 dimensions and 64 projections that is about 30 MB.
SHARD_ROWS = 16_384
TILE_PAIRS = 1 << 31


def finite(vector: Column) -> Column:
    """Whether the vector is there and every component is there and finite (true for an empty one)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrices(column: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) for each length of vector among the rows, longest last."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(lists) == 0:
        return []
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    out = []
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out.append((rows, values[offsets[rows][:, None] + np.arange(n)[None, :]]))
    return out


def first_by_score(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by falling score, ties by rising id; ties at the cut are all looked at."""
    if len(score) > 4 * k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= floor)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))[:k]]


def in_tiles(rows: DataFrame, queries: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str, row_key: Column,
             query_key: Column) -> DataFrame:
    """``fn(rows of a shard, queries of a block)`` for every pair of a shard and a block, side by side in tasks.

    The grid is laid out from the two row counts: shards of about ``SHARD_ROWS`` rows (by a hash, so a hot value is
    spread), and as many blocks of queries as keep a tile under ``TILE_PAIRS`` pairs and the cluster busy. What ``fn``
    gets of the shard does not depend on the number of blocks, so neither do its answers. Queries are copied once per
    shard, rows once per block, and nothing is broadcast.
    """
    spark = rows.sparkSession
    n, q = rows.count(), queries.count()
    shards = max(1, math.ceil(n / SHARD_ROWS))
    tiles = max(2 * spark.sparkContext.defaultParallelism, math.ceil(n * q / TILE_PAIRS))
    blocks = max(1, min(math.ceil(tiles / shards), max(1, q)))
    cut = rows.withColumn("_shard", F.pmod(F.xxhash64(row_key), F.lit(shards)))
    left = cut.withColumn("_tile", F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b * shards + F.col("_shard")))).drop("_shard")
    block = queries.withColumn("_block", F.pmod(F.xxhash64(query_key, F.lit(1)), F.lit(blocks)))
    right = block.withColumn("_tile", F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.col("_block") * shards + s))).drop("_block")
    # Queries may stem from the rows: new names for their columns keep the two sides apart.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    # A fixed number of parts on both sides: the grouping reuses it, and tiles are not packed into fewer tasks. Few tiles
    # get more parts than there are tiles, so that their hashes seldom meet in one.
    parts = max(shards * blocks, 16 * spark.sparkContext.defaultParallelism)
    left, right = left.repartition(parts, "_tile"), right.repartition(parts, "_tile")
    return left.groupBy("_tile").cogroup(right.groupBy("_tile")).applyInArrow(fn, schema)
