"""Counts, min/max labels, distinct sets, last-wins, duplicates, blocks, top-N and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts_rollup(df: DataFrame, key: str, count_alias: str = "rows") -> DataFrame:
    """Rows per key and the grand total in one pass (``rollup``); the total row has
    ``nivel = 'total'``, part rows ``nivel = 'parte'``."""
    return (df.rollup(key).agg(F.count(F.lit(1)).alias(count_alias), F.grouping(key).alias("_g"))
              .select(F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.lit("parte")).alias("nivel"),
                      key, count_alias))


def version_label(df: DataFrame, col: str, alias: str = "versao") -> DataFrame:
    """'min-max' label of a version column (one global aggregate, partial per task)."""
    return df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")).select(
        F.col("_lo").alias(f"{col}_min"), F.col("_hi").alias(f"{col}_max"),
        F.concat_ws("-", F.col("_lo").cast("string"), F.col("_hi").cast("string")).alias(alias))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values (the sort is left to the consumer; order-free compare)."""
    return df.select(col).distinct()


def last_wins(df: DataFrame, key: str, value: str, order: str, alias: str | None = None) -> DataFrame:
    """Value of the last row per key in listing order (``max_by``; one partial aggregate).
    Rows tied on ``order`` are broken by the value itself, so a recomputed task
    (after an executor loss) picks the same winner."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(F.col(order), F.col(value))).alias(alias or value))


def duplicate_keys(df: DataFrame, keys: list[str], count_alias: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_alias)).filter(F.col(count_alias) > 1)


# Groups above this many rows are numbered by the distributed path of ``block_ids``.
HOT_GROUP_ROWS = 1_000_000


def block_ids(df: DataFrame, group: list[str], order: list[str], size: int, alias: str = "bloco",
              hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Fixed-size blocks of the rows of a group in ``order``: block = (rank - 1) div size.

    Ordinary groups: ``row_number`` over a window (one shuffle). Groups above
    ``hot_rows`` rows would put all their rows into one task, so they take a
    distributed path: range-partitioned on (group, order) so one hot group spans
    many tasks, sorted inside each task, positions from
    ``monotonically_increasing_id``, and each task's run of a group shifted by the
    rows of that group in earlier tasks (a small per-(task, group) table, broadcast).
    The positioned rows are checkpointed to the shared checkpoint folder, so the
    offsets and the numbering read the same rows even if executors are lost.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > hot_rows).select(*group)
    if hot.limit(1).count() == 0:          # common case: no hot group, one window
        return df.withColumn(alias, F.floor((F.row_number().over(w) - 1) / size).cast("int"))
    # Null-safe, so a hot null group is hot too. No hint: the list grows with the input, and adaptive execution
    # sends it to every task only where its measured size is small.
    in_hot = [F.col(f"d.{g}").eqNullSafe(F.col(f"h.{g}")) for g in group]
    normal = df.alias("d").join(hot.alias("h"), in_hot, "left_anti")
    normal = normal.withColumn(alias, F.floor((F.row_number().over(w) - 1) / size).cast("int"))

    from vigiframe.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    heavy = df.alias("d").join(hot.alias("h"), in_hot, "left_semi")
    ranged = (heavy.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    chunks = ranged.groupBy("_pid", *group).agg(F.min("_mid").alias("_start"), F.count(F.lit(1)).alias("_len"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_offset", F.coalesce(F.sum("_len").over(before), F.lit(0)))
    same = [F.col("r._pid") == F.col("c._pid"), *(F.col(f"r.{g}").eqNullSafe(F.col(f"c.{g}")) for g in group)]
    heavy = (ranged.alias("r").join(chunks.alias("c"), same)
             .select("r.*", "c._start", "c._offset")
             .withColumn(alias, F.floor((F.col("_mid") - F.col("_start") + F.col("_offset")) / size).cast("int"))
             .drop("_mid", "_pid", "_start", "_offset"))
    return normal.unionByName(heavy)


def top_n_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` largest distinct values (a top-k report: the limit is the feature)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return df.select(col).distinct().orderBy(F.col(col).desc()).limit(n)


def latest(df: DataFrame, value: str, version: str, group: list[str] | None = None) -> DataFrame:
    """Row value holding the highest version (``max_by``; ties broken by the value)."""
    aggs = [F.max_by(value, F.struct(F.col(version), F.col(value))).alias(value), F.max(version).alias(version)]
    return df.groupBy(*(group or [])).agg(*aggs)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def except_distinct(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required minus present (set semantics, like Python sets)."""
    return required.subtract(present)
