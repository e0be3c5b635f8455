"""Dimension lookups, semi/anti tests and completeness grids.

Dimensions (codes, calendar, regions) are small and bounded; they are
broadcast only behind ``sized_broadcast``'s check of bytes, otherwise Spark keeps
a shuffle join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigiframe.operators.sizing import sized_broadcast, staged


def strict_lookup(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str,
                  what: str = "code") -> DataFrame:
    """Left join to a code dimension; a non-null code missing from it fails the job.

    The check is fused into the join's projection (``raise_error``), so it costs
    no extra pass over the data. It sits in the key and in every column taken from
    the dimension: reading any of them runs it, and pruning can't remove it.
    """
    d = sized_broadcast(dim.withColumnRenamed(dim_key, "_dim_key").withColumn("_hit", F.lit(True)))
    j = df.join(d, F.col(left_key) == F.col("_dim_key"), "left")
    unknown = F.col(left_key).isNotNull() & F.col("_hit").isNull()
    fail = F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.col(left_key).cast("string")))
    guarded = {left_key, *(c for c in dim.columns if c != dim_key)}
    # The test is one column, which each guarded column reads: a row is tested once.
    j = j.withColumn("_known", F.when(unknown, fail.cast("boolean")).otherwise(F.lit(True)))
    return j.select(*[F.when(F.col("_known"), F.col(f"`{c}`")).alias(c) if c in guarded else F.col(f"`{c}`")
                      for c in j.columns if c not in ("_dim_key", "_hit", "_known")])


def unknown_codes(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str) -> DataFrame:
    """Distinct codes of ``df`` absent from the dimension (report form of the strict check).
    Distinct first (partial aggregation), then a broadcast anti join."""
    codes = df.select(left_key).distinct()
    return codes.join(sized_broadcast(dim.select(F.col(dim_key).alias(left_key)).distinct()), left_key, "left_anti")


def prefix_lookup(df: DataFrame, code: str, dim: DataFrame, dim_key: str, n: int = 3) -> DataFrame:
    """Classify a code by its first ``n`` characters against a dimension."""
    return df.join(sized_broadcast(dim), F.substring(F.col(code), 1, n) == F.col(dim_key), "left")


def nodot_lookup(df: DataFrame, code: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Classify a code written with a dot ('A00.1') against undotted keys ('A001')."""
    return df.join(sized_broadcast(dim), F.translate(F.col(code), ".", "") == F.col(dim_key), "left")


def semi_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``. The key side is de-duplicated first
    (map-side partial aggregation), so a key repeated in many rows is shipped once
    per task instead of once per row."""
    return df.join(keys.distinct(), on, "left_semi")


# Buckets that the values of a dimension are numbered in, side by side.
NUMBER_BUCKETS = 256
WORD_BITS = 64
# Most elements of an array that is laid out in one row.
RUN = 4096


def value_numbers(df: DataFrame, dims: list[str]) -> DataFrame:
    """The distinct values of each column (null is one), numbered 0, 1, ... in ``_no``: ``_dim`` is the column's place
    in ``dims``, ``_v`` a struct of all columns in which only that one is set.

    Values are dealt into buckets by a hash and numbered there; a bucket starts where the ones before it end. Only the
    buckets' counts, ``NUMBER_BUCKETS`` rows a column, are put in one order.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    alone = [F.struct(F.lit(i).alias("_dim"), F.struct(*[(F.col(f"`{c}`") if c == d else F.lit(None).cast(kinds[c])).alias(c) for c in dims]).alias("_v"))
             for i, d in enumerate(dims)]
    values = df.select(F.explode(F.array(*alone)).alias("_r")).select("_r.*").distinct()
    values = values.withColumn("_bucket", F.pmod(F.xxhash64("_v"), F.lit(NUMBER_BUCKETS)))
    starts = values.groupBy("_dim", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_dim").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_dim", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_dim", "_bucket").orderBy("_v")) - 1
    return values.withColumn("_place", place).join(starts, ["_dim", "_bucket"]).select("_dim", "_v", (F.col("_place") + F.col("_start")).cast("long").alias("_no"))


def _div(a: Column, b: int) -> Column:
    """Whole quotient of numbers that are not negative; a division of doubles would round beyond 2^53."""
    return F.call_function("div", a, F.lit(b).cast("long"))


def _lay_out(n: Column) -> list[Column]:
    """0 .. n-1 as two nested explodes' arrays, so that no row holds more than about sqrt(n) or ``RUN`` elements."""
    return [F.sequence(F.lit(0).cast("long"), _div(n - 1, RUN)),
            F.sequence(F.col("_run") * RUN, F.least(F.col("_run") * RUN + RUN - 1, n - 1))]


def missing_cells(df: DataFrame, entity: str, dims: list[str]) -> DataFrame:
    """Cells of the grid entity x dim1 x dim2 ... that have no row in ``df``; null is a value like any other.

    The values of each dimension are numbered, which numbers the cells of the grid; an entity's cells become bits of
    64-bit words (``bit_or`` in the aggregation). Entities whose bits are all set drop out, and of the others only the
    words with a gap, and of these only the bits that are not set, become rows, which get their values back from the
    numbers. So the work follows the rows there are and the gaps, plus one word per 64 cells of an incomplete entity;
    nothing is gathered per dimension or per entity.
    """
    # Written once, as it is read often; the planner broadcasts it where the file is small.
    numbered = staged(value_numbers(df, dims))
    counts = {r["_dim"]: r["n"] for r in numbered.groupBy("_dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [counts.get(i, 0) for i in range(len(dims))]

    def numbers(i: int) -> DataFrame:
        return numbered.where(F.col("_dim") == i).select(F.struct(F.col(f"_v.`{dims[i]}`").alias(dims[i])).alias(f"_v{i}"), F.col("_no").alias(f"_n{i}"))

    total = math.prod(sizes)
    if total >= 1 << 62:
        raise ValueError(f"a grid of {total} cells an entity can't be numbered")
    cells, words = F.lit(total).cast("long"), F.lit(-(-total // WORD_BITS)).cast("long")

    # Not made distinct: setting a bit twice is setting it once, and the aggregation combines before its shuffle.
    have = df.select(F.struct(F.col(f"`{entity}`").alias(entity)).alias("_e"),
                     *[F.struct(F.col(f"`{d}`").alias(d)).alias(f"_v{i}") for i, d in enumerate(dims)])
    cell = F.lit(0).cast("long")
    for i, d in enumerate(dims):
        have = have.join(numbers(i), f"_v{i}")
        cell = cell * F.lit(sizes[i]).cast("long") + F.col(f"_n{i}")
    bits = (have.withColumn("_cell", cell)
            .groupBy("_e", _div(F.col("_cell"), WORD_BITS).alias("_word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_cell") % WORD_BITS).cast("int"))).alias("_bits")))
    open_entities = bits.groupBy("_e").agg(F.sum(F.bit_count("_bits")).alias("_set")).where(F.col("_set") < cells).select("_e")
    runs, in_run = _lay_out(words)
    wanted = open_entities.withColumn("_run", F.explode(runs)).withColumn("_word", F.explode(in_run)).drop("_run")
    full = F.lit(-1).cast("long")
    rest = (cells - F.col("_word") * WORD_BITS).cast("int")
    mask = F.when(rest >= WORD_BITS, full).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), rest) - 1)
    gaps = wanted.join(bits, ["_e", "_word"], "left").withColumn("_gap", F.coalesce(F.bitwise_not("_bits"), full).bitwiseAND(mask)).where("_gap <> 0")
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda b: F.getbit("_gap", b) == 1))
    out = gaps.select("_e", "_word", bit.alias("_bit")).select("_e", (F.col("_word") * WORD_BITS + F.col("_bit")).alias("_cell"))
    for i in reversed(range(len(dims))):
        out = out.withColumn(f"_n{i}", F.col("_cell") % sizes[i]).withColumn("_cell", _div(F.col("_cell"), sizes[i]))
    for i, d in enumerate(dims):
        out = out.join(numbers(i), f"_n{i}")
    return out.select(F.col(f"_e.`{entity}`").alias(entity), *[F.col(f"_v{i}.`{d}`").alias(d) for i, d in enumerate(dims)])


def chain(df: DataFrame, *steps: tuple[DataFrame, Column | str | list]) -> DataFrame:
    """Chained left lookups (e.g. municipality -> state -> region), each dimension
    broadcast behind its size check."""
    out = df
    for dim, on in steps:
        out = out.join(sized_broadcast(dim), on, "left")
    return out
