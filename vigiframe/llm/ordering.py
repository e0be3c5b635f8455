"""Global order by an id and then by a text's hash, in ranges of rows, without a global sort in one task."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = -(1 << 63)


def range_count(spark: SparkSession) -> int:
    """Ranges to cut into: the session's shuffle partitions, which are set by the input's size, so that a range is
    about a task's share of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_order(text: str = "text") -> Column:
    """The number that orders rows of one id: a hash of the text, over the whole range of a bigint."""
    return F.xxhash64(text)


def range_starts(df: DataFrame, column: str, parts: int) -> list[tuple[int | None, int]]:
    """Ascending starts ``(id, hash)`` of ranges of ``(column, text_order())`` with about as many rows each.

    Quantiles of the ids cut the ranges; an id (or null, which comes first) that holds several quantiles is cut further
    by the hash into as many parts, so a frequent id spreads over ranges unless its texts are equal too: equal rows
    share a range. The driver gets one number per range; an empty table has no starts.
    """
    found = df.agg(F.percentile_approx(column, [(i + 0.5) / parts for i in range(parts)], 10 * max(parts, 100)).alias("q"), F.min(column).alias("least"),
                   F.count(F.lit(1)).alias("rows"), F.count(column).alias("known")).first()
    wanted: Counter = Counter(found["q"] or [])
    if found["least"] is not None:
        wanted[found["least"]] = max(1, wanted[found["least"]])
    missing = found["rows"] - found["known"]
    nulls = -(-parts * missing // found["rows"]) if missing else 0
    cuts = lambda n: [LEAST + k * ((1 << 64) // n) for k in range(n)]
    return [(None, c) for c in cuts(nulls)] * (nulls > 0) + [(i, c) for i in sorted(wanted) for c in cuts(wanted[i])]


def _last_start(count: int, reached) -> Column:
    """The last of ``count`` ascending starts that is ``reached``: a binary search over places (0 if none is)."""
    steps = [1 << k for k in range(count.bit_length())][::-1]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when((at + step < count) & reached(at + step), at + step).otherwise(at))


def range_number(column: Column, order: Column, starts: list[tuple[int | None, int]]) -> Column:
    """Place of the range that holds the row; ``order`` is ``text_order()``. The starts go into the plan as one literal."""
    def table(numbers: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")

    nulls = [c for i, c in starts if i is None]
    rest = [(i, c) for i, c in starts if i is not None]
    ids, cuts, null_cuts = table([i for i, _ in rest]), table([c for _, c in rest]), table(nulls)
    known = _last_start(len(rest), lambda p: (F.get(ids, p) < column) | ((F.get(ids, p) == column) & (F.get(cuts, p) <= order)))
    return F.when(column.isNull(), _last_start(len(nulls), lambda p: F.get(null_cuts, p) <= order)).otherwise(known + len(nulls))
