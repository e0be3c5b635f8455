"""Data-quality checks. Each returns rows ``(check, failures)``; all row checks of
one table are computed in a single aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def column_checks(spark: SparkSession, df: DataFrame, expected: list[str]) -> DataFrame:
    """Schema checks (exact column list, lowercase names, missing names; decided on
    the schema) plus the not-empty check (one count over the data), as
    ``(check, failures)`` rows from a single aggregate."""
    cols = list(df.columns)
    missing = sorted(set(expected) - set(cols))
    fixed = [("exact_columns", 0 if cols == expected else 1),
             ("lowercase_names", sum(1 for c in cols if c != c.lower())),
             ("missing_columns", len(missing))]
    pairs = [F.struct(F.lit(n).alias("check"), F.lit(v).cast("long").alias("failures")) for n, v in fixed]
    pairs.append(F.struct(F.lit("not_empty").alias("check"),
                          F.when(F.col("_n") > 0, 0).otherwise(1).cast("long").alias("failures")))
    return df.agg(F.count(F.lit(1)).alias("_n")).select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass: ``failures = count_if(not ok)`` for each named row predicate, plus row count.
    Output is one row per check (stacked from the single aggregate row)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"_c{i}") for i, ok in enumerate(checks.values())]
    one = df.agg(*aggs)
    pairs = [F.struct(F.lit("not_empty").alias("check"),
                      F.when(F.col("_rows") > 0, 0).otherwise(1).cast("long").alias("failures"))]
    pairs += [F.struct(F.lit(name).alias("check"), F.col(f"_c{i}").cast("long").alias("failures"))
              for i, name in enumerate(checks)]
    return one.select(F.explode(F.array(*pairs)).alias("r")).select("r.check", "r.failures")


def row_bounds(df: DataFrame, exact: int | None = None, minimum: int | None = None) -> DataFrame:
    n = F.count(F.lit(1))
    ok = F.lit(True)
    if exact is not None:
        ok = ok & (n == exact)
    if minimum is not None:
        ok = ok & (n >= minimum)
    return df.agg(n.alias("rows"), ok.alias("ok"))


def unique_key_failures(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key values held by more than one row (partial aggregation, one shuffle)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return dup.agg(F.count(F.lit(1)).alias("duplicated_keys"),
                   F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_in_duplicates"))


def exactly_one(df: DataFrame, group: list[str], member_ok: Column) -> DataFrame:
    """Groups that do not have exactly one matching member."""
    return (df.groupBy(*group).agg(F.count_if(member_ok).alias("matches"))
              .filter(F.col("matches") != 1))


def rows_match(declared: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Declared rows per part (manifest) against counted rows per part."""
    j = declared.join(actual, key, "full_outer")
    return j.withColumn("ok", F.coalesce(F.col("declared_rows") == F.col("actual_rows"), F.lit(False)))
