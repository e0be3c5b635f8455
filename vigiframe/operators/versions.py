"""Version gates, retention and catalogue of source versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_versions(available: DataFrame, published: DataFrame, version: str) -> DataFrame:
    """Available versions above the published high-water mark (all when nothing is
    published). The mark is a one-row scalar subquery, so the gate is one filter."""
    mark = published.agg(F.max(version).alias("_mark")).scalar()
    # Nothing published -> the comparison is null -> keep everything.
    return available.filter(F.coalesce(F.col(version) > mark, F.lit(True)))


def retain_latest(df: DataFrame, version: str, n: int, versions: DataFrame | None = None) -> DataFrame:
    """Rows of the ``n`` most recent versions (rolling retention).

    The cut-off is the n-th largest distinct version, found by a small
    aggregate over distinct versions, then applied as a plain filter, so the big
    table is never sorted or windowed as a whole. ``versions`` (one column named
    ``version``, e.g. a file catalogue) avoids deriving the version list from
    ``df`` itself when ``df`` is expensive to compute.
    """
    if n < 1:
        raise ValueError("n must be >= 1 (0 would mean 'all versions')")
    source = versions if versions is not None else df
    top = source.select(version).distinct().orderBy(F.col(version).desc()).limit(n)
    cutoff = top.agg(F.min(version).alias("_cut")).scalar()
    return df.filter(F.col(version) >= cutoff)


def retain_latest_years(df: DataFrame, date: str, n: int, among: DataFrame | None = None) -> DataFrame:
    """Rows of the ``n`` most recent years of a date column (of ``among``'s years, if given).

    The cut is the first day of the n-th latest year, in the column's own type, compared with the raw column: the
    scan gets it as a pushed filter and skips row groups of older years.
    """
    if n < 1:
        raise ValueError("n must be >= 1 (0 would mean 'all years')")
    years = (df if among is None else among).select(F.year(date).alias("_year")).distinct().orderBy(F.col("_year").desc()).limit(n)
    first_day = F.make_date(F.min("_year"), F.lit(1), F.lit(1)).cast(df.schema[date].dataType)
    return df.filter(F.col(date) >= years.agg(first_day.alias("_cut")).scalar())
