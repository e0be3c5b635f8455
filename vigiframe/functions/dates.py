"""Date functions: epidemiological weeks, date parts, Brazilian date text, date spine.

The epidemiological week runs Sunday to Saturday; week 1 of a year is the
week that holds January 4th. The week's Wednesday therefore always lies in
the epidemiological year, which gives a closed form with no lookups:

    wednesday = d + (4 - dayofweek(d))        # Spark: Sunday = 1
    ano_epi   = year(wednesday)
    semana    = (dayofyear(wednesday) - 1) div 7 + 1
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: text pattern of the Brazilian day/month/year date.
BR_DATE_PATTERN = "d/M/yyyy"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epi_year_start(year) -> Column:
    """Sunday that opens epidemiological week 1 of ``year`` (Sunday on or before Jan 4)."""
    jan4 = F.make_date(_c(year).cast("int"), F.lit(1), F.lit(4))
    return F.date_sub(jan4, F.dayofweek(jan4) - 1)


def _wednesday(d) -> Column:
    d = _c(d).cast("date")
    return F.date_add(d, F.lit(4) - F.dayofweek(d))


def epi_year(d) -> Column:
    return F.year(_wednesday(d)).cast("long")


def epi_week(d) -> Column:
    return (F.floor((F.dayofyear(_wednesday(d)) - 1) / 7) + 1).cast("long")


def epi_week_label(ano_epi, semana_epi) -> Column:
    """'YYYYWW' text label."""
    return F.format_string("%d%02d", _c(ano_epi).cast("long"), _c(semana_epi).cast("long"))


def epi_week_number(ano_epi, semana_epi) -> Column:
    """YYYY*100 + WW as a number."""
    return (_c(ano_epi).cast("long") * 100 + _c(semana_epi).cast("long")).cast("long")


def parse_br_date(x) -> Column:
    """'dd/mm/yyyy' text -> date; blank, impossible or other-format text -> null."""
    s = F.nullif(_c(x).cast("string"), F.lit(""))
    return F.try_to_timestamp(s, F.lit(BR_DATE_PATTERN)).cast("date")


def calendar_columns(d) -> list[Column]:
    """The published calendar row for a date column ``d``."""
    d = _c(d).cast("date")
    ano_epi, semana = epi_year(d), epi_week(d)
    return [
        d.alias("data"),
        F.year(d).cast("long").alias("ano"),
        F.month(d).cast("long").alias("mes"),
        F.dayofmonth(d).cast("long").alias("dia"),
        ano_epi.alias("ano_epi"),
        semana.alias("semana_epi"),
        epi_week_label(ano_epi, semana).alias("ano_semana_epi"),
        epi_week_number(ano_epi, semana).alias("ano_semana_epi_num"),
    ]


def date_spine(spark: SparkSession, start_year: int, end_year: int,
               num_partitions: int | None = None) -> DataFrame:
    """One row per day from Jan 1 of ``start_year`` to Dec 31 of ``end_year``.

    Built on ``spark.range`` so the days are spread over partitions instead of
    exploding one array inside a single task.
    """
    if end_year < start_year:
        raise ValueError("end_year must be >= start_year")
    n_days = (_dt.date(end_year, 12, 31) - _dt.date(start_year, 1, 1)).days + 1
    ids = spark.range(0, n_days, 1, num_partitions) if num_partitions else spark.range(0, n_days)
    return ids.select(F.date_add(F.make_date(F.lit(start_year), F.lit(1), F.lit(1)),
                                 F.col("id").cast("int")).alias("data"))


def date_spine_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Days spanning the years of a one-row ``bounds`` frame (columns ``lo``, ``hi`` dates).

    Used when the range comes from data: Jan 1 of year(lo) .. Dec 31 of year(hi).
    The bounds row is one row; the days are generated with ``sequence`` per year so
    each generated array is at most 366 long and years spread over tasks.
    """
    years = bounds.select(F.explode(F.sequence(F.year(lo), F.year(hi))).alias("y"))
    years = years.repartition("y")
    return years.select(F.explode(F.sequence(F.make_date("y", F.lit(1), F.lit(1)),
                                             F.make_date("y", F.lit(12), F.lit(31)))).alias("data"))
