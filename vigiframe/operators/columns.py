"""Column-name repair, projection, typing by name and row filters.

Name operations work on ``df.columns`` (plan metadata, no job); value work is
a single projection Catalyst can push through and prune.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiframe.functions.dates import parse_br_date

# Generated header form repaired to the bare column name, and the
# prefix that marks date columns.
TO_CHAR_HEADER = re.compile(r"TO_CHAR\((?P<column>[^,]+),'DD/MM/YYYY'\)", re.IGNORECASE)
DATE_PREFIX = "dt_"
# Names a CSV reader gives to a header cell that was blank.
_BLANK_NAME = re.compile(r"^(_c\d+|Unnamed: \d+)$")


def normalize_names(df: DataFrame) -> DataFrame:
    """Strip and lowercase every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def repair_header_name(name: str) -> str:
    m = TO_CHAR_HEADER.fullmatch(name)
    return m.group("column").strip() if m else name


def repair_headers(df: DataFrame) -> DataFrame:
    """``TO_CHAR(COL,'DD/MM/YYYY')`` -> ``COL`` (case-insensitive, whole name only)."""
    return df.toDF(*[repair_header_name(c) for c in df.columns])


def drop_blank_names(df: DataFrame) -> DataFrame:
    """Drop columns whose header was blank (also Spark's ``_cN`` / pandas' ``Unnamed: N``)."""
    keep = [c for c in df.columns if c.strip() != "" and not _BLANK_NAME.match(c.strip())]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def type_by_prefix(df: DataFrame, prefix: str = DATE_PREFIX) -> DataFrame:
    """Columns named ``dt_*`` become dates parsed from dd/mm/yyyy text (bad -> null);
    all other columns are text."""
    return df.select(*[
        (parse_br_date(F.col(f"`{c}`")) if c.startswith(prefix) else F.col(f"`{c}`").cast("string")).alias(c)
        for c in df.columns])


def regex_filter(df: DataFrame, col: str, pattern: str, case_insensitive: bool = True) -> DataFrame:
    """Whole-value regex match (``re.match`` with ``$``), optionally case-insensitive."""
    flags = "(?i)" if case_insensitive else ""
    return df.filter(F.col(col).rlike(f"{flags}^(?:{pattern})$"))


def in_text_list(col: str | Column, text_list: str, pad: int) -> Column:
    """Membership in a comma list given as text ('1, 3,,07') with zero-padding."""
    from vigiframe.functions.scalars import split_list, zfill
    c = F.col(col) if isinstance(col, str) else col
    return F.array_contains(split_list(F.lit(text_list), pad), zfill(c, pad))


def not_deleted(flag: str | Column) -> Column:
    c = F.col(flag) if isinstance(flag, str) else flag
    return F.coalesce(c, F.lit(" ")) != "*"
