"""Helpers shared by the operators: tables, staging, Arrow batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigiframe.session import ensure_checkpoint_dir

# Rows of one Arrow batch sent to Python. Texts can be long, so batches are kept small in rows; the operators
# cut them further by characters where they build arrays per character.
BATCH_ROWS = 256
ASCII_SPACE = "\x20\x09-\x0d"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage and survives lost executors: the folder is the one the session names in
    ``spark.checkpoint.dir`` (a scratch folder only where that is unset, as in tests).
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_ROWS`` rows."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def by_characters(texts: list[str], most: int = 1 << 20) -> Iterator[slice]:
    """Cut a list of texts into runs of about ``most`` characters (a longer text is a run of its own)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def safe_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed by position, so that helper columns can't clash, and old name -> new name."""
    names = {c: f"in{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def text_key(text: str = "text"):
    """Content key of a text: the first 16 bytes of its SHA-256 (null for null)."""
    return F.unhex(F.substring(F.sha2(F.col(text).cast("binary"), 256), 1, 32))


def id_hash(seed: int, *cols):
    """Uniform number in [0, 1) fixed by the given columns and the seed (53 bits, exact as a double)."""
    h = F.xxhash64(F.lit(seed).cast("bigint"), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))
