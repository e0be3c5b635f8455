"""Incremental publication of landed source files with Structured Streaming.

The reference refreshes on a schedule and skips sources it has already
published (version gates). Here a file-source stream with
``Trigger.AvailableNow`` does the same: each run processes only files not yet
seen (Spark's source log in the checkpoint), then stops; the built-in file sink
commits each batch exactly once, so a run that dies mid-way is simply re-run.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigiframe.functions.scalars import state_bucket
from vigiframe.plans.pipelines import establishments


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    """The stream's own folder, the same in every application: given, or under ``spark.checkpoint.dir`` as configured.

    The session's checkpoint folder itself is new in every application and would lose what was read before.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not checkpoint and not base:
        raise ValueError("give the stream's checkpoint folder, or set spark.checkpoint.dir")
    return checkpoint or os.path.join(base, "streams", name)


def landed_csv(spark: SparkSession, source_dir: str, sample_file: str, sep: str = ";",
               encoding: str = "ISO-8859-1") -> DataFrame:
    """Streaming read of delimited files landing in ``source_dir``; every column text.
    The header of ``sample_file`` gives the column names (streams need a schema)."""
    header = spark.read.option("sep", sep).option("header", True).option("encoding", encoding) \
        .csv(sample_file).columns
    schema = ", ".join(f"`{c}` string" for c in header)
    return (spark.readStream.schema(schema).option("sep", sep).option("header", True)
            .option("quote", '"').option("escape", '"').option("encoding", encoding)
            .csv(source_dir))


def publish_establishments_stream(spark: SparkSession, source_dir: str, sample_file: str, target: str,
                                  state_column: str = "co_estado_gestor",
                                  checkpoint: str | None = None) -> StreamingQuery:
    """Establishment files -> repaired, typed rows appended to the state-partitioned table."""
    raw = landed_csv(spark, source_dir, sample_file).na.fill("")
    rows = establishments(raw).withColumn("particao", state_bucket(state_column))
    return (rows.writeStream.format("parquet").partitionBy("particao")
            .option("path", target).option("checkpointLocation", _checkpoint(spark, "establishments", checkpoint))
            .trigger(availableNow=True).start())


def weekly_counts_stream(spark: SparkSession, events: DataFrame, ts: str = "ts",
                         watermark: str = "14 days") -> DataFrame:
    """Streaming weekly case counts by epidemiological week (Sunday-start weeks).

    ``window(ts, '7 days', startTime='3 days')`` aligns windows on Sundays (the Unix
    epoch is a Thursday); the watermark bounds the state kept for late events."""
    w = F.window(F.col(ts), "7 days", startTime="3 days")
    return (events.withWatermark(ts, watermark).groupBy(w.alias("semana"))
            .agg(F.count(F.lit(1)).alias("casos"))
            .select(F.col("semana.start").cast("date").alias("inicio"), "casos"))
