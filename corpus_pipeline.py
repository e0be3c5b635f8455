"""Corpus pipeline over ``documents``: quality, near duplicates, secrets, mixture, pieces.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each stage's rows to the shared
checkpoint folder and reads them again as the next stage's documents. Null texts: the classifier keeps or rejects
them by its prior, near-dedup and the secret scan pass them on, and the mixture never draws a document without a
token. Repeated rows count as copies of each other. Extra columns stay up to the last stage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from vigiframe.llm import op2_raking, op3_unigram, op4_entropy_secrets, op6_weak_labels, op7_dart_minhash
from vigiframe.llm.common import staged
from vigiframe.llm.registry import piece_vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return op6_weak_labels.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return op7_dart_minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets replaced by a mark, and ``n_chars`` counted anew where one was."""
    return op4_entropy_secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the probabilities that rake sources, languages and topics to their targets."""
    return op2_raking.sample(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' piece ids in place of their texts, and how many there are."""
    return op3_unigram.encode_documents(docs, piece_vocabulary())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("pieces", pieces)]

# Expectation-maximisation, components and raking have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    rows = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for _, stage in STAGES[:-1]:
        rows = staged(stage(spark, rows, sf_dir))
    return STAGES[-1][1](spark, rows, sf_dir)
