"""The registered queries of the operators: name -> callable(spark, sf_dir), and DuckDB SQL where there is one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigiframe.llm import (
    op1_crf_lines,
    op2_raking,
    op3_unigram,
    op4_entropy_secrets,
    op5_html_blocks,
    op6_weak_labels,
    op7_dart_minhash,
    op8_semicrf_pii,
    op9_merkle,
    op10_pfor,
    op11_collision_ann,
    op12_strassen_negatives,
    op13_qdwh_whitening,
)
from vigiframe.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file: the folder in ``VIGIFRAME_TOKENIZERS``, else the installed package's."""
    folder = os.environ.get("VIGIFRAME_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_vocabulary() -> str:
    return tokenizer_file("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


@query("op1_crf_lines")
def crf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, line labels and verdict of every document; the field is fitted to the labelled documents."""
    docs = read_table(spark, sf_dir, "documents")
    return op1_crf_lines.rate_documents(docs, op1_crf_lines.train(docs, read_table(spark, sf_dir, "labels")))


@query("op2_raking")
def raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, calibrated weight, probability and draw of every document."""
    return op2_raking.calibrate(read_table(spark, sf_dir, "documents"))


@query("op3_unigram")
def unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and whether they decode to its text."""
    return op3_unigram.digest(read_table(spark, sf_dir, "documents"), piece_vocabulary())


@query("op4_entropy_secrets", op4_entropy_secrets.oracle_sql())
def entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return op4_entropy_secrets.scan(read_table(spark, sf_dir, "documents"))


@query("op5_html_blocks")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return op5_html_blocks.extract(read_table(spark, sf_dir, "pages"))


@query("op6_weak_labels")
def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior, score and verdict of every document."""
    return op6_weak_labels.classify(read_table(spark, sf_dir, "documents"))


@query("op7_dart_minhash")
def dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, with the class's rows and whether the document stays."""
    classes = op7_dart_minhash.near_duplicate_classes(read_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "is_lead")


@query("op8_semicrf_pii")
def semicrf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return op8_semicrf_pii.scan(docs, op8_semicrf_pii.fit(docs))


@query("op9_merkle")
def merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return op9_merkle.fingerprints(read_table(spark, sf_dir, "documents"))


@query("op10_pfor")
def pfor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to files and read back."""
    return op10_pfor.digest(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op11_collision_ann")
def collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return op11_collision_ann.nearest(read_table(spark, sf_dir, "embeddings"))


@query("op12_strassen_negatives", op12_strassen_negatives.oracle_sql())
def strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    return op12_strassen_negatives.mine(read_table(spark, sf_dir, "embeddings"))


@query("op13_qdwh_whitening")
def qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector."""
    return op13_qdwh_whitening.whiten(read_table(spark, sf_dir, "embeddings"))
