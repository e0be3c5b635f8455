import os

import corpus_pipeline
from vigiframe.llm import op2_raking, op3_unigram, op6_weak_labels
from vigiframe.llm.common import read_table
from vigiframe.llm.registry import piece_vocabulary

from .test_dedup_mix import plain_classes
from .test_spans_text import plain_secrets

SMALL = "/root/testdata/sf0.001"


def test_every_stage_against_its_plain_form(spark, tmp_path):
    docs = read_table(spark, SMALL, "documents")
    tables = {"": docs}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, SMALL).write.parquet(str(tmp_path / name))
        rows = tables[name] = spark.read.parquet(str(tmp_path / name))
        if name != "pieces":
            assert rows.columns == docs.columns
    took = {name: {r.doc_id: r for r in t.collect()} for name, t in tables.items()}

    verdicts = {r.doc_id for r in op6_weak_labels.classify(docs).where("kept").collect()}
    assert set(took["quality"]) == verdicts

    classes = plain_classes([(i, r.text) for i, r in took["quality"].items()])
    assert set(took["near_duplicates"]) == {i for i, c in classes.items() if i == c}

    assert set(took["secrets"]) == set(took["near_duplicates"])
    for i, r in took["near_duplicates"].items():
        text, at = "", 0
        for start, _, end in plain_secrets(r.text)[0]:
            if start >= at and (start > at or not text):
                text += r.text[at:start] + "<secret>"
            at = max(at, end)
        clean = took["secrets"][i]
        assert clean.text == text + r.text[at:] and clean.n_chars == (len(clean.text) if at else r.n_chars)

    drawn = {r.doc_id for r in op2_raking.calibrate(tables["secrets"]).where("kept").collect()}
    assert set(took["mixture"]) == drawn == set(took["pieces"])

    back = op3_unigram.decode(tables["pieces"], piece_vocabulary())
    assert {r.doc_id: r.decoded for r in back.collect()} == {i: r.text for i, r in took["mixture"].items()}


def test_run_returns_the_last_stage(spark, tmp_path, docs):
    os.makedirs(tmp_path / "d")
    docs.limit(40).write.parquet(str(tmp_path / "d" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "d"))
    assert {"doc_id", "lang", "source", "n_chars", "piece_ids", "n_pieces"} == set(got.columns) and got.count() > 5


def test_pipeline_on_odd_rows(spark, tmp_path, odd_docs, no_docs):
    for name, table in (("odd", odd_docs), ("none", no_docs)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name))
        assert "key" in got.columns and got.where("n_pieces is null").count() == 0
