import itertools
import re
from collections import Counter

import duckdb
import numpy as np

from vigiframe.llm import op1_crf_lines as crf
from vigiframe.llm import op6_weak_labels as weak
from vigiframe.llm.common import read_table

SF_ORACLE = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(t):
    words = WORD.findall(t)
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked)


def test_base_counts(docs):
    for t in [r.text for r in docs.collect()] + ["", "a b c a b c", "x\x0by\x85z\xa0w \x1c", "a a a a", "é# é#\né# é#\n\n"]:
        assert crf.base_counts(t) == plain_counts(t)


def test_viterbi_is_the_best_of_all_sequences():
    rng = np.random.default_rng(1)
    for n in range(1, 9):
        e, t = rng.normal(size=n), rng.normal(size=(2, 2))
        score = lambda ys: sum(e[i] for i, y in enumerate(ys) if y) + sum(t[a, b] for a, b in zip(ys, ys[1:]))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert crf.viterbi(e, t) == list(best)


def test_gradient_fit_separates_lines():
    x = np.zeros((4, len(crf.FEATURES)))
    x[:, 0] = 1
    x[2:, crf.FEATURES.index("many_symbols")] = 1
    w, trans = crf.fit([(x, np.array([1, 1, 0, 0]))] * 5)
    assert crf.viterbi(x @ w, trans) == [1, 1, 0, 0]


def test_long_notices_are_found_by_their_share_of_cues():
    at = crf.FEATURES.index("notice")
    notice = lambda line: crf.line_features(line, line.split(), False, True, True)[at]
    real = "the day was long and they went to the house by the river with all of them " * 10
    licence = "This work is licensed under a Creative Commons licence, all rights reserved by the owner of the copyright in the pages of it. " * 3
    assert len(licence.split()) > 40 and notice(licence) == 1.0 and notice(real) == 0.0
    assert notice("we use cookies here") == 1.0 and 0 < notice(real + "and ate a cookie") < 0.3
    x = crf.chain(licence + "\n" + real + "and ate a cookie")[0]
    assert crf.line_labels(1, x).tolist() == [0, 1]


def test_a_repeated_id_does_not_push_out_others(spark, monkeypatch):
    rows = [(0, f"the day was long {i % 3}") for i in range(90)] + [(i, "# | # | #" if i % 2 else "it was for you and me") for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(9)], "doc_id bigint, quality bigint, toxic bigint")
    seen = []
    monkeypatch.setattr(crf, "fit", lambda chains: seen.extend(chains))
    crf.train(docs, labels, sample_docs=20)
    assert [int(y[0]) for _, y in seen] == [1 - i % 2 for i in range(9)]


def held_out(key, kept):
    p = f"{SF_ORACLE}/labels.parquet"
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{p}'").fetchall())
    pairs = [(quality[i], k) for i, k in zip(key, kept, strict=True) if i in quality]
    clean = [k for q, k in pairs if q == 1]
    junk = [k for q, k in pairs if q == 0]
    return sum(clean) / len(clean), sum(junk) / len(junk)


def test_verdicts_on_labelled_documents(spark):
    docs = read_table(spark, SF_ORACLE, "documents")
    got = crf.rate_documents(docs, crf.train(docs, read_table(spark, SF_ORACLE, "labels"), sample_docs=150)).where("not base_failed").toPandas()
    clean, junk = held_out(got.doc_id, got.kept)
    assert clean > 0.99 and junk < 0.2
    got = weak.classify(docs).toPandas()
    clean, junk = held_out(got.doc_id, got.kept)
    assert clean > 0.99 and junk < 0.05


def test_em_recovers_accuracies():
    rng = np.random.default_rng(2)
    k = len(weak.LABELLERS)
    good = rng.random(4000) < 0.8
    votes = np.where(rng.random((4000, k)) < np.where(good[:, None], 0.98, 0.5), 2, 1)
    numbers, counts = np.unique([weak.pattern_number(v) for v in votes.tolist()], return_counts=True)
    prior, table = weak.fit_accuracies(numbers, counts)
    assert abs(prior - good.mean()) < 0.03 and np.allclose(table[1, :, 2], 0.98, atol=0.02) and np.allclose(table[0, :, 1], 0.5, atol=0.08)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1, 0), (None, None, None)], "doc_id bigint, quality bigint, toxic bigint")
    field = crf.train(odd_docs, labels)
    assert crf.rate_documents(odd_docs, field).count() == odd_docs.count() and crf.rate_documents(no_docs, field).count() == 0
    assert crf.train(no_docs, labels.limit(0))[0].shape == (len(crf.FEATURES),)
    assert crf.label_lines(None, field) == []
    kept = weak.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("text is null or length(text) < 50").count() == odd_docs.where("text is null or length(text) < 50").count()
    assert weak.keep_good(no_docs).count() == 0 and weak.classify(no_docs).count() == 0


def test_copies_do_not_fill_the_classifiers_sample(spark, monkeypatch):
    """A third of the rows are one text, under many ids: it is drawn once, and every other text has its chance."""
    seen = []
    real = weak.fit_scorer
    monkeypatch.setattr(weak, "SAMPLE_ROWS", 60)
    monkeypatch.setattr(weak, "fit_scorer", lambda x, y, prior: seen.append(x) or real(x, y, prior))
    good = "The {} of the day and it was for all of them to read in the house with number {} of the others, as they said. "
    rows = [(i, good.format("hot", 1) * 3) for i in range(200)] + [(1000 + i, good.format(f"cold{i}", i) * 3) for i in range(400)]
    rows += [(5000 + i, f"buy {i} now !!! $$$ ### " * 30) for i in range(20)]
    weak.fit(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert 30 <= len(seen[0]) <= 60 and len(np.unique(seen[0], axis=0)) == len(seen[0])
