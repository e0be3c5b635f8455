"""The semi-Markov field: sums over the lattice, the gradient, the sample, and what it adds to the patterns."""

import itertools
import math
import time

import numpy as np
import pytest

from vigiframe.llm import op8_semicrf_pii as pii


def segmentations(n):
    """All ways to cut chunks 0..n-1 into entities (kind, first, last) of bounded length and chunks outside."""
    def rest(at):
        if at == n:
            yield ()
            return
        for tail in rest(at + 1):
            yield tail
        for last in range(at, min(n, at + pii.MAX_CHUNKS)):
            for k in range(len(pii.KINDS)):
                for tail in rest(last + 1):
                    yield ((k, at, last), *tail)
    return rest(0)


TEXTS = ["call +1 (555) 123", "on 2019-12-31", "a@b.co 10.0.0.1 4111 1111"]


def cases():
    return [(t, r, pii.gold(r, pii.base_spans(t))) for t in TEXTS for r in pii.regions(t)]


def test_partition_function_and_expectations_against_enumeration():
    rng = np.random.default_rng(1)
    weights, outside = rng.normal(size=(len(pii.KINDS), len(pii.SPAN_FEATURES))), 0.4
    for t, region, want in cases():
        total, expected, free = pii.Lattices([(t, region, want)]).log_sums(weights, outside)
        scores, features, frees = [], [], []
        for s in segmentations(len(region)):
            f = np.zeros_like(weights)
            for k, i, j in s:
                f[k] += pii.span_features(t, region[i][0], region[j][1], j - i + 1)[k]
            out = len(region) - sum(j - i + 1 for _, i, j in s)
            scores.append(float((f * weights).sum()) + outside * out)
            features.append(f)
            frees.append(out)
        p = np.exp(np.array(scores) - max(scores))
        assert math.isclose(total, max(scores) + math.log(p.sum()), rel_tol=1e-9)
        p /= p.sum()
        assert np.allclose(expected, sum(x * f for x, f in zip(p, features))) and math.isclose(free, float(p @ frees), rel_tol=1e-9)


def test_gradient_against_differences():
    rng = np.random.default_rng(2)
    by_length = {}
    for c in cases():
        by_length.setdefault(len(c[1]), []).append(c)
    groups = [pii.Lattices(c) for c in by_length.values()]
    weights, outside = rng.normal(size=(len(pii.KINDS), len(pii.SPAN_FEATURES))), 0.3
    _, dw, do = pii.likelihood(groups, weights, outside)
    for k, f in itertools.product(range(len(pii.KINDS)), (0, 3, 6, 10)):
        step = np.zeros_like(weights)
        step[k, f] = 1e-5
        up, down = pii.likelihood(groups, weights + step, outside)[0], pii.likelihood(groups, weights - step, outside)[0]
        assert math.isclose(dw[k, f], (up - down) / 2e-5, abs_tol=1e-6)
    up, down = pii.likelihood(groups, weights, outside + 1e-5)[0], pii.likelihood(groups, weights, outside - 1e-5)[0]
    assert math.isclose(do, (up - down) / 2e-5, abs_tol=1e-6)


def test_training_raises_the_likelihood():
    made = pii.made_regions(each=20)
    groups = [pii.Lattices([c]) for c in made]
    start = pii.likelihood(groups, np.zeros((len(pii.KINDS), len(pii.SPAN_FEATURES))), 0.0)[0]
    weights, outside = pii.train(made)
    assert pii.likelihood(groups, weights, outside)[0] > start / 4


@pytest.fixture(scope="module")
def model(docs):
    return pii.fit(docs)


def added(text, model):
    return [(pii.KINDS[k], text[s:e]) for k, s, e in pii.added_spans(text, pii.base_spans(text), *model)]


@pytest.mark.parametrize("text,kind,span", [
    ("please call 020 7946 0958 today", "phone", "020 7946 0958"), ("my phone (555) 123-4567.", "phone", "(555) 123-4567"),
    ("Tel: 555-123-4567", "phone", "555-123-4567"), ("fax 030 1234567 or so", "phone", "030 1234567"),
    ("card: 4111.1111.1111.1111!", "card", "4111.1111.1111.1111"), ("paid by visa 5500.0000.0000.0004", "card", "5500.0000.0000.0004")])
def test_odd_forms_are_found(model, text, kind, span):
    assert added(text, model) == [(kind, span)]


@pytest.mark.parametrize("text", ["on 2019-12-31 we met", "call 2019-12-31", "since 31/12/2019", "in 1999-2000 and at 12:30", "order 12345678901", "invoice 2024 000 12345",
                                  "card 4111 1111 1111 1112 x", "card 4111.1111.1111.1112", "about 020 7946 0958", "ISBN 978-3-16-148410-0", "sum 1,234,567.89", "version 1.2.3",
                                  "call +1 (555) 123-4567", "a@b.co", "10.0.0.1", "pages 12 to 15", "1234567890"])
def test_nothing_is_added(model, text):
    assert added(text, model) == []


def test_repeated_rows_do_not_fill_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "train", lambda cases: seen.append(cases) or (None, 0.0))
    rows = [(1, "write to hot@a.co")] * 400 + [(i, f"write to u{i}@a.co") for i in range(2, 200)]
    pii.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), sample=50)
    made = len(pii.made_regions())
    texts = [t for t, _, _ in seen[0][:-made]]
    assert len(texts) == 50 == len(set(texts))


def test_regions_late_in_long_documents_are_drawn(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "train", lambda cases: seen.append(cases) or (None, 0.0))
    long = "\n".join(f"line {i} of it" for i in range(500)) + " " + "x" * 100_000 + " mail late@end.org"
    pii.fit(spark.createDataFrame([(1, long), (2, None), (3, "")], "doc_id bigint, text string"))
    assert any("late@end.org" in t for t, _, _ in seen[0][:-len(pii.made_regions())])


def test_added_spans_touch_no_base_span():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(len(pii.KINDS), len(pii.SPAN_FEATURES)))
    text = " ".join(rng.choice(["a@b.co", "10.0.0.1", "4111 1111 1111 1111", "+1 555 123 4567", "12", "x", "\n", "2019-12-31"], 400))
    base = pii.base_spans(text)
    got = pii.added_spans(text, base, weights, 0.1)
    assert got
    assert not any(a < e and b > s for _, s, e in got for _, a, b in base)
    missed = [(k, region[i][0], region[j][1]) for region in pii.regions(text) for k, i, j in pii.decode(text, region, weights, 0.1)]
    assert got == [(k, s, e) for k, s, e in missed if not any(a < e and b > s for _, a, b in base)]


def test_many_spans_in_one_region_take_linear_time(model):
    text = " ".join(f"u{i}@a.co" for i in range(4000))
    start = time.perf_counter()
    assert added(text, model) == []
    assert time.perf_counter() - start < 20
