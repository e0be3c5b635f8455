"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document. Their accuracies are unknown: expectation-
maximisation over the counts of vote patterns of all documents estimates, per labeller, how often it casts each
vote on good and on bad documents, and with them the posterior of every pattern. A linear scorer over hashed byte
4-grams is then fitted to the posteriors of a bounded sample and scores every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiframe.llm.common import id_hash, map_batches, safe_names, staged
from vigiframe.llm.features import equal_neighbours, hashed_grams, longest_run, lower_count, stop_words, symbol_count, upper_count

# Votes: 0 abstain, 1 bad, 2 good. A labeller's number is its digit (base 3) in the vote pattern.
LABELLERS = ("symbols", "shouting", "exclamations", "table_bars", "repeats", "stop_words", "word_length", "variety", "runs")
BITS = 12
SAMPLE_ROWS = 1500      # documents the scorer is fitted on: at most half of each label
THRESHOLD = 0.5
FEW_WORDS = 20          # under so many words a labeller that looks at shares doesn't call a text bad
PAD_GRAMS = 200.0       # shrinks the vectors of short texts towards zero, where the bias (good) decides
PRIOR_GOOD = 0.85       # the labellers are right on most documents at the start; EM moves on from there


def _vote(value: float, good: float, bad: float) -> int:
    """Good at or under ``good``, bad at or over ``bad`` (or the other way round), else abstain (0)."""
    if good <= bad:
        return 2 if value <= good else 1 if value >= bad else 0
    return 2 if value >= good else 1 if value <= bad else 0


def votes(text: str | None) -> list[int]:
    """The labellers' votes on a whole text; a text of under five words (or null) gets abstentions only."""
    words = (text or "").split()
    n = len(words)
    if n < 5:
        return [0] * len(LABELLERS)
    raw = text.encode("utf-8", "replace")
    upper, lower = upper_count(raw), lower_count(raw)
    cast = [
        _vote(symbol_count(raw) / n, 0.05, 0.30),
        _vote(upper / max(1, upper + lower), 0.15, 0.50),
        _vote(raw.count(b"!") / n, 0.05, 0.40),
        _vote(raw.count(b" | ") / n, 0.01, 0.20),
        _vote(equal_neighbours(words) / n, 0.05, 0.20),
        _vote(stop_words(words) / n, 0.10, 0.02),
        _vote(abs(len(text) / n - 6.5), 2.5, 6.0),
        _vote(len(set(words)) / n ** 0.85, 0.55, 0.25),
        _vote(longest_run(words), 2, 5),
    ]
    return cast if n >= FEW_WORDS else [0 if v == 1 else v for v in cast]


def pattern_number(cast: list[int]) -> int:
    return sum(v * 3 ** i for i, v in enumerate(cast))


def pattern_votes(patterns: np.ndarray) -> np.ndarray:
    """Votes (patterns x labellers) of pattern numbers."""
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def fit_accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray]:
    """EM for ``(share of good documents, P[class, labeller, vote])`` from pattern counts; class 1 is good.

    Starts from labellers that call one good document in a hundred bad, while a bad document shows only some of
    the faults that they look for. Counts are smoothed by one document a vote. Without documents the start is
    returned.
    """
    v = pattern_votes(patterns)
    k = len(LABELLERS)
    table = np.empty((2, k, 3))
    table[0], table[1] = (0.15, 0.35, 0.5), (0.15, 0.01, 0.84)
    prior = PRIOR_GOOD
    if not len(patterns):
        return prior, table
    counts = counts.astype(float)
    for _ in range(rounds):
        p = posteriors(patterns, prior, table)
        new = min(max((counts @ p + PRIOR_GOOD) / (counts.sum() + 1), 0.01), 0.99)
        for c, weight in ((0, counts * (1 - p)), (1, counts * p)):
            hits = np.stack([(weight[:, None] * (v == vote)).sum(axis=0) for vote in range(3)], axis=1) + table[c] * 1.0
            table[c] = hits / hits.sum(axis=1, keepdims=True)
        if abs(new - prior) < 1e-9:
            break
        prior = new
    return prior, table


def posteriors(patterns: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    """P(good) of each pattern. Votes count as evidence, abstentions don't."""
    v = pattern_votes(patterns)
    at = np.arange(len(LABELLERS))
    given = np.log(table[:, :, 1:] / table[:, :, 1:].sum(axis=2, keepdims=True))
    log_vote = np.concatenate([np.zeros((2, len(LABELLERS), 1)), given], axis=2)
    good = np.log(prior) + log_vote[1][at, v].sum(axis=1)
    bad = np.log1p(-prior) + log_vote[0][at, v].sum(axis=1)
    return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))


def document_vector(text: str | None) -> np.ndarray:
    """Square roots of the shares of the hashed byte 4-grams, and in bucket 0 that of the words equal to their neighbour."""
    counts = hashed_grams((text or "").encode("utf-8", "replace"), BITS)
    words = (text or "").split()
    x = np.sqrt(counts / (counts.sum() + PAD_GRAMS))
    x[0] = np.sqrt(equal_neighbours(words) / (len(words) + FEW_WORDS))
    return x.astype(np.float32)


def fit_scorer(x: np.ndarray, y: np.ndarray, prior: float, rounds: int = 200, rate: float = 30.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient steps with momentum, both classes weighted alike.

    The bias is held at the log odds of a good document, so a text without evidence is kept. Without rows of both
    classes the weights stay zero and nothing is rejected.
    """
    w, b = np.zeros(1 << BITS, np.float32), np.float32(max(1.0, np.log(prior / (1 - prior))))
    if not len(y) or (y >= 0.5).all() or (y < 0.5).all():
        return w, float(b)
    x, y = np.ascontiguousarray(x, np.float32), y.astype(np.float32)
    weight = np.where(y >= 0.5, 0.5 / (y >= 0.5).sum(), 0.5 / (y < 0.5).sum()).astype(np.float32)
    dw = np.zeros_like(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = weight * (p - y)
        dw = 0.8 * dw - rate * (g @ x + np.float32(decay) * w)
        w = (w + dw).astype(np.float32)
    return w, float(b)


def vote_patterns(docs: DataFrame) -> DataFrame:
    """``(doc_id, pick, pattern)`` per row: the vote pattern, and the number that draws the sample (equal texts share it)."""
    def run(batches):
        for batch in batches:
            numbers = [pattern_number(votes(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("pick"), pa.array(numbers, pa.int32())], names=["doc_id", "pick", "pattern"])

    picked = docs.select("doc_id", "text", id_hash(6, F.col("text")).alias("pick"))
    return map_batches(picked, run, "doc_id bigint, pick double, pattern int")


def fit(docs: DataFrame) -> dict:
    """The label model over all rows of ``docs`` and the scorer fitted to a bounded sample of their different texts.

    At most 3 ** labellers patterns and ``SAMPLE_ROWS`` vectors reach the driver. Half the sample is to be of either
    label; a text that many rows repeat is drawn once.
    """
    patterns = staged(vote_patterns(docs))
    found = patterns.groupBy("pattern").agg(F.count("*").alias("n"), F.approx_count_distinct("pick").alias("texts")).orderBy("pattern").collect()
    different = {r.pattern: r.texts for r in found}
    numbers, counts = np.array([r.pattern for r in found], np.int64), np.array([r.n for r in found], np.int64)
    prior, table = fit_accuracies(numbers, counts)
    p = posteriors(numbers, prior, table) if len(numbers) else np.zeros(0)
    # The sample of a label is the rows with its least pick numbers: a share slightly over what is needed, then cut.
    half = SAMPLE_ROWS // 2
    good = set(numbers[p >= 0.5].tolist())
    shares = {}
    for label, own in (("good", good), ("bad", set(numbers.tolist()) - good)):
        total = sum(n for k, n in different.items() if k in own)
        shares[label] = min(1.0, half / total) if total else 0.0

    labels = dict(zip(numbers.tolist(), p.tolist(), strict=True))

    def vectors(batches):
        for batch in batches:
            picks, rows = batch.column("pick").to_pylist(), []
            for pick, t in zip(picks, batch.column("text").to_pylist(), strict=True):
                if pick < max(shares.values()):
                    y = labels[pattern_number(votes(t))]
                    share = shares["good" if y >= 0.5 else "bad"]
                    if pick < share:
                        x = document_vector(t)
                        at = np.flatnonzero(x)
                        rows.append((pick, pick / share, y, at.astype(np.int32), x[at]))
            kinds = [pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float32())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["pick", "place", "y", "at", "x"])

    picked = docs.select("text", id_hash(6, F.col("text")).alias("pick")).where(F.col("pick") < F.lit(max(shares.values())))
    drawn = map_batches(picked, vectors, "pick double, place double, y double, at array<int>, x array<float>").dropDuplicates(["pick"])
    # By the place in the label's share, so that a slight surplus is cut from both labels alike.
    rows = drawn.orderBy("place", "pick").limit(SAMPLE_ROWS).collect()
    x, y = np.zeros((len(rows), 1 << BITS), np.float32), np.array([r.y for r in rows])
    for i, r in enumerate(rows):
        x[i, r.at] = r.x
    w, b = fit_scorer(x, y, prior)
    return {"prior": prior, "table": table, "weights": w, "bias": b, "rows": len(rows)}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``_good`` and ``_bad`` (labellers of that vote), ``_posterior`` and ``_score``.

    Empty and null texts have the prior as posterior, and the scorer's bias decides on them.
    """
    prior, table, w, b = model["prior"], model["table"], model["weights"], model["bias"]
    columns, text_at = docs.columns, docs.columns.index(text)

    def run(batches):
        known = {}
        for batch in batches:
            scores, post, good, bad = [], [], [], []
            for t in batch.column(text_at).to_pylist():
                v = votes(t)
                key = pattern_number(v)
                if key not in known:
                    known[key] = float(posteriors(np.array([key]), prior, table)[0])
                post.append(known[key])
                good.append(v.count(2))
                bad.append(v.count(1))
                scores.append(float(1 / (1 + np.exp(-(document_vector(t) @ w + b)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good, pa.int64()), pa.array(bad, pa.int64()), pa.array(post, pa.float64()), pa.array(scores, pa.float64())],
                                             names=[*columns, "_good", "_bad", "_posterior", "_score"])

    added = T.StructType().add("_good", T.LongType()).add("_bad", T.LongType()).add("_posterior", T.DoubleType()).add("_score", T.DoubleType())
    return map_batches(docs, run, T.StructType(docs.schema.fields + added.fields))


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, n_good, n_bad, posterior, score, kept)`` per row of ``docs(doc_id, text)``.

    Null and empty texts, and texts of under five words, get no votes; the scorer alone decides on them (an empty
    text scores the bias). Repeated rows get the same score. Empty tables give no rows. If the labellers find only
    one class, every document is kept.
    """
    docs = docs.select("doc_id", "text")
    found = score(docs, fit(docs))
    return found.select("doc_id", F.col("_good").alias("n_good"), F.col("_bad").alias("n_bad"),
                        F.col("_posterior").alias("posterior"), F.col("_score").alias("score"), (F.col("_score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    model = fit(docs.select("doc_id", "text"))
    safe, names = safe_names(docs)
    found = score(safe, model, names["text"])
    return found.where(F.col("_score") >= threshold).select(*safe.columns).toDF(*docs.columns)
