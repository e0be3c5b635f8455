"""Quality rules with a linear-chain conditional random field over lines.

Every line with a word is a step of a chain with the labels boilerplate (0) and content (1). Emissions are linear
in line features, transitions link neighbouring lines; Viterbi decoding labels the lines, and the share of words
in content lines decides whether the document stays. The weights are the maximum of the (regularised) conditional
likelihood on a bounded sample of labelled documents, found by gradient steps with the forward-backward algorithm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.common import id_hash, map_batches
from vigiframe.llm.features import digit_count, equal_neighbours, longest_run, lower_count, stop_words, symbol_count, upper_count

SAMPLE_DOCS = 1200          # labelled documents that the field is fitted on, at most
SAMPLE_LINES = 500          # documents of more lines are not drawn: the fit gets SAMPLE_DOCS * SAMPLE_LINES lines at most
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
FEATURES = ("bias", "few_words", "many_words", "symbols", "many_symbols", "upper", "exclamations", "bars", "repeats", "run",
            "stop_words", "no_stop_words", "sentence_end", "digits", "notice", "seen_before", "first", "last")
# Wording of licence and site notices, in lower case.
NOTICES = ("licensed under", "licenced under", "released under", "all rights reserved", "copyright", "©", "terms of use", "terms of service",
           "privacy policy", "cookie", "subscribe", "sign in", "sign up", "log in", "click here", "read more", "creative commons")
CUE_WORDS = 40              # a line with a cue for so many words (or fewer) is a notice in full, others are by their share
# Emission weights (of content) and transitions where no labelled document is at hand.
FALLBACK = {"bias": 1.0, "many_symbols": -3.0, "upper": -3.0, "exclamations": -3.0, "bars": -3.0, "repeats": -3.0, "run": -2.0,
            "notice": -2.0, "seen_before": -1.0}
_SYMBOLS, _SPACES, _SENTENCE_ENDS = b"#*$%&|<>", b" \t\n\r\x0b\x0c", frozenset((b".", b"!", b"?", b":", b";", b'"'))


def line_features(line: str, words: list[str], seen: bool, first: bool, last: bool) -> list[float]:
    n = max(1, len(words))
    raw = line.encode("utf-8", "replace")
    symbols = symbol_count(raw) / n
    upper = upper_count(raw)
    stops = stop_words(words) / n
    repeats = equal_neighbours(words)
    run = min(longest_run(words) / 5, 1.0) if repeats and n > 4 else 0.0
    low = line.lower()
    notice = min(sum(map(low.count, NOTICES)) * CUE_WORDS / n, 1.0)
    return [1.0, n < 5, n > 30, min(symbols, 1.0), symbols > 0.3, upper > 0 and upper > lower_count(raw), min(raw.count(b"!") / n, 1.0),
            min(raw.count(b" | ") / n, 1.0), repeats / n, run, min(stops * 4, 1.0), n >= 5 and stops < 0.02,
            raw.rstrip()[-1:] in _SENTENCE_ENDS, min(digit_count(raw) / n, 1.0), notice, seen, first, last]


def chain(text: str) -> tuple[np.ndarray, list[int], list[str]]:
    """Features (lines x features), word counts and the lines with a word of a text."""
    split = [(line, words) for line in text.split("\n") if (words := line.split())]
    seen, rows = set(), []
    for i, (line, words) in enumerate(split):
        rows.append(line_features(line, words, line in seen, i == 0, i == len(split) - 1))
        seen.add(line)
    return np.array(rows, np.float64).reshape(len(split), len(FEATURES)), [len(w) for _, w in split], [line for line, _ in split]


def viterbi(emission: np.ndarray, trans: np.ndarray) -> list[int]:
    """Best label sequence of one chain: ``emission`` is the score of content over boilerplate per line, ``trans``
    the 2 x 2 scores from label to next label. Ties go to content."""
    if not len(emission):
        return []
    (t00, t01), (t10, t11) = trans.tolist()
    back, bad, good = [], 0.0, float(emission[0])
    for e in emission[1:].tolist():
        to_bad = 1 if good + t10 >= bad + t00 else 0
        to_good = 1 if good + t11 >= bad + t01 else 0
        back.append((to_bad, to_good))
        bad, good = (good + t10 if to_bad else bad + t00), (good + t11 if to_good else bad + t01) + e
    label = 1 if good >= bad else 0
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return out[::-1]


def fit(chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = 250, rate: float = 5.0, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights and transitions from ``(features, labels)`` chains; the fallback without both labels."""
    k = len(FEATURES)
    w, trans = np.array([FALLBACK.get(f, 0.0) for f in FEATURES]), np.array([[0.5, -0.5], [-0.5, 0.5]])
    chains = sorted((c for c in chains if len(c[1])), key=lambda c: -len(c[1]))
    if not chains or len({int(y) for _, ys in chains for y in ys}) < 2:
        return w, trans
    x, y = np.concatenate([c[0] for c in chains]), np.concatenate([c[1] for c in chains]).astype(int)
    begin = np.cumsum([0] + [len(c[1]) for c in chains])
    longest = len(chains[0][1])
    # Step s of all chains long enough: chains are sorted by length, so these are the first ones.
    active = [sum(1 for c in chains if len(c[1]) > s) for s in range(longest)]
    at = [begin[:n] + s for s, n in enumerate(active)]
    inner = np.ones(len(y), bool)
    inner[begin[:-1]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
    velocity = np.zeros(k + 4)
    for _ in range(rounds):
        e = np.stack([np.zeros(len(y)), x @ w], axis=1)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[at[0]] = e[at[0]]
        for s in range(1, longest):
            alpha[at[s]] = e[at[s]] + np.logaddexp.reduce(alpha[at[s] - 1][:, :, None] + trans, axis=1)
        pair = np.zeros((2, 2))
        z = np.repeat(np.logaddexp.reduce(alpha[begin[1:] - 1], axis=1), np.diff(begin))
        for s in range(longest - 1, 0, -1):
            into = trans + (e[at[s]] + beta[at[s]])[:, None, :]
            beta[at[s] - 1] = np.logaddexp.reduce(into, axis=2)
            pair += np.exp(alpha[at[s] - 1][:, :, None] + into - z[at[s]][:, None, None]).sum(axis=0)
        p = np.exp(alpha[:, 1] + beta[:, 1] - z)
        g = np.concatenate([x.T @ (y - p) / len(y) - decay * w, ((seen - pair) / len(y) - decay * trans).ravel()])
        velocity = 0.8 * velocity + rate * g
        w, trans = w + velocity[:k], trans + velocity[k:].reshape(2, 2)
    return w, trans


def line_labels(quality: int, x: np.ndarray) -> np.ndarray:
    """Training labels: a line of a good document is content unless it is a notice in full (a cue per
    ``CUE_WORDS`` words) or repeats an earlier line."""
    if not quality:
        return np.zeros(len(x), int)
    return 1 - np.maximum(x[:, FEATURES.index("notice")], x[:, FEATURES.index("seen_before")]).astype(int)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Field fitted on at most ``sample_docs`` of the labelled documents, drawn by a hash of their ids; of these, documents
    of more than ``SAMPLE_LINES`` lines are left out whole (they are decoded and judged like any other).

    Labels that contradict each other, nulls and documents without a label are left out. Of rows that share an id the
    one with the least text hash counts, so a repeated id weighs no more than any other.
    """
    sure = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_top"))
    drawn = sure.where("quality = _top").select("doc_id", "quality").orderBy(id_hash(1, F.col("doc_id")), "doc_id").limit(sample_docs)

    def chains(batches):
        for batch in batches:
            rows = [chain(t or "")[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array([r.astype(np.float32).ravel() for r in rows], pa.list_(pa.float32()))],
                                             names=["doc_id", "quality", "x"])

    # At most sample_docs ids and labels: small enough to send to every task.
    picked = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.size(F.split("text", "\n")) <= SAMPLE_LINES)).join(F.broadcast(drawn.withColumn("quality", F.col("quality").cast("bigint"))), "doc_id")
    picked = picked.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).getField("text").alias("text"))
    rows = map_batches(picked.select("doc_id", "quality", "text"), chains, "doc_id bigint, quality bigint, x array<float>").orderBy("doc_id").collect()
    xs = [(np.array(r.x, np.float64).reshape(-1, len(FEATURES)), r.quality) for r in rows]
    return fit([(x, line_labels(q, x)) for x, q in xs])


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in three-word windows that occur twice or more."""
    raw = text.encode("utf-8", "surrogatepass")
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    chars = len(text) - (len(raw) - len(raw.translate(None, _SPACES)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return n, chars, symbols, len(lines) - len(set(lines)), _repeated_words(words)


def _repeated_words(words: list[bytes]) -> int:
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    lead = ids[:-2] * len(number) + ids[1:-1]
    if len(number) >= 1 << 21:  # three numbers would not fit 63 bits: number the pairs first
        lead = np.unique(lead, return_inverse=True)[1]
    windows = lead * len(number) + ids[2:]
    ranked = np.sort(windows)
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(again):
        return 0
    twice, mark = np.isin(windows, again), np.zeros(n, bool)
    for k in range(3):
        mark[k:n - 2 + k] |= twice
    return int(mark.sum())


def rate_documents(docs: DataFrame, field: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the base counts, the lines by label, the share of words in content lines
    and the verdict.

    A null or empty text, or one of white space only, has no words, no lines, a content share of zero and fails.
    Repeated rows give repeated results; an empty table gives none; other columns are not looked at.
    """
    w, trans = field
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_content_lines", "content_share"]

    def run(batches):
        for batch in batches:
            rows = []
            for t in batch.column("text").to_pylist():
                n, chars, symbols, dup, repeated = base_counts(t or "")
                failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
                x, counts, _ = chain(t or "")
                marks = viterbi(x @ w, trans)
                share = sum(c for c, m in zip(counts, marks, strict=True) if m) / max(1, sum(counts))
                rows.append((n, chars, symbols, dup, repeated, failed, not failed and share >= MIN_CONTENT_SHARE, len(marks), sum(marks), share))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.float64()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=names)

    schema = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
              "kept boolean, n_lines bigint, n_content_lines bigint, content_share double")
    return map_batches(docs.select("doc_id", "text"), run, schema)


def label_lines(text: str | None, field: tuple[np.ndarray, np.ndarray]) -> list[tuple[str, int]]:
    """The lines with a word of a text and their labels (1 content, 0 boilerplate)."""
    x, _, lines = chain(text or "")
    return list(zip(lines, viterbi(x @ field[0], field[1]), strict=True))
