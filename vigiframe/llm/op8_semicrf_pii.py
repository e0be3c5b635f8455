"""Personal data by patterns and a semi-Markov conditional random field.

The patterns give the base spans. Around chunks with a digit or an at sign the field segments the text further: every
run of up to ``MAX_CHUNKS`` chunks may be an entity of one type, scored by features of the whole span (shape, digits,
check sums, separators, the word before), every chunk outside an entity has its own weight, and dynamic programming
over the bounded entities picks boundaries and types together. Only chunks with a digit or an at sign can be in an
entity, so each run of such chunks is decoded by itself. Decoded entities that touch no base span are added to them.

The weights maximise the conditional likelihood of segmentations (sums over the lattice of all segmentations by forward
and backward recursions, an L2 penalty, full gradient steps). They are fitted to regions drawn from all documents, whose
base spans are the entities, and to made regions with weak labels that the patterns can't give: numbers after a cue word
without a plus sign, cards with unusual separators, and as counterexamples the same numbers without a cue, cards that
fail their check sum, dates, amounts, versions and order numbers.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.common import map_batches

KINDS = ("email", "ip", "card", "phone")
MAX_CHUNKS = 6
# Bounds of the training sample: different regions drawn by a hash over all documents, whole; regions of more chunks or
# characters are not drawn (scan() looks at every one).
SAMPLE_REGIONS, SAMPLE_REGION_CHUNKS, SAMPLE_REGION_CHARS = 2500, 64, 4096
MADE = 150                      # made regions of each sort
STEPS, RATE, PENALTY = 150, 0.3, 1e-3
CONTEXT = 24                    # characters before a span that are searched for its cue
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match always starts where its digits start, so places inside a run of digits needn't be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CHUNK = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
_TRIM_LEFT, _TRIM_RIGHT = "\"'([{<,;:.!?*#$%&|", "\"')]}>,;:.!?*#$%&|"
# Words before an entity that speak for a type.
CUES = {"email": "email e-mail mail contact write", "ip": "ip host server address client", "card": "card visa mastercard amex credit debit account",
        "phone": "phone tel telephone call fax mobile cell whatsapp"}
_CUE_OF = {w: k for k, words in CUES.items() for w in words.split()}
# Words before a number that is no personal one.
REFERENCES = frozenset("""order invoice ref reference no nr number id isbn issn version date year since from page code ticket serial chapter section part
figure table total amount sum on in of""".split())
_DATE = re.compile(r"[0-9]{1,4}([-/.])[0-9]{1,2}\1[0-9]{1,4}|[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?|(1[5-9]|20)[0-9]{2}-(1[5-9]|20)?[0-9]{2}")
SPAN_FEATURES = ("plus_number", "cued_number", "card", "cued_card", "date", "reference", "bias", "at_sign", "email_shape", "four_numbers", "octets", "digits_under_8", "digits_8_15", "digits_16_19", "digits_over_19", "luhn", "plus_first",
                 "letters", "brackets", "only_digits_and_separators", "chunks", "cue", "other_cue")


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The pattern matches as (kind, start, end): leftmost, non-overlapping per kind, failing ones dropped."""
    out = []
    at = text.find("@")
    free = 0        # end of the last address: the next one starts there at the earliest
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append((0, m.start(), m.end()))
            free = m.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))
    if any(c in text for c in "0123456789"):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring chunks with a digit or an at sign, as trimmed (start, end) places; a line break ends a run."""
    out, last = [], None
    for m in _CHUNK.finditer(text):
        start, end = m.span()
        while start < end and text[start] in _TRIM_LEFT:
            start += 1
        while end > start and text[end - 1] in _TRIM_RIGHT:
            end -= 1
        if start == end:
            continue
        if start > m.start() and text[start - 1] == "(" and ")" in m[0][1:]:
            start -= 1
        if last is not None and m.start() - last <= 2 and "\n" not in text[last:m.start()]:
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
        last = m.end()
    return out


def span_features(text: str, start: int, end: int, chunks: int) -> np.ndarray:
    """Features of a whole span for every type (types x features); only the cues differ between types."""
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    n = len(digits)
    before = text[max(0, start - CONTEXT):start].replace(":", " ").replace("=", " ").split()
    word = before[-1].lower().strip("\"'(,.#") if before else ""
    cue = _CUE_OF.get(word)
    four = _IP.fullmatch(span) is not None
    plain, plus = all(c in "0123456789 +().-" for c in span), span[:1] == "+"
    date = _DATE.fullmatch(span) is not None
    checked = 16 <= n <= 19 and luhn(digits)
    number = plain and 8 <= n <= 15 and not four and not date
    f = [number and plus, number and cue == "phone", plain and checked, plain and checked and cue == "card", date, word in REFERENCES,
         1.0, "@" in span, _EMAIL.fullmatch(span) is not None, four, four and _octets(span), n < 8, 8 <= n <= 15, 16 <= n <= 19, n > 19,
         checked, plus, any(c.isalpha() for c in span), "(" in span or ")" in span, plain, chunks / MAX_CHUNKS]
    return np.array([[*f, cue == k, cue is not None and cue != k] for k in KINDS], np.float64)


def decode(text: str, region: list[tuple[int, int]], weights: np.ndarray, outside: float) -> list[tuple[int, int, int]]:
    """Best segmentation of a region: entities as (kind, first chunk, last chunk).

    ``weights`` (types x features) score spans, ``outside`` scores each chunk in none. On ties the shorter entity and
    outside win.
    """
    n = len(region)
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1] + outside
        for i in range(j - 1, max(-1, j - 1 - MAX_CHUNKS), -1):
            scores = (span_features(text, region[i][0], region[j - 1][1], j - i) * weights).sum(axis=1)
            k = int(scores.argmax())
            if best[i] + scores[k] > best[j] + 1e-9:
                best[j], back[j] = best[i] + float(scores[k]), (k, i)
    out, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            k, i = back[j]
            out.append((k, i, j - 1))
            j = i
    return out[::-1]


def gold(region: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans that cover whole chunks of the region, as (kind, first chunk, last chunk), without overlaps."""
    starts, ends = {s: i for i, (s, _) in enumerate(region)}, {e: i for i, (_, e) in enumerate(region)}
    out, last = [], -1
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s in starts and e in ends and starts[s] > last and ends[e] - starts[s] < MAX_CHUNKS:
            out.append((k, starts[s], ends[e]))
            last = ends[e]
    return out


# A region to learn from: its text, chunks, and entities as (kind, first chunk, last chunk).
Case = tuple[str, list[tuple[int, int]], list[tuple[int, int, int]]]


def made_regions(seed: int = 8, each: int = MADE) -> list[Case]:
    """Regions with weak labels, the same on every run: odd forms of numbers and cards, and what looks like them."""
    rng, out = random.Random(seed), []

    def digits(n: int) -> str:
        return str(rng.randrange(1, 10)) + "".join(str(rng.randrange(10)) for _ in range(n - 1))

    def card(good: bool) -> str:
        body = digits(15)
        check = next(str(c) for c in range(10) if luhn(body + str(c)))
        return body + (check if good else str((int(check) + rng.randrange(1, 10)) % 10))

    def grouped(text: str, sizes: tuple[int, ...], mark: str) -> str:
        parts, at = [], 0
        for size in sizes:
            parts.append(text[at:at + size])
            at += size
        return mark.join(p for p in [*parts, text[at:]] if p)

    def add(before: str, entity: str, kind: int | None) -> None:
        text = f"{before} {entity}".strip()
        found = regions(text)
        if not found:
            return
        region = found[-1]
        first = next((i for i, (s, _) in enumerate(region) if s >= len(text) - len(entity)), None)
        if first is not None and (kind is None or len(region) - first <= MAX_CHUNKS):
            out.append((text, region, [] if kind is None else [(kind, first, len(region) - 1)]))

    cues = CUES["phone"].split()
    for _ in range(each):
        n = digits(rng.choice((8, 9, 10, 11)))
        shape = rng.choice((grouped(n, (3, 4), " "), grouped(n, (3, 3), "-"), grouped(n, (3, 3), "."), f"({n[:3]}) {grouped(n[3:], (3,), '-')}", n, "0" + grouped(n, (2, 4), " ")))
        cue = rng.choice(cues)
        add(rng.choice((f"{cue}:", cue, f"my {cue}", f"{cue.title()}:")), shape, 3)
        add(rng.choice(("about", "with", "", "the", "and")), shape, None)
        add(rng.choice(sorted(REFERENCES)), shape, None)
        good, bad, mark = card(True), card(False), rng.choice((".", "  ", ". ", " . "))
        add(rng.choice(("card:", "paid by visa", "", "with")), grouped(good, (4, 4, 4), mark.strip() or mark), 2)
        add(rng.choice(("card:", "paid by visa", "", "with", "call")), grouped(bad, (4, 4, 4), rng.choice((" ", "-", ".", ""))), None)
        day, month, year = rng.randrange(1, 29), rng.randrange(1, 13), rng.randrange(1900, 2100)
        date = rng.choice((f"{year}-{month:02d}-{day:02d}", f"{day:02d}/{month:02d}/{year}", f"{day}.{month}.{year}", f"{year}-{year + 1}", f"{day:02d}:{month:02d}"))
        add(rng.choice(("on", "since", "until", "call", "phone", "card", "", "the")), date, None)
        add(rng.choice(("order", "invoice", "No.", "ref", "id", "ticket", "isbn", "")), rng.choice((digits(rng.randrange(4, 14)), grouped(digits(13), (3, 1, 4), "-"))), None)
        add(rng.choice(("about", "sum of", "version", "EUR")), rng.choice((f"{digits(3)}.{digits(3)}.{digits(3)}", f"{digits(2)},{digits(3)},{digits(3)}", "1.2.3", digits(5))), None)
    return out


class Lattices:
    """Regions of one length, side by side: features of all their spans, and the entities they have."""

    def __init__(self, cases: list[Case]):
        self.n = len(cases[0][1])
        self.spans = [(i, j) for j in range(1, self.n + 1) for i in range(max(0, j - MAX_CHUNKS), j)]
        self.at = {s: k for k, s in enumerate(self.spans)}
        self.features = np.array([[span_features(t, region[i][0], region[j - 1][1], j - i) for i, j in self.spans] for t, region, _ in cases])
        self.gold, self.gold_outside = np.zeros(self.features.shape[2:]), 0.0
        for c, (_, _, want) in enumerate(cases):
            self.gold_outside += self.n - sum(j - i + 1 for _, i, j in want)
            for k, i, j in want:
                self.gold[k] += self.features[c, self.at[i, j + 1], k]

    def log_sums(self, weights: np.ndarray, outside: float) -> tuple[float, np.ndarray, float]:
        """Sum over the regions of the log of all segmentations' scores; expected features of entities; expected chunks
        outside."""
        scores = (self.features * weights).sum(axis=3)                       # regions x spans x types
        count = len(scores)
        forward, backward = np.full((self.n + 1, count), -np.inf), np.full((self.n + 1, count), -np.inf)
        forward[0], backward[self.n] = 0.0, 0.0
        each = np.logaddexp.reduce(scores, axis=2)                           # regions x spans
        for j in range(1, self.n + 1):
            steps = [forward[j - 1] + outside] + [forward[i] + each[:, self.at[i, j]] for i in range(max(0, j - MAX_CHUNKS), j)]
            forward[j] = np.logaddexp.reduce(steps, axis=0)
        for i in range(self.n - 1, -1, -1):
            steps = [backward[i + 1] + outside] + [backward[j] + each[:, self.at[i, j]] for j in range(i + 1, min(self.n, i + MAX_CHUNKS) + 1)]
            backward[i] = np.logaddexp.reduce(steps, axis=0)
        total = forward[self.n]
        starts, ends = [i for i, _ in self.spans], [j for _, j in self.spans]
        share = np.exp(scores + (forward[starts] + backward[ends] - total).T[:, :, None])
        free = np.exp(forward[:-1] + outside + backward[1:] - total).sum()
        return float(total.sum()), np.einsum("csk,cskf->kf", share, self.features), float(free)


def likelihood(groups: list[Lattices], weights: np.ndarray, outside: float, penalty: float = PENALTY) -> tuple[float, np.ndarray, float]:
    """Mean log likelihood of the regions' segmentations less the penalty, and its gradient."""
    value, dw, do, count = 0.0, np.zeros_like(weights), 0.0, sum(len(g.features) for g in groups)
    for g in groups:
        total, expected, free = g.log_sums(weights, outside)
        value += float((g.gold * weights).sum()) + g.gold_outside * outside - total
        dw += g.gold - expected
        do += g.gold_outside - free
    count = max(1, count)
    return value / count - penalty / 2 * float((weights**2).sum()), dw / count - penalty * weights, do / count


def train(cases: list[Case], steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights (types x features) and the weight of a chunk outside, by gradient steps with running moments."""
    groups: dict[int, list[Case]] = {}
    for case in cases:
        groups.setdefault(len(case[1]), []).append(case)
    lattices = [Lattices(groups[n]) for n in sorted(groups)]
    x = np.zeros(len(KINDS) * len(SPAN_FEATURES) + 1)
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        _, dw, do = likelihood(lattices, x[:-1].reshape(len(KINDS), -1), float(x[-1]))
        g = np.append(dw.ravel(), do)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        x = x + RATE * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return x[:-1].reshape(len(KINDS), -1), float(x[-1])


def added_spans(text: str, base: list[tuple[int, int, int]], weights: np.ndarray, outside: float) -> list[tuple[int, int, int]]:
    """Decoded entities that touch no base span, as (kind, start, end)."""
    # Base spans of a kind don't overlap, so both their starts and their ends are in order.
    known = [([s for k, s, _ in base if k == kind], [e for k, _, e in base if k == kind]) for kind in range(len(KINDS))]
    out = []
    for region in regions(text):
        for k, i, j in decode(text, region, weights, outside):
            s, e = region[i][0], region[j][1]
            if all(bisect.bisect_right(ends, s) >= bisect.bisect_left(starts, e) for starts, ends in known):
                out.append((k, s, e))
    return out


def region_pick(snippet: str) -> float:
    """Number in [0, 1) that draws a region: equal regions have the same."""
    return int.from_bytes(hashlib.blake2b(snippet.encode("utf-8", "replace"), digest_size=6).digest(), "big") / float(1 << 48)


def drawn_regions(text: str, share: float):
    """(pick, snippet, chunks in it, entities) for the regions of a text that the share draws."""
    base = None
    for region in regions(text):
        first, last = region[0][0], region[-1][1]
        if len(region) > SAMPLE_REGION_CHUNKS or last - first > SAMPLE_REGION_CHARS:
            continue
        offset = max(0, first - CONTEXT)
        snippet = text[offset:last]
        pick = region_pick(snippet)
        if pick < share:
            base = base_spans(text) if base is None else base
            yield pick, snippet, [(s - offset, e - offset) for s, e in region], gold(region, base)


def fit(docs: DataFrame, sample: int = SAMPLE_REGIONS) -> tuple[np.ndarray, float]:
    """Weights fitted to at most ``sample`` different regions of all documents, drawn whole by a hash, and the made ones.

    A region that many rows or documents repeat is drawn once. The driver gets the drawn regions only.
    """
    texts = docs.select("text").where(F.col("text").rlike("[0-9@]"))

    def picks(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for t in batch.column(0).to_pylist() for d in drawn_regions(t, 1.0)], pa.float64())], names=["pick"])

    different = map_batches(texts, picks, "pick double").agg(F.approx_count_distinct("pick").alias("n")).first()["n"]
    share = min(1.0, 1.25 * sample / different) if different else 0.0

    def cases(batches):
        for batch in batches:
            rows = [d for t in batch.column(0).to_pylist() for d in drawn_regions(t, share)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([[x for pair in r[2] for x in pair] for r in rows], pa.list_(pa.int32())),
                 pa.array([[x for entity in r[3] for x in entity] for r in rows], pa.list_(pa.int32()))], names=["pick", "snippet", "chunks", "entities"])

    found = map_batches(texts, cases, "pick double, snippet string, chunks array<int>, entities array<int>")
    # Of a region that stands in many texts the entities may differ with what follows it: one of them, the same each time.
    one = found.groupBy("pick").agg(F.min(F.struct("snippet", "chunks", "entities")).alias("r")).orderBy("pick").limit(sample).select("r.*").collect()
    drawn = [(r["snippet"], list(zip(r["chunks"][::2], r["chunks"][1::2])), list(zip(r["entities"][::3], r["entities"][1::3], r["entities"][2::3]))) for r in one]
    return train([*drawn, *made_regions()])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def scan(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` per row of ``docs(doc_id, text)``.

    Counts are of base spans. A null or empty text has no spans; repeated rows give repeated results; other columns
    are not looked at.
    """
    weights, outside = model
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def run(batches):
        for batch in batches:
            rows = []
            for t in batch.column("text").to_pylist():
                base = base_spans(t or "")
                more = added_spans(t or "", base, weights, outside)
                rows.append((*(sum(k == i for k, _, _ in base) for i in range(4)), hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more)))
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")
