"""Merkle trees over sections, paragraphs and clauses of a text.

Leaves are the clauses of a paragraph (a line), cut at sentence marks of many scripts and, whatever their length, at
places that the last few code points decide, so an edit moves only cuts near it; paragraphs are grouped into sections (up to a blank line, or after
a paragraph whose digest ends a group), the root is over the sections. A node's digest covers its children's
digests under a label of its level. Equal texts have equal roots; to compare two trees only branches with different
digests are followed down, and the clauses that are reached locate the edits.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.common import map_batches
from vigiframe.llm.ordering import range_count, range_number, range_starts, text_order
from vigiframe.llm.shingles import mix

LEAF_BYTES = 6              # of a clause's digest
SECTION_MASK = 7            # a paragraph ends its section if its digest's last bits under the mask are zero
CUT_POINTS = 8              # a cut depends on so many code points before it
CUT_MASK = 63               # ... and falls where the last bits of their hash under the mask are zero
LONGEST_LEAF = 256          # where no such place comes (periodic text), a leaf ends after so many code points
# Latin; Chinese and Japanese, full and half width; Arabic and Urdu; Indic; Armenian; Ethiopic; Khmer; Burmese; Tibetan.
_ENDS = ".!?,;:|…。！？，、；：．｡､؟،؛۔।॥՝։፡።፣፤፥፦፧፨។៕၊။།༎"
_CLAUSE = re.compile(rf"[^{_ENDS}]*[{_ENDS}]+[^\S\n]*|[^{_ENDS}]+")
_SALTS = mix(np.arange(1, CUT_POINTS + 1, dtype=np.uint64)) | np.uint64(1)


def _digest(level: bytes, parts: bytes, size: int = 16) -> bytes:
    return hashlib.blake2b(parts, digest_size=size, person=level).digest()


def _cut_places(text: str) -> np.ndarray:
    """Places of a text, in ascending order, at which the code points before them (of one line) call for a cut."""
    if len(text) <= CUT_POINTS:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes) - CUT_POINTS + 1
    h = np.zeros(n, np.uint64)
    for k in range(CUT_POINTS):
        h += codes[k:k + n] * _SALTS[k]
    at = np.flatnonzero(mix(h) & np.uint64(CUT_MASK) == 0)
    breaks = np.flatnonzero(codes == 10)
    at = at[np.searchsorted(breaks, at) == np.searchsorted(breaks, at + CUT_POINTS)]
    # Of neighbouring places (a repeated character) the first counts.
    return at[np.diff(at, prepend=-2) > 1] + CUT_POINTS


def _leaves(text: str) -> list[list[str]]:
    """The leaves of every line of a text."""
    cuts = _cut_places(text).tolist()
    out, begin, k = [], 0, 0
    for line in text.split("\n"):
        leaves, at = [], 0
        for clause in _CLAUSE.findall(line):
            end = at + len(clause)
            start = begin + at + CUT_POINTS     # the points that decide a cut lie in its clause
            while k < len(cuts) and cuts[k] < start:
                k += 1
            ends = [end]
            while k < len(cuts) and cuts[k] < begin + end:
                ends.insert(-1, cuts[k] - begin)
                k += 1
            for to in ends:
                while to - at > LONGEST_LEAF:
                    leaves.append(line[at:at + LONGEST_LEAF])
                    at += LONGEST_LEAF
                leaves.append(line[at:to])
                at = to
        out.append(leaves)
        begin += len(line) + 1
    return out


def clauses(line: str) -> list[str]:
    """The leaves of a line, in order; together they are the line."""
    return _leaves(line)[0]


@dataclass
class Tree:
    """Root, and per section its digest and paragraphs, per paragraph its digest and clause digests."""

    root: bytes
    sections: list[tuple[bytes, list[tuple[bytes, list[bytes]]]]]

    def leaves(self) -> list[bytes]:
        return [leaf for _, paragraphs in self.sections for _, leaves in paragraphs for leaf in leaves]

    def fingerprint(self) -> str:
        """Root, then the leaves by paragraph and section: 32 hex digits, and 12 a clause; separators ``: / .``."""
        return self.root.hex() + ":" + "/".join(".".join("".join(x.hex() for x in leaves) for _, leaves in paragraphs) for _, paragraphs in self.sections)


def merkle_tree(text: str) -> Tree:
    """The tree of a whole text. An empty text has one empty paragraph without a clause."""
    sections, current = [], []
    for line, own in zip(text.split("\n"), _leaves(text), strict=True):
        leaves = [hashlib.blake2b(c.encode("utf-8", "replace"), digest_size=LEAF_BYTES).digest() for c in own]
        paragraph = _digest(b"paragraph", b"".join(leaves))
        current.append((paragraph, leaves))
        if not leaves or not line.strip() or paragraph[-1] & SECTION_MASK == 0:
            sections.append(current)
            current = []
    if current:
        sections.append(current)
    done = [(_digest(b"section", b"".join(p for p, _ in own)), own) for own in sections]
    # The root also covers the text itself, so that equal roots mean equal texts whatever the clause digests' length.
    whole = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
    return Tree(_digest(b"root", b"".join(d for d, _ in done) + whole), done)


def _unmatched(mine: list[tuple], theirs: list[tuple]) -> tuple[list, list]:
    """Children of two nodes whose digests have no partner on the other side."""
    a, b = Counter(d for d, _ in mine), Counter(d for d, _ in theirs)
    both = a & b
    left, right = Counter(both), Counter(both)
    out = []
    for nodes, budget in ((mine, left), (theirs, right)):
        rest = []
        for digest, children in nodes:
            if budget[digest] > 0:
                budget[digest] -= 1
            else:
                rest.append((digest, children))
        out.append(rest)
    return out[0], out[1]


def likeness(a: Tree, b: Tree) -> float:
    """Share of clauses the trees have in common (twice the common ones over all), 1 for equal roots.

    Only sections, and in them paragraphs, that differ are opened.
    """
    if a.root == b.root:
        return 1.0
    n, m = sum(len(x) for _, p in a.sections for _, x in p), sum(len(x) for _, p in b.sections for _, x in p)
    if not n or not m:
        return 0.0
    mine, theirs = _unmatched(a.sections, b.sections)
    mine, theirs = _unmatched([p for _, own in mine for p in own], [p for _, own in theirs for p in own])
    rest_a, rest_b = Counter(x for _, leaves in mine for x in leaves), Counter(x for _, leaves in theirs for x in leaves)
    common = (n - rest_a.total()) + (rest_a & rest_b).total()
    return min(1.0, 2.0 * common / (n + m))


def edited_clauses(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Where ``b`` differs from ``a``: (section, paragraph) places in ``b`` of paragraphs without a partner in ``a``."""
    known = Counter(d for _, own in a.sections for d, _ in own)
    out = []
    for i, (_, own) in enumerate(b.sections):
        for j, (d, _) in enumerate(own):
            if known[d] > 0:
                known[d] -= 1
            else:
                out.append((i, j))
    return out


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many first code points of the next one, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_places)`` per row.

    The next document is the next row in ascending order of id, then of the text's hash (repeated rows follow each
    other), and after the last row the first. Rows without an id come before all others, ordered by the hash. Null
    texts count as empty. A single row is its own next. ``edited_places`` locates the edit: the ``section.paragraph``
    places (from 0) of the first and the last paragraph of the edited text that the text has not, empty if there is none.

    Rows go to ranges of (id, hash) once; the first row of every range also goes to the end of the range before, so each
    range is walked by itself with two texts in memory. A frequent id spreads over ranges; only rows that are equal in
    id and text share one, where they stream by.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("place_in_id", text_order())
    parts = range_count(docs.sparkSession)
    starts = range_starts(rows.select("doc_id"), "doc_id", parts)
    part = rows.withColumn("part", range_number(F.col("doc_id"), F.col("place_in_id"), starts))
    # The least row of every range: one small row per range.
    found = part.groupBy("part").agg(F.min(F.struct("doc_id", "place_in_id")).alias("m")).orderBy("part").collect()
    first = [(r["part"], r["m"]["doc_id"], r["m"]["place_in_id"]) for r in found]
    # One row of three numbers per range: small enough to send to every task.
    leads = docs.sparkSession.createDataFrame([(number, at, (at - 1) % len(first), doc_id, h) for at, (number, doc_id, h) in enumerate(first)],
                                              "part int, place int, ahead int, lead_id bigint, lead_hash bigint")
    dealt = part.join(F.broadcast(leads), "part")
    is_lead = F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col("place_in_id") == F.col("lead_hash"))
    own, ahead = (F.struct(F.col(p).alias("place"), F.lit(last).alias("last")) for p, last in (("place", 0), ("ahead", 1)))
    dealt = dealt.select(F.explode(F.when(is_lead, F.array(own, ahead)).otherwise(F.array(own))).alias("p"), "doc_id", "place_in_id", "text")
    walk = dealt.select("p.place", "p.last", "doc_id", "place_in_id", "text").repartitionById(max(1, len(first)), F.col("place"))
    walk = walk.sortWithinPartitions("last", F.col("doc_id").asc_nulls_first(), "place_in_id", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_places"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]

    def run(batches):
        held = None
        for batch in batches:
            out = []
            for last, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                tree = merkle_tree(text)
                if held is not None and not held[2]:
                    out.append(_compared(*held[:2], text, tree))
                held = ((doc_id, text), tree, last)
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return map_batches(walk.select("last", "doc_id", "text"), run,
                       "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_places string")


def _compared(own: tuple, tree: Tree, following: str, next_tree: Tree) -> tuple:
    doc_id, text = own
    changed = edited(text, following)
    changed_tree = merkle_tree(changed)
    places = [f"{i}.{j}" for i, j in edited_clauses(tree, changed_tree)]
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), tree.fingerprint(), changed_tree.fingerprint(),
            likeness(tree, changed_tree), likeness(tree, next_tree), "-".join((places[0], places[-1])) if places else "")
