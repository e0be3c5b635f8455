"""Word hashes and word shingles of texts as arrays."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        table = np.full(max(n, _BLOCK + 1), base, np.uint64)
        table[0] = 1
        _powers[name] = table = np.cumprod(table, dtype=np.uint64)
    return table[:n]


def _block_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the whitespace-separated words of one block of bytes."""
    word = np.concatenate(([False], ~_SPACE[buf], [False]))
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _power("base", _BASE, len(buf)), out=sums[1:])
    h = (sums[end] - sums[start]) * _power("inverse", _INVERSE, len(buf) + 1)[start]
    return mix(h + (end - start).astype(np.uint64)), start


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of the texts, one text after the other, and the texts' offsets in them.

    Words are runs without ASCII white space. A null byte pattern or an empty text has no words. Long input is
    hashed in blocks cut at white space, so memory stays bounded by the block (or the longest word).
    """
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    joined = b"\n".join(raw) + b"\n" if raw else b""
    buf = np.frombuffer(joined, np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(buf):
        stop = min(len(buf), at + _BLOCK)
        if stop < len(buf):
            cut = max(joined.rfind(b" ", at, stop), joined.rfind(b"\n", at, stop))
            if cut < 0:
                ends = [p for p in (joined.find(b" ", stop), joined.find(b"\n", stop)) if p >= 0]
                cut = min(ends, default=len(buf) - 1)
            stop = cut + 1
        h, s = _block_words(buf[at:stop])
        hashes.append(h)
        starts.append(s + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), begins)


def shingle_sets(texts: list[str], words: int = SHINGLE_WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct shingle hashes in ascending order, and how often each occurs.

    A text of fewer than ``words`` words (but at least one) has a single shingle of all its words.
    """
    h, at = word_hashes(texts)
    salts = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(words):
        rolled += h[k:k + n] * salts[k]
    rolled = mix(rolled)
    out = []
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if b - a >= words:
            s = np.sort(rolled[a:b - words + 1])
            first = np.concatenate(([True], s[1:] != s[:-1]))
            where = np.flatnonzero(first)
            out.append((s[where], np.diff(np.append(where, len(s)))))
        elif b > a:
            one = mix((h[a:b] * salts[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            out.append((one, np.ones(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two ascending arrays of distinct values (0 if either is empty)."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)
