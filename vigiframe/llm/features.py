"""Cheap text measures shared by the quality operators: counts by byte class and fixed word lists."""

from __future__ import annotations

import numpy as np

# Frequent function words of the corpus languages (English, German, French, Spanish).
STOP_WORDS = frozenset("""
a an and are as at be by for from has he in is it its not of on or that the this to was what were which will with you
als auch auf aus bei das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu zum
au avec ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui se sur un une
al como con de del el en es la las lo los más no para pero por que se su un una y
""".split())
SYMBOLS = b"#*$%&|<>~^=_{}[]\\"
_OTHER_THAN_SYMBOLS = bytes(i for i in range(256) if i not in SYMBOLS)
_OTHER_THAN_UPPER = bytes(i for i in range(256) if not 65 <= i <= 90)
_OTHER_THAN_LOWER = bytes(i for i in range(256) if not 97 <= i <= 122)
_OTHER_THAN_DIGIT = bytes(i for i in range(256) if not 48 <= i <= 57)


def symbol_count(raw: bytes) -> int:
    return len(raw.translate(None, _OTHER_THAN_SYMBOLS))


def upper_count(raw: bytes) -> int:
    return len(raw.translate(None, _OTHER_THAN_UPPER))


def lower_count(raw: bytes) -> int:
    return len(raw.translate(None, _OTHER_THAN_LOWER))


def digit_count(raw: bytes) -> int:
    return len(raw.translate(None, _OTHER_THAN_DIGIT))


def stop_words(words: list[str]) -> int:
    return sum(map(STOP_WORDS.__contains__, words))


def equal_neighbours(words: list) -> int:
    """How many words equal the word before them."""
    return sum(map(str.__eq__, words, words[1:]))


def longest_run(words: list) -> int:
    """Length of the longest run of equal words."""
    most = run = 1 if words else 0
    if not any(map(str.__eq__, words, words[1:])):
        return most
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        most = max(most, run)
    return most


def hashed_grams(raw: bytes, bits: int, size: int = 4, block: int = 1 << 20) -> np.ndarray:
    """Counts of the hashed byte ``size``-grams of a text (2 ** bits buckets), counted in blocks."""
    counts = np.zeros(1 << bits, np.float64)
    for at in range(0, len(raw) - size + 1, block):
        part = np.frombuffer(raw[at:at + block + size - 1], np.uint8).astype(np.uint32)
        n = len(part) - size + 1
        key = np.zeros(n, np.uint32)
        for k in range(size):
            key = key * np.uint32(257) + part[k:k + n]
        key = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
        counts += np.bincount(key, minlength=1 << bits)
    return counts
