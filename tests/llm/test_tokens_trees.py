import bisect
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigiframe.llm import op3_unigram as uni
from vigiframe.llm import op9_merkle as tree
from vigiframe.llm import op10_pfor as pfor
from vigiframe.llm import ordering
from vigiframe.llm.registry import piece_vocabulary, tokenizer_file

WORDS = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return uni.load_vocabulary(piece_vocabulary())


def plain_path(v, words, text):
    if not text:
        return []
    t = uni.MARKER + text.replace(" ", uni.MARKER)
    best, back = [0.0] + [-1e18] * len(t), [None] * (len(t) + 1)
    for p in range(len(t)):
        for q in range(p + 1, min(len(t), p + 20) + 1):
            k = words.get(t[p:q].encode())
            s = v.scores[k] if k is not None else v.unknown if q == p + 1 else None
            if s is not None and best[p] + s > best[q]:
                best[q], back[q] = best[p] + s, (p, k)
    out, at = [], len(t)
    while at:
        p, k = back[at]
        out[:0] = [k] if k is not None else [int(v.byte_ids[b]) for b in t[p:at].encode()]
        at = p
    return out


def test_paths_and_round_trip(vocabulary):
    v, rng = vocabulary, random.Random(1)
    words = {p: i for i, p in enumerate(v.pieces) if p and i not in set(v.byte_ids.tolist())}
    texts = ["", "a", "  hello  world\n\nfoo ", "é😀ß ▁x", "\t\ttab", "x" * 500 + " y", "naïve\x00null", "  "]
    texts += ["".join(rng.choice("abcthe \n  éñ😀中文ing▁.,0") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    encoder = uni.Encoder(v, known=50)
    for at in range(0, len(texts), 16):
        for t, ids in zip(texts[at:at + 16], encoder.encode(texts[at:at + 16]), strict=True):
            assert np.frombuffer(ids, "<i4").tolist() == plain_path(v, words, t)
            assert encoder.decode(ids) == t.replace(uni.MARKER, " ")


def test_double_array_holds_its_words():
    rng = random.Random(2)
    words = {bytes(rng.randrange(256) for _ in range(rng.randint(1, 6))): i for i in range(3000)}
    base, check, value = uni.double_array(words)
    for word, number in words.items():
        state = 0
        for c in word:
            to = base[state] + c
            assert check[to] == state
            state = to
        assert value[state] == number


def test_piece_rows(odd_docs, no_docs, docs):
    got = uni.digest(odd_docs, piece_vocabulary()).collect()
    assert len(got) == odd_docs.count() and all(r.round_trip for r in got) and uni.digest(no_docs, piece_vocabulary()).count() == 0
    rows = uni.encode_documents(docs, piece_vocabulary())
    back = uni.decode(rows, piece_vocabulary()).join(docs.select("doc_id", "text"), "doc_id")
    assert back.where("decoded <> text").count() == 0 and rows.where("n_pieces <> size(piece_ids)").count() == 0


def test_blocks_round_trip():
    rng = random.Random(3)
    for n in (1, 2, 5, 127, 128):
        for pick in (lambda: rng.randrange(50_000), lambda: rng.choice([5, 6, 7, 2 ** 32 - 1, 0]), lambda: 7, lambda: rng.choice([1] * 30 + [40_000])):
            ids = np.array([pick() for _ in range(n)], np.uint64)
            raw, = pfor.encode_blocks(ids[None, :])
            assert (pfor.decode_blocks(b"xx" + raw, np.array([2])) == ids).all() and len(raw) <= 8 + 4 * n + 4
    few = np.array([[3] * 126 + [2 ** 31] * 2], np.uint64)
    assert len(pfor.encode_blocks(few)[0]) == 8 + 2 * 5
    many = np.array([[rng.choice([1, 9, 500, 49_000]) >> (i % 7) for _ in range(128)] for i in range(300)], np.uint64)
    raw = pfor.encode_blocks(many)
    assert (pfor.decode_blocks(b"".join(raw), np.cumsum([0, *map(len, raw[:-1])])) == many.ravel()).all()


def test_tokenizer_equals_library():
    rng, library, own = random.Random(4), Tokenizer.from_file(WORDS), pfor.Tokenizer(WORDS, known=20)
    texts = ["It's THE İstanbul naïve's Éá x́ ́y 中文 ½ ² ª '' \"'s don't 'S <|endoftext|> a", "a\x0bb\x0cc\x1cd\x85e\xa0f g", "ΣΑΣ ς Σ", "", "rock'n'roll ’s"]
    texts += ["".join(rng.choice("abé ÉZ'sdt.,#1 \n\tñß中²") for _ in range(50)) for _ in range(500)]
    for t in texts:
        assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def assert_stream(rows, got, library):
    """The files hold every row once, in ascending order of id (null first), without a gap."""
    want = [(i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t in rows]
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((i, len(ids), zlib.crc32(ids.tobytes())) for i, ids in want), key=key) == sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key)
    stream = sorted(got, key=lambda r: r.start)
    assert [key((r.doc_id,)) for r in stream] == sorted(key((i,)) for i, _ in rows)
    assert [r.start for r in stream] == np.cumsum([0, *[r.n_tokens for r in stream]])[:-1].tolist()


@pytest.fixture(scope="module")
def hot_docs(spark):
    """One id and null hold a third of the rows each; the least id there is, repeated rows, and texts of all kinds."""
    rng = random.Random(9)
    ids = [7] * 300 + [None] * 300 + [-(1 << 63), (1 << 63) - 1] + list(range(100, 398))
    rows = [(i, " ".join(rng.choice(["one", "two", "three", "Four.", "\n"]) for _ in range(rng.randint(0, 40)))) for i in ids]
    return spark.createDataFrame(rows + rows[:5] + [(7, None)], "doc_id bigint, text string").repartition(4).cache()


def test_frequent_ids_spread_over_ranges(hot_docs, no_docs):
    for parts in (1, 16, 3000):
        starts = ordering.range_starts(hot_docs, "doc_id", parts)
        key = [(i is not None, i or 0, c) for i, c in starts]
        assert key == sorted(set(key)) and len(starts) <= 1.5 * parts + 3
        rows = hot_docs.select("doc_id", ordering.text_order().alias("h")).withColumn("n", ordering.range_number(F.col("doc_id"), F.col("h"), starts)).collect()
        for r in rows:
            assert r.n == max(0, bisect.bisect_right(key, (r.doc_id is not None, r.doc_id or 0, r.h)) - 1)
        if parts == 16:
            assert max(Counter(r.n for r in rows).values()) < 3 * len(rows) / parts
    assert ordering.range_starts(no_docs, "doc_id", 8) == []


def test_frequent_ids_in_files_and_trees(hot_docs):
    rows = [(r.doc_id, r.text) for r in hot_docs.collect()]
    assert_stream(rows, pfor.digest(hot_docs, WORDS).collect(), Tokenizer.from_file(WORDS))
    hashes = {r.text: r.h for r in hot_docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = Counter((i, hashlib.sha256(tree.edited(t or "", nxt or "").encode()).hexdigest()) for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True))
    got = tree.fingerprints(hot_docs).collect()
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_files_hold_the_stream_in_order(docs, odd_docs, no_docs):
    library = Tokenizer.from_file(WORDS)
    for table in (docs, odd_docs):
        assert_stream([(r.doc_id, r.text) for r in table.collect()], pfor.digest(table, WORDS).collect(), library)
    assert pfor.digest(no_docs, WORDS).count() == 0


def test_trees():
    text = "One, two. Three four; five!\nSix seven.\n\nEight nine ten: eleven.\nTwelve."
    a, b = tree.merkle_tree(text), tree.merkle_tree(text.replace("Eight", "Ten"))
    assert tree.likeness(a, tree.merkle_tree(text)) == 1.0 and 0.5 < tree.likeness(a, b) < 1.0 and a.fingerprint() != b.fingerprint()
    assert [b.sections[i][1][j] for i, j in tree.edited_clauses(a, b)] == [p for _, own in b.sections for p in own if p not in [q for _, o in a.sections for q in o]]
    assert tree.likeness(a, tree.merkle_tree("")) == 0.0 and tree.merkle_tree(text + " ").root != a.root


def test_edits_follow_the_next_document(docs, odd_docs, no_docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in tree.fingerprints(docs).collect()}
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        changed = t[:len(t) - half] + following[:half]
        a, b = tree.merkle_tree(t), tree.merkle_tree(changed)
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and got[i].n_chars == len(t)
        places = tree.edited_clauses(a, b)
        assert got[i].edited_places == (f"{places[0][0]}.{places[0][1]}-{places[-1][0]}.{places[-1][1]}" if places else "")
        assert got[i].fingerprint == a.fingerprint() and got[i].edited_fingerprint == b.fingerprint()
        n = a.leaves() + b.leaves()
        rest = list(b.leaves())
        common = sum(1 for x in a.leaves() if x in rest and not rest.remove(x))
        assert abs(got[i].near_edited - (1.0 if a.root == b.root else 2 * common / len(n) if n else 1.0)) < 1e-12
    assert tree.fingerprints(odd_docs).count() == odd_docs.count() and tree.fingerprints(no_docs).count() == 0


def test_texts_of_any_script_have_many_leaves():
    rng = np.random.default_rng(5)
    letters = lambda n, low, high: "".join(map(chr, rng.integers(low, high, n)))
    logs = " ".join(letters(int(k), 97, 123) for k in rng.integers(2, 9, 400))
    chinese = "。".join(letters(30, 0x4E00, 0x9FA5) for _ in range(60))
    arabic = "؟ ".join(letters(30, 0x627, 0x64A) for _ in range(60))
    hindi = "। ".join(letters(30, 0x905, 0x939) for _ in range(60))
    for text in (logs, chinese, arabic, hindi, letters(2000, 0xE01, 0xE2E), "a" * 5000, ", ".join(["word"] * 50) + " " + logs):
        a = tree.merkle_tree(text)
        assert len(a.leaves()) >= 9 and "".join(tree.clauses(text)) == text
        changed = tree.merkle_tree(tree.edited(text, letters(3000, 0x410, 0x44F)))
        assert 0.2 < tree.likeness(a, changed) < 0.8
    assert tree.likeness(tree.merkle_tree(logs), tree.merkle_tree(letters(7, 97, 123) + logs)) > 0.9
    clause = letters(160, 97, 123)
    a, b = tree.merkle_tree(clause), tree.merkle_tree(clause + "x")
    assert len(a.leaves()) > 1 and a.leaves()[:-1] == b.leaves()[:len(a.leaves()) - 1]
    assert tree.clauses("One, two. Three") == ["One, ", "two. ", "Three"]
