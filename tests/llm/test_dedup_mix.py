from collections import defaultdict

import numpy as np

from vigiframe.llm import op2_raking as rak
from vigiframe.llm import op7_dart_minhash as dart
from vigiframe.llm.components import connected_components
from vigiframe.llm.shingles import jaccard, shingle_sets, word_hashes


def plain_set(text, n=5):
    w = text.lower().encode().split()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def plain_classes(rows):
    sets = {i: plain_set(t) for i, t in rows}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in sets.items():
        for j in {j for x in s for j in where[x] if j < i}:
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in sets}


def test_classes_match_all_pairs(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()
    rows += [(100_000 + i, " ".join([*base * 3, *(f"w{k}" for k in range(i)), "end"])) for i in range(12)]
    got = dart.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == plain_classes(rows)


def test_repeated_passages_stay_links(spark):
    """Sets are alike although one text has a passage 2 to 10 times: weighted bands alone lose most of these pairs."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(40):
        passage = " ".join(f"w{x}" for x in rng.integers(0, 5000, 200))
        rows += [(2 * i, passage), (2 * i + 1, " ".join([passage] * (2, 3, 5, 10)[i % 4]))]
    got = {r.doc_id: r.class_id for r in dart.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == plain_classes(rows) == {i: i - i % 2 for i in range(80)}


def test_a_text_without_repeats_has_one_hash_per_band(spark):
    rows = [(b"a", "a b c d e f g"), (b"b", "a b c d e f g " * 3), (b"c", "")]
    got = {bytes(r.key): r.bands for r in dart.signatures(spark.createDataFrame(rows, "key binary, text string")).collect()}
    assert len(got[b"a"]) == dart.BANDS and dart.BANDS < len(got[b"b"]) == len(set(got[b"b"])) <= 2 * dart.BANDS and got[b"c"] is None


def test_blocks_link_what_the_centre_missed(spark):
    """A chain of texts in one bucket: neighbours are alike, the ends are not."""
    words = [f"w{i}" for i in range(300)]
    texts = {i: " ".join(words[12 * i:12 * i + 150]) for i in range(8)}
    key = {i: bytes([i]) * 16 for i in texts}
    members = spark.createDataFrame([(1, key[i], 146, key[i], key[3]) for i in texts], "hash bigint, key binary, n int, root binary, top binary")
    table = spark.createDataFrame([(key[i], t) for i, t in texts.items()], "key binary, text string")
    got = {tuple(x[0] for x in (bytes(r.a), bytes(r.b))) for r in dart.linked_in_blocks(members, table).collect()}
    assert got == {(i, i + 1) for i in range(7)}


def test_tiles_of_a_large_bucket_meet_every_pair_once(spark, monkeypatch):
    """A bucket cut into many blocks and pieces gives the links that all pairs give."""
    monkeypatch.setattr(dart, "TILE_ROWS", 7)
    monkeypatch.setattr(dart, "TILE_SHINGLES", 900)
    rng = np.random.default_rng(5)
    texts = {}
    for i in range(60):
        words = [f"w{i % 12}x{k}" for k in range(120)]
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            words[at] = f"new{i}x{at}"
        texts[i] = " ".join(words)
    key = {i: bytes([i]) * 16 for i in texts}
    members = spark.createDataFrame([(h, key[i], 116, key[i], key[0]) for i in texts for h in (1, 2)], "hash bigint, key binary, n int, root binary, top binary")
    table = spark.createDataFrame([(key[i], t) for i, t in texts.items()], "key binary, text string")
    got = {(bytes(r.a)[0], bytes(r.b)[0]) for r in dart.linked_in_blocks(members, table).collect()}
    sets = {i: plain_set(t) for i, t in texts.items()}
    want = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert got == want and len(want) > 40


def test_shingle_index_counts():
    sets = [np.array(x, np.uint64) for x in ([1, 4, 9], [], [4, 5], [2])]
    index = dart.ShingleIndex(sets)
    assert index.shared(np.array([0, 4, 9, 11], np.uint64)).tolist() == [2, 0, 1, 0] and index.shared(np.array([7], np.uint64)).tolist() == [0] * 4


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    items = rng.integers(1, 1 << 62, 400, dtype=np.uint64)
    a, b = np.sort(items[:300]), np.sort(items[100:])
    sig = dart.dart_signatures([(a, np.ones(300, int)), (b, np.ones(300, int)), (a, np.ones(300, int)), (a[:0], np.ones(0, int))], 2048)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.05 and (sig[0] == sig[2]).all() and not sig[3].any()
    heavy = np.where(np.arange(300) < 100, 20, 1)
    w1, w2 = dict(zip(a.tolist(), 1 + np.log(heavy))), dict.fromkeys(a.tolist(), 1.0)
    want = sum(min(w1[x], w2[x]) for x in w1) / sum(max(w1[x], w2[x]) for x in w1)
    sig = dart.dart_signatures([(a, heavy), (a, np.ones(300, int))], 2048)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.05


def test_word_hashes_follow_words():
    h, at = word_hashes(["a b a", "", "B\x0bA", "x" * 3_000_000 + " a"])
    assert h[0] == h[2] == h[4] == h[-1] and h[1] == h[3] and at.tolist() == [0, 3, 3, 5, 7]
    (e, n), = shingle_sets(["a b c d e a b c d e"])
    assert n.sum() == 6 and len(e) == 5 and jaccard(e, e) == 1.0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 50), (70, 70)], "a int, b int")
    assert {r.node: r.root for r in connected_components(edges).collect()} == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50}


def test_keep_one_on_odd_rows(odd_docs, no_docs):
    got = dart.keep_one(odd_docs)
    assert got.columns == odd_docs.columns
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in got.collect()) == [-1, -1, 0, 1, 2, 3, 4, 6, 7]
    assert dart.keep_one(no_docs).count() == 0


def plain_raking(cells, mass):
    """Raking by turns over a dictionary of cells."""
    power = {s: m ** rak.SOURCE_POWER for s, m in mass.items()}
    targets = [{s: p / sum(power.values()) for s, p in power.items()}, None, None]
    for axis, shares in ((1, rak.LANGUAGES), (2, {k: v for k, (_, v) in rak.TOPICS.items()})):
        have = {c[axis] for c in cells}
        targets[axis] = {k: v / sum(shares[h] for h in have) for k, v in shares.items() if k in have}
    w = {c: n / sum(cells.values()) for c, n in cells.items()}
    for _ in range(3000):
        for axis in range(3):
            sums = defaultdict(float)
            for c, x in w.items():
                sums[c[axis]] += x
            w = {c: x * targets[axis][c[axis]] / sums[c[axis]] for c, x in w.items()}
    return {c: x / cells[c] for c, x in w.items()}


def test_raking_meets_marginals_and_budget(docs):
    got = rak.calibrate(docs).toPandas()
    cells, mass = defaultdict(float), defaultdict(float)
    for r in got.itertuples():
        cells[(r.source, r.lang, r.topic)] += r.tokens
        mass[r.source] += r.tokens
    want = plain_raking(dict(cells), dict(mass))
    for r in got.itertuples():
        assert abs(r.weight - want[(r.source, r.lang, r.topic)]) < 1e-3 * max(want.values())
    assert abs((got.tokens * got.probability).sum() / got.tokens.sum() - rak.BUDGET) < 1e-6
    assert (got.tokens == [len(t.encode().split()) for t in got.merge(docs.select("doc_id", "text").toPandas(), on="doc_id").text]).all()


def test_sampling_odd_rows(odd_docs, no_docs):
    got = rak.sample(odd_docs)
    assert got.columns == odd_docs.columns and not [r for r in got.collect() if not (r.text or "").split()]
    assert rak.sample(no_docs).count() == 0 and rak.calibrate(no_docs).count() == 0
    assert rak.calibrate(odd_docs).count() == odd_docs.count()


def test_impossible_targets_end_with_their_error(spark):
    """English stands in one topic only and all else in another: the shares asked for can't be met together."""
    rows = [(i, "plain words of it " * 5, "en", "a") for i in range(50)] + [(100 + i, "licensed under it " * 5, "de", "b") for i in range(50)]
    df = rak.calibrate(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"))
    errors = {r.raking_error for r in df.collect()}
    assert len(errors) == 1 and errors.pop() > 0.01
    possible = [(i, "plain words of it " * 5, lang, "a") for i, lang in enumerate(["en", "de", "fr", "es"] * 20)]
    df = rak.calibrate(spark.createDataFrame(possible, "doc_id bigint, text string, lang string, source string"))
    assert {r.raking_error < rak.TOLERANCE for r in df.collect()} == {True}
