"""Operators on embeddings against brute force, numpy's own solver and SQL."""

import math
import random

import duckdb
import numpy as np
import pytest

from vigiframe.llm import op11_collision_ann, op12_strassen_negatives, op13_qdwh_whitening, vectors
from vigiframe.llm.common import read_table
from vigiframe.llm.registry import ORACLE

SMALL = "/root/testdata/sf0.001"
SCHEMA = ("vec_id bigint, embedding array<float>, label int, query_id string, rank string, score string, vector string, _tile string, anchor_key string, "
          "n string, component string, label_ string")
CLASH = ("q", "r", "s", "v", "t", "a", "n", "c", "l")


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, *CLASH) for i, v, label in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Ties, copies, a third of the rows alike, nulls everywhere, zero, empty and short vectors, repeated ids."""
    rng = random.Random(3)

    def some():
        return [float(np.float32(rng.gauss(0, 1))) for _ in range(8)]

    hot, rows = some(), []
    for i in range(240):
        rows.append((i, hot if i % 3 == 1 else some(), rng.randrange(4)))
    rows += [(300, None, 1), (301, [0.0] * 8, 2), (302, [], 3), (303, [1.0, None] + [0.0] * 6, 1), (304, [float("nan")] + [1.0] * 7, 1),
             (305, [float("inf")] + [1.0] * 7, 1), (350, some(), None), (None, some(), 1), (None, None, None), (400, hot[:3], 1), (401, hot[:3], 2),
             (100, rows[100][1], rows[100][2]), (100, some(), 3), (7, rows[7][1], rows[7][2]), (450, [-2 * x for x in hot], 1)]
    return rows


def takes_part(v, zero=False):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(x != 0 for x in v))


def plain_nearest(rows):
    kept = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and takes_part(v)]
    out, asked = [], set()
    for q, u in kept:
        if q % 50 or (q, u.tobytes()) in asked:
            continue
        asked.add((q, u.tobytes()))
        scores = sorted((-float((u * v).sum() / (math.sqrt((u * u).sum()) * math.sqrt((v * v).sum()))), i) for i, v in kept if i != q and len(v) == len(u))
        out.append((q, [(i, -s) for s, i in scores[:5]]))
    return out


def found_by(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return groups


def test_nearest_on_odd_rows(spark, odd_rows):
    df = op11_collision_ann.nearest(table(spark, odd_rows))
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got, want = found_by(df), {}
    for q, near in plain_nearest(odd_rows):
        want.setdefault(q, []).extend((k + 1, i, s) for k, (i, s) in enumerate(near))
    assert set(got) == set(want)                    # 100 asks twice, with two vectors
    for q in want:
        assert len(got[q]) == len(want[q])
        # So few rows that windows soon cover them: nothing may be missed here, ties included.
        for (k, i, s), (wk, wi, ws) in zip(sorted(got[q]), sorted(want[q])):
            assert k == wk and math.isclose(s, ws, abs_tol=1e-12)
            assert i == wi or len(got[q]) > 5


def test_recall_and_scores_on_all_queries(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding, None) for r in df.collect()]
    got, hit, total = found_by(op11_collision_ann.nearest(df)), 0, 0
    by_id = {i: np.array(v, float) for i, v, _ in rows}
    for q, near in plain_nearest(rows):
        mine = sorted(got[q])
        assert [k for k, _, _ in mine] == [1, 2, 3, 4, 5]
        assert mine == sorted(mine, key=lambda t: (-t[2], t[1]))
        for _, i, s in mine:
            u, v = by_id[q], by_id[i]
            assert math.isclose(s, u @ v / math.sqrt(u @ u) / math.sqrt(v @ v), abs_tol=1e-14)
        hit, total = hit + len({i for i, _ in near} & {i for _, i, _ in mine}), total + len(near)
    assert hit / total >= 0.95


def test_search_counts_what_recounting_counts():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((700, 16))
    index = op11_collision_ann.SortedProjections(x, np.arange(700))
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    places, least = unit @ index.lines, op11_collision_ann.threshold()
    for q in range(0, 700, 70):
        radius, seen = op11_collision_ann.FIRST_RADIUS, set()
        while True:
            counts = (np.abs(places - places[q]) <= op11_collision_ann.WIDTH * radius / 2).sum(axis=1)
            seen = {int(i) for i in np.flatnonzero(counts >= least)} - {q}
            best = sorted(((-(unit[i] @ unit[q]), i) for i in seen))[:5]
            if len(seen) == 699 or len(best) == 5 and math.sqrt(max(0, 2 + 2 * best[-1][0])) <= radius:
                break
            radius *= op11_collision_ann.GROWTH
        ids, _ = index.search(x[q], q)
        assert list(ids) == [i for _, i in best]


def test_huge_and_tiny_vectors_have_cosines():
    x = np.array([[1e200, 1e200], [1e-200, 1e-200], [1.0, -1.0], [3e307, 0.0]])
    ids, score = op11_collision_ann.SortedProjections(x, np.arange(4)).search(np.array([1e250, 1e250]), -1)
    assert list(ids) == [0, 1, 3, 2] and np.allclose(score, [1, 1, math.sqrt(0.5), 0])


def plain_mine(rows):
    kept = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and takes_part(v, zero=True)]
    out, asked = [], set()
    for a, label, u in kept:
        if a % 100 or (a, label, tuple(u)) in asked:
            continue
        asked.add((a, label, tuple(u)))
        scored = [(-sum(x * y for x, y in zip(u, v)), i, other) for i, other, v in kept if i != a and len(v) == len(u)]
        for p, pid, _ in sorted(t for t in scored if t[2] == label)[:5]:
            window = sorted(t[:2] for t in scored if t[2] != label and 80 * -p <= 100 * -t[0] <= 100 * -p)[:5]
            out += [(a, pid, k + 1, i, -p, -n) for k, (n, i) in enumerate(window)]
    return sorted(out)


def test_negatives_on_odd_rows(spark, odd_rows):
    df = op12_strassen_negatives.mine(table(spark, odd_rows))
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert sorted(tuple(r) for r in df.collect()) == plain_mine(odd_rows)


def test_negatives_equal_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    want = sorted(db.execute(ORACLE["op12_strassen_negatives"]).fetchall())
    got = sorted(tuple(r) for r in op12_strassen_negatives.mine(read_table(spark, SMALL, "embeddings")).collect())
    assert got == want and got


def test_more_tiles_change_nothing(spark, odd_rows, monkeypatch):
    """Many shards and blocks: heaps of tiles merge into the same answers."""
    rows = table(spark, odd_rows)
    before = sorted(tuple(r) for r in op12_strassen_negatives.mine(rows).collect())
    near = sorted(tuple(r) for r in op11_collision_ann.nearest(rows).collect())
    monkeypatch.setattr(vectors, "SHARD_ROWS", 30)
    monkeypatch.setattr(vectors, "TILE_PAIRS", 40)
    assert sorted(tuple(r) for r in op12_strassen_negatives.mine(rows).collect()) == before
    assert sorted(tuple(r) for r in op11_collision_ann.nearest(rows).collect()) == near


@pytest.mark.parametrize("a,b,c", [(1, 1, 1), (33, 40, 35), (64, 64, 64), (129, 131, 67), (200, 3, 200), (17, 17, 17)])
def test_strassen_is_exact(a, b, c):
    rng = np.random.default_rng(a)
    x, y = rng.integers(-2**27, 2**27, (a, b)), rng.integers(-2**27, 2**27, (b, c))
    assert (op12_strassen_negatives.strassen(x, y) == x @ y).all()


def test_vectors_too_large_for_longs_fail():
    with pytest.raises(ValueError, match="too large"):
        op12_strassen_negatives.integers(np.array([[1e30, 0.0]]))
    with pytest.raises(ValueError, match="too large"):
        op13_qdwh_whitening.to_integers(np.array([[1e30, 0.0]]))


def check_whitening(rows, got, components=32):
    kept = [(i, v) for i, v, _ in rows if v and takes_part(v, zero=True) and len(v) == 8]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = {}
    for (i, _), row in zip(kept, x):
        deviation.setdefault(i, set()).add(sum((n * a - s) ** 2 for a, s in zip(row, sums)))
    centred = np.array([[float(a) - 1_000_000 for a in row] for row in x])
    centred -= centred.mean(axis=0)
    v = centred.T @ centred / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    whitened = {}
    for (i, _), row in zip(kept, centred @ w / np.sqrt(e)):
        whitened.setdefault(i, []).append(row)
    assert len(got) == n * min(8, components)
    signs = {}
    for r in got:
        assert r.n == n and r.deviation in deviation[r.vec_id] and int(r.deviation_exact) == r.deviation
        assert math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9) and r.identity_error < 1e-9
        near = min(whitened[r.vec_id], key=lambda y: abs(abs(y[r.component - 1]) - abs(r.whitened)))[r.component - 1]
        assert math.isclose(abs(near), abs(r.whitened), abs_tol=1e-8)
        if abs(near) > 1e-3 and len(whitened[r.vec_id]) == 1:
            signs.setdefault(r.component, set()).add(near * r.whitened > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_on_odd_rows(spark, odd_rows):
    check_whitening(odd_rows, op13_qdwh_whitening.whiten(table(spark, odd_rows)).collect())
    check_whitening(odd_rows, op13_qdwh_whitening.whiten(table(spark, odd_rows).repartition(7), components=3).collect(), 3)


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i % 7), 5.0, float(i % 3), float(i % 7 + i % 3)], 0) for i in range(60)]
    got = op13_qdwh_whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 120
    assert op13_qdwh_whitening.whiten(table(spark, [(1, [1.0, 2.0], 0)] * 5)).collect() == []


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [4e9 * i, float(i % 5)], 0) for i in range(50)]
    got = op13_qdwh_whitening.whiten(table(spark, rows)).collect()
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in rows]
    sums = [sum(c) for c in zip(*x)]
    for r in got:
        exact = sum((50 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert int(r.deviation_exact) == exact and r.deviation == (exact if exact < 2**63 else None)
    assert any(r.deviation is None for r in got)


@pytest.mark.parametrize("kind", ["any", "repeated", "rank", "spread", "equal"])
@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
def test_spectral_divide_and_conquer(n, kind):
    rng = np.random.default_rng(n)
    b = rng.standard_normal((n, n))
    q, _ = np.linalg.qr(b)
    a = {"any": b @ b.T, "repeated": q @ np.diag(np.repeat([1.0, 2.0], [n // 2, n - n // 2])) @ q.T, "rank": b[:, : n // 3 + 1] @ b[:, : n // 3 + 1].T,
         "spread": np.diag(10.0 ** -np.arange(n) if n < 12 else np.r_[100.0, np.ones(n - 1)]), "equal": 3 * np.eye(n)}[kind]
    a = (a + a.T) / 2
    e, w = op13_qdwh_whitening.eigen(a)
    size = np.linalg.norm(a)
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * size
    assert np.linalg.norm(a @ w - w * e) < 1e-13 * size and np.abs(w.T @ w - np.eye(n)).max() < 1e-13


def test_polar_factor():
    rng = np.random.default_rng(2)
    for n in (1, 5, 30):
        a = rng.standard_normal((n, n))
        a = a + a.T
        e, w = np.linalg.eigh(a)
        assert np.abs(op13_qdwh_whitening.polar(a) - w @ np.diag(np.sign(e)) @ w.T).max() < 1e-11


def test_empty_tables(spark):
    none = table(spark, [])
    unusable = table(spark, [(1, None, None), (50, [], 1), (None, None, 2)])
    for df in (none, unusable):
        assert op11_collision_ann.nearest(df).collect() == []
        assert op12_strassen_negatives.mine(df).collect() == []
        assert op13_qdwh_whitening.whiten(df).collect() == []


def test_lone_rows(spark):
    one = table(spark, [(100, [1.0, 2.0], 1)])
    assert op11_collision_ann.nearest(one).collect() == [] and op12_strassen_negatives.mine(one).collect() == []
    two = table(spark, [(100, [1.0, 2.0], 1), (101, [1.0, 2.5], 1)])
    assert [(r.query_id, r.vec_id) for r in op11_collision_ann.nearest(two).collect()] == [(100, 101)]


