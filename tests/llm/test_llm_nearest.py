import math

import numpy as np
import pytest

from tidemark.llm import nearest as N


def brute(rows, k, every):
    """(query, rank, vec_id, score) of all pairs; ids are different."""
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in whole:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("shape", ["spread", "lumps", "ties", "line"])
def test_dual_tree_against_all_scores(shape):
    random = np.random.default_rng(4)
    n = 3000
    vectors = {
        "spread": lambda: random.normal(size=(n, 16)) * 256,
        "lumps": lambda: random.normal(size=(20, 16))[random.integers(0, 20, n)] * 256 + random.normal(size=(n, 16)) * 3,
        "ties": lambda: random.integers(-1, 2, (n, 3)),
        "line": lambda: np.outer(np.arange(n), np.ones(4)),
    }[shape]()
    vectors = np.floor(vectors).astype(np.int64)
    ids = random.permutation(n)
    ask = ids % 10 == 0
    best, named = N.top_k(vectors[ask], ids[ask], vectors, ids, 5)
    scores = vectors[ask] @ vectors.T
    scores[ids[ask][:, None] == ids[None, :]] = -(1 << 62)
    for row in range(int(ask.sum())):
        order = np.lexsort((ids, -scores[row]))[:5]
        assert best[row].tolist() == scores[row, order].tolist() and named[row].tolist() == ids[order].tolist()


def test_lumps_are_pruned(monkeypatch):
    """Tight groups far apart: most pairs of leaves are never counted out."""
    random, counted = np.random.default_rng(5), []
    vectors = (random.normal(size=(40, 8)) * 5000)[np.repeat(np.arange(40), 100)] + random.normal(size=(4000, 8)) * 5
    vectors = np.floor(vectors).astype(np.int64)
    merge = N._merge
    monkeypatch.setattr(N, "_merge", lambda *a: counted.append(a[3].size) or merge(*a))
    N.top_k(vectors[::10], np.arange(0, 4000, 10), vectors, np.arange(4000), 5)
    assert sum(counted) < 0.5 * 400 * 4000


def test_tree_covers_its_vectors():
    vectors = np.random.default_rng(6).normal(size=(500, 3))
    tree = N.CoverTree(vectors)
    assert sorted(tree.order) == list(range(500))
    for centre, radius, (lo, hi), children in zip(tree.centre, tree.radius, tree.range, tree.children):
        assert (np.linalg.norm(vectors[tree.order[lo:hi]] - centre, axis=1) <= radius + 1e-9).all()
        assert not children or sum(tree.range[c][1] - tree.range[c][0] for c in children) == hi - lo


def test_large_numbers_stay_exact():
    a = np.array([[2**30, 1], [2**30, 2]], np.int64)
    best, _ = N.top_k(a, np.array([0, 1]), a, np.array([0, 1]), 1)
    assert best[0, 0] == 2**60 + 2


def test_odd_rows(spark, monkeypatch):
    rows = [(i, [float((i * 7 + j * 3) % 5) / 4 - 0.5 for j in range(4)]) for i in range(30)]
    rows += [(50, None), (100, [1.0, None, 0.0, 0.0]), (60, [float("nan"), 1.0, 1.0, 1.0]), (70, [float("inf")] * 4), (None, [1.0] * 4), (40, [])]
    frame = lambda r: spark.createDataFrame(r, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in N.nearest(frame(rows).selectExpr("*", "1 as score", "2 as _q"), "vec_id % 10 = 0").collect())
    assert got == brute([(i, v if v != [] else [0.0] * 4) for i, v in rows], 5, 10)
    assert N.nearest(frame([]), "vec_id % 10 = 0").collect() == []
    assert N.nearest(frame([(0, [1.0])]), "vec_id % 10 = 0").collect() == []
    twice = sorted(tuple(r) for r in N.nearest(frame([(0, [1.0]), (0, [1.0]), (1, [1.0]), (1, [1.0])]), "vec_id = 0").collect())
    assert twice == [(0, 1, 1, 65536)]


def test_blocks_give_the_same(spark, monkeypatch):
    rows = [(i, [math.sin(i * (j + 1)) for j in range(6)]) for i in range(120)]
    for name in ("QUERY_BLOCK", "CANDIDATE_BLOCK"):
        monkeypatch.setattr(N, name, 17)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert sorted(tuple(r) for r in N.nearest(frame, "vec_id % 4 = 0", 3).collect()) == brute(exact, 3, 4)


def test_every_tree_has_leaves(monkeypatch):
    """Also of vectors without structure; then little is cut off, but what is answers the same (see above)."""
    vectors = np.random.default_rng(7).normal(size=(3000, 32))
    tree = N.CoverTree(vectors)
    leaves = [hi - lo for (lo, hi), c in zip(tree.range, tree.children, strict=True) if not c]
    assert len(leaves) > 20 and max(leaves) <= N.LEAF and sum(leaves) == 3000
